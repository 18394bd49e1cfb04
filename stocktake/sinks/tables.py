"""Writers: listing, all-accounts and analysis tables, one result set per run id.

Tables are Parquet; a CSV export has text parity to the classic CSV output (timestamps as
``2024-10-14 08:49:01+00:00``, with a fraction only where there is one, booleans as
``True``/``False``) but for texts with line breaks, which are encoded so that each row is a line (see
:func:`stocktake.functions.uri.csv_cell`). Listing writes use dynamic partition overwrite, so writing one account of a
run never touches the other accounts' partitions (accounts may be extracted by separate jobs);
every account that is written needs a row, or its old partition would stay.
"""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.functions.uri import csv_cell, quoted
from stocktake.sources.readers import CSV_DIALECT

# Fixed value: run ids look like 20250519224348 (UTC, year to second).
RUN_ID_FORMAT = "%Y%m%d%H%M%S"

LISTINGS_DIR = "accounts"
ALL_ACCOUNTS_DIR = "all_accounts"
ANALYSIS_DIR = "analysis"
UNMAPPED_DIR = "unmapped_objects"
SUBFOLDERS_DIR = "subfolders"
DUPLICATES_DIR = "duplicate_keys"
RAW_DIR = "raw_entries"
UNLIKE_HASHES_DIR = "unlike_hashes"
# Marks of finished runs: a row written last.
RUNS_DIR = "runs"
RUN_MARK = "committed_at timestamp, tables array<string>"
# CSV exports: the same tables under this folder.
CSV_DIR = "csv"


def new_run_id(now: datetime.datetime | None = None) -> str:
    now = now or datetime.datetime.now(datetime.timezone.utc)
    return now.strftime(RUN_ID_FORMAT)


def _text_of(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(kind, T.TimestampType):
        fraction = F.when(F.unix_micros(c) % 1_000_000 != 0, F.date_format(c, ".SSSSSS")).otherwise(F.lit(""))
        return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), fraction, F.date_format(c, "xxx"))
    return csv_cell(c) if isinstance(kind, T.StringType) else c


def _as_csv_text(df: DataFrame) -> DataFrame:
    return df.select(*[_text_of(quoted(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _save(df: DataFrame, path: str, fmt: str, mode: str, partition_by: list[str]) -> None:
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    out = _as_csv_text(df) if fmt == "csv" else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if fmt == "csv":
        writer.options(header=True, **CSV_DIALECT).csv(path)
    else:
        writer.parquet(path)


def _write(df: DataFrame, path: str, partition_by: list[str], fmt: str, mode: str = "overwrite") -> None:
    _save(df, path, fmt, mode, partition_by)


def write_listing(listing: DataFrame, root: str, run_id: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Listing rows into ``<root>/accounts/run_id=<id>/account=<a>``; overwrite replaces only the accounts written."""
    path = f"{root.rstrip('/')}/{LISTINGS_DIR}"
    _write(listing.withColumn("run_id", F.lit(run_id)), path, ["run_id", "account"], fmt, mode)
    return path


def write_all_accounts(flat: DataFrame, root: str, run_id: str, fmt: str = "parquet") -> str:
    path = f"{root.rstrip('/')}/{ALL_ACCOUNTS_DIR}"
    _write(flat.withColumn("run_id", F.lit(run_id)), path, ["run_id"], fmt)
    return path


def write_analysis(flat: DataFrame, root: str, run_id: str, fmt: str = "parquet") -> str:
    path = f"{root.rstrip('/')}/{ANALYSIS_DIR}"
    _write(flat.withColumn("run_id", F.lit(run_id)), path, ["run_id"], fmt)
    return path


def write_run(df: DataFrame, table_path: str, run_id: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write straight into one run's folder of a table partitioned by ``run_id``.

    ``overwrite`` replaces the whole run folder (also when ``df`` is empty), so a
    retried job never leaves rows of an earlier attempt; ``append`` adds files.
    """
    path = run_path(table_path, run_id)
    _save(df, path, fmt, mode, [])
    return path


def begin_run(spark: SparkSession, root: str, run_id: str) -> None:
    """Take back the mark of an earlier attempt, before any of its tables change."""
    write_run(spark.createDataFrame([], RUN_MARK), table_path(root, RUNS_DIR), run_id)


def commit_run(spark: SparkSession, root: str, run_id: str, tables: list[str]) -> None:
    """Mark a run as finished; call it after its last table is written."""
    mark = spark.range(1).select(F.current_timestamp().alias("committed_at"), F.array(*[F.lit(t) for t in sorted(tables)]).cast("array<string>").alias("tables"))
    write_run(mark.coalesce(1), table_path(root, RUNS_DIR), run_id)


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    """``run_id, committed_at, tables`` of the finished runs under a root (none where nothing was ever begun)."""
    try:
        found = spark.read.schema(f"{RUN_MARK}, run_id string").parquet(table_path(root, RUNS_DIR))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], f"{RUN_MARK}, run_id string")
    return found.select("run_id", "committed_at", "tables")


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def run_path(table_path: str, run_id: str) -> str:
    """Folder of one run inside a table written above."""
    return f"{table_path.rstrip('/')}/run_id={run_id}"
