"""Readers: URI map CSV, rule config JSON, listing tables (parquet/CSV), flattened results."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.functions.uri import from_csv_cell, quoted
from stocktake.operators.rules import RuleConfig
from stocktake.operators.uri_map import ORD, MapFileError
from stocktake.schemas import LISTING, LISTING_CSV_TEXT, LISTING_CSV_WITH_RUN, LISTING_WITH_RUN, RAW_ENTRY, RULE_CONFIG, all_accounts_schema

# The CSV dialect of all listing and result files, the same for reading and writing: quotes are
# doubled, white space is kept. A row of our exports is one line (cells with line breaks are encoded), so their files
# are split among tasks; files of others may hold line breaks in quoted cells, and are one split each then.
CSV_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
CSV_READ = {**CSV_DIALECT, "header": True, "enforceSchema": True}


def _header(spark: SparkSession, path: str) -> list[str]:
    """First line of the map file (one small read), split as CSV; names trimmed."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return []
    line = first[0]["value"].lstrip("\ufeff")  # a byte-order mark is not part of the first name
    return [c.strip() for c in next(csv.reader(io.StringIO(line)))]


def read_uri_map(spark: SparkSession, path: str) -> DataFrame:
    """Wide URI map with a file-order ordinal; header names trimmed, duplicates rejected.

    Column names of the results contain account names and Spark compares them without regard to
    case, so names that differ in case only are rejected as well.
    """
    names = _header(spark, path)
    folded = [n.lower() for n in names]
    if len(set(folded)) != len(names):
        dup = sorted({n for n in names if folded.count(n.lower()) > 1})
        raise MapFileError(f"Duplicated account names: {', '.join(dup)}")
    # Empty header cells keep Spark's `_c<i>` name so that the empty-account check sees them.
    fixed = [n if n else f"_c{i}" for i, n in enumerate(names)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fixed])
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, escape='"')
    return df.select(F.monotonically_increasing_id().alias(ORD), *[quoted(n) for n in fixed])


def read_rule_config_df(spark: SparkSession, path: str) -> DataFrame:
    """One row. Text that is no JSON (a trailing comma, a file cut short) raises when it is read."""
    return spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(RULE_CONFIG).json(path)


def read_rule_config(spark: SparkSession, path: str) -> RuleConfig:
    """Parse the one-row rule config; raises on malformed JSON and on a missing key.

    ``run_analysis`` counts only when it is JSON ``true``.
    """
    rows = read_rule_config_df(spark, path).limit(1).collect()
    keys = spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path).columns
    if not rows or not keys:
        raise ValueError(f"empty rule config: {path}")
    missing = [f for f in RULE_CONFIG.fieldNames() if f not in keys]
    if missing:
        raise ValueError(f"rule config {path} has no {', '.join(missing)}")
    r = rows[0]
    return RuleConfig(
        origin=r["origin"],
        is_hash_the_same_in=list(r["is_hash_the_same_in"] or []),
        can_the_file_exist_in=list(r["can_the_file_exist_in"] or []),
        run_analysis=r["run_analysis"] is True,
    )


def parse_size(c: str = "size"):
    """Text size -> BIGINT; `49.0` (an integer written as float) reads as 49, junk as null."""
    return F.expr(f"try_cast(try_cast({c} as decimal(20,1)) as bigint)")


def parse_date(c: str = "date"):
    return F.expr(f"try_cast({c} as timestamp)")


def _typed_listing(text: DataFrame, account) -> DataFrame:
    return text.select(
        account.alias("account"),
        *[from_csv_cell(c).alias(c) for c in ("bucket", "prefix", "name")],
        parse_date("date").alias("date"),
        parse_size("size").alias("size"),
        from_csv_cell("hash").alias("hash"),
    )


def read_listing_csv(spark: SparkSession, path: str, account: str, multi_line: bool = True) -> DataFrame:
    """One account's listing CSV (``bucket,prefix,name,date,size,hash``) -> long listing rows.

    A file whose every row is a line, as in our exports, is split among tasks with ``multi_line=False``."""
    return _typed_listing(spark.read.csv(path, schema=LISTING_CSV_TEXT, multiLine=multi_line, **CSV_READ), F.lit(account))


def read_account_csvs(spark: SparkSession, folder: str, accounts: list[str], multi_line: bool = True) -> DataFrame:
    """``<folder>/<account>.csv`` for every account (one listing file per account) -> long listing.

    One read over all files; the account comes from the file name. ``multi_line`` as in :func:`read_listing_csv`.
    """
    paths = [f"{folder.rstrip('/')}/{a}.csv" for a in accounts]
    df = spark.read.csv(paths, schema=LISTING_CSV_TEXT, multiLine=multi_line, **CSV_READ)
    return _typed_listing(df, F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1))


def read_listing_csv_table(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """A listing table written as CSV (folders ``run_id=<id>/account=<a>``), typed like :func:`read_listing_csv`."""
    df = spark.read.option("basePath", path).csv(path, schema=LISTING_CSV_WITH_RUN, **CSV_READ)
    if run_id is not None:
        df = df.where(F.col("run_id") == F.lit(run_id))
    return _typed_listing(df, F.col("account"))


def read_listing_table(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Listing table written by :func:`stocktake.sinks.tables.write_listing` (partitioned by run and account).

    Without ``run_id`` the rows of all runs come back together; a diff reads one run.
    """
    df = spark.read.schema(LISTING_WITH_RUN).parquet(path)
    if run_id is not None:
        df = df.where(F.col("run_id") == F.lit(run_id))
    return df.select(*[f.name for f in LISTING.fields])


def newest_run(spark: SparkSession, path: str) -> str:
    """The last finished run of a table under a root; run ids sort by time.

    A run counts once it is committed (see :func:`stocktake.sinks.tables.commit_run`): what a run that was
    stopped has left in the table is never taken for one.
    """
    from stocktake.sinks.tables import committed_runs

    root, table = path.rstrip("/").rsplit("/", 1)
    last = committed_runs(spark, root).where(F.array_contains("tables", table)).agg(F.max("run_id")).first()[0]
    if last is None:
        raise ValueError(f"no finished run in {path}")
    return last


# What the columns of raw entries are called in the inventory, where names differ.
INVENTORY_COLUMNS = {f: f for f in RAW_ENTRY.fieldNames()}


def read_inventory(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    *,
    account: str | None = None,
    columns: dict[str, str] | None = None,
    csv_columns: list[str] | None = None,
    url_encoded_keys: bool = False,
    multi_line: bool = True,
    on_unreadable: str = "fail",
) -> DataFrame:
    """An inventory report or list export (``parquet``, ``orc`` or ``csv``) -> raw entries.

    ``columns`` maps raw entry fields (``bucket, key, last_modified, size, etag, account``) to the report's
    column names, in any case; one that the report doesn't have raises, and a field without a column is null. A size or
    date that can't be read fails the job (an unknown size would count as no file), or is null with
    ``on_unreadable="null"``. ``account`` names the account where the
    report has no such column. ``csv_columns`` gives the names of a CSV without a header line;
    otherwise its first line has them. ``url_encoded_keys`` decodes keys as stores write them in CSV reports
    (``+`` is a space); a CSV of such keys has no line breaks in cells, so ``multi_line=False`` splits its files. The ETag is taken as it is: no object is read.
    """
    names = {**INVENTORY_COLUMNS, **(columns or {})}
    if fmt == "csv":
        schema = T.StructType([T.StructField(c, T.StringType()) for c in csv_columns]) if csv_columns else None
        df = spark.read.csv(path, schema=schema, header=not csv_columns, multiLine=multi_line, **CSV_DIALECT)
    elif fmt in ("parquet", "orc"):
        df = spark.read.format(fmt).load(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    there = {c.lower(): c for c in df.columns}  # Spark reads column names without case
    absent = [f"{field}={name}" for field, name in {"bucket": names["bucket"], "key": names["key"], **(columns or {})}.items() if name.lower() not in there]
    if absent:
        raise ValueError(f"the report has no such columns: {', '.join(absent)} (it has {', '.join(df.columns)})")
    typed = {"size": parse_size, "last_modified": parse_date}
    out = []
    for field in RAW_ENTRY.fields:
        name = there.get(names[field.name].lower())
        if field.name == "account" and account is not None:
            c = F.lit(account)
        elif name is None:
            c = F.lit(None)
        elif field.name in typed:
            c = typed[field.name](f"`{name.replace('`', '``')}`")
            if on_unreadable == "fail":
                text = quoted(name).cast("string")
                c = F.when(c.isNull() & text.isNotNull() & (text != ""), F.raise_error(F.concat(F.lit(f"unreadable {name}: "), text))).otherwise(c)
        else:
            c = quoted(name)
            if field.name == "key" and url_encoded_keys:
                c = F.url_decode(c)
        out.append(c.cast(field.dataType).alias(field.name))
    return df.select(*out)


def read_all_accounts_csv(spark: SparkSession, path: str, accounts: list[str], multi_line: bool = False) -> DataFrame:
    """Flattened all-accounts CSV, typed from the account list (sizes via decimal, see :func:`parse_size`).

    Each row is a line, as in our exports; ``multi_line`` reads files of others with line breaks in quoted cells."""
    schema = all_accounts_schema(accounts)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = spark.read.csv(path, schema=text, multiLine=multi_line, **CSV_READ)
    cols = []
    for f in schema.fields:
        name = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, T.LongType):
            cols.append(F.expr(f"try_cast(try_cast({name} as decimal(20,1)) as bigint)").alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            cols.append(F.expr(f"try_cast({name} as timestamp)").alias(f.name))
        else:
            cols.append(from_csv_cell(quoted(f.name)).alias(f.name))
    return df.select(*cols)


def read_all_accounts_table(spark: SparkSession, path: str, accounts: list[str], run_id: str | None = None) -> DataFrame:
    schema = T.StructType([*all_accounts_schema(accounts).fields, T.StructField("run_id", T.StringType())])
    df = spark.read.schema(schema).parquet(path)
    if run_id is not None:
        df = df.where(F.col("run_id") == F.lit(run_id))
    return df.select(*[quoted(f.name) for f in all_accounts_schema(accounts).fields])
