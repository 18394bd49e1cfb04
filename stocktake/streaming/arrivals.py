"""Incremental runs: combine and analyse a run as soon as its last account listing lands.

Accounts are often listed by separate jobs (each with its own credentials) that
write their listing into the shared listing table, partitioned by
``run_id, account``. This module watches that table with Structured Streaming
(file source, ``availableNow`` or periodic trigger). For every run touched by a
micro-batch it checks, with a left-anti join against the map's accounts, whether
any account is still pending; when none is, it reads the whole run back as a
batch and writes the all-accounts and analysis tables for that run.

Writes overwrite the run's partition (dynamic partition overwrite), so a
micro-batch replayed after a failure produces the same result; the stream's
progress is kept in its checkpoint location on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stocktake.operators import accounts as A
from stocktake.operators import rules as R
from stocktake.operators import uri_map as M
from stocktake.plans import pipeline as P
from stocktake.schemas import LISTING_WITH_RUN
from stocktake.sinks import tables as S
from stocktake.sources.readers import read_listing_table

# Files of a micro-batch: bounds the runs that one batch can touch, also on a first start.
MAX_FILES = 1000


def complete_runs(batch: DataFrame, listing_path: str, long_map: DataFrame) -> list[str]:
    """Runs touched by ``batch`` whose listing now covers every account of the map.

    Only these runs' folders are opened: a batch costs the same however many runs the table holds by
    now. A batch holds at most ``MAX_FILES`` files, so at most as many run ids come back.
    """
    spark = batch.sparkSession
    touched = [r["run_id"] for r in batch.select("run_id").distinct().collect()]
    if not touched:
        return []
    accounts = A.map_accounts(long_map).select("account").distinct()
    folders = [S.run_path(listing_path, r) for r in touched]
    present = spark.read.schema(LISTING_WITH_RUN).option("basePath", listing_path).parquet(*folders).select("run_id", "account").distinct()
    covered = present.join(accounts, "account", "left_semi").groupBy("run_id").agg(F.count("*").alias("n"))
    return [r["run_id"] for r in covered.where(F.col("n") == accounts.count()).select("run_id").orderBy("run_id").collect()]


def process_run(spark: SparkSession, listing_path: str, long_map: DataFrame, accounts: list[str], config: R.RuleConfig, out_root: str, run_id: str) -> None:
    listing = read_listing_table(spark, listing_path, run_id)
    S.begin_run(spark, out_root, run_id)
    # Returns a frame over the written run: the analysis never recomputes the combine.
    flat = P.write_all_accounts_run(listing, long_map, accounts, out_root, run_id)
    if config.run_analysis:
        S.write_run(P.analysis(flat, config, accounts), S.table_path(out_root, S.ANALYSIS_DIR), run_id)
    S.commit_run(spark, out_root, run_id, [S.ALL_ACCOUNTS_DIR] + [S.ANALYSIS_DIR] * config.run_analysis)


def watch_listings(
    spark: SparkSession,
    listing_path: str,
    wide_map: DataFrame,
    config: R.RuleConfig,
    out_root: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination()`` for ``availableNow``)."""
    accounts = M.accounts_of(wide_map)
    if config.run_analysis:
        R.assert_config_matches(config, accounts)
    long_map = P.prepare_map(wide_map)
    stream = spark.readStream.schema(LISTING_WITH_RUN).option("maxFilesPerTrigger", MAX_FILES).parquet(listing_path)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        for run_id in complete_runs(batch, listing_path, long_map):
            process_run(batch.sparkSession, listing_path, long_map, accounts, config, out_root, run_id)

    writer = stream.select("run_id", "account").writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def runs_written(spark: SparkSession, out_root: str) -> DataFrame:
    """Ids of the finished runs that have an all-accounts result."""
    return S.committed_runs(spark, out_root).where(F.array_contains("tables", S.ALL_ACCOUNTS_DIR)).select("run_id").orderBy("run_id")
