"""Incremental runs: the combine waits for the last account of a run."""

import os

from pyspark.sql import functions as F

from stocktake.operators import rules as R
from stocktake.plans import pipeline as P
from stocktake.sinks import tables as S
from stocktake.streaming.arrivals import complete_runs, runs_written, watch_listings
from tests import fixtures as X

RULES = R.RuleConfig(origin="pro", is_hash_the_same_in=["release", "dev"], can_the_file_exist_in=["release"])


def test_run_completes_when_last_account_lands(spark, tmp_root):
    wide = X.wide_map(spark)
    long_map = P.prepare_map(wide)
    listing, _ = P.extract_accounts(X.raw_entries(spark), long_map)
    table = f"{tmp_root}/{S.LISTINGS_DIR}"
    out = f"{tmp_root}/out"
    ckpt = f"{tmp_root}/ckpt"

    # Two of three accounts extracted: nothing to combine yet.
    assert S.write_listing(listing.where(F.col("account") != "dev"), tmp_root, "r1") == table
    q = watch_listings(spark, table, wide, RULES, out, ckpt)
    q.awaitTermination()
    assert not os.path.exists(f"{out}/all_accounts")

    # The last account lands: the run is combined and analysed.
    listing.where(F.col("account") == "dev").withColumn("run_id", F.lit("r1")).write.mode("append").partitionBy(
        "run_id", "account"
    ).parquet(table)
    q = watch_listings(spark, table, wide, RULES, out, ckpt)
    q.awaitTermination()
    assert [r["run_id"] for r in runs_written(spark, out).collect()] == ["r1"]
    # Another run's folder that can't be read is never opened for this one's batch.
    batch = spark.createDataFrame([("r1",)], "run_id string")
    os.makedirs(f"{table}/run_id=r0/account=pro")
    with open(f"{table}/run_id=r0/account=pro/part-0.parquet", "w") as f:
        f.write("no parquet")
    assert complete_runs(batch, table, long_map) == ["r1"] and complete_runs(batch.limit(0), table, long_map) == []
    ana = spark.read.parquet(f"{out}/analysis").where("run_id = 'r1'")
    assert ana.count() == 8
    got = sorted(
        (tuple(r) for r in ana.select("bucket_in_pro", "prefix_in_pro", "file_name_in_all_accounts",
                                      "is_hash_the_same_in_release", "is_hash_the_same_in_dev", "can_exist_in_release").collect()),
        key=repr,
    )
    assert got == sorted(X.EXPECTED_RULES, key=repr)
