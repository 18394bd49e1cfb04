"""The written path: re-runs, earlier runs, names, account ids, configs (one test per past fault)."""

import json

import pytest
from pyspark.sql import functions as F

from stocktake.functions.uri import parent_folder
from stocktake.operators import listing as L
from stocktake.operators import rules as R
from stocktake.operators.uri_map import MapFileError
from stocktake.plans import pipeline as P
from stocktake.sinks import tables as S
from stocktake.sources import readers as RD
from tests import fixtures as X

RULES = R.RuleConfig(origin="pro", is_hash_the_same_in=["dev"], can_the_file_exist_in=["dev"])
RAW = "account string, bucket string, key string, last_modified timestamp, size long, etag string"
WIDE = [("s3://b/f", "s3://c/g")]


def raw_of(spark, *rows):
    return spark.createDataFrame([(a, b, k, None, 1, h) for a, b, k, h in rows], RAW)


def wide_of(spark, accounts=("pro", "dev")):
    return spark.createDataFrame(WIDE, ", ".join(f"`{a}` string" for a in accounts))


def test_rerun_leaves_nothing_of_an_account_that_became_empty(spark, tmp_root):
    first = raw_of(spark, ("pro", "b", "f/x", "h"), ("dev", "c", "g/x", "h"))
    P.full_diff(wide_of(spark), RULES, raw=first, out_root=tmp_root, run_id="r1")
    again = P.full_diff(wide_of(spark), RULES, raw=first.where("account = 'pro'"), out_root=tmp_root, run_id="r1")
    assert [tuple(r) for r in again.analysis.select("hash_in_dev", "is_hash_the_same_in_dev").collect()] == [(None, False)]
    given = RD.read_listing_table(spark, f"{tmp_root}/accounts", "r1").where("account = 'pro'")
    again = P.full_diff(wide_of(spark), RULES, listing=given, out_root=tmp_root, run_id="r1")
    assert again.analysis.where("hash_in_dev is not null").count() == 0


def test_strict_check_comes_before_any_write(spark, tmp_root):
    listing = P.full_diff(wide_of(spark), RULES, raw=raw_of(spark, ("pro", "b", "f/x", "h"))).listing.withColumn("prefix", F.lit("else/"))
    with pytest.raises(ValueError, match="could not be replaced"):
        P.full_diff(wide_of(spark), RULES, listing=listing, out_root=f"{tmp_root}/out", run_id="r1")
    import os

    assert not os.path.exists(f"{tmp_root}/out")


def test_names_and_fractions_survive_csv(spark, tmp_root):
    names = [" lead.csv", "trail.csv ", 'q"uote.csv', "a,b.csv", "two\nlines", "cr\r\nlf", '"', "\\", '\\"', "é", "#x", "'"]
    rows = [("pro", "b", "f/", n, 1, "h") for n in names]
    listing = spark.createDataFrame(rows, "account string, bucket string, prefix string, name string, size long, hash string")
    listing = listing.withColumn("date", F.expr("timestamp'2024-01-01 00:00:00.123456'"))
    P.full_diff(wide_of(spark), RULES, listing=listing, out_root=tmp_root, run_id="r1", fmt="csv")
    back = RD.read_listing_csv_table(spark, f"{tmp_root}/csv/accounts", "r1").where("name is not null")
    assert sorted(r["name"] for r in back.collect()) == sorted(names)
    assert {str(r["date"]) for r in back.collect()} == {"2024-01-01 00:00:00.123456"}
    flat = RD.read_all_accounts_csv(spark, f"{tmp_root}/csv/all_accounts/run_id=r1", ["pro", "dev"])
    assert sorted(r["file_name_in_all_accounts"] for r in flat.collect()) == sorted(names)


def test_account_ids_of_digits_stay_text(spark, tmp_root):
    accounts = ("012345678901", "123456789012")
    raw = raw_of(spark, (accounts[0], "b", "f/x", "h"), (accounts[1], "c", "g/x", "h"))
    rules = R.RuleConfig(origin=accounts[0], is_hash_the_same_in=[accounts[1]])
    done = P.full_diff(wide_of(spark, accounts), rules, raw=raw, out_root=tmp_root, run_id="20250101000000", fmt="csv")
    assert done.analysis.first()[f"is_hash_the_same_in_{accounts[1]}"] is True
    assert {r["account"] for r in RD.read_listing_csv_table(spark, f"{tmp_root}/csv/accounts").collect()} == set(accounts)
    assert RD.newest_run(spark, f"{tmp_root}/accounts") == "20250101000000"


def test_sub_folder_error_names_them_all(spark):
    raw = raw_of(spark, *[("pro", "b", f"f/s{k:04d}/x", "h") for k in range(1005)])
    report = L.subfolders(raw, P.prepare_map(wide_of(spark)))
    with pytest.raises(L.SubfolderError) as error:
        L.assert_no_subfolders(report)
    assert str(error.value).count("f/s") == 1005 and "(1005)" in str(error.value)


def test_reports_are_written(spark, tmp_root):
    raw = raw_of(spark, ("pro", "b", "f/x", "h"), ("pro", "b", "f/deep/y", "h"), ("pro", "b", "f/x/", "h"))
    done = P.full_diff(wide_of(spark), RULES, raw=raw, out_root=tmp_root, run_id="r1")
    assert done.subfolders.count() == 2 and spark.read.parquet(f"{tmp_root}/subfolders").count() == 2
    assert done.unmapped.count() == 0 and done.duplicates.count() == 0
    twice = done.listing.unionByName(done.listing)
    done = P.full_diff(wide_of(spark), RULES, listing=twice, out_root=tmp_root, run_id="r2")
    assert [r["n_copies"] for r in done.duplicates.collect()] == [2] and done.analysis.where("hash_in_pro is not null").count() == 2


def test_keys_with_line_breaks_stay_in_their_folder(spark):
    df = spark.createDataFrame([("f/a\nb/c.csv",)], "key string").select(parent_folder("key").alias("p"))
    assert df.first()["p"] == "f/a\nb/"


@pytest.mark.parametrize("text", ['{"run_analysis": true, "origin": "pro",}', '{"run_analysis": true, "orig', "", '{"run_analysis": true, "origin": "pro"}'])
def test_a_bad_config_speaks(spark, tmp_root, text):
    with open(f"{tmp_root}/c.json", "w") as f:
        f.write(text)
    with pytest.raises(Exception):
        RD.read_rule_config(spark, f"{tmp_root}/c.json")


def test_analysis_is_off_only_by_its_value(spark, tmp_root):
    for value in (True, False, None):
        with open(f"{tmp_root}/c.json", "w") as f:
            json.dump({"run_analysis": value, "origin": "pro", "is_hash_the_same_in": ["dev"], "can_the_file_exist_in": []}, f)
        assert RD.read_rule_config(spark, f"{tmp_root}/c.json").run_analysis is (value is True)


def test_accounts_that_differ_in_case_are_rejected(spark, tmp_root):
    with open(f"{tmp_root}/m.csv", "w") as f:
        f.write("Pro,pro\ns3://b/f,s3://c/g\n")
    with pytest.raises(MapFileError, match="Pro, pro"):
        RD.read_uri_map(spark, f"{tmp_root}/m.csv")


def test_inventory_formats(spark, tmp_root):
    raw = X.raw_entries(spark)
    raw.write.orc(f"{tmp_root}/orc")
    assert sorted(map(repr, RD.read_inventory(spark, f"{tmp_root}/orc", "orc").collect())) == sorted(map(repr, raw.collect()))
    raw.where("account = 'pro'").drop("account").withColumnRenamed("key", "Key").write.option("header", True).csv(f"{tmp_root}/csv")
    back = RD.read_inventory(spark, f"{tmp_root}/csv", "csv", account="pro", columns={"key": "Key"})
    assert {(r["account"], r["key"], r["size"]) for r in back.collect()} == {("pro", r["key"], r["size"]) for r in raw.where("account = 'pro'").collect()}
    with pytest.raises(ValueError):
        RD.read_inventory(spark, tmp_root, "xml")


def test_command_line(spark, tmp_root, monkeypatch, capsys):
    from stocktake import __main__ as CLI

    monkeypatch.setattr(CLI, "cluster_session", lambda: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    X.raw_entries(spark).write.parquet(f"{tmp_root}/inv")
    with open(f"{tmp_root}/m.csv", "w") as f:
        f.write(",".join(X.ACCOUNTS) + "\n" + "\n".join(",".join(r) for r in X.MAP_ROWS) + "\n")
    with open(f"{tmp_root}/c.json", "w") as f:
        json.dump({"run_analysis": True, "origin": "pro", "is_hash_the_same_in": ["dev"], "can_the_file_exist_in": []}, f)
    base = ["--map", f"{tmp_root}/m.csv", "--config", f"{tmp_root}/c.json"]
    assert CLI.main([*base, "--inventory", f"{tmp_root}/inv", "--out", f"{tmp_root}/o", "--run-id", "20250101000000", "--format", "csv"]) == 0
    assert CLI.main([*base, "--listing", f"{tmp_root}/o/accounts", "--out", f"{tmp_root}/o2", "--run-id", "20250102000000"]) == 0
    a, b = (spark.read.parquet(f"{tmp_root}/{o}/analysis").drop("run_id") for o in ("o", "o2"))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert "sub-folders: 0" in capsys.readouterr().out


def test_a_stopped_run_is_no_run(spark, tmp_root, monkeypatch):
    raw = raw_of(spark, ("pro", "b", "f/x", "h"), ("dev", "c", "g/x", "h"))
    P.full_diff(wide_of(spark), RULES, raw=raw, out_root=tmp_root, run_id="r1")
    write = S.write_run

    def stops(df, path, run_id, *a, **k):
        if path.endswith(S.ANALYSIS_DIR) or k.get("mode") == "append":
            raise OSError("lost")
        return write(df, path, run_id, *a, **k)

    monkeypatch.setattr(S, "write_run", stops)
    for run_id in ("r2", "r1"):  # a new run, and a second attempt of a finished one
        with pytest.raises(OSError):
            P.full_diff(wide_of(spark), RULES, raw=raw, out_root=tmp_root, run_id=run_id)
    assert S.committed_runs(spark, tmp_root).count() == 0
    assert RD.read_listing_table(spark, f"{tmp_root}/accounts", "r2").count() == 2  # it looks finished
    with pytest.raises(ValueError, match="no finished run"):
        RD.newest_run(spark, f"{tmp_root}/accounts")
    monkeypatch.undo()
    P.full_diff(wide_of(spark), RULES, raw=raw, out_root=tmp_root, run_id="r1")
    assert RD.newest_run(spark, f"{tmp_root}/accounts") == "r1" == RD.newest_run(spark, f"{tmp_root}/analysis")
    assert S.committed_runs(spark, f"{tmp_root}/nowhere").count() == 0


def test_raw_entries_are_read_once(spark, tmp_root):
    """Files, placeholders and sub-folders come from the same stored entries, whatever the source says a second time."""
    calls = spark.sparkContext.accumulator(0)

    def listed(batches):
        import pyarrow as pa

        for batch in batches:
            calls.add(batch.num_rows)
            yield pa.RecordBatch.from_pylist(batch.to_pylist(), schema=batch.schema)

    raw = raw_of(spark, ("pro", "b", "f/x", "h"), ("pro", "b", "f/sub/y", "h"), ("dev", "c", "g/x", "h")).repartition(1)
    done = P.full_diff(wide_of(spark), RULES, raw=raw.mapInArrow(listed, raw.schema), out_root=tmp_root, run_id="r1", on_subfolders="report")
    assert done.subfolders.count() == 1 and done.listing.count() == 2 and calls.value == 3
    for frame in (done.listing, done.subfolders, done.all_accounts):
        assert "MapInArrow" not in frame._jdf.queryExecution().executedPlan().toString()


def test_hashes_of_different_kinds(spark, tmp_root):
    md5, parts = "d41d8cd98f00b204e9800998ecf8427e", "d41d8cd98f00b204e9800998ecf8427e-2"
    raw = raw_of(spark, ("pro", "b", "f/x", md5), ("dev", "c", "g/x", parts), ("pro", "b", "f/y", md5), ("dev", "c", "g/y", md5), ("dev", "c", "g/z", parts))
    for root in (None, tmp_root):
        done = P.full_diff(wide_of(spark), RULES, raw=raw, out_root=root, run_id="r1")
        assert [tuple(r) for r in done.unlike_hashes.collect()] == [("pro", "dev", "md5", "multipart", 1)]
        with pytest.raises(R.HashKindError, match="1 objects with md5 in 'pro' and multipart in 'dev'"):
            P.full_diff(wide_of(spark), RULES, raw=raw, out_root=root, run_id="r2", on_unlike_hashes="fail")
    assert P.full_diff(wide_of(spark), R.RuleConfig(origin="pro"), raw=raw).unlike_hashes.count() == 0


@pytest.mark.parametrize("size", [0, 1, 9, 10, 11, 20, 25])
def test_digests_of_uploads_in_parts(size):
    import hashlib
    import io

    from stocktake.sources.objects import digest_of

    body = bytes(range(size))
    parts = [hashlib.md5(body[k : k + 10]).digest() for k in range(0, size, 10)]
    want = hashlib.md5(body).hexdigest() if size < 10 else f"{hashlib.md5(b''.join(parts)).hexdigest()}-{len(parts)}"
    assert digest_of(io.BytesIO(body), 10) == want and digest_of(io.BytesIO(body)) == hashlib.md5(body).hexdigest()


def test_many_copies_of_a_key_in_a_written_run(spark, tmp_root, monkeypatch):
    from stocktake.operators import combine as C

    monkeypatch.setattr(C.repeated_keys, "__defaults__", (3,))
    rows = [(a, p, f"f/{n}" if a == "pro" else f"g/{n}", None, k, f"h{k % 4}") for a, p in (("pro", "b"), ("dev", "c")) for n, times in (("x", 9), ("y", 2), ("z", 1)) for k in range(times)]
    raw = spark.createDataFrame(rows, RAW)
    done = P.full_diff(wide_of(spark), RULES, raw=raw, out_root=tmp_root, run_id="r1")
    lazy = P.full_diff(wide_of(spark), RULES, raw=raw)
    assert done.all_accounts.count() == 12 and sorted(map(repr, done.analysis.collect())) == sorted(map(repr, lazy.analysis.collect()))


def test_inventory_columns_are_checked(spark, tmp_root):
    report = spark.createDataFrame([("b", "f/x", "7", "2024-01-01 00:00:00", "h"), ("b", "f/y", "many", "2024-01-01 00:00:00", "h")], "Bucket string, Key string, Size string, Date string, ETag string")
    report.write.parquet(f"{tmp_root}/report")
    read = lambda **k: RD.read_inventory(spark, f"{tmp_root}/report", account="pro", columns={"last_modified": "Date"} | k.pop("columns", {}), **k)
    with pytest.raises(ValueError, match="etag=E_Tag"):
        read(columns={"etag": "E_Tag"})
    rows = {r["key"]: r for r in read(on_unreadable="null").collect()}
    assert rows["f/x"]["etag"] == "h" and rows["f/x"]["size"] == 7 and rows["f/y"]["size"] is None and rows["f/y"]["last_modified"] is not None
    with pytest.raises(Exception, match="unreadable Size: many"):
        read().collect()


def test_counts_of_a_run_come_from_its_write(spark, tmp_root, monkeypatch):
    from stocktake.operators import combine as C

    passes = []
    counted = C.rekey_counts
    monkeypatch.setattr(C, "rekey_counts", lambda *a: passes.append(1) or counted(*a))
    raw = raw_of(spark, ("pro", "b", "f/x", "h"), ("pro", "b", "f/y", "h"), ("dev", "c", "g/x", "h"))
    done = P.full_diff(wide_of(spark), RULES, raw=raw, out_root=tmp_root, run_id="r1")
    assert done.counts == {"n_rows": 3, "n_rekeyed": 3, "n_unmapped": 0} and not passes
    stray = done.listing.unionByName(done.listing.limit(1).withColumn("prefix", F.lit("else/")))
    done = P.full_diff(wide_of(spark), RULES, listing=stray, out_root=tmp_root, run_id="r2", strict=False)
    assert done.counts == {"n_rows": 4, "n_rekeyed": 3, "n_unmapped": 1} and not passes
    twice = spark.createDataFrame([("s3://b/f", "s3://c/g"), ("s3://b/k", "s3://c/g")], "pro string, dev string")  # one folder, two keys
    done = P.full_diff(twice, RULES, raw=raw, out_root=tmp_root, run_id="r3", strict=False)
    assert done.counts["n_rekeyed"] > done.counts["n_rows"] - done.counts["n_unmapped"] and passes == [1]


def test_one_csv_file_is_read_by_several_tasks(spark, tmp_root):
    """Names with line breaks, and with the mark of encoded cells, in one file that is cut into splits anywhere."""
    names = [f"{k}\nline\r\nbreak \r%url: é,\"" if k % 3 == 0 else f"%url:{k}" if k % 3 == 1 else f'plain "{k}", x' for k in range(3000)]
    rows = spark.createDataFrame([("pro", "b", "f/", n, 1, "h") for n in names], "account string, bucket string, prefix string, name string, size long, hash string")
    listing = rows.withColumn("date", F.expr("timestamp'2024-01-01 00:00:00'"))
    path = S.write_listing(listing.coalesce(1), tmp_root, "r1", "csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        back = RD.read_listing_csv_table(spark, path, "r1")
        assert back.groupBy(F.spark_partition_id()).count().count() > 4
        assert sorted(r["name"] for r in back.collect()) == sorted(names)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_small_objects_are_written_by_many_tasks(spark, tmp_root):
    import os

    from stocktake.sources.objects import write_objects

    # Hardly a byte in all: Spark's own writer would leave them to one task.
    lines = spark.createDataFrame([(f"f={k % 9}/p={k % 40}/x", k, str(k)) for k in range(400)] + [(None, 0, "lost")], "key string, n long, text string")
    want = {}
    for k in range(400):
        want.setdefault(f"f={k % 9}/p={k % 40}/x", []).append(f"{k}\n")
    for _ in range(2):  # a second attempt leaves the same objects
        assert write_objects(lines, ["n"], f"{tmp_root}/", "docs", tasks=6) == len(want)
        found = {os.path.relpath(f"{at}/{name}", f"{tmp_root}/docs"): open(f"{at}/{name}").read() for at, _, names in os.walk(f"{tmp_root}/docs") for name in names}
        assert found == {key: "".join(texts) for key, texts in want.items()}
    assert len(os.listdir(f"{tmp_root}/docs_unfinished")) == 12
