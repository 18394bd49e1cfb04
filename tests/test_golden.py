"""End-to-end on the golden scenario: three accounts, four folders, eight rule rows."""

from pyspark.sql import functions as F

from stocktake.operators import rules as R
from stocktake.plans import pipeline as P
from stocktake.sources.objects import list_folders, with_content_hash
from tests import fixtures as X

RULES = R.RuleConfig(origin="pro", is_hash_the_same_in=["release", "dev"], can_the_file_exist_in=["release"])

# Sizes and hashes of the golden contents (fixed values of the scenario).
GOLDEN_HASH = {
    "C1": (49, "f15993242621717c5eb2a329b672bc1d"),
    "C2": (20, "78e051ff226ded4e9aa2b03e07788619"),
    "C3": (28, "4d58ea08451ece64e3924aeb78b2c2af"),
    "C4": (19, "77bb49be128f088eda87f370b58b2ee0"),
    "C5": (38, "14e40c09cf854c4802c8352939fd9a10"),
    "C6": (44, "b513223316f922e948ea530ae7304e6d"),
    "C7": (28, "7e3bd8ea6895b50856c6390a134a8c2b"),
    "C8": (68, "475220fb2304d19a3ac36d287dbbd1a8"),
}


def _rule_rows(df):
    rows = df.select(
        "bucket_in_pro", "prefix_in_pro", "file_name_in_all_accounts",
        "is_hash_the_same_in_release", "is_hash_the_same_in_dev", "can_exist_in_release",
    ).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_contents_match_golden_sizes_and_hashes():
    for cid, (size, h) in GOLDEN_HASH.items():
        assert len(X.CONTENT[cid].encode()) == size
        assert X.md5(X.CONTENT[cid]) == h


def test_full_diff_from_raw_entries(spark):
    res = P.full_diff(X.wide_map(spark), RULES, raw=X.raw_entries(spark))
    assert res.analysis.columns == [
        "bucket_in_pro", "prefix_in_pro", "file_name_in_all_accounts",
        "date_in_pro", "size_in_pro", "hash_in_pro",
        "date_in_release", "size_in_release", "hash_in_release",
        "date_in_dev", "size_in_dev", "hash_in_dev",
        "is_hash_the_same_in_release", "is_hash_the_same_in_dev", "can_exist_in_release",
    ]
    assert _rule_rows(res.analysis) == sorted(X.EXPECTED_RULES, key=repr)


def test_per_account_placeholders(spark):
    res = P.full_diff(X.wide_map(spark), RULES, raw=X.raw_entries(spark))
    empty = res.listing.where(F.col("name").isNull()).select("account", "bucket", "prefix").collect()
    assert sorted(tuple(r) for r in empty) == sorted(
        [
            ("pro", "pets", "horses/europe/"),
            ("pro", "pets", "non-existent-prefix/"),
            ("release", "pets", "horses/europe/"),
            ("release", "pets", "non-existent-prefix/"),
            ("dev", "pets_dev", "non-existent-prefix/"),
        ]
    )
    assert res.listing.where(F.col("name").isNotNull()).count() == len(X.OBJECTS)


def test_full_diff_from_listed_folders(spark, tmp_root):
    """Objects written as files per account; the mapped folders listed, objects hashed with MD5."""
    X.write_object_tree(tmp_root)
    store = f"file://{tmp_root}/{{account}}/"
    raw = with_content_hash(list_folders(P.prepare_map(X.wide_map(spark)), store=store), store)
    res = P.full_diff(X.wide_map(spark), RULES, raw=raw)
    assert _rule_rows(res.analysis) == sorted(X.EXPECTED_RULES, key=repr)
    sizes = {r["file_name_in_all_accounts"]: r["size_in_pro"] for r in res.analysis.collect()}
    assert sizes["cars-20241014.csv"] == 49


def test_full_diff_written_and_reread(spark, tmp_root):
    from stocktake.sources.readers import read_all_accounts_table

    res = P.full_diff(X.wide_map(spark), RULES, raw=X.raw_entries(spark), out_root=tmp_root, run_id="20250101000000")
    back = read_all_accounts_table(spark, f"{tmp_root}/all_accounts", X.ACCOUNTS, run_id="20250101000000")
    assert back.count() == 8
    ana = spark.read.parquet(f"{tmp_root}/analysis").where("run_id = '20250101000000'")
    assert ana.count() == 8
    listing = spark.read.parquet(f"{tmp_root}/accounts")
    assert sorted(r["account"] for r in listing.select("account").distinct().collect()) == sorted(X.ACCOUNTS)
    assert res.analysis.count() == 8


def test_csv_sink_text_format(spark, tmp_root):
    from stocktake.sinks import tables as S

    res = P.full_diff(X.wide_map(spark), RULES, raw=X.raw_entries(spark))
    S.write_analysis(res.analysis, tmp_root, "r1", fmt="csv")
    lines = [r["value"] for r in spark.read.text(f"{tmp_root}/analysis/run_id=r1").collect()]
    header = [ln for ln in lines if ln.startswith("bucket_in_pro")]
    assert header and header[0].endswith("is_hash_the_same_in_release,is_hash_the_same_in_dev,can_exist_in_release")
    car = [ln for ln in lines if "cars-20241014.csv" in ln][0]
    assert "2024-10-14 08:49:01+00:00" in car and car.endswith("True,True,")


def test_full_diff_written_csv(spark, tmp_root):
    from stocktake.sources.readers import read_listing_csv_table

    res = P.full_diff(X.wide_map(spark), RULES, raw=X.raw_entries(spark), out_root=tmp_root, run_id="r9", fmt="csv")
    assert _rule_rows(res.analysis) == sorted(X.EXPECTED_RULES, key=repr)
    listing = read_listing_csv_table(spark, f"{tmp_root}/csv/accounts", "r9")
    assert listing.where(F.col("name").isNull()).count() == 5
    assert listing.where(F.col("name").isNotNull()).count() == len(X.OBJECTS)
    lines = [r["value"] for r in spark.read.text(f"{tmp_root}/csv/analysis/run_id=r9").collect()]
    assert any(ln.endswith("False,,False") for ln in lines)  # dogs-20241020-test.csv


def test_full_diff_from_account_csv_files(spark, tmp_root):
    """Per-account CSV listings (sizes written as `49.0`, placeholder rows with empty cells)."""
    from stocktake.sources.readers import read_account_csvs

    for a in X.ACCOUNTS:
        with open(f"{tmp_root}/{a}.csv", "w") as f:
            f.write("bucket,prefix,name,date,size,hash\n")
            for acc, bucket, key, cid in X.OBJECTS:
                if acc == a:
                    prefix, name = key.rsplit("/", 1)
                    f.write(f"{bucket},{prefix}/,{name},2024-10-14 08:49:01+00:00,{len(X.CONTENT[cid])}.0,{X.md5(X.CONTENT[cid])}\n")
            f.write("pets,non-existent-prefix/,,,,\n" if a != "dev" else "pets_dev,non-existent-prefix/,,,,\n")
    listing = read_account_csvs(spark, tmp_root, X.ACCOUNTS)
    assert listing.where(F.col("size").isNull() & F.col("name").isNotNull()).count() == 0
    res = P.full_diff(X.wide_map(spark), RULES, listing=listing)
    assert _rule_rows(res.analysis) == sorted(X.EXPECTED_RULES, key=repr)


def test_ordered_csv_output_follows_map(spark, tmp_root):
    P.full_diff(X.wide_map(spark), RULES, raw=X.raw_entries(spark), out_root=tmp_root, run_id="o1", fmt="csv", ordered=True)
    import glob

    names = []
    for f in sorted(glob.glob(f"{tmp_root}/csv/analysis/run_id=o1/part-*.csv")):
        with open(f) as fh:
            names += [ln.split(",")[2] for ln in fh.read().splitlines()[1:]]
    assert names == [
        "cars-20241014.csv", "dogs-20240914.csv", "dogs-20241015.csv", "dogs-20241019.csv",
        "dogs-20241020-test.csv", "dogs-20241021.csv", "horses-20210219.csv", "",
    ]
