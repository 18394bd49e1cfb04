"""Re-key, N-way combine, empty folders, unmapped objects, join strategies and plan shape."""

import pytest
from pyspark.sql import functions as F

from stocktake.operators import combine as C
from stocktake.operators import rules as R
from stocktake.operators import uri_map as M
from stocktake.plans import pipeline as P
from tests import fixtures as X

LISTING = "account string, bucket string, prefix string, name string, date timestamp, size long, hash string"


def _long(spark, rows, accounts):
    return M.unpivot_map(M.clean_map(X.wide_map(spark, rows, accounts)))


@pytest.mark.parametrize("slash", ["", "/"])
def test_rekey_with_and_without_trailing_slash(spark, slash):
    rows = [(o + slash, t + slash) for o, _, t in X.MAP_ROWS]
    long = _long(spark, rows, ["pro", "dev"])
    listing = spark.createDataFrame(
        [("dev", "cars_dev", "europe/spain/", "cars-20241014.csv", None, 1, "foo"),
         ("dev", "pets_dev", "dogs/size/heavy/", "dogs-20240914.csv", None, 1, "foo"),
         ("dev", "pets_dev", "non-existent-prefix/", None, None, None, None)],
        LISTING,
    )
    out = sorted((r["key_bucket"], r["key_prefix"], r["name"]) for r in C.rekey(listing, long).collect())
    assert out == [
        ("cars", "europe/spain/", "cars-20241014.csv"),
        ("pets", "dogs/big_size/", "dogs-20240914.csv"),
        ("pets", "non-existent-prefix/", None),
    ]


def test_unmapped_objects_reported_even_with_identical_map(spark):
    long = _long(spark, [("s3://b/f", "s3://b/f")], ["pro", "release"])
    listing = spark.createDataFrame(
        [("pro", "b", "f/", "a.csv", None, 1, "h"), ("release", "b", "stray/", "x.csv", None, 1, "h")], LISTING
    )
    assert [(r["account"], r["prefix"]) for r in C.unmapped_objects(listing, long).collect()] == [("release", "stray/")]
    flat = C.all_accounts(listing, long, ["pro", "release"])
    assert [r["file_name_in_all_accounts"] for r in flat.collect()] == ["a.csv"]


def test_account_names_sharing_a_prefix(spark):
    """Accounts `pro` and `prod`: columns never bind to the wrong account."""
    long = _long(spark, [("s3://b/f", "s3://c/f")], ["pro", "prod"])
    listing = spark.createDataFrame(
        [("pro", "b", "f/", "a.csv", None, 1, "h1"), ("prod", "c", "f/", "a.csv", None, 2, "h2")], LISTING
    )
    row = C.all_accounts(listing, long, ["pro", "prod"]).first()
    assert (row["size_in_pro"], row["hash_in_pro"], row["size_in_prod"], row["hash_in_prod"]) == (1, "h1", 2, "h2")


def test_null_names_group_together(spark):
    long = _long(spark, [("s3://b/f", "s3://b/f")], ["pro", "release"])
    listing = spark.createDataFrame(
        [("pro", "b", "f/", None, None, 5, "h"), ("release", "b", "f/", None, None, 5, "h")], LISTING
    )
    rows = C.all_accounts(listing, long, ["pro", "release"]).collect()
    assert len(rows) == 1 and rows[0]["size_in_pro"] == 5 and rows[0]["size_in_release"] == 5


def test_all_digit_hashes_stay_text(spark):
    long = _long(spark, [("s3://b/f", "s3://b/f")], ["pro", "release"])
    listing = spark.createDataFrame(
        [("pro", "b", "f/", "a", None, 1, "00123"), ("release", "b", "f/", "a", None, 1, "123")], LISTING
    )
    flat = C.all_accounts(listing, long, ["pro", "release"])
    row = R.analyse(flat, R.RuleConfig(origin="pro", is_hash_the_same_in=["release"]), ["pro", "release"]).first()
    assert row["hash_in_pro"] == "00123" and row["is_hash_the_same_in_release"] is False


def test_key_account_differs_from_origin(spark):
    cfg = R.RuleConfig(origin="dev", is_hash_the_same_in=["pro"], can_the_file_exist_in=["pro"])
    res = P.full_diff(X.wide_map(spark), cfg, raw=X.raw_entries(spark))
    rows = {r["file_name_in_all_accounts"]: (r["is_hash_the_same_in_pro"], r["can_exist_in_pro"]) for r in res.analysis.collect()}
    # Key columns still come from the first map column (pro).
    assert "bucket_in_pro" in res.analysis.columns
    assert rows["dogs-20241015.csv"] == (False, None)  # dev C4 vs pro C3
    assert rows["dogs-20240914.csv"] == (True, None)
    assert rows["dogs-20241021.csv"] == (False, None)  # only in dev (origin)
    assert rows["dogs-20241020-test.csv"] == (None, None)  # only in release: in neither dev nor pro
    assert rows[None] == (None, None)


def test_salted_fallback_matches_broadcast(spark):
    cfg = R.RuleConfig(origin="pro", is_hash_the_same_in=["release", "dev"], can_the_file_exist_in=["release"])
    base = sorted(map(tuple, P.full_diff(X.wide_map(spark), cfg, raw=X.raw_entries(spark)).analysis.collect()), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("stocktake.skew.saltBuckets", "4")
    try:
        res = P.full_diff(X.wide_map(spark), cfg, raw=X.raw_entries(spark))
        salted = sorted(map(tuple, res.analysis.collect()), key=repr)
        plan = res.analysis._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert "SortMergeJoin" in plan and "__salt" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("stocktake.skew.saltBuckets")
    assert salted == base


def test_plan_one_object_shuffle_and_broadcast_map(spark):
    long = _long(spark, X.MAP_ROWS, X.ACCOUNTS)
    listing = X.raw_entries(spark)
    from stocktake.operators import listing as L

    lst = L.extract_listing(listing, long)
    flat = C.all_accounts(lst, long, X.ACCOUNTS)
    flat.collect()
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    # The object rows are shuffled once, by (bucket, prefix, name): the file name spreads a hot folder
    # over all reducers. The empty-folder check reuses that shuffle.
    import re

    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    combine_keys = [k for k in keys if "name#" in k]
    assert combine_keys and all("key_bucket#" in k and "key_prefix#" in k for k in combine_keys), plan
    assert "ReusedExchange" in plan


def test_fallback_never_broadcasts_the_salted_copies(spark):
    """A map over the budget with broadcasting left on: no salts explode below a broadcast."""
    long = _long(spark, [(f"s3://b/f{k}", f"s3://c/g{k}") for k in range(300)], ["pro", "dev"])
    listing = spark.createDataFrame([("pro", "b", f"f{k}/", "a", None, k, "h") for k in range(300)], LISTING)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8KB")
    try:
        df = C.rekey(listing, long)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 300 and "__salt" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_hot_folders_are_copied(spark):
    """One folder holds a third of all objects: its map row is copied by the salts, no other."""
    from stocktake.operators import joins as J

    rows = [("s3://b/hot", "s3://c/hot")] + [(f"s3://b/f{k}", f"s3://c/g{k}") for k in range(300)]
    long = M.materialize(_long(spark, rows, ["pro", "dev"]))
    listing = spark.createDataFrame(
        [("pro", "b", "hot/", f"n{k}", None, k, "h") for k in range(300)] + [("pro", "b", f"f{k}/", "a", None, k, "h") for k in range(300)] + [("pro", "b", None, f"x{k}", None, k, "h") for k in range(300)],
        LISTING,
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8KB")
    spark.conf.set("stocktake.skew.saltBuckets", "16")
    try:
        hot = J.hot_keys(listing, C.FOLDER_KEY, 16, long)
        is_hot = F.xxhash64(*C.FOLDER_KEY).isin(hot)
        assert len(hot) == 2 and {r["prefix"] for r in listing.where(is_hot).select("prefix").collect()} == {None, "hot/"}
        df = C.rekey(listing, long)
        assert df.count() == 600 and {r["key_prefix"] for r in df.where("name LIKE 'n%'").collect()} == {"hot/"}
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "__salt" in plan
        copies = C.map_for_rekey(long).where(is_hot).count() * 15 + C.map_for_rekey(long).count()
        assert copies == 602 + 15
        assert C.unmapped_objects(listing, long).count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("stocktake.skew.saltBuckets")


def test_byte_sizes():
    from stocktake.operators.joins import parse_bytes

    assert [parse_bytes(x) for x in ("10485760", "64MB", "1g", "10k", "7b", "-1")] == [10485760, 64 << 20, 1 << 30, 10240, 7, -1]
    with pytest.raises(ValueError):
        parse_bytes("lots")


def test_combine_is_one_exchange_of_the_objects(spark):
    rows = spark.createDataFrame([("pro", "b", "f/", "a", None, 1, "h")], "account string, key_bucket string, key_prefix string, name string, date timestamp, size long, hash string")
    df = C.combine(rows, ["pro", "dev"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_every_copy_of_a_key_is_kept(spark):
    kind = "account string, key_bucket string, key_prefix string, name string, date timestamp, size long, hash string"
    rows = [("pro", "b", "f/", "f", None, 5, "x"), ("pro", "b", "f/", "f", None, 9, "y"), ("dev", "b", "f/", "f", None, 5, "x"), ("pro", "b", "f/", None, None, 1, "z")]
    found = C.flatten(C.combine(spark.createDataFrame(rows, kind), ["pro", "dev"]), ["pro", "dev"]).select("file_name_in_all_accounts", "size_in_pro", "size_in_dev").collect()
    assert sorted(map(tuple, found), key=repr) == [("f", 5, 5), ("f", 9, None), (None, 1, None)]


ROWS = "account string, key_bucket string, key_prefix string, name string, date timestamp, size long, hash string"


def pairing(rows, accounts):
    """Brute force: rows as dicts from account to (date, size, hash)."""
    low = lambda v: tuple((x is not None, x) for x in v)
    out = []
    for key in {r[1:4] for r in rows}:
        left = {a: sorted((r[4:] for r in rows if r[1:4] == key and r[0] == a), key=low) for a in accounts}
        lines = []
        for h in sorted({v[2] for c in left.values() for v in c if v[2] is not None}):
            while sum(any(v[2] == h for v in c) for c in left.values()) > 1:
                line = {}
                for a, c in left.items():
                    mine = [v for v in c if v[2] == h]
                    if mine:
                        line[a] = mine[0]
                        c.remove(mine[0])
                lines.append(line)
        for a, c in left.items():
            free = [line for line in lines if a not in line]
            for v in c:
                if not free:
                    free = [{}]
                    lines.append(free[0])
                free.pop(0)[a] = v
        out += [(key, *(line.get(a, (None,) * 3) for a in accounts)) for line in lines]
    return sorted(out, key=repr)


def test_copies_pair_by_hash_first_like_brute_force(spark):
    import datetime
    import random

    rng = random.Random(2)
    accounts = ["x", "y", "z"]
    day = lambda: datetime.datetime(2024, 1, rng.randrange(1, 4))
    rows = [
        (a, "b", "f/", f"n{k}" if k else None, day(), rng.randrange(3), rng.choice(["h1", "h2", "h3", "h4", None]))
        for k in range(120) for a in accounts for _ in range(rng.choice([0, 1, 1, 1, 2, 3, 5]))
    ]
    for df in (C.combine(spark.createDataFrame(rows, ROWS), accounts), C.combine_many_copies(spark.createDataFrame(rows, ROWS), accounts)):
        got = [((r["key_bucket"], r["key_prefix"], r["name"]), *(tuple(r[C.account_column(accounts, a)] or (None,) * 3) for a in accounts)) for r in df.collect()]
        assert sorted(got, key=repr) == pairing(rows, accounts)
    crossed = [("x", "b", "f/", "k", None, 1, "h1"), ("x", "b", "f/", "k", None, 2, "h2"), ("y", "b", "f/", "k", None, 0, "h2"), ("y", "b", "f/", "k", None, 3, "h1")]
    flat = C.flatten(C.combine(spark.createDataFrame(crossed, ROWS), ["x", "y"]), ["x", "y"])
    assert all(r["hash_in_x"] == r["hash_in_y"] for r in flat.collect())


def test_keys_with_many_copies_take_the_sorted_way(spark):
    rows = [(a, "b", "f/", None if k % 2 else "n", None, k // 3, f"h{k % 5}") for k in range(40) for a in ("x", "y")[: 1 + (k % 3 > 0)]]
    rows += [("x", "b", "f/", "other", None, 1, "h")]
    df = spark.createDataFrame(rows, ROWS)
    many = spark.createDataFrame([("b", "f/", None), ("b", "f/", "n")], "key_bucket string, key_prefix string, name string")
    want = sorted(map(repr, C.combine(df, ["x", "y"]).collect()))
    assert sorted(map(repr, C.combine(df, ["x", "y"], repeated=many).collect())) == want


def test_accounts_named_like_columns(spark):
    wide = spark.createDataFrame([("s3://b/f", "s3://c/g", "s3://d/h")], "name string, uri_ord_x string, size string")
    raw = spark.createDataFrame([("name", "b", "f/a", None, 1, "h"), ("size", "d", "h/a", None, 1, "h")], "account string, bucket string, key string, last_modified timestamp, size long, etag string")
    r = P.full_diff(wide, R.RuleConfig(origin="name", is_hash_the_same_in=["size"]), raw=raw).analysis.first()
    assert (r["hash_in_name"], r["hash_in_size"], r["is_hash_the_same_in_size"]) == ("h", "h", True)


def test_list_folders_sees_every_name(spark, tmp_root):
    """Zero-byte, hidden and underscore names count; nested objects show as sub-folders; roots repeat in paths."""
    import os

    from stocktake.operators import listing as L
    from stocktake.sources.objects import list_folders, with_content_hash

    root = f"{tmp_root}/data/proj/data"
    os.makedirs(f"{root}/b/f g/deep")
    for name, body in (("a.csv", "x"), ("empty.csv", ""), ("_SUCCESS", ""), (".hid", "h"), ("deep/z", "z"), ("é %41.txt", "u")):
        with open(f"{root}/b/f g/{name}", "w") as f:
            f.write(body)
    long = _long(spark, [("s3://b/f g",), ("s3://b/none",)], ["pro"])
    raw = list_folders(long, store=f"file://{root}/")
    listing = {r["name"]: r for r in L.extract_listing(with_content_hash(raw, f"file://{root}/"), long).collect()}
    assert set(listing) == {"a.csv", "empty.csv", "_SUCCESS", ".hid", "é %41.txt", None}
    assert listing["empty.csv"]["size"] == 0 and listing["a.csv"]["hash"] == "9dd4e461268c8034f5c8564e155c67a6"
    assert [r["subfolder"] for r in L.subfolders(raw, long).collect()] == ["f g/deep/"]


def test_rekey_counts_preserved_and_unmapped(spark):
    long = _long(spark, [("s3://b/f", "s3://c/g")], ["pro", "dev"])
    listing = spark.createDataFrame(
        [("pro", "b", "f/", "a", None, 1, "h"), ("dev", "c", "g/", "a", None, 1, "h"), ("dev", "c", "x/", "s", None, 1, "h")],
        LISTING,
    )
    rows = {r["account"]: (r["n_rows"], r["n_rekeyed"], r["n_unmapped"]) for r in C.rekey_counts(listing, long).collect()}
    assert rows == {"pro": (1, 1, 0), "dev": (2, 1, 1)}


def test_order_like_map(spark):
    res = P.full_diff(X.wide_map(spark), R.RuleConfig(origin="pro"), raw=X.raw_entries(spark))
    long = M.unpivot_map(M.clean_map(X.wide_map(spark)))
    names = [r["file_name_in_all_accounts"] for r in C.order_like_map(res.all_accounts, long, X.ACCOUNTS).collect()]
    assert names == [
        "cars-20241014.csv", "dogs-20240914.csv", "dogs-20241015.csv", "dogs-20241019.csv",
        "dogs-20241020-test.csv", "dogs-20241021.csv", "horses-20210219.csv", None,
    ]


def test_strict_unmapped_listing_raises(spark):
    listing = spark.createDataFrame([("pro", "cars", "elsewhere/", "a", None, 1, "h")], LISTING)
    with pytest.raises(ValueError, match="Some values could not be replaced"):
        P.full_diff(X.wide_map(spark), R.RuleConfig(origin="pro"), listing=listing)
    res = P.full_diff(X.wide_map(spark), R.RuleConfig(origin="pro"), listing=listing, strict=False)
    assert res.unmapped.count() == 1


def test_flatten_and_struct_form_round_trip(spark):
    res = P.full_diff(X.wide_map(spark), R.RuleConfig(origin="pro"), raw=X.raw_entries(spark))
    again = C.flatten(C.to_struct_form(res.all_accounts, X.ACCOUNTS), X.ACCOUNTS)
    assert again.columns == res.all_accounts.columns
    assert sorted(map(repr, again.collect())) == sorted(map(repr, res.all_accounts.collect()))
