"""URI parsing, prefix normalisation, map reading and map validation."""

import pytest
from pyspark.sql import functions as F

from stocktake.functions import uri as U
from stocktake.operators import uri_map as M
from stocktake.sources.readers import read_uri_map


def _eval(spark, col_fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(col_fn(F.col("v"))).collect()]


def test_uri_parts(spark):
    assert _eval(spark, U.uri_bucket, ["s3://a/b/c", "s3://a/", "s3:/a/b", None]) == ["a", None, None, None]
    assert _eval(spark, U.uri_key, ["s3://a/b/c", "s3://bucket-1/tmp", "s3://a//"]) == ["b/c", "tmp", "/"]
    assert _eval(spark, U.is_valid_uri, ["s3://a/b", "s3://a/", "a/b"]) == [True, False, False]


def test_folder_prefix(spark):
    assert _eval(spark, U.folder_prefix, ["prefix_1", "a/", "a/b", "a//", None]) == ["prefix_1/", "a/", "a/b/", "a//", None]


def test_base_name_and_parent(spark):
    assert _eval(spark, U.base_name, ["a/b/c.csv", "a/b/", "c", "/", ""]) == ["c.csv", "b", "c", "", ""]
    assert _eval(spark, U.parent_folder, ["a/b/c.csv", "a/b/", "c"]) == ["a/b/", "a/b/", ""]


def test_strip_quotes_and_clean(spark):
    assert _eval(spark, U.strip_quotes, ['"abc"', "abc", '""x""']) == ["abc", "abc", "x"]
    assert _eval(spark, U.clean_cell, ["  s3://a/b \t", "   ", "", None]) == ["s3://a/b", None, None, None]


def test_render_uri(spark):
    df = spark.createDataFrame([("b", "p/q/")], "bucket string, prefix string")
    assert df.select(U.render_uri("bucket", "prefix")).first()[0] == "s3://b/p/q/"


def _write(tmp_root, name, text):
    path = f"{tmp_root}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_read_map_accounts_and_queries(spark, tmp_root):
    from tests.fixtures import MAP_ROWS

    text = "pro,release,dev\n" + "".join(",".join(r) + "\n" for r in MAP_ROWS)
    wide = read_uri_map(spark, _write(tmp_root, "map.csv", text))
    assert M.accounts_of(wide) == ["pro", "release", "dev"]
    long = M.unpivot_map(M.clean_map(wide))
    dev = sorted(tuple(r) for r in long.where("account = 'dev'").select("bucket", "prefix").collect())
    assert dev == [
        ("cars_dev", "europe/spain/"),
        ("pets_dev", "dogs/size/heavy/"),
        ("pets_dev", "horses/europe/"),
        ("pets_dev", "non-existent-prefix/"),
    ]
    keys = {r["uri"]: (r["key_bucket"], r["key_prefix"]) for r in long.where("account = 'dev'").collect()}
    assert keys["s3://pets_dev/dogs/size/heavy"] == ("pets", "dogs/big_size/")


@pytest.mark.parametrize(
    "text,message",
    [
        ("live,,vault\ns3://a/x,s3://b/x,s3://c/x\n", "Error in s3-uris-to-analyze.csv. Some AWS account names are empty"),
        ("live,vault\ns3://a/x,s3://c/x\n   ,s3://c/y\n", "Error in s3-uris-to-analyze.csv. Some URIs are empty"),
        (
            "live,vault\ns3://a/x,s3://c/1\ns3://a/y,s3://c/2\ns3://a/z,s3://c/1/\n",
            "Error in s3-uris-to-analyze.csv. The AWS account vault has duplicated URIs",
        ),
    ],
)
def test_bad_maps(spark, tmp_root, text, message):
    wide = read_uri_map(spark, _write(tmp_root, "bad.csv", text))
    with pytest.raises(M.MapFileError) as e:
        M.assert_valid_map(wide)
    assert str(e.value) == message


def test_duplicate_detected_after_normalisation(spark):
    wide = spark.createDataFrame([("s3://a/x", "s3://b/1"), ("s3://a/x/", "s3://b/2")], "p string, q string")
    dup = M.duplicated_uris(M.unpivot_map(M.clean_map(wide))).collect()
    assert [(r["account"], r["prefix"], r["n_uris"]) for r in dup] == [("p", "x/", 2)]


def test_whole_bucket_uri_is_invalid(spark):
    wide = spark.createDataFrame([("s3://a/",)], "p string")
    with pytest.raises(M.MapFileError):
        M.assert_valid_map(wide)


def test_any_null_uri(spark):
    wide = spark.createDataFrame([("s3://a/x", "  ")], "p string, q string")
    assert M.any_null_uri(M.unpivot_map(M.clean_map(wide))).first()[0] is True


def test_header_trim_and_duplicates(spark, tmp_root):
    wide = read_uri_map(spark, _write(tmp_root, "m.csv", " pro , dev\ns3://a/b,s3://c/d\n"))
    assert M.accounts_of(wide) == ["pro", "dev"]
    with pytest.raises(M.MapFileError):
        read_uri_map(spark, _write(tmp_root, "d.csv", "a,a\ns3://a/b,s3://c/d\n"))


def test_account_names_with_dots_and_dashes(spark):
    wide = spark.createDataFrame([("s3://a/x", "s3://b/y")], "`pro.eu` string, `dev-1` string")
    long = M.unpivot_map(M.clean_map(wide))
    assert sorted(r["account"] for r in long.collect()) == ["dev-1", "pro.eu"]


def test_account_pair(spark):
    from tests.fixtures import MAP_ROWS

    wide = spark.createDataFrame(MAP_ROWS, "pro string, release string, dev string")
    rows = M.account_pair(wide, "pro", "dev").collect()
    assert [tuple(r) for r in rows] == [(p, d) for p, _, d in MAP_ROWS]


def test_header_with_byte_order_mark(spark, tmp_root):
    path = f"{tmp_root}/bom.csv"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("pro,dev\ns3://a/b,s3://c/d\n")
    wide = read_uri_map(spark, path)
    assert M.accounts_of(wide) == ["pro", "dev"]
    assert [tuple(r)[1:] for r in wide.collect()] == [("s3://a/b", "s3://c/d")]
