"""Listings from raw entries: files only, placeholders, sub-folders, duplicate keys."""

import pytest
from pyspark.sql import functions as F

from stocktake.operators import listing as L
from stocktake.operators import uri_map as M

RAW = "account string, bucket string, key string, last_modified timestamp, size long, etag string"


def _map(spark, rows, accounts):
    return M.unpivot_map(M.clean_map(spark.createDataFrame(rows, ", ".join(f"`{a}` string" for a in accounts))))


def test_placeholders_when_all_folders_empty(spark):
    long = _map(spark, [("s3://shelf-a/north",), ("s3://shelf-b/south",)], ["foo"])
    raw = spark.createDataFrame([], RAW)
    rows = L.extract_listing(raw, long).collect()
    assert sorted((r["bucket"], r["prefix"], r["name"], r["size"]) for r in rows) == [
        ("shelf-a", "north/", None, None),
        ("shelf-b", "south/", None, None),
    ]


def test_files_only_and_marker_only_folder(spark):
    long = _map(spark, [("s3://b/f1",), ("s3://b/f2",)], ["a"])
    raw = spark.createDataFrame(
        [
            ("a", "b", "f1/", None, 0, '""'),  # folder marker: dropped
            ("a", "b", "f1/x.csv", None, 3, '"h1"'),
            ("a", "b", "f2/", None, 0, '""'),  # marker only: f2 gets a placeholder
            ("a", "b", "f1/odd/", None, 5, '"h2"'),  # non-empty key ending in '/': a file named 'odd' in f1/odd/
        ],
        RAW,
    )
    rows = sorted((r["prefix"], r["name"], r["hash"]) for r in L.extract_listing(raw, long).collect())
    assert rows == [("f1/", "x.csv", "h1"), ("f2/", None, None)]


def test_subfolder_report_and_message(spark):
    long = _map(spark, [("s3://crate/in",)], ["a"])
    raw = spark.createDataFrame(
        [("a", "crate", "in/box/x", None, 1, '"h"'), ("a", "crate", "in/box/y/z", None, 1, '"h"'),
         ("a", "crate", "in/loose", None, 1, '"h"')],
        RAW,
    )
    report = L.subfolders(raw, long)
    assert [(r["prefix"], r["subfolder"], r["n_subfolders"]) for r in report.collect()] == [("in/", "in/box/", 1)]
    with pytest.raises(L.SubfolderError) as e:
        L.assert_no_subfolders(report)
    assert str(e.value) == (
        "Subfolders detected in bucket 'crate'. The current version of the program cannot manage subfolders"
        ". Subfolders (1): in/box/"
    )


def test_duplicate_keys(spark):
    df = spark.createDataFrame(
        [("a", "b", "p/", "n", 1), ("a", "b", "p/", "n", 2), ("a", "b", "p/", None, None), ("a", "b", "p/", None, None)],
        "account string, bucket string, prefix string, name string, size long",
    )
    assert [(r["name"], r["n_copies"]) for r in L.duplicate_keys(df).collect()] == [("n", 2)]


def test_listing_csv_sizes_written_as_float(spark, tmp_root):
    """A size written as `49.0` must read back as 49, not null."""
    from stocktake.sources.readers import read_listing_csv

    path = f"{tmp_root}/pro.csv"
    with open(path, "w") as f:
        f.write("bucket,prefix,name,date,size,hash\n")
        f.write("cars,europe/spain/,cars.csv,2024-10-14 08:49:01+00:00,49.0,0123\n")
        f.write("pets,horses/europe/,,,,\n")
    rows = read_listing_csv(spark, path, "pro").orderBy(F.col("name").asc_nulls_last()).collect()
    assert rows[0]["size"] == 49 and rows[0]["hash"] == "0123"
    assert str(rows[0]["date"]) == "2024-10-14 08:49:01"
    assert rows[1]["name"] is None and rows[1]["size"] is None


def test_prefixes_end_in_slash(spark):
    df = spark.createDataFrame([("p/",), ("q",)], "prefix string")
    assert L.prefixes_end_in_slash(df).first()[0] is False


def test_hash_kinds(spark):
    df = spark.createDataFrame(
        [("a", "f15993242621717c5eb2a329b672bc1d"), ("a", "f15993242621717c5eb2a329b672bc1d-3"), ("b", "xyz"), ("b", None)],
        "account string, hash string",
    ).withColumn("name", F.lit("n"))
    rows = sorted(((r["account"], r["hash_kind"], r["n_objects"]) for r in L.hash_kinds(df).collect()), key=repr)
    assert rows == sorted([("a", "md5", 1), ("a", "multipart", 1), ("b", None, 1), ("b", "other", 1)], key=repr)
