"""Inventories derived from the driver's ``documents`` table (and ``lineitem``, ``pages``).

The driver tables hold no object listings, so three accounts are derived from
``documents``: every document is an object ``<doc_id>.txt`` in folder
``<source>/<lang>/``. Which account holds which object, and which copies were
changed, is decided by fixed rules on ``doc_id`` (the diff scenario, not a
sample: every document row is read and every text is hashed whole).

* ``pro``: bucket ``docs``, every document except ``doc_id % 11 = 0`` (but those that no other
  account has, ``doc_id % 21 = 0``, are all there: each document is in some account)
* ``release``: same folders, except ``doc_id % 7 = 0``; ``doc_id % 5 = 0`` changed
  (text + ``#r``, size + 2)
* ``dev``: bucket ``docs_dev``, folder ``<lang>/dev_<source>/``, except ``doc_id % 3 = 0``;
  ``doc_id % 13 = 0`` changed (text + ``#d``)
* date: 2024-01-01 00:00 UTC + ``doc_id`` minutes

The three accounts come from one scan of ``documents`` (an ``explode`` of three
account indexes per document, then a filter), not from three scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ACCOUNTS = ["pro", "release", "dev"]
EPOCH_2024 = 1704067200  # 2024-01-01T00:00:00Z


# Columns of the driver tables that the derived inventories use (types as stored). Reading
# with a declared schema skips the schema-inference job and states the column pruning.
TABLE_COLUMNS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id bigint, url string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in TABLE_COLUMNS:
        return spark.read.schema(TABLE_COLUMNS[name]).parquet(path)
    return spark.read.parquet(path)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as a one-partition plan of literals (no Python data shipped to an RDD)."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    structs = [
        F.struct(*[F.lit(v).cast(t.strip()).alias(n.strip()) for (n, t), v in zip(fields, row)]) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def _doc_date() -> Column:
    return F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("doc_id") * F.lit(60))


def listing_from_documents(docs: DataFrame) -> DataFrame:
    """``account, bucket, prefix, name, date, size, hash`` for the three derived accounts.

    One row per document and account that has it. The hash of every account's copy is made inside the
    array that is exploded, so ``text`` ends before the rows multiply.
    """
    i = F.col("doc_id")

    def copy(k: int, there: Column, changed: Column, suffix: str) -> Column:
        content = F.when(changed, F.concat("text", F.lit(suffix))).otherwise(F.col("text"))
        return F.when(there, F.struct(F.lit(k).alias("k"), F.md5(content).alias("hash")))

    copies = F.array(
        copy(0, (i % 11 != 0) | (i % 21 == 0), F.lit(False), ""),
        copy(1, i % 7 != 0, i % 5 == 0, "#r"),
        copy(2, i % 3 != 0, i % 13 == 0, "#d"),
    )
    there = F.filter(copies, lambda c: c.isNotNull())
    base = docs.select("doc_id", "n_chars", "source", "lang", F.inline(there))
    k = F.col("k")
    rel_changed = (k == 1) & (i % 5 == 0)
    return base.select(
        F.element_at(F.array(*[F.lit(a) for a in ACCOUNTS]), k + 1).alias("account"),
        F.when(k == 2, F.lit("docs_dev")).otherwise(F.lit("docs")).alias("bucket"),
        F.when(k == 2, F.concat("lang", F.lit("/dev_"), "source", F.lit("/")))
        .otherwise(F.concat("source", F.lit("/"), "lang", F.lit("/")))
        .alias("prefix"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"),
        _doc_date().alias("date"),
        F.when(rel_changed, F.col("n_chars") + 2).otherwise(F.col("n_chars")).cast("long").alias("size"),
        "hash",
    )


def wide_map_from_documents(docs: DataFrame) -> DataFrame:
    """Map ``pro, release, dev`` (one row per source/lang folder) plus a folder that holds nothing.

    ``dev`` URIs keep a trailing slash on purpose.
    """
    spark = docs.sparkSession
    folders = docs.select("source", "lang").distinct()
    mapped = folders.select(
        F.concat(F.lit("s3://docs/"), "source", F.lit("/"), "lang").alias("pro"),
        F.concat(F.lit("s3://docs/"), "source", F.lit("/"), "lang").alias("release"),
        F.concat(F.lit("s3://docs_dev/"), "lang", F.lit("/dev_"), "source", F.lit("/")).alias("dev"),
    )
    empty = literal_rows(
        spark, [("s3://docs/non-existent", "s3://docs/non-existent", "s3://docs_dev/non-existent")], "pro string, release string, dev string"
    )
    return mapped.unionByName(empty)


# Extra map rows for the map checks: slash/space variants of an existing folder, a whole
# bucket, a blank cell and a URI without scheme.
DIRTY_MAP_ROWS = [
    ("  s3://docs/src0/en/  ", "s3://docs/src0/en/", "s3://docs_dev/en/dev_src0"),
    ("s3://docs/", "   ", "docs_dev/en/dev_src1/"),
]


def dirty_wide_map(docs: DataFrame) -> DataFrame:
    """The map with faults: two fixed rows, and a row for each source and version (``doc_id % 50``) of the
    documents, padded with spaces, with blank, scheme-less and repeated cells by the version.
    """
    extra = literal_rows(docs.sparkSession, DIRTY_MAP_ROWS, "pro string, release string, dev string")
    versions = docs.select("source", (F.col("doc_id") % 50).alias("v")).distinct()
    name = F.concat("source", F.lit("/v"), F.col("v").cast("string"))
    faulty = versions.select(
        F.concat(F.lit("  s3://docs/"), name, F.lit("/ ")).alias("pro"),
        F.when(F.col("v") % 5 == 0, F.lit("  ")).when(F.col("v") % 5 == 1, F.concat(F.lit("s3://docs/"), "source", F.lit("/all/"))).otherwise(F.concat(F.lit("s3://docs/"), name)).alias("release"),
        F.when(F.col("v") % 7 == 0, F.concat(F.lit("docs_dev/"), name)).otherwise(F.concat(F.lit("s3://docs_dev/"), name)).alias("dev"),
    )
    return wide_map_from_documents(docs).unionByName(extra).unionByName(faulty)


# Extra raw entries: a zero-byte folder marker, a non-empty key ending in `/`, keys one
# and two levels below a mapped folder, a marker-only folder, and a folder outside the map.
EXTRA_ENTRIES = [
    ("pro", "docs", "src0/en/", 0, "d41d8cd98f00b204e9800998ecf8427e"),
    ("pro", "docs", "src1/en/", 5, "0cc175b9c0f1b6a831c399e269772661"),
    ("pro", "docs", "src0/en/deeper/x.txt", 7, "9dd4e461268c8034f5c8564e155c67a6"),
    ("pro", "docs", "src0/en/deeper/more/y.txt", 9, "415290769594460e2e485922904f345d"),
    ("pro", "docs", "src0/en/other/z.txt", 3, "fbade9e36a3f36d3d676c1b808451dd7"),
    ("release", "docs", "src2/fr/old/z.txt", 3, "fbade9e36a3f36d3d676c1b808451dd7"),
    ("pro", "docs", "non-existent/", 0, "d41d8cd98f00b204e9800998ecf8427e"),
    ("dev", "docs_dev", "xx/stray.txt", 4, "8277e0910d750195b448797616e091ad"),
]


def old_versions(docs: DataFrame) -> DataFrame:
    """Raw entries one or two levels below the mapped folders of ``pro``: every 23rd document's old version, in a
    sub-folder by its number, so that sub-folders grow with the documents.
    """
    i = F.col("doc_id")
    below = F.concat(F.lit("v"), F.floor(i / 512).cast("string"), F.lit("/"), F.when(i % 46 == 0, F.lit("more/")).otherwise(F.lit("")))
    return docs.where(i % 23 == 0).select(
        F.lit("pro").alias("account"),
        F.lit("docs").alias("bucket"),
        F.concat("source", F.lit("/"), "lang", F.lit("/"), below, i.cast("string"), F.lit(".txt")).alias("key"),
        _doc_date().alias("last_modified"),
        F.col("n_chars").cast("long").alias("size"),
        F.concat(F.lit('"'), F.md5("text"), F.lit('"')).alias("etag"),
    )


def raw_entries_from_documents(docs: DataFrame) -> DataFrame:
    """Raw listing entries (quoted ETags) of the three accounts, their old versions, and :data:`EXTRA_ENTRIES`."""
    spark = docs.sparkSession
    listing = listing_from_documents(docs)
    raw = listing.select(
        "account",
        "bucket",
        F.concat("prefix", "name").alias("key"),
        F.col("date").alias("last_modified"),
        "size",
        F.concat(F.lit('"'), "hash", F.lit('"')).alias("etag"),
    )
    extra = literal_rows(spark, EXTRA_ENTRIES, "account string, bucket string, key string, size long, md5 string").select(
        "account",
        "bucket",
        "key",
        F.timestamp_seconds(F.lit(EPOCH_2024)).alias("last_modified"),
        "size",
        F.concat(F.lit('"'), "md5", F.lit('"')).alias("etag"),
    )
    return raw.unionByName(old_versions(docs)).unionByName(extra)


# Listing rows in folders the map does not name.
STRAY_ROWS = [
    ("dev", "docs_dev", "xx/", "stray.txt", 4, "8277e0910d750195b448797616e091ad"),
    ("release", "docs", "src0/zz/", "lost.txt", 3, "fbade9e36a3f36d3d676c1b808451dd7"),
]


def listing_with_strays(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    stray = literal_rows(
        spark, STRAY_ROWS, "account string, bucket string, prefix string, name string, size long, hash string"
    ).select("account", "bucket", "prefix", "name", F.timestamp_seconds(F.lit(EPOCH_2024)).alias("date"), "size", "hash")
    # Every 17th document has also been left in a folder that no map row names.
    left = docs.filter(F.col("doc_id") % 17 == 0).select(
        F.lit("release").alias("account"), F.lit("docs").alias("bucket"), F.concat(F.lit("lost/"), "lang", F.lit("/")).alias("prefix"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), _doc_date().alias("date"), F.col("n_chars").alias("size"), F.md5("text").alias("hash"),
    )
    return listing_from_documents(docs).unionByName(stray).unionByName(left)


def listing_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as a listing keyed by ``(l_orderkey, l_linenumber)``, which repeats: the duplicate-key fixture."""
    return lineitem.select(
        F.lit("lineitem").alias("account"),
        F.lit("tpch").alias("bucket"),
        F.concat(F.lit("orders/"), F.col("l_orderkey").cast("string"), F.lit("/")).alias("prefix"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".row")).alias("name"),
        F.col("l_shipdate").cast("timestamp").alias("date"),
        F.col("l_quantity").cast("long").alias("size"),
        F.md5(F.concat_ws("|", "l_partkey", "l_suppkey", "l_extendedprice")).alias("hash"),
    )
