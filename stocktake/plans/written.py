"""Queries over the written path: files in, tables and CSV out, and read back from there.

Inputs are derived from whole driver tables (see :mod:`stocktake.plans.documents`); what a query
returns comes from files that the job itself wrote under the scratch folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.functions.uri import from_csv_cell, quoted
from stocktake.operators import combine as C
from stocktake.operators import listing as L
from stocktake.operators import rules as R
from stocktake.operators import uri_map as M
from stocktake.plans import documents as D
from stocktake.plans import pipeline as P
from stocktake.schemas import all_accounts_schema
from stocktake.session import scratch_root
from stocktake.sinks import tables as S
from stocktake.sources import readers as RD
from stocktake.sources.objects import list_folders, with_content_hash, write_objects

ACCOUNTS = D.ACCOUNTS
RULES = R.RuleConfig(origin="pro", is_hash_the_same_in=["release", "dev"], can_the_file_exist_in=["release"])
# Account ids are often digits with leading zeros.
NUMBERED = {"pro": "012345678901", "release": "123456789012", "dev": "000000000007"}
RUN = "20250101000000"
LATER_RUN = "20250102000000"
STOPPED_RUN = "20250103000000"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "documents")


def _raw(listing: DataFrame) -> DataFrame:
    """A listing as the raw entries it came from (quoted ETags)."""
    return listing.select(
        "account", "bucket", F.concat("prefix", "name").alias("key"), F.col("date").alias("last_modified"), "size", F.concat(F.lit('"'), "hash", F.lit('"')).alias("etag")
    )


def _analysis(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    rules = [T.StructField(n, T.BooleanType()) for n in ("is_hash_the_same_in_release", "is_hash_the_same_in_dev", "can_exist_in_release")]
    return spark.read.schema(T.StructType([*all_accounts_schema(ACCOUNTS).fields, *rules])).parquet(S.run_path(S.table_path(root, S.ANALYSIS_DIR), run_id))


def q_full_diff_written(spark, sf_dir):
    """P-4 from raw entries, the analysis read back from its table."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    P.full_diff(D.wide_map_from_documents(docs), RULES, raw=_raw(D.listing_from_documents(docs)), out_root=root, run_id=RUN)
    return _analysis(spark, root, RUN)


def odd_listing(docs: DataFrame) -> DataFrame:
    """Names with outer spaces, quotes, commas and line breaks; dates with fractions of a second."""
    i = F.col("doc_id")
    name = (
        F.when(i % 5 == 0, F.concat(F.lit(" "), i.cast("string"), F.lit(".csv ")))
        .when(i % 5 == 1, F.concat(F.lit('a"'), i.cast("string"), F.lit('",b.csv')))
        .when(i % 5 == 2, F.concat(i.cast("string"), F.lit("\nline\r\nbreak.csv")))
        .when(i % 5 == 3, F.concat(F.lit('"'), i.cast("string"), F.lit('\\".csv')))
        .otherwise(F.concat(i.cast("string"), F.lit(".csv")))
    )
    date = F.timestamp_micros(F.lit(D.EPOCH_2024 * 1_000_000).cast("long") + i * 60_000_000 + i % 3 * 123_456)
    listing = D.listing_from_documents(docs).withColumn("doc_id", F.substring_index("name", ".", 1).cast("long"))
    return listing.withColumns({"name": name, "date": date}).drop("doc_id")


def q_full_diff_csv(spark, sf_dir):
    """The CSV export of a run, with names that only a careful dialect keeps."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    P.full_diff(D.wide_map_from_documents(docs), RULES, listing=odd_listing(docs), out_root=root, run_id=RUN, fmt="csv")
    return RD.read_all_accounts_csv(spark, S.run_path(S.table_path(f"{root}/{S.CSV_DIR}", S.ALL_ACCOUNTS_DIR), RUN), ACCOUNTS)


def q_analysis_csv(spark, sf_dir):
    """SNK-3: the analysis as CSV text (``True``/``False``), typed again when read."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    P.full_diff(D.wide_map_from_documents(docs), RULES, listing=odd_listing(docs), out_root=root, run_id=RUN, fmt="csv")
    base = all_accounts_schema(ACCOUNTS)
    rules = ["is_hash_the_same_in_release", "is_hash_the_same_in_dev", "can_exist_in_release"]
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*base.fieldNames(), *rules]])
    back = spark.read.csv(S.run_path(S.table_path(f"{root}/{S.CSV_DIR}", S.ANALYSIS_DIR), RUN), schema=text, **RD.CSV_READ)
    typed = [(from_csv_cell(quoted(f.name)) if isinstance(f.dataType, T.StringType) else quoted(f.name).try_cast(f.dataType)).alias(f.name) for f in base.fields]
    return back.select(*typed, *[F.col(r).try_cast("boolean").alias(r) for r in rules])


def q_full_diff_rerun(spark, sf_dir):
    """The same run twice; ``dev`` has lost all of its objects by the second time."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    wide, raw = D.wide_map_from_documents(docs), _raw(D.listing_from_documents(docs))
    P.full_diff(wide, RULES, raw=raw, out_root=root, run_id=RUN)
    P.full_diff(wide, RULES, raw=raw.filter("account <> 'dev'"), out_root=root, run_id=RUN)
    return _analysis(spark, root, RUN)


def q_full_diff_earlier_run(spark, sf_dir):
    """Two runs in the listing table; the newest one is diffed, in which every fourth document is gone."""
    docs, root, out = _docs(spark, sf_dir), scratch_root(spark), scratch_root(spark)
    wide, listing = D.wide_map_from_documents(docs), D.listing_from_documents(docs)
    long_map = P.prepare_map(wide)
    path = S.write_listing(L.with_placeholders(listing, long_map), root, RUN)
    later = listing.filter(F.substring_index("name", ".", 1).cast("long") % 4 != 0)
    S.write_listing(L.with_placeholders(later, long_map), root, LATER_RUN)
    # A third run was stopped before its end: it has rows, but no mark.
    S.begin_run(spark, root, STOPPED_RUN)
    S.write_listing(L.with_placeholders(listing.filter("account = 'pro'"), long_map, ["pro"]), root, STOPPED_RUN)
    for done in (RUN, LATER_RUN):
        S.commit_run(spark, root, done, [S.LISTINGS_DIR])
    newest = RD.newest_run(spark, path)
    P.full_diff(wide, RULES, listing=RD.read_listing_table(spark, path, newest), out_root=out, run_id=newest)
    return _analysis(spark, out, newest)


def q_full_diff_subfolders(spark, sf_dir):
    """The sub-folder report that a run writes beside its tables."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    done = P.full_diff(D.wide_map_from_documents(docs), RULES, raw=D.raw_entries_from_documents(docs), out_root=root, run_id=RUN)
    return done.subfolders.select("account", "bucket", "prefix", "subfolder", "n_subfolders")


def q_numeric_accounts(spark, sf_dir):
    """Account ids of digits keep their zeros through the Parquet and the CSV listing."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    wide = D.wide_map_from_documents(docs).withColumnsRenamed(NUMBERED)
    names = F.create_map(*[F.lit(x) for pair in NUMBERED.items() for x in pair])
    listing = D.listing_from_documents(docs).withColumn("account", names[F.col("account")])
    rules = R.RuleConfig(origin=NUMBERED["pro"], is_hash_the_same_in=[NUMBERED["dev"]])
    done = P.full_diff(wide, rules, listing=listing, out_root=root, run_id=RUN, fmt="csv")
    columns = ["account", "bucket", "prefix", "name", "size", "hash"]
    as_csv = RD.read_listing_csv_table(spark, S.table_path(f"{root}/{S.CSV_DIR}", S.LISTINGS_DIR), RUN)
    return done.listing.select(F.lit("parquet").alias("source"), *columns).unionByName(as_csv.select(F.lit("csv").alias("source"), *columns))


def q_combine_duplicate_keys(spark, sf_dir):
    """J-3 where keys repeat: order lines by order and line number, two accounts, every copy kept."""
    lines = D.listing_from_lineitem(D.table(spark, sf_dir, "lineitem"))
    keyed = lines.select(F.col("bucket").alias("key_bucket"), F.col("prefix").alias("key_prefix"), "name", "date", "size", "hash")
    second = keyed.filter("size % 3 <> 0").withColumn("account", F.lit("name"))  # an account called like a column
    rekeyed = keyed.withColumn("account", F.lit("all")).unionByName(second)
    return C.flatten(C.combine(rekeyed, ["all", "name"]), ["all", "name"])


def _map_file(wide: DataFrame, root: str, header: str) -> str:
    """A map as one CSV file with this header line, rows in descending order of the first column."""
    cells = F.concat_ws(",", *[F.coalesce(quoted(c), F.lit("")) for c in wide.columns])
    lines = wide.select(F.lit(1).alias("place"), quoted(wide.columns[0]).alias("first"), cells.alias("value"))
    head = wide.sparkSession.range(1).select(F.lit(0).alias("place"), F.lit(None).cast("string").alias("first"), F.lit(header).alias("value"))
    # Folder-sized: one file, as users write it.
    one = head.unionByName(lines).repartition(1).sortWithinPartitions("place", F.col("first").desc(), "value")
    one.select("value").write.mode("overwrite").text(f"{root}/map")
    return f"{root}/map"


def q_map_file_round_trip(spark, sf_dir):
    """SRC-3: the map read from its CSV file."""
    path = _map_file(D.dirty_wide_map(_docs(spark, sf_dir)), scratch_root(spark), " pro , release,dev ")
    return M.unpivot_map(M.clean_map(RD.read_uri_map(spark, path))).select("account", "uri", "bucket", "prefix", "key_bucket", "key_prefix")


def q_map_empty_account(spark, sf_dir):
    """V-1: a map whose second header cell is empty; URIs by account, and whether its name is empty."""
    wide = RD.read_uri_map(spark, _map_file(D.wide_map_from_documents(_docs(spark, sf_dir)), scratch_root(spark), "pro,,dev"))
    empty = M.empty_account_names(wide)
    return M.unpivot_map(wide).groupBy("account_ord").agg(F.max(F.col("account").isin(empty)).alias("is_empty"), F.countDistinct("uri").alias("n_uris"))


def q_rule_config_file(spark, sf_dir):
    """SRC-5: a config file whose targets are sources of the documents, read and unfolded."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    sources = lambda lang: F.array_sort(F.collect_set(F.when(F.col("lang") == lang, F.col("source"))))
    config = docs.agg(F.lit(True).alias("run_analysis"), F.max("source").alias("origin"), sources("en").alias("can_the_file_exist_in"), sources("de").alias("is_hash_the_same_in"))
    config.coalesce(1).write.json(f"{root}/config")
    read = RD.read_rule_config(spark, f"{root}/config")
    back = R.rules_long(RD.read_rule_config_df(spark, f"{root}/config"))
    return back.select("rule", F.col("ord").cast("long").alias("ord"), "target", F.lit(read.origin).alias("origin"), F.lit(read.run_analysis).alias("run_analysis"))


def q_struct_form(spark, sf_dir):
    """PRJ-15: the all-accounts table to one struct per account, and flat again."""
    from stocktake.plans.queries import all_accounts_flat

    return C.flatten(C.to_struct_form(all_accounts_flat(spark, sf_dir), ACCOUNTS), ACCOUNTS)


def q_account_pair(spark, sf_dir):
    """PRJ-17: the URIs of two accounts side by side."""
    return M.account_pair(D.dirty_wide_map(_docs(spark, sf_dir)), "pro", "dev")


def q_prefix_check(spark, sf_dir):
    """A-3, account by account; ``dev``'s prefixes have lost their slash in one language."""
    listing = D.listing_from_documents(_docs(spark, sf_dir))
    bare = (F.col("account") == "dev") & F.col("prefix").startswith("fr/")
    listing = listing.withColumn("prefix", F.when(bare, F.expr("rtrim('/', prefix)")).otherwise(F.col("prefix")))
    return L.prefixes_end_in_slash(listing, "account")


def with_position(ordered: DataFrame, root: str) -> DataFrame:
    """Adds ``position`` (from 0) of every row of an ordered table: its place in its part, after the parts before."""
    place = F.col("__id")
    ordered.withColumn("__id", F.monotonically_increasing_id()).write.parquet(f"{root}/ordered")
    rows = ordered.sparkSession.read.parquet(f"{root}/ordered").withColumns({"__part": F.shiftright(place, 33), "__place": place.bitwiseAND((1 << 33) - 1)})
    # One row for each part of the sort: the running total is over the parts only.
    parts = rows.groupBy("__part").agg(F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return rows.join(starts, "__part").withColumn("position", F.col("__start") + F.col("__place")).drop("__id", "__part", "__place", "__start")


def q_analysis_ordered(spark, sf_dir):
    """O-2: the all-accounts table in the order of the map file, with each row's position."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    wide = RD.read_uri_map(spark, _map_file(D.wide_map_from_documents(docs), root, "pro,release,dev"))
    long_map = P.prepare_map(wide)
    flat = C.all_accounts(D.listing_from_documents(docs), long_map, ACCOUNTS)
    ordered = with_position(C.order_like_map(flat, long_map, ACCOUNTS), root)
    return ordered.select("position", "bucket_in_pro", "prefix_in_pro", "file_name_in_all_accounts", "hash_in_dev")


def q_inventory_listing(spark, sf_dir):
    """An inventory report (CSV without a header, URL-encoded keys, other column names) to the listing."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    report = D.raw_entries_from_documents(docs).select("bucket", F.url_encode("key"), "size", F.col("last_modified").cast("string"), "etag", "account")
    report.write.options(header=False, **RD.CSV_DIALECT).csv(f"{root}/inventory")
    raw = RD.read_inventory(
        spark, f"{root}/inventory", "csv", csv_columns=["Bucket", "Key", "Size", "LastModifiedDate", "ETag", "Owner"], url_encoded_keys=True,
        columns={"bucket": "Bucket", "key": "Key", "size": "Size", "last_modified": "LastModifiedDate", "etag": "ETag", "account": "Owner"},
    )
    return L.extract_listing(raw, P.prepare_map(D.wide_map_from_documents(docs))).select("account", "bucket", "prefix", "name", "size", "hash")


def q_binaryfile_listing(spark, sf_dir):
    """SRC-1: documents written as text into a folder per source and language, the folders listed from the map.

    Per folder the sizes of its files and its placeholders; the files' own names are Spark's.
    """
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    docs.select(F.concat("source", F.lit("_"), "lang").alias("folder"), "text").write.partitionBy("folder").text(f"{root}/docs")
    named = docs.select("source", "lang").distinct().select(F.concat(F.lit("s3://docs/folder="), "source", F.lit("_"), "lang").alias("pro"))
    empty = spark.range(1).select(F.lit("s3://docs/folder=none").alias("pro"))
    long_map = P.prepare_map(named.unionByName(empty))
    # A local file system keeps a checksum file beside every file that Spark writes; they are no objects of ours.
    raw = list_folders(long_map, store=f"{root}/").filter(~F.col("key").endswith(".crc"))
    listing = L.extract_listing(raw, long_map)
    return listing.groupBy("account", "bucket", "prefix").agg(F.sum("size").alias("size"), F.count(F.when(F.col("name").isNull(), 1)).alias("n_placeholders"))


def _line_objects(docs: DataFrame, numbers: int, line: Column, root: str) -> DataFrame:
    """Objects of one line a document, in order, one object for each source, language and so many document numbers; their folders as a map."""
    part = F.floor(F.col("doc_id") / numbers).cast("string")
    lines = docs.select(F.concat(F.lit("folder="), "source", F.lit("_"), "lang", F.lit("/part="), part).alias("folder"), "doc_id", line.alias("text"))
    write_objects(lines.withColumn("key", F.concat("folder", F.lit("/lines.txt"))), ["doc_id", "text"], f"{root}/", "docs")
    return lines.select(F.concat(F.lit("s3://docs/"), "folder").alias("pro")).distinct()


def q_object_hashes(spark, sf_dir):
    """SRC-1 with content hashes: an object for each source, language and 2048 document numbers, listed and hashed."""
    root, docs = scratch_root(spark), _docs(spark, sf_dir)
    named = _line_objects(docs, 2048, F.coalesce("text", F.lit("")), root)
    raw = list_folders(P.prepare_map(named), store=f"{root}/").filter(~F.col("key").endswith(".crc"))
    return with_content_hash(raw, f"{root}/").select("account", F.regexp_extract("key", "^(.*/)", 1).alias("prefix"), "size", F.col("etag").alias("hash"))


PART_BYTES = 33 * 16


def q_multipart_hashes(spark, sf_dir):
    """T14: objects hashed as uploads in parts, so that they compare with a listing of such digests."""
    root = scratch_root(spark)
    named = _line_objects(_docs(spark, sf_dir), 256, F.md5(F.coalesce("text", F.lit(""))), root)
    raw = list_folders(P.prepare_map(named), store=f"{root}/").filter(~F.col("key").endswith(".crc"))
    hashed = with_content_hash(raw, f"{root}/", PART_BYTES)
    return hashed.select("account", F.regexp_extract("key", "^(.*/)", 1).alias("prefix"), "size", F.col("etag").alias("hash"), L.hash_kind("etag").alias("hash_kind"))


def q_unlike_hashes(spark, sf_dir):
    """T14: ``dev`` holds every fifth object as an upload in parts; the kinds that a run found side by side."""
    docs, root = _docs(spark, sf_dir), scratch_root(spark)
    listing = D.listing_from_documents(docs)
    in_parts = (F.col("account") == "dev") & (F.substring_index("name", ".", 1).cast("long") % 5 == 0)
    mixed = listing.withColumn("hash", F.when(in_parts, F.concat("hash", F.lit("-2"))).otherwise(F.col("hash")))
    done = P.full_diff(D.wide_map_from_documents(docs), RULES, listing=mixed, out_root=root, run_id=RUN)
    return done.unlike_hashes.select("origin", "target", "origin_kind", "target_kind", "n_objects")


QUERIES = {
    "full_diff_written": q_full_diff_written,
    "full_diff_csv": q_full_diff_csv,
    "analysis_csv": q_analysis_csv,
    "full_diff_rerun": q_full_diff_rerun,
    "full_diff_earlier_run": q_full_diff_earlier_run,
    "full_diff_subfolders": q_full_diff_subfolders,
    "numeric_accounts": q_numeric_accounts,
    "combine_duplicate_keys": q_combine_duplicate_keys,
    "map_file_round_trip": q_map_file_round_trip,
    "map_empty_account": q_map_empty_account,
    "rule_config_file": q_rule_config_file,
    "struct_form": q_struct_form,
    "account_pair": q_account_pair,
    "prefix_check": q_prefix_check,
    "analysis_ordered": q_analysis_ordered,
    "inventory_listing": q_inventory_listing,
    "binaryfile_listing": q_binaryfile_listing,
    "object_hashes": q_object_hashes,
    "multipart_hashes": q_multipart_hashes,
    "unlike_hashes": q_unlike_hashes,
}
