"""Registered queries: each takes ``(spark, sf_dir)`` and returns a lazy DataFrame.

Names follow the operator IDs they exercise; ``stocktake.plans.oracle`` holds the
independent SQL for each (written as chained FULL JOINs and CASEs, where the
Spark side uses one conditional aggregation).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.functions.uri import WEB_URL_PATTERN, base_name, clean_cell, is_valid_uri, parent_folder, render_uri, uri_bucket, uri_key
from stocktake.operators import accounts as A
from stocktake.operators import combine as C
from stocktake.operators import listing as L
from stocktake.operators import rules as R
from stocktake.operators import uri_map as M
from stocktake.plans import documents as D
from stocktake.plans.written import QUERIES as WRITTEN
from stocktake.schemas import FILE_NAME_COLUMN, key_bucket_column, key_prefix_column

Query = Callable[[SparkSession, str], DataFrame]

ACCOUNTS = D.ACCOUNTS
FLAGSHIP_RULES = R.RuleConfig(origin="pro", is_hash_the_same_in=["release", "dev"], can_the_file_exist_in=["release"])
OTHER_ORIGIN_RULES = R.RuleConfig(origin="release", is_hash_the_same_in=["pro", "dev"], can_the_file_exist_in=["pro", "dev"])


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "documents")


def _long_map(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    docs = docs if docs is not None else _docs(spark, sf_dir)
    return M.materialize(M.unpivot_map(M.clean_map(D.wide_map_from_documents(docs))))


def _dirty_long_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.materialize(M.unpivot_map(M.clean_map(D.dirty_wide_map(_docs(spark, sf_dir)))))


def _key_columns() -> list[str]:
    return [key_bucket_column(ACCOUNTS[0]), key_prefix_column(ACCOUNTS[0]), FILE_NAME_COLUMN]


# ----------------------------------------------------------------- URI / map


def q_uri_parts(spark, sf_dir):
    m = _dirty_long_map(spark, sf_dir)
    return m.select(
        "account",
        "uri",
        "bucket",
        "key",
        "prefix",
        F.when(F.col("bucket").isNotNull(), render_uri("bucket", "prefix")).alias("uri_rendered"),
        is_valid_uri("uri").alias("is_valid"),
    )


def q_url_parts_pages(spark, sf_dir):
    pages = D.table(spark, sf_dir, "pages")
    key = uri_key("url", WEB_URL_PATTERN)
    return pages.select(
        "page_id",
        "url",
        uri_bucket("url", WEB_URL_PATTERN).alias("host"),
        key.alias("key"),
        parent_folder(key).alias("folder"),
        base_name(key).alias("name"),
    )


def q_map_unpivot(spark, sf_dir):
    return _long_map(spark, sf_dir).select("account", "uri", "bucket", "prefix", "key_bucket", "key_prefix")


def q_map_clean(spark, sf_dir):
    raw = M.unpivot_map(D.dirty_wide_map(_docs(spark, sf_dir)))
    return raw.select(
        "account", F.col("uri").alias("uri_raw"), clean_cell("uri").alias("uri"), clean_cell("uri").isNull().alias("is_empty")
    )


def q_map_any_null(spark, sf_dir):
    return M.any_null_uri(_dirty_long_map(spark, sf_dir))


def q_map_duplicates(spark, sf_dir):
    return M.duplicated_uris(_dirty_long_map(spark, sf_dir)).select("account", "bucket", "prefix", "n_uris")


def q_map_invalid_uris(spark, sf_dir):
    return M.invalid_uris(_dirty_long_map(spark, sf_dir)).select("account", "uri")


# ----------------------------------------------------------------- listings


def _raw(spark, sf_dir, docs=None):
    return D.raw_entries_from_documents(docs if docs is not None else _docs(spark, sf_dir))


def q_listing_files_only(spark, sf_dir):
    return L.to_records(L.files_only(_raw(spark, sf_dir))).select("account", "bucket", "prefix", "name", "size", "hash")


def q_listing_subfolders(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return L.subfolders(_raw(spark, sf_dir, docs), _long_map(spark, sf_dir, docs)).select(
        "account", "bucket", "prefix", "subfolder", "n_subfolders"
    )


def q_listing_with_placeholders(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    listing = L.extract_listing(_raw(spark, sf_dir, docs), _long_map(spark, sf_dir, docs))
    return listing.select("account", "bucket", "prefix", "name", "size", "hash")


def q_listing_hash_kinds(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return L.hash_kinds(L.extract_listing(_raw(spark, sf_dir, docs), _long_map(spark, sf_dir, docs)))


def q_listing_csv_round_trip(spark, sf_dir):
    """Per-account listings written as CSV tables and read back (sizes through decimal, hashes as text)."""
    from stocktake.session import scratch_root
    from stocktake.sinks import tables as S
    from stocktake.sources.readers import read_listing_csv_table

    docs = _docs(spark, sf_dir)
    listing = L.extract_listing(_raw(spark, sf_dir, docs), _long_map(spark, sf_dir, docs))
    run_id = S.new_run_id()
    path = S.write_listing(listing, scratch_root(spark), run_id, fmt="csv")
    back = read_listing_csv_table(spark, path, run_id)
    return back.select("account", "bucket", "prefix", "name", "size", "hash")


def q_listing_duplicate_keys(spark, sf_dir):
    return L.duplicate_keys(D.listing_from_lineitem(D.table(spark, sf_dir, "lineitem")))


# ----------------------------------------------------------------- re-key / combine


def q_rekey(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    listing = D.listing_with_strays(docs)
    return C.rekey(listing, _long_map(spark, sf_dir, docs)).select("account", "key_bucket", "key_prefix", "name", "size", "hash")


def q_unmapped_objects(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    listing = D.listing_with_strays(docs)
    return C.unmapped_objects(listing, _long_map(spark, sf_dir, docs)).select("account", "bucket", "prefix", "name")


def q_rekey_counts(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return C.rekey_counts(D.listing_with_strays(docs), _long_map(spark, sf_dir, docs))


def q_combine_full_outer(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    listing = D.listing_from_documents(docs)
    combined = C.combine(C.rekey(listing, _long_map(spark, sf_dir, docs)), ACCOUNTS)
    return C.flatten(combined, ACCOUNTS)


def all_accounts_flat(spark, sf_dir) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return C.all_accounts(D.listing_from_documents(docs), _long_map(spark, sf_dir, docs), ACCOUNTS)


def q_all_accounts(spark, sf_dir):
    return all_accounts_flat(spark, sf_dir)


def q_rule_hash_match(spark, sf_dir):
    flat = all_accounts_flat(spark, sf_dir)
    cols = [R.is_hash_the_same("pro", t).alias(R.HASH_COLUMN_PREFIX + t) for t in ("release", "dev")]
    return flat.select(*_key_columns(), *cols)


def q_rule_can_exist(spark, sf_dir):
    flat = all_accounts_flat(spark, sf_dir)
    cols = [R.can_exist("pro", t).alias(R.EXIST_COLUMN_PREFIX + t) for t in ("release", "dev")]
    return flat.select(*_key_columns(), *cols)


def q_analysis_full(spark, sf_dir):
    return R.analyse(all_accounts_flat(spark, sf_dir), FLAGSHIP_RULES, ACCOUNTS)


def q_analysis_other_origin(spark, sf_dir):
    return R.analyse(all_accounts_flat(spark, sf_dir), OTHER_ORIGIN_RULES, ACCOUNTS)


def q_orders_analysis(spark, sf_dir):
    """Full analysis on the row-heavy ``orders`` inventory (thousands of objects per folder)."""
    from stocktake.plans import orders as O

    orders = D.table(spark, sf_dir, "orders")
    long_map = M.materialize(M.unpivot_map(M.clean_map(O.wide_map_from_orders(orders))))
    flat = C.all_accounts(O.listing_from_orders(orders), long_map, ACCOUNTS)
    return R.analyse(flat, FLAGSHIP_RULES, ACCOUNTS)


def q_rules_unknown_accounts(spark, sf_dir):
    """Accounts are the sources; the config names sources with a suffix by size and language, which mostly are none."""
    docs = _docs(spark, sf_dir)
    grown = F.when(F.col("lang") == "en", F.concat("source", F.lit("-"), F.floor(F.col("n_chars") / 500).cast("string"))).otherwise(F.col("source"))
    names = lambda c: F.array_sort(F.collect_set(c))
    config = docs.agg(
        F.lit(True).alias("run_analysis"), F.concat(F.max("source"), F.lit("-none")).alias("origin"),
        names(grown).alias("can_the_file_exist_in"), names(F.concat("source", F.lit("_"), "lang")).alias("is_hash_the_same_in"),
    )
    return R.unknown_accounts_report(config, docs.select(F.col("source").alias("account")).distinct())


def q_pending_accounts(spark, sf_dir):
    # Listing table at the moment `dev` has not been extracted yet.
    docs = _docs(spark, sf_dir)
    listing = D.listing_from_documents(docs).where(F.col("account") != "dev")
    return A.pending_accounts(_long_map(spark, sf_dir, docs), listing)


def q_round_trip_csv(spark, sf_dir):
    from stocktake.session import scratch_root
    from stocktake.sinks import tables as S
    from stocktake.sources.readers import read_all_accounts_csv

    root = scratch_root(spark)
    run_id = S.new_run_id()
    path = S.write_all_accounts(all_accounts_flat(spark, sf_dir), root, run_id, fmt="csv")
    return read_all_accounts_csv(spark, S.run_path(path, run_id), ACCOUNTS)


QUERIES: dict[str, Query] = {
    "uri_parts": q_uri_parts,
    "url_parts_pages": q_url_parts_pages,
    "map_unpivot": q_map_unpivot,
    "map_clean": q_map_clean,
    "map_any_null": q_map_any_null,
    "map_duplicates": q_map_duplicates,
    "map_invalid_uris": q_map_invalid_uris,
    "listing_files_only": q_listing_files_only,
    "listing_subfolders": q_listing_subfolders,
    "listing_with_placeholders": q_listing_with_placeholders,
    "listing_csv_round_trip": q_listing_csv_round_trip,
    "listing_hash_kinds": q_listing_hash_kinds,
    "listing_duplicate_keys": q_listing_duplicate_keys,
    "rekey": q_rekey,
    "unmapped_objects": q_unmapped_objects,
    "rekey_counts": q_rekey_counts,
    "combine_full_outer": q_combine_full_outer,
    "all_accounts": q_all_accounts,
    "rule_hash_match": q_rule_hash_match,
    "rule_can_exist": q_rule_can_exist,
    "analysis_full": q_analysis_full,
    "analysis_other_origin": q_analysis_other_origin,
    "orders_analysis": q_orders_analysis,
    "rules_unknown_accounts": q_rules_unknown_accounts,
    "pending_accounts": q_pending_accounts,
    "round_trip_csv": q_round_trip_csv,
} | WRITTEN
