"""Composite pipelines.

* P-1 ``extract_accounts``: raw entries -> per-account listings (placeholders for empty folders)
* P-2 ``combine_accounts``: listings -> all-accounts table (re-key, N-way combine, empty folders)
* P-3 ``analysis``: all-accounts table -> rule columns
* P-4 ``full_diff``: map checks, then P-1 .. P-3, optionally written per run id

What reaches the driver is bounded: the map's header, the rule config, size sums and the first
finding of each strict check. The folder-sized map is materialized once (``checkpoint``);
without an output root the rest is one lazy plan. With one, each stage is written for
the run as Parquet and the next stage reads the written table, so the tables are the lineage cut
points (also when stages run as separate jobs). A CSV export is written last, from these tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stocktake.functions.uri import quoted
from stocktake.operators import combine as C
from stocktake.operators import listing as L
from stocktake.operators import rules as R
from stocktake.operators import uri_map as M
from stocktake.operators.joins import join_small
from stocktake.schemas import RAW_ENTRY, all_accounts_schema, key_bucket_column, key_prefix_column
from stocktake.sinks import tables as S
from stocktake.sources.readers import read_listing_table

# Fixed value: error text when listing rows fall outside the map.
MSG_UNMAPPED = "Some values could not be replaced"


@dataclass
class DiffResult:
    long_map: DataFrame
    listing: DataFrame
    all_accounts: DataFrame
    analysis: DataFrame
    unmapped: DataFrame
    duplicates: DataFrame
    subfolders: DataFrame | None = None
    unlike_hashes: DataFrame | None = None
    #: Of a written run: rows of the listing, rows the re-key made of them, and rows outside the map.
    counts: dict[str, int] | None = None


def prepare_map(wide_map: DataFrame, strict: bool = True) -> DataFrame:
    """Clean, unpivot and materialize the map; in strict mode raise on the first map error."""
    long = M.materialize(M.unpivot_map(M.clean_map(wide_map)))
    if strict:
        M.check_long_map(wide_map, long)
    return long


def extract_accounts(raw: DataFrame, long_map: DataFrame, accounts: list[str] | None = None, on_subfolders: str = "report"):
    """P-1. Returns ``(listing, subfolder_report)``; ``on_subfolders="fail"`` raises like a delimiter listing would."""
    report = L.subfolders(raw, long_map, accounts)
    if on_subfolders == "fail":
        L.assert_no_subfolders(report)
    return L.extract_listing(raw, long_map, accounts), report


def combine_accounts(listing: DataFrame, long_map: DataFrame, accounts: list[str]) -> DataFrame:
    """P-2."""
    return C.all_accounts(listing, long_map, accounts)


def analysis(all_accounts_flat: DataFrame, config: R.RuleConfig, accounts: list[str]) -> DataFrame:
    """P-3 (returns the all-accounts table unchanged when ``run_analysis`` is off)."""
    return R.analyse(all_accounts_flat, config, accounts)


def full_diff(
    wide_map: DataFrame,
    config: R.RuleConfig,
    *,
    raw: DataFrame | None = None,
    listing: DataFrame | None = None,
    strict: bool = True,
    on_subfolders: str = "report",
    on_unlike_hashes: str = "report",
    out_root: str | None = None,
    run_id: str | None = None,
    fmt: str = "parquet",
    ordered: bool = False,
) -> DiffResult:
    """P-4. Give either raw entries (P-1 runs) or a ready listing of one run.

    ``ordered`` writes the analysis in map order, then file name (a range-partitioned
    sort; meant for outputs read by people). ``strict`` raises on map errors and on listing rows
    outside the map, before anything is written. ``on_unlike_hashes="fail"`` raises where a hash rule meets hashes of
    different kinds (an MD5 against a multipart digest never match); else they are a report.

    Without ``out_root`` everything stays one lazy plan. With it, each stage is
    written under ``out_root`` for the run and the next stage reads the written
    table (lineage cut), the raw entries first; empty folders are then found from written rows. The run is
    marked as finished last (``runs``): one that was stopped has no mark, and a second attempt takes an old mark back first. The reports (rows outside
    the map, sub-folders, keys listed more than once) are written beside the tables; ``fmt="csv"``
    adds a CSV export of the tables under ``csv/``.
    """
    if listing is None and raw is None:
        raise ValueError("give raw entries or a listing")
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown format {fmt!r}")
    accounts = M.accounts_of(wide_map)
    if config.run_analysis:
        R.assert_config_matches(config, accounts)
    long_map = prepare_map(wide_map, strict)
    given = listing
    if given is not None:
        # A listing extracted here holds mapped folders only; a given one may hold strays.
        unmapped = C.unmapped_objects(given, long_map)
        if strict and unmapped.limit(1).count() > 0:
            raise ValueError(MSG_UNMAPPED)
    run_id = run_id or S.new_run_id()
    if out_root is not None:
        S.begin_run(wide_map.sparkSession, out_root, run_id)
        raw = write_raw_run(raw, out_root, run_id) if raw is not None else None
    report = L.subfolders(raw, long_map, accounts) if raw is not None else None
    if report is not None and on_subfolders == "fail":
        L.assert_no_subfolders(report)

    if out_root is None:
        if listing is None:
            listing = L.extract_listing(raw, long_map, accounts)
            unmapped = C.unmapped_objects(listing, long_map)
        flat = combine_accounts(listing, long_map, accounts)
        unlike = unlike_hashes(flat, config, on_unlike_hashes)
        return DiffResult(long_map, listing, flat, analysis(flat, config, accounts), unmapped, L.duplicate_keys(listing), report, unlike)

    if given is None:
        listing = write_listing_run(raw, long_map, accounts, out_root, run_id)
        unmapped = C.unmapped_objects(listing, long_map)
    else:
        # Every account of the map gets rows, so none of an earlier attempt's rows stay.
        path = S.write_listing(L.with_placeholders(given, long_map, accounts), out_root, run_id)
        listing = read_listing_table(given.sparkSession, path, run_id)
        unmapped = C.unmapped_objects(listing, long_map)
    spark = listing.sparkSession
    kept = {}

    def keep(name: str, report: DataFrame) -> None:
        kept[name] = spark.read.schema(report.schema).parquet(S.write_run(report, S.table_path(out_root, name), run_id))

    keep(S.DUPLICATES_DIR, L.duplicate_keys(listing))
    counts: dict[str, int] = {}
    flat = write_all_accounts_run(listing, long_map, accounts, out_root, run_id, kept[S.DUPLICATES_DIR], counts)
    unlike = unlike_hashes(flat, config, on_unlike_hashes)
    result = analysis(flat, config, accounts)
    columns = result.schema
    if config.run_analysis:
        out = C.order_like_map(result, long_map, accounts) if ordered else result
        result = spark.read.schema(columns).parquet(S.write_run(out, S.table_path(out_root, S.ANALYSIS_DIR), run_id))
    for name, found in ((S.UNMAPPED_DIR, unmapped), (S.SUBFOLDERS_DIR, report), (S.UNLIKE_HASHES_DIR, unlike)):
        if found is not None:
            keep(name, found)
    if fmt == "csv":
        export = S.table_path(out_root, S.CSV_DIR)
        S.write_listing(listing, export, run_id, "csv")
        S.write_all_accounts(flat, export, run_id, "csv")
        if config.run_analysis:
            S.write_run(C.order_like_map(result, long_map, accounts) if ordered else result, S.table_path(export, S.ANALYSIS_DIR), run_id, "csv")
    counts = checked_counts(counts, kept[S.UNMAPPED_DIR], listing, long_map, strict)
    written = [S.LISTINGS_DIR, S.ALL_ACCOUNTS_DIR, *kept] + [S.ANALYSIS_DIR] * config.run_analysis + [S.RAW_DIR] * (raw is not None) + [S.CSV_DIR] * (fmt == "csv")
    S.commit_run(spark, out_root, run_id, written)
    return DiffResult(long_map, listing, flat, result, kept[S.UNMAPPED_DIR], kept[S.DUPLICATES_DIR], kept.get(S.SUBFOLDERS_DIR), kept.get(S.UNLIKE_HASHES_DIR), counts)


def checked_counts(counts: dict[str, int], unmapped: DataFrame, listing: DataFrame, long_map: DataFrame, strict: bool) -> dict[str, int]:
    """A-4: re-keyed and unmapped rows make the listing's rows, unless a folder is mapped to two key folders.

    Metrics of a write may count the rows of a task that ran twice, so where they don't add up, one pass counts again
    before anything is said; ``strict`` raises if rows were lost.
    """
    counts = counts | {"n_unmapped": unmapped.count()}
    if counts.get("n_rows") != counts.get("n_rekeyed", 0) + counts["n_unmapped"] or "n_rows" not in counts:
        sums = C.rekey_counts(listing, long_map).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", "n_rekeyed", "n_unmapped")])
        counts = sums.first().asDict()
        if strict and counts["n_rekeyed"] + counts["n_unmapped"] < counts["n_rows"]:
            raise ValueError(MSG_UNMAPPED)
    return counts


def unlike_hashes(flat: DataFrame, config: R.RuleConfig, on_unlike: str) -> DataFrame | None:
    """The report of hashes that can't be compared, if rules run; ``fail`` raises where it has rows."""
    if not config.run_analysis:
        return None
    report = R.unlike_hashes(flat, config)
    if on_unlike == "fail":
        R.assert_like_hashes(report)
    return report


def write_raw_run(raw: DataFrame, out_root: str, run_id: str) -> DataFrame:
    """Raw entries into the run's own table, once: files, placeholders and the sub-folder report all read it.

    So a store is listed (and its objects hashed) once, and all three tell of the same moment.
    """
    columns = RAW_ENTRY.fieldNames()
    path = S.write_run(raw.select(*columns), S.table_path(out_root, S.RAW_DIR), run_id)
    return raw.sparkSession.read.schema(RAW_ENTRY).parquet(path)


def write_listing_run(raw: DataFrame, long_map: DataFrame, accounts: list[str], out_root: str, run_id: str) -> DataFrame:
    """P-1 into the listing table: files and placeholders in one write.

    So every account owned has rows, and the write replaces all of them: an account that has become
    empty leaves no rows of an earlier attempt. Returns a frame over the written run (lineage cut).
    """
    path = S.write_listing(L.extract_listing(raw, long_map, accounts), out_root, run_id)
    return read_listing_table(raw.sparkSession, path, run_id)


def write_all_accounts_run(listing: DataFrame, long_map: DataFrame, accounts: list[str], out_root: str, run_id: str, duplicates: DataFrame | None = None, counts: dict[str, int] | None = None) -> DataFrame:
    """P-2 into a table: object rows first, then the empty folders found from the written rows.

    ``duplicates`` is the listing's report of keys listed more than once, if it is written already. ``counts`` is
    given ``n_rows`` and ``n_rekeyed``, the listing's rows and those of them that the re-key kept, placeholders included (A-4).

    Reading back two folder columns of the written run is cheaper than a second
    pass over the combine, and the returned frame reads the written table, so
    later stages never recompute the combine (a lineage cut that survives
    executor loss).
    """
    spark, counts = listing.sparkSession, {} if counts is None else counts
    table = S.table_path(out_root, S.ALL_ACCOUNTS_DIR)
    repeated = C.repeated_keys(L.duplicate_keys(listing) if duplicates is None else duplicates, listing, long_map)
    rekeyed = C.rekey(listing, long_map)
    if repeated.isEmpty():
        # Counted by the write's own pass over the rows.
        given, kept = Observation(), Observation()
        seen = listing.observe(given, F.count(F.lit(1)).alias("n_rows"))
        rekeyed = C.rekey(seen, long_map).observe(kept, F.count(F.lit(1)).alias("n_rekeyed"))
        path = S.write_run(C.flatten(C.combine(rekeyed, accounts), accounts), table, run_id, mode="overwrite")
        counts.update(given.get, **kept.get)
    else:
        path = S.write_run(C.flatten(C.combine(rekeyed, accounts, repeated), accounts), table, run_id, mode="overwrite")
    written = spark.read.schema(all_accounts_schema(accounts)).parquet(path)
    key = accounts[0]
    seen = written.select(
        quoted(key_bucket_column(key)).alias("key_bucket"), quoted(key_prefix_column(key)).alias("key_prefix")
    ).distinct()
    folders = M.key_folders(long_map)
    empty = join_small(folders, seen.withColumnsRenamed({"key_bucket": "bucket", "key_prefix": "prefix"}), ["bucket", "prefix"], "left_anti", bound=long_map)
    filler = C.placeholder_rows(empty, accounts)
    S.write_run(C.flatten(filler, accounts), table, run_id, mode="append")
    return spark.read.schema(all_accounts_schema(accounts)).parquet(path)
