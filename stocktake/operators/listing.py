"""Per-account listings from raw object-store entries.

Raw entries (``account, bucket, key, last_modified, size, etag``) come from a
store listing, an inventory report, or a ``binaryFile`` scan. An object belongs to
a mapped folder when its parent folder equals the folder (non-recursive, as a
delimiter listing). Objects deeper than a mapped folder are not files of it; they
show up in the sub-folder report instead.

Output listing: ``account, bucket, prefix, name, date, size, hash`` plus one
placeholder row (null name and attributes) per mapped folder without files.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.functions.uri import ancestor_folders, base_name, hash_kind, is_folder_marker, parent_folder, strip_quotes
from stocktake.operators.joins import join_small

FOLDER_KEY = ["account", "bucket", "prefix"]
LISTING_COLUMNS = ["account", "bucket", "prefix", "name", "date", "size", "hash"]

# User-facing text of the sub-folder error.
MSG_SUBFOLDERS = (
    "Subfolders detected in bucket '{bucket}'. The current version of the program cannot manage subfolders"
    ". Subfolders ({n}): {names}"
)


class SubfolderError(IsADirectoryError):
    pass


def files_only(raw: DataFrame) -> DataFrame:
    """Drop folder markers: entries whose key ends in `/` and whose size is 0."""
    return raw.filter(~is_folder_marker("key", "size") | F.col("size").isNull())


def to_records(raw: DataFrame) -> DataFrame:
    """Raw entries -> listing records (name = last path component, hash = ETag without quotes)."""
    return raw.select(
        "account",
        "bucket",
        parent_folder("key").alias("prefix"),
        base_name("key").alias("name"),
        F.col("last_modified").cast("timestamp").alias("date"),
        F.col("size").cast("long").alias("size"),
        strip_quotes("etag").alias("hash"),
    )


def mapped_folders(long_map: DataFrame, accounts: list[str] | None = None) -> DataFrame:
    """Distinct ``(account, bucket, prefix)`` folders of the map, optionally for some accounts."""
    m = long_map.where(F.col("bucket").isNotNull())
    if accounts is not None:
        m = m.where(F.col("account").isin(list(accounts)))
    return m.select(*FOLDER_KEY).distinct()


def placeholders(folders: DataFrame, records: DataFrame, key: list[str] | None = None, bound: DataFrame | None = None) -> DataFrame:
    """Folders of ``folders`` that have no row in ``records``, as null-attribute rows.

    ``records`` must hold rows of ``folders`` only (as after a semi join), so the
    folder list (or the map it comes from, ``bound``) bounds the seen-folder list
    and is what gets size-checked.
    """
    key = key or FOLDER_KEY
    seen = records.select(*key).distinct()
    empty = join_small(folders.select(*key), seen, key, "left_anti", bound=bound if bound is not None else folders)
    return empty.select(
        *key,
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("timestamp").alias("date"),
        F.lit(None).cast("long").alias("size"),
        F.lit(None).cast("string").alias("hash"),
    )


def with_placeholders(listing: DataFrame, long_map: DataFrame, accounts: list[str] | None = None) -> DataFrame:
    """A given listing with a placeholder for every mapped folder of which it has no row (strays stay)."""
    folders = mapped_folders(long_map, accounts)
    inside = join_small(listing.select(*FOLDER_KEY, "name"), folders, FOLDER_KEY, "left_semi", salt_by=["name"], bound=long_map)
    return listing.select(*LISTING_COLUMNS).unionByName(placeholders(folders, inside, bound=long_map))


def extract_files(raw: DataFrame, long_map: DataFrame, accounts: list[str] | None = None) -> DataFrame:
    """Raw entries -> listing rows of the files directly inside mapped folders (no placeholders)."""
    folders = mapped_folders(long_map, accounts)
    records = to_records(files_only(raw))
    return join_small(records, folders, FOLDER_KEY, "left_semi", salt_by=["name"], bound=long_map).select(*LISTING_COLUMNS)


def extract_listing(raw: DataFrame, long_map: DataFrame, accounts: list[str] | None = None) -> DataFrame:
    """Raw entries of one or more accounts -> their listings, empty folders kept as placeholders."""
    files = extract_files(raw, long_map, accounts)
    return files.unionByName(placeholders(mapped_folders(long_map, accounts), files, bound=long_map))


def subfolders(raw: DataFrame, long_map: DataFrame, accounts: list[str] | None = None) -> DataFrame:
    """Immediate sub-folders found under each mapped folder, with their number per folder.

    One row per ``(account, bucket, prefix, subfolder)``; the folder list of the
    objects is reduced to distinct parents before ancestors are expanded, so the
    expansion grows with the number of folders, not objects.
    """
    folders = mapped_folders(long_map, accounts)
    parents = raw.select("account", "bucket", parent_folder("key").alias("parent")).distinct()
    ancestors = parents.select("account", "bucket", "parent", F.explode(ancestor_folders("parent")).alias("prefix")).where(
        F.col("prefix") != F.col("parent")
    )
    inside = join_small(ancestors, folders, FOLDER_KEY, "inner", bound=long_map)
    rest = F.expr("substring(parent, length(prefix) + 1)")
    found = inside.select(
        *FOLDER_KEY, F.concat(F.col("prefix"), F.substring_index(rest, "/", 1), F.lit("/")).alias("subfolder")
    ).distinct()
    counts = found.groupBy(*FOLDER_KEY).agg(F.count(F.lit(1)).alias("n_subfolders"))
    return join_small(found, counts, FOLDER_KEY, "inner", bound=long_map)


def assert_no_subfolders(report: DataFrame) -> None:
    """Strict mode: raise for the first folder that has sub-folders, with its names in order; no other folder's are gathered."""
    first = report.orderBy(*FOLDER_KEY).limit(1).collect()
    if first:
        mine = reduce(operator.and_, [F.col(c).eqNullSafe(F.lit(first[0][c])) for c in FOLDER_KEY])
        names = [r["subfolder"] for r in report.where(mine).select("subfolder").orderBy("subfolder").collect()]
        raise SubfolderError(MSG_SUBFOLDERS.format(bucket=first[0]["bucket"], n=first[0]["n_subfolders"], names=", ".join(names)))


def duplicate_keys(listing: DataFrame) -> DataFrame:
    """Object keys present more than once in one account's listing (placeholders excluded)."""
    return (
        listing.where(F.col("name").isNotNull())
        .groupBy("account", "bucket", "prefix", "name")
        .agg(F.count(F.lit(1)).alias("n_copies"))
        .where(F.col("n_copies") > 1)
    )


def hash_kinds(listing: DataFrame) -> DataFrame:
    """Objects per account and hash kind: a diff between accounts of different kinds flags every file."""
    return (
        listing.where(F.col("name").isNotNull())
        .groupBy("account", hash_kind("hash").alias("hash_kind"))
        .agg(F.count(F.lit(1)).alias("n_objects"))
    )


def prefixes_end_in_slash(listing: DataFrame, *by: str) -> DataFrame:
    """One row, or one for each value of the named columns: whether every non-null prefix ends in `/`."""
    return listing.groupBy(*by).agg(F.coalesce(F.bool_and(F.col("prefix").endswith("/")), F.lit(True)).alias("all_end_in_slash"))
