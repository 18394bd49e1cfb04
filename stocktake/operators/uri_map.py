"""The URI map: one column per account, one row per logical folder.

Wide form (as the user writes it) -> long form, one row per (folder, account):
``uri_ord, account_ord, account, uri, bucket, key, prefix, key_bucket, key_prefix``
where ``key_bucket``/``key_prefix`` are the folder of the *key account* (the first
column) in the same row. Every later join re-keys listings through this table.

Validation operators return violation DataFrames; ``assert_valid_map`` raises
with the user-facing messages.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.functions.uri import clean_cell, folder_prefix, is_valid_uri, quoted, uri_bucket, uri_key

ORD = "uri_ord"

# User-facing error messages of the map checks.
MAP_FILE_NAME = "s3-uris-to-analyze.csv"
MSG_PREFIX = f"Error in {MAP_FILE_NAME}"
MSG_EMPTY_ACCOUNT = "Some AWS account names are empty"
MSG_EMPTY_URI = "Some URIs are empty"
MSG_DUPLICATED_URI = "The AWS account {account} has duplicated URIs"
MSG_INVALID_URI = "Some URIs do not match s3://<bucket>/<key>"

# Spark's name for a column whose header cell is empty.
_UNNAMED_COLUMN = re.compile(r"^_c\d+$")


class MapFileError(ValueError):
    """A URI map that cannot be used."""

    def __init__(self, detail: str):
        super().__init__(f"{MSG_PREFIX}. {detail}")


def accounts_of(wide: DataFrame) -> list[str]:
    """Accounts in declared order (column metadata, no job)."""
    return [c for c in wide.columns if c != ORD]


def with_ordinal(wide: DataFrame) -> DataFrame:
    """Add a stable row ordinal (file order for a single CSV) if the map has none."""
    if ORD in wide.columns:
        return wide
    return wide.select(F.monotonically_increasing_id().alias(ORD), *[quoted(c) for c in wide.columns])


def clean_map(wide: DataFrame) -> DataFrame:
    """Trim every cell; blank cells become null."""
    wide = with_ordinal(wide)
    return wide.select(F.col(ORD), *[clean_cell(quoted(a)).alias(a) for a in accounts_of(wide)])


def unpivot_map(wide: DataFrame, accounts: list[str] | None = None) -> DataFrame:
    """Wide map -> long map, with the key account's folder next to every account's folder."""
    wide = with_ordinal(wide)
    accounts = accounts or accounts_of(wide)
    key_account = accounts[0]
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("account_ord"), F.lit(a).alias("account"), quoted(a).cast("string").alias("uri"))
            for i, a in enumerate(accounts)
        ]
    )
    long = wide.select(F.col(ORD), quoted(key_account).cast("string").alias("__key_uri"), F.inline(cells))
    return long.select(
        F.col(ORD),
        "account_ord",
        "account",
        "uri",
        uri_bucket("uri").alias("bucket"),
        uri_key("uri").alias("key"),
        folder_prefix(uri_key("uri")).alias("prefix"),
        uri_bucket("__key_uri").alias("key_bucket"),
        folder_prefix(uri_key("__key_uri")).alias("key_prefix"),
    )


def materialize(long_map: DataFrame) -> DataFrame:
    """Compute the folder-sized long map once, into the shared checkpoint folder.

    Every later use (the broadcast size check, the re-key broadcast, the folder
    lists, the checks) reads the stored rows instead of re-deriving the map, all
    uses see the same row ordinals, and a lost executor never forces a
    recomputation. Unlike ``cache()``, a checkpointed frame keeps AQE's reuse of
    the combine's shuffle intact.
    """
    from stocktake.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(long_map.sparkSession)
    return long_map.checkpoint(eager=True)


def account_pair(wide: DataFrame, origin: str, target: str) -> DataFrame:
    """URIs of two accounts side by side, one row per map row (a projection of the wide map).

    Taken from the wide form in one pass: the row ordinal is not stable across
    two scans of a shuffled input, so it is never used as a join key.
    """
    return wide.select(quoted(origin).alias(origin), quoted(target).alias(target))


def key_folders(long: DataFrame) -> DataFrame:
    """Distinct folders of the key account: the row key space of every result."""
    return long.select(F.col("key_bucket").alias("bucket"), F.col("key_prefix").alias("prefix")).where(
        F.col("bucket").isNotNull()
    ).distinct()


# ---------------------------------------------------------------- checks


def empty_account_names(wide: DataFrame) -> list[str]:
    """Header cells that are blank (Spark names them `_c<i>`)."""
    return [c for c in accounts_of(wide) if not c.strip() or _UNNAMED_COLUMN.match(c)]


def null_uris(long: DataFrame) -> DataFrame:
    return long.filter(F.col("uri").isNull()).select(ORD, "account_ord", "account")


def any_null_uri(long: DataFrame) -> DataFrame:
    return long.agg(F.coalesce(F.bool_or(F.col("uri").isNull()), F.lit(False)).alias("any_null_uri"))


def invalid_uris(long: DataFrame) -> DataFrame:
    """Non-blank URIs that do not split into bucket and key (a whole bucket `s3://b/` included)."""
    return long.filter(F.col("uri").isNotNull() & ~is_valid_uri("uri")).select(ORD, "account_ord", "account", "uri")


def duplicated_uris(long: DataFrame) -> DataFrame:
    """Folders listed more than once for the same account, compared after normalisation (`a` = `a/`)."""
    return (
        long.filter(F.col("bucket").isNotNull())
        .groupBy("account", "bucket", "prefix")
        .agg(F.count(F.lit(1)).alias("n_uris"), F.min("account_ord").alias("account_ord"))
        .filter(F.col("n_uris") > 1)
    )


def assert_valid_map(wide: DataFrame) -> DataFrame:
    """Raise :class:`MapFileError` on the first problem; return the long map otherwise."""
    long = unpivot_map(clean_map(wide))
    check_long_map(wide, long)
    return long


def check_long_map(wide: DataFrame, long: DataFrame) -> None:
    """The checks of :func:`assert_valid_map` on an already unpivoted map."""
    if empty_account_names(wide):
        raise MapFileError(MSG_EMPTY_ACCOUNT)
    if null_uris(long).limit(1).count() > 0:
        raise MapFileError(MSG_EMPTY_URI)
    if invalid_uris(long).limit(1).count() > 0:
        raise MapFileError(MSG_INVALID_URI)
    first_dup = duplicated_uris(long).orderBy("account_ord").select("account").limit(1).collect()
    if first_dup:
        raise MapFileError(MSG_DUPLICATED_URI.format(account=first_dup[0]["account"]))
