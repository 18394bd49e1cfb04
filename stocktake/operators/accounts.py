"""Which configured accounts still have no listing (accounts may be extracted by separate jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.operators.joins import join_small


def map_accounts(long_map: DataFrame) -> DataFrame:
    """``account, account_ord`` of the map, in declared order."""
    return long_map.select("account", "account_ord").distinct()


def pending_accounts(long_map: DataFrame, listing: DataFrame) -> DataFrame:
    """Accounts of the map with no row in the listing table, with ``is_next`` on the first in map order."""
    accounts = map_accounts(long_map)
    # Accounts of the listing that the map knows (bounded by the map's account list).
    present = join_small(listing.select("account"), accounts.select("account"), ["account"], "left_semi", bound=long_map).distinct()
    pending = join_small(accounts, present, ["account"], "left_anti", bound=long_map)
    first_ord = pending.agg(F.min("account_ord")).scalar()  # scalar subquery, evaluated once
    return pending.select("account", "account_ord", F.coalesce(F.col("account_ord") == first_ord, F.lit(False)).alias("is_next"))


def next_account(long_map: DataFrame, listing: DataFrame) -> DataFrame:
    """The first pending account in map order (zero or one row)."""
    return pending_accounts(long_map, listing).where("is_next").select("account", "account_ord")
