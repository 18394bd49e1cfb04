"""Join helpers: broadcast a small side only after its size is checked, salt otherwise.

The small sides in this library (URI map, folder lists) grow with the number of
folders, not with the number of objects, but nothing guarantees they stay small.
``join_small`` therefore measures the small side first (the bytes of its values, or those of
a frame that bounds it), broadcasts it when they fit the broadcast budget, and otherwise
falls back to a shuffle join in which hot keys are salted on a high-cardinality column of the big side,
so that one hot folder holding a third of all objects is still spread over many
tasks. Only rows of hot keys are copied on the small side. The salt is a hash of row data, never a random number, so a task that is
re-run after an executor loss puts every row into the same bucket again.
"""

from __future__ import annotations

import operator
import re
import weakref
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.functions.uri import quoted
from stocktake.session import ensure_checkpoint_dir

SALT_COLUMN = "__salt"
# Spark's byte-string suffixes.
UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def parse_bytes(text: str) -> int:
    """A size as Spark writes it: ``10485760``, ``64MB``, ``1g``; negative values stay negative."""
    found = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)b?\s*", str(text).lower())
    if not found:
        raise ValueError(f"not a byte size: {text!r}")
    return int(found[1]) * UNITS[found[2]]


def broadcast_budget(df: DataFrame) -> int:
    """Bytes of a side that may be broadcast: the session's broadcast threshold."""
    return parse_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


# Size checks already run, per DataFrame object (a DataFrame's plan and file listing are fixed).
_MEASURED: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()


def measured_bytes(small: DataFrame) -> int:
    """Bytes of a side's rows, by a sum over its values (nothing is collected but the sum).

    Runs once per DataFrame object; callers pass the same bounding frame (e.g. the
    materialized long map) for every side derived from it.
    """
    if small not in _MEASURED:
        sizes = [F.coalesce(F.octet_length(quoted(f.name).cast("string")), F.lit(0)) + 16 for f in small.schema.fields]
        _MEASURED[small] = int(small.agg(F.sum(reduce(operator.add, sizes).cast("long"))).first()[0] or 0)
    return _MEASURED[small]


def fits_broadcast(small: DataFrame) -> bool:
    """True when the side's measured bytes are within the broadcast budget."""
    budget = broadcast_budget(small)
    return budget > 0 and measured_bytes(small) <= budget


def salt_buckets(df: DataFrame) -> int:
    """Pieces that a hot key is cut into: one for each shuffle partition, unless set."""
    explicit = df.sparkSession.conf.get("stocktake.skew.saltBuckets", None)
    return max(int(explicit or df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1)


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    salt_by: Sequence[str | Column] | None = None,
    broadcast: bool | None = None,
    null_safe: bool = False,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Equi-join a large side to a side expected to be small.

    ``how`` is one of ``inner``, ``left``, ``left_semi``, ``left_anti`` (the big side is
    always the preserved/streamed side). ``broadcast`` forces the decision (tests);
    by default it is taken from the measured size of ``small``, or of ``bound``: a
    cheap DataFrame whose size is proven to be at least ``small``'s (e.g. the
    map's folder list for "folders seen in the listing"), so that sizing the small
    side never runs the expensive plan that produces it.

    ``null_safe`` (semi/anti joins only) compares keys with ``<=>``. Besides
    matching nulls, it stops the optimizer from inferring ``IS NOT NULL`` filters
    from the join and pushing them into ``small``'s subtree, which keeps that
    subtree identical to the same DataFrame used elsewhere in the plan, so its
    shuffle can be reused.
    """
    on = list(on)
    use_broadcast = fits_broadcast(bound if bound is not None else small) if broadcast is None else broadcast
    right = F.broadcast(small) if use_broadcast else small
    if null_safe:
        if how not in ("left_semi", "left_anti"):
            raise ValueError("null_safe joins are for left_semi / left_anti")
        cond = reduce(operator.and_, [big[c].eqNullSafe(right[c]) for c in on])
        return big.join(right, cond, how)
    if use_broadcast:
        return big.join(right, on, how)
    if not salt_by:
        # No column to spread a hot key: rely on AQE's skew-join split of the sort-merge join.
        return big.join(small.hint("merge"), on, how)
    n = salt_buckets(big)
    hot = hot_keys(big, on, n, bound if bound is not None else small)
    # Only hot keys get salts, and only their rows of the small side are copied. Both sides know them by the hash of the key.
    is_hot = F.xxhash64(*on).isin(hot) if hot else F.lit(False)
    unkeyed = reduce(operator.or_, [F.col(c).isNull() for c in on])  # they match nothing, but would all meet in one task
    salt = F.when(is_hot | unkeyed, F.pmod(F.xxhash64(*salt_by), F.lit(n))).otherwise(F.lit(0).cast("long"))
    salts = F.sequence(F.lit(0).cast("long"), F.when(is_hot, F.lit(n - 1)).otherwise(F.lit(0)).cast("long"))
    salted_big = big.withColumn(SALT_COLUMN, salt)
    salted_small = small.withColumn(SALT_COLUMN, F.explode(salts))
    # Spark's own estimate leaves out the growth by the salts, so it could broadcast the copies: the hint forbids it.
    return salted_big.join(salted_small.hint("merge"), on + [SALT_COLUMN], how).drop(SALT_COLUMN)


# Hot keys found, per frame that bounds the small side. They decide where rows go, never which rows match, so what
# was found for one listing serves the next one of the same map.
_HOT: "weakref.WeakKeyDictionary[DataFrame, dict[tuple[str, ...], list[int]]]" = weakref.WeakKeyDictionary()


def hot_keys(big: DataFrame, on: Sequence[str], n: int, bound: DataFrame) -> list[int]:
    """Hashes of the keys that hold more than their share (one ``n``-th) of the big side's rows: fewer than ``n`` can.

    One pass over the key columns, counted per task before anything is shuffled.
    """
    known = _HOT.setdefault(bound, {})
    if tuple(on) not in known:
        ensure_checkpoint_dir(big.sparkSession)
        counts = big.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).checkpoint()  # as many rows as keys
        whole = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
        known[tuple(on)] = [r[0] for r in counts.where(F.col("__n") * n > F.lit(whole)).select(F.xxhash64(*on)).collect()]
    return known[tuple(on)]
