"""Documents in ascending ``doc_id`` order, in blocks of about equal row counts.

The cut points are quantiles of ``doc_id`` alone (one number for each block reaches the driver). Rows of one
block meet in one task, sorted; with ``guests`` the first document of a block also comes last in the block
before it (the very first one in the last block), so that a task sees every row's successor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block, on average.
BLOCK_ROWS = 4096


def ordered_blocks(rows: DataFrame, guests: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``block`` (ascending with ``doc_id``, nulls first) and ``guest``, each block sorted within one partition."""
    spark = rows.sparkSession
    known = rows.filter("doc_id IS NOT NULL")
    count = rows.count()
    n = max(1, -(-count // block_rows))
    shares = [k / n for k in range(1, n)]
    cuts = sorted({int(x) for x in known.stat.approxQuantile("doc_id", shares, 0.1 / n)}) if shares else []
    order = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long"))
    limits = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    block = F.size(F.filter(limits, lambda c: c <= order))
    dealt = rows.withColumn("block", block)
    if guests:
        first = {r.block: r.first for r in dealt.groupBy("block").agg(F.min(order).alias("first")).collect()}
        kept = sorted(first)
        before = {b: kept[i - 1] for i, b in enumerate(kept)}  # the first block's own start goes to the last block
        if kept:
            starts = spark.createDataFrame([(b, first[b], before[b]) for b in kept], "block int, first long, previous int")
            lent = dealt.join(F.broadcast(starts), "block").filter(order == F.col("first"))  # one row for each block
            lent = lent.select(*rows.columns, F.col("previous").alias("block"), F.lit(True).alias("guest"))
            dealt = dealt.withColumn("guest", F.lit(False)).unionByName(lent)
        else:
            dealt = dealt.withColumn("guest", F.lit(False))
    else:
        dealt = dealt.withColumn("guest", F.lit(False))
    return dealt.repartition("block").sortWithinPartitions("block", "guest", "doc_id", "text")
