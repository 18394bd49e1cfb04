"""A row-heavy inventory derived from the driver's ``orders`` table.

Every order is an object ``<o_orderkey>.json`` (150,000 per account at sf0.1) in a
folder per priority and year, so each folder holds thousands of objects. Which
account holds or changed which object follows the order's own attributes:

* ``pro``: bucket ``sales``, folder ``<priority>/<year>/``, every order
* ``release``: same folders; pending orders (status ``P``) are not there yet;
  open urgent orders (status ``O``, priority ``1-URGENT``) were changed
  (content + ``#r``, size + 1)
* ``dev``: bucket ``sales_dev``, folder ``<year>/<priority>/``; finished orders from
  before 1997 were archived away; open low-priority orders were changed (content + ``#d``)

Size is the customer key and the hash is the MD5 of the order's key fields, so
the diff runs on whole rows of ``orders`` with one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.plans.documents import literal_rows


def listing_from_orders(orders: DataFrame) -> DataFrame:
    """One row per order and account index; see :func:`stocktake.plans.documents.listing_from_documents`."""
    k = F.col("k")
    year = F.year("o_orderdate").cast("string")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    content = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    base = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
        F.md5(content).alias("h"),
        F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"),
    )
    rel_changed = (k == 1) & (status == "O") & (priority == "1-URGENT")
    dev_changed = (k == 2) & (status == "O") & (priority == "5-LOW")
    keep = (
        F.when(k == 0, F.lit(True))
        .when(k == 1, status != "P")
        .otherwise(~((status == "F") & (F.year("o_orderdate") < 1997)))
    )
    return base.where(keep).select(
        F.element_at(F.array(F.lit("pro"), F.lit("release"), F.lit("dev")), k + 1).alias("account"),
        F.when(k == 2, F.lit("sales_dev")).otherwise(F.lit("sales")).alias("bucket"),
        F.when(k == 2, F.concat(year, F.lit("/"), priority, F.lit("/")))
        .otherwise(F.concat(priority, F.lit("/"), year, F.lit("/")))
        .alias("prefix"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".json")).alias("name"),
        F.col("o_orderdate").cast("timestamp").alias("date"),
        F.when(rel_changed, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).cast("long").alias("size"),
        F.when(rel_changed, F.md5(F.concat(content, F.lit("#r"))))
        .when(dev_changed, F.md5(F.concat(content, F.lit("#d"))))
        .otherwise(F.col("h"))
        .alias("hash"),
    )


def wide_map_from_orders(orders: DataFrame) -> DataFrame:
    """One map row per priority and year, plus a folder that holds nothing."""
    year = F.year("o_orderdate").cast("string")
    folders = orders.select(F.col("o_orderpriority").alias("p"), year.alias("y")).distinct()
    mapped = folders.select(
        F.concat(F.lit("s3://sales/"), "p", F.lit("/"), "y").alias("pro"),
        F.concat(F.lit("s3://sales/"), "p", F.lit("/"), "y").alias("release"),
        F.concat(F.lit("s3://sales_dev/"), "y", F.lit("/"), "p").alias("dev"),
    )
    empty = literal_rows(
        orders.sparkSession,
        [("s3://sales/returns", "s3://sales/returns", "s3://sales_dev/returns")],
        "pro string, release string, dev string",
    )
    return mapped.unionByName(empty)
