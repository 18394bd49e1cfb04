"""stocktake: compare object inventories across accounts with Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
built-in Spark expressions. The main entry points:

* :func:`stocktake.operators.uri_map.unpivot_map` - wide URI map to long form
* :func:`stocktake.operators.listing.extract_account_listing` - raw entries to a listing
* :func:`stocktake.operators.combine.all_accounts` - re-key + N-way combine + empty folders
* :func:`stocktake.operators.rules.analyse` - three-valued rule columns
* :func:`stocktake.plans.pipeline.full_diff` - the whole chain
"""

from stocktake.session import build_session, scratch_root  # noqa: F401

__all__ = ["build_session", "scratch_root"]
