from stocktake.operators import accounts as A
from stocktake.operators import uri_map as M
from tests import fixtures as X


def test_pending_accounts_in_map_order(spark):
    long = M.unpivot_map(M.clean_map(X.wide_map(spark)))
    listing = spark.createDataFrame([("release", "pets")], "account string, bucket string")
    rows = sorted((r["account"], r["account_ord"], r["is_next"]) for r in A.pending_accounts(long, listing).collect())
    assert rows == [("dev", 2, False), ("pro", 0, True)]
    assert [r["account"] for r in A.next_account(long, listing).collect()] == ["pro"]


def test_no_pending_when_all_listed(spark):
    long = M.unpivot_map(M.clean_map(X.wide_map(spark)))
    listing = spark.createDataFrame([(a,) for a in X.ACCOUNTS], "account string")
    assert A.pending_accounts(long, listing).count() == 0
