"""Random raw listings against a brute-force model of P-1 (files, placeholders, sub-folders)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stocktake.operators import listing as L
from stocktake.operators import uri_map as M

PARTS = ["a", "b", "c"]
FOLDERS = ["a/", "a/b/", "c/"]  # mapped folders of the single account (nested on purpose)
RAW = "account string, bucket string, key string, last_modified timestamp, size long, etag string"

keys = st.lists(st.sampled_from(PARTS + ["x.csv", "y.csv"]), min_size=1, max_size=4).map("/".join)
entries = st.lists(
    st.tuples(keys, st.booleans(), st.integers(0, 2)),  # key, trailing slash, size
    max_size=20,
    unique_by=lambda t: t[0] + ("/" if t[1] else ""),
)


def model(rows):
    files, subs = set(), {}
    for key, size in rows:
        is_marker = key.endswith("/") and size == 0
        # A key ending in "/" lists as an entry of that folder itself.
        parent = key if key.endswith("/") else key[: key.rfind("/") + 1]
        for f in FOLDERS:
            if parent == f and not is_marker:
                files.add((f, key.rstrip("/").split("/")[-1], size))
            rest = key[len(f):] if key.startswith(f) else None
            if rest and "/" in rest:
                subs.setdefault(f, set()).add(f + rest.split("/")[0] + "/")
    seen = {f for f, _, _ in files}
    holders = {(f, None, None) for f in FOLDERS if f not in seen}
    return files | holders, {(f, s, len(v)) for f, v in subs.items() for s in v}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=entries)
def test_random_listing_matches_model(spark, rows):
    raw_rows = [(k + ("/" if slash else ""), size) for k, slash, size in rows]
    raw = spark.createDataFrame([("acc", "bk", k, None, s, '"h"') for k, s in raw_rows], RAW)
    wide = spark.createDataFrame([(f"s3://bk/{f}",) for f in FOLDERS], "acc string")
    long_map = M.unpivot_map(M.clean_map(wide))
    got = {(r["prefix"], r["name"], r["size"]) for r in L.extract_listing(raw, long_map).collect()}
    got_subs = {(r["prefix"], r["subfolder"], r["n_subfolders"]) for r in L.subfolders(raw, long_map).collect()}
    want, want_subs = model(raw_rows)
    assert got == want
    assert got_subs == want_subs
