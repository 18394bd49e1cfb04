"""Random inventories against a brute-force model of the diff (re-key, combine, empty folders, rules)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stocktake.operators import rules as R
from stocktake.plans import pipeline as P

ACCOUNTS = ["pro", "release", "dev"]
NAMES = ["a.csv", "b.csv", "c.csv", "d.csv"]
HASHES = ["h1", "h2", None]
LISTING = "account string, bucket string, prefix string, name string, date timestamp, size long, hash string"


def _folder(account: str, i: int) -> tuple[str, str]:
    # Each account names the same logical folder differently (bucket and depth differ).
    return {"pro": ("b", f"f{i}/"), "release": ("r", f"x/f{i}/"), "dev": ("d", f"dev/y{i}/")}[account]


objects = st.lists(
    st.tuples(
        st.sampled_from(ACCOUNTS),
        st.integers(0, 2),  # folder index
        st.sampled_from(NAMES),
        st.integers(0, 3),  # size
        st.sampled_from(HASHES),
    ),
    max_size=25,
    unique_by=lambda t: (t[0], t[1], t[2]),
)
configs = st.tuples(
    st.sampled_from(ACCOUNTS),
    st.lists(st.sampled_from(ACCOUNTS), unique=True, max_size=3),
    st.lists(st.sampled_from(ACCOUNTS), unique=True, max_size=3),
)


def model(objs, origin, hash_in, exist_in):
    """Expected analysis rows, keyed by (key bucket, key prefix, name)."""
    cells = {}
    for a, i, n, size, h in objs:
        cells.setdefault((i, n), {})[a] = (size, h)
    rows = {}
    for i in range(3):
        kb, kp = _folder("pro", i)
        names = sorted(n for (j, n) in cells if j == i)
        if not names:
            rows[(kb, kp, None)] = tuple([None] * (len(hash_in) + len(exist_in)))
            continue
        for n in names:
            c = cells[(i, n)]
            out = []
            for t in hash_in:
                o, tg = c.get(origin), c.get(t)
                if o is not None:
                    out.append(tg is not None and o[1] is not None and tg[1] is not None and o[1] == tg[1])
                elif tg is not None:
                    out.append(False)
                else:
                    out.append(None)
            for t in exist_in:
                out.append(False if (c.get(origin) is None and c.get(t) is not None) else None)
            rows[(kb, kp, n)] = tuple(out)
    return rows


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(objs=objects, cfg=configs)
def test_random_inventories_match_model(spark, objs, cfg):
    origin, hash_in, exist_in = cfg
    wide = spark.createDataFrame(
        [tuple("s3://%s/%s" % _folder(a, i) for a in ACCOUNTS) for i in range(3)], "pro string, release string, dev string"
    )
    listing = spark.createDataFrame(
        [(a, *_folder(a, i), n, None, size, h) for a, i, n, size, h in objs], LISTING
    )
    config = R.RuleConfig(origin=origin, is_hash_the_same_in=hash_in, can_the_file_exist_in=exist_in)
    res = P.full_diff(wide, config, listing=listing)
    rule_cols = [R.HASH_COLUMN_PREFIX + t for t in hash_in] + [R.EXIST_COLUMN_PREFIX + t for t in exist_in]
    got = {
        (r["bucket_in_pro"], r["prefix_in_pro"], r["file_name_in_all_accounts"]): tuple(r[c] for c in rule_cols)
        for r in res.analysis.collect()
    }
    assert res.analysis.count() == len(got)
    assert got == model(objs, origin, hash_in, exist_in)
