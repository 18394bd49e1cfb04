import hashlib
import math
import random

import numpy as np

from stocktake.llm import nsimplex as N

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, v int, d int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "c", 2, 3) for i, v in vectors], SCHEMA)


def brute_force(vectors, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c)) for _, v in kept]
    for _ in range(rounds):
        of = assign()
        for c in set(of):
            mine = [v for (_, v), o in zip(kept, of) if o == c]
            centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    of = assign()
    distance = [far(v, centroids[o]) for (_, v), o in zip(kept, of)]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = lambda c: sum(d for d, o in zip(distance, of) if o == c)
    return sorted(((-1 if i is None else i), o, d, inertia(o), sum(distance), digest[o]) for (i, _), o, d in zip(kept, of, distance))


def rows_of(df):
    return sorted(((-1 if r.vec_id is None else r.vec_id), *r[1:]) for r in df.collect())


def vectors(seed, n, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    near = lambda c: [float(np.float32(x + spread * rng.gauss(0, 0.3))) for x in c]
    return [(k, near(rng.choice(centres))) for k in range(n)]


def test_equals_brute_force_with_hard_cases(spark):
    rows = vectors(1, 150)
    rows += [(5, rows[5][1]), (5, rows[5][1]), (200, rows[6][1]), (7, rows[8][1])]  # repeated rows and ids, ties
    rows += [(300, None), (301, [1.0] * 63), (302, []), (303, [None] + [1.0] * 63), (304, [float("nan")] + [0.0] * 63), (305, [float("inf")] * 64)]
    rows += [(None, rows[0][1]), (306, [0.0] * 64), (307, [-0.001] * 64), (308, [1000.0] * 64)]
    df = N.cluster_vectors(table(spark, rows))
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert rows_of(df) == brute_force(rows)


def test_few_vectors_equal_vectors_and_none(spark):
    assert N.cluster_vectors(table(spark, [])).count() == 0
    assert N.cluster_vectors(table(spark, [(1, None)])).count() == 0
    few = vectors(2, 5)
    assert rows_of(N.cluster_vectors(table(spark, few))) == brute_force(few)
    same = [(k, [0.5] * 64) for k in range(40)]
    assert rows_of(N.cluster_vectors(table(spark, same))) == brute_force(same)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(3)
    centres = rng.integers(-60, 60, (16, 64))
    points = np.vstack([c + rng.integers(-6, 7, (200, 64)) for c in centres])
    simplex = N.choose_simplex(centres)
    assert len(simplex.pivots) == N.PIVOTS
    squared = N.squared_distances(points, simplex.pivots)
    low, high = N.bounds(simplex.apexes(squared), simplex.apexes(N.squared_distances(centres, simplex.pivots)))
    exact = N.squared_distances(points, centres)
    assert (low <= exact * (1 + 1e-9) + 1e-6).all() and (high >= exact * (1 - 1e-9) - 1e-6).all()
    cluster, distance, done = N.nearest(points, squared, simplex, centres, True)
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert done < 0.2 * exact.size  # most centroids are out by their bounds


def test_pivots_in_one_plane():
    line = np.array([[k] * 64 for k in range(16)])
    simplex = N.choose_simplex(line)
    assert len(simplex.pivots) == 2
    points = np.arange(64 * 50).reshape(50, 64) % 17
    cluster, distance, _ = N.nearest(points, N.squared_distances(points, simplex.pivots), simplex, line, True)
    exact = N.squared_distances(points, line)
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
