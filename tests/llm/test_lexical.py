import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from stocktake.llm import lexical as X

from .cases import documents, prose, texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def brute_force(rows, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in rows if terms(t)]
    count, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        asked, found = set(terms(text)), []
        for doc_id, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * count // length
            score = sum(w[t] * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def ranked(spark, rows, items, k=10, **more):
    queries = spark.createDataFrame([(i, t, 3, "x") for i, t in items], "item_id long, text string, rank int, terms string")
    df = X.rank_documents(documents(spark, [(i, t, "en") for i, t in rows]), queries, k, **more)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


ITEMS = [
    (1, prose(1, 40)),
    (1, prose(1, 40)),  # a repeated query
    (2, "WATER People größe die"),
    (3, None),
    (4, ""),
    (5, "nothinglikethis"),
    (None, "naïve café 日本語 x1_y2 Ünïcödé"),
    (6, "one two three four"),
    (7, "the of and to in"),
    (8, "again"),
    (9, "!!! ### 12345"),
]


@pytest.mark.parametrize("at_once", [1 << 16, 12])
def test_equals_brute_force_with_hard_cases(spark, at_once):
    rows = [(i, t) for i, t, _ in texts()] + [(100 + k, prose(50, 30)) for k in range(30)]  # ties beyond the tenth
    assert ranked(spark, rows, ITEMS, query_terms_at_once=at_once) == brute_force(rows, ITEMS)


def test_many_segments(spark, monkeypatch):
    monkeypatch.setattr(X, "CELLS", 1)
    monkeypatch.setattr(X, "LEAST_DOCS", 40)
    rng = random.Random(4)
    rows = [(k, prose(rng.randrange(300), rng.randrange(3, 60), rng.choice(["en", "de"]))) for k in range(700)]
    rng.shuffle(rows)
    items = [(k, prose(1000 + k, rng.randrange(1, 30), rng.choice(["en", "de"]))) for k in range(25)]
    for k in (1, 10):
        assert ranked(spark, rows, items, k) == brute_force(rows, items, k)


def test_empty_tables(spark):
    assert ranked(spark, [], ITEMS) == [] and ranked(spark, [(1, "water")], []) == []
    assert ranked(spark, [(1, None), (2, ""), (3, " !")], ITEMS) == []


def test_summaries_bound_their_documents_and_blocks_are_skipped():
    rng = np.random.default_rng(1)
    topics = rng.random((12, 80)) < 0.2
    scores = np.vstack([(rng.random((60, 80)) < 0.9 * t) * rng.integers(300, 1000, (60, 80)) for t in topics])
    queries = [np.flatnonzero(t) for t in topics]
    search = X.Search(queries, 80, 10)
    segment = X.Segment(np.arange(len(scores)), scores, search.related)
    for i, q in enumerate(queries):
        for t in q:
            members, summaries, first = segment.blocks_of(int(t))
            assert sorted(np.concatenate(members)) == list(np.flatnonzero(scores[:, t]))
            bound = summaries[:, search.places[i][int(t)]].sum(1)
            for docs, b, f in zip(members, bound, first):
                assert scores[np.ix_(docs, q)].sum(1).max() <= b and f == docs.min()
    search.run(segment)
    for i, q in enumerate(queries):
        whole = scores[:, q].sum(1)
        order = np.lexsort((np.arange(len(scores)), -whole))[:10]
        assert (search.best[i][0] == whole[order]).all() and (search.best[i][1] == order).all()
    assert search.skipped > 0 and search.scored < 0.5 * sum((scores[:, q].sum(1) > 0).sum() for q in queries)
