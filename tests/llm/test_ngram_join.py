import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
from stocktake.llm import ngram_join as J
from stocktake.llm.components import components
from stocktake.llm.text import scratch

from .cases import documents, prose, texts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows):
    sets = []
    for _, t, _ in rows:
        w = [x.lower() for x in WORD.findall((t or "").encode())]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for g, (i, _, _) in zip(group, rows, strict=True):
        if i is not None:
            least[g].append(i)
    return sorted(((i, len(s), min(least[g], default=None)) for (i, _, _), s, g in zip(rows, sets, group, strict=True)), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_hard_cases_equal_brute_force(spark):
    assert result(J.near_duplicate_groups(documents(spark))) == brute(texts())


def test_empty_table(spark):
    assert result(J.near_duplicate_groups(documents(spark, []))) == []


def test_many_near_copies_over_several_bands(spark, monkeypatch):
    """Small tiles: copies with edits at many places, chains of copies, and a passage that all texts share."""
    monkeypatch.setattr(J, "TILE", 8)
    passage, rows = prose("p", 60), []
    for k in range(6):
        words = (prose(k, 150) + "\n" + passage).split(" ")
        for c in range(9):
            words = list(words)
            words[(17 * c + k) % len(words)] = f"edit{c}"
            rows.append((len(rows) + 100, " ".join(words), "en"))
    assert result(J.near_duplicate_groups(documents(spark, rows))) == brute(rows)


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        data, ends = J.bitmaps(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        x, y = (np.frombuffer(data[i:j], np.uint64) for i, j in zip(ends[:-1], ends[1:], strict=True))
        bits = 64 * min(len(x), len(y))
        differ = int(np.bitwise_count(J.folded(x, bits) ^ J.folded(y, bits)).sum())
        assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - differ) // 2


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in components(edges, scratch(spark)).collect()}
    assert found == {i: 0 for i in range(201)} | {400: 400, 500: 400}


def test_one_of_each_group_stays(spark):
    kept = J.keep_one_of_each_group(documents(spark))
    assert kept.columns == documents(spark).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    expected = {i for i, _, c in brute(texts()) if i == c or i is None} | {4, 5, 6}
    assert ids == sorted(expected, key=repr)


def test_a_tile_folds_each_bitmap_once_a_width(monkeypatch):
    rng, calls, plain = np.random.default_rng(3), [], J.folded
    base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    sets = sorted((np.unique(np.concatenate([base, rng.integers(0, 1 << 62, 20 + k).astype(np.uint64)])) for k in range(30)), key=len)
    n = np.array([len(s) for s in sets])
    bits, ends = J.bitmaps(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]))
    raw = [np.frombuffer(bits[a:b], np.uint64) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    monkeypatch.setattr(J, "folded", lambda words_, wide: calls.append(wide) or plain(words_, wide))
    node, none = np.arange(30), np.zeros(30, np.int64)
    pairs = J.tile_pairs(none, node, n, none, node, raw, Fraction("0.8"), False)
    assert len(pairs) == 30 * 29 // 2  # the base is over 0.8 of every union
    assert len(calls) <= 30 * len({len(x) for x in raw})


def near_copies(count, share, seed=5, n=150):
    """Sets of ``n`` elements: chains in which each has ``share`` new elements in place of some of the last one's."""
    rng = np.random.default_rng(seed)
    sets, now = [], rng.integers(0, 1 << 62, n).astype(np.uint64)
    for _ in range(count):
        now = now.copy()
        now[rng.choice(n, round(share * n), replace=False)] = rng.integers(0, 1 << 62, round(share * n)).astype(np.uint64)
        sets.append(np.unique(now))
    return sets


def tile_of(sets, tree):
    sets = sorted(sets, key=len)
    n = np.array([len(s) for s in sets])
    bits, ends = J.bitmaps(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]))
    raw = [np.frombuffer(bits[a:b], np.uint64) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    node, none = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    pairs = J.tile_pairs(none, node, n, none, node, raw, Fraction("0.8"), tree)
    index = [len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) for a, b in pairs]
    return pairs, np.array(index)


def test_a_tree_takes_the_nearest_pairs():
    """Each set is linked with its neighbours of the chain; those two steps away (index 0.75) look alike to narrow bitmaps."""
    pairs, index = tile_of(near_copies(60, 0.075), True)
    assert len(pairs) == 59 and (index >= 0.8).all()


def test_bitmaps_of_short_sets_rule_out_most_pairs_below_the_threshold():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 150).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.permutation(150)[:139]], rng.integers(0, 1 << 62, 11).astype(np.uint64)])) for _ in range(40)]
    pairs, index = tile_of(sets, False)
    assert (index < 0.8).sum() < 0.1 * 40 * 39 // 2


def test_only_rows_with_wanted_ids_are_cut_into_ngrams():
    ids = [5, None, 7, 5, 0, None, 1 << 60]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(list("abcdefg"))], ["doc_id", "text"])
    taken = lambda *a: "".join(J.wanted_rows(batch, *a).column(1).to_pylist())
    assert taken(np.array([5, 1 << 60]), False) == "adg"
    assert taken(np.array([7]), True) == "bcf"
    assert taken(np.empty(0, np.int64), False) == ""


def test_near_copies_whose_rows_share_or_lack_an_id(spark):
    words = prose("w", 80).split(" ")
    text = lambda k: " ".join([*words[:k], f"edit{k}", *words[k + 1 :]])
    rows = [(3, text(0), "en"), (3, text(70), "en"), (None, text(75), "en"), (None, text(75), "en"), (8, text(75), "en"), (9, "other words", "en")]
    found = sorted(((r.doc_id, r.component_id) for r in J.near_duplicate_groups(documents(spark, rows)).collect()), key=repr)
    assert found == sorted([(3, 3), (3, 3), (None, 3), (None, 3), (8, 3), (9, 9)], key=repr)
