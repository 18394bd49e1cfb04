import math
import re
from collections import Counter
from zlib import crc32

import numpy as np

from stocktake.llm import gru_lm as G

from .cases import documents, prose, texts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(t):
    return [x.lower() for x in WORD.findall((t or "").encode())] + [None]


def brute(rows):
    held = [i is None or crc32(str(i).encode()) % 7 == 2 for i, _, _ in rows]
    counts = Counter(w for (_, t, _), h in zip(rows, held, strict=True) if not h for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return n, sorted(((i, h, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 5)) for (i, t, _), h in zip(rows, held, strict=True)), key=repr)


def test_base_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(G, "TOP_COUNTS", 60)  # most words' counts come by the join
    rows = texts() + [(200 + k, prose(k, 90), "en") for k in range(20)]
    n, want = brute(rows)
    found = G.score_documents(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in found), key=repr) == want
    assert all(r.train_tokens == n and r.score < 0 for r in found)


def test_empty_table_and_nothing_to_learn_from(spark):
    assert G.score_documents(documents(spark, [])).count() == 0
    r = G.score_documents(documents(spark, [(None, "some words", "en")])).first()
    assert r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0.0 and math.isfinite(r.score)


def model():
    return {k: v + np.float32(0.05) * np.random.default_rng(1).normal(size=v.shape).astype(np.float32) for k, v in G.initial(np.arange(G.WORDS)[::-1].astype(float)).items()}


def test_probabilities_of_all_ids_sum_to_one():
    w, h = model(), np.random.default_rng(2).normal(size=(3, G.HIDDEN)).astype(np.float32)
    total = sum(10 ** G.log10_of(w, h, np.full(3, y)) for y in range(G.WORDS))
    assert np.allclose(total, 1, atol=1e-4)


def test_lanes_windows_and_order_do_not_change_a_score():
    w, rng = model(), np.random.default_rng(3)
    size = [1, 40, 7, 300, 2, 2, 75, 0, 130]
    ids, offsets = rng.integers(0, G.WORDS, sum(size)).astype(np.int32), np.concatenate([[0], np.cumsum(size)])
    alone = np.array([G.text_scores(w, ids[a:b], np.array([0, b - a])).sum() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
    for lanes in (1, 3, 64):
        assert np.allclose(G.text_scores(w, ids, offsets, lanes), alone, rtol=1e-4)


def test_a_long_text_takes_no_room_in_other_lanes():
    size = np.array([400_000] + [20] * 300)
    offsets = np.concatenate([[0], np.cumsum(size)])
    ids = (np.arange(offsets[-1]) % G.WORDS).astype(np.int32)
    packed = G.Lanes(ids, offsets, 256)
    assert sum(a.nbytes for a in vars(packed).values() if isinstance(a, np.ndarray)) < 20 * len(ids)
    seen, first = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for inputs, targets, begins, text in packed.windows(4096):
        there = text >= 0
        seen += np.bincount(text[there], minlength=len(size))
        first += np.bincount(text[there & begins], minlength=len(size))
        assert (inputs[there & ~begins] == (targets[there & ~begins] - 1) % G.WORDS).all() and (inputs[begins] == 0).all()
    assert (seen == size).all() and (first == 1).all()


def test_gradients_equal_finite_differences():
    w = {k: v.astype(np.float64) for k, v in model().items()}
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 40, (5, 3)), rng.integers(0, 40, (5, 3))
    begins, live = np.zeros((5, 3), bool), np.ones((5, 3), bool)
    begins[0], begins[2, 1], live[4, 2] = True, True, False
    h0 = rng.normal(size=(3, G.HIDDEN))

    def loss(w):
        h, total = h0, 0.0
        for t in range(5):
            out, _ = G.run_window(w, x[t : t + 1], begins[t : t + 1], h)
            h = out[0]
            total -= G.log10_of(w, h[live[t]], y[t][live[t]]).sum() * math.log(10)
        return total / live.sum()

    g, _ = G.gradients(w, x, y, begins, live, h0)
    for k in w:
        at = np.unravel_index(np.argsort(-np.abs(g[k]).ravel())[:4], g[k].shape)
        for place in zip(*at, strict=True):
            e = 1e-3
            up, down = ({**w, k: w[k].copy()} for _ in range(2))
            up[k][place] += e
            down[k][place] -= e
            assert abs((loss(up) - loss(down)) / (2 * e) - g[k][place]) < 2e-2 * abs(g[k][place]) + 1e-5, k


def test_training_beats_the_unigram_start():
    """Texts in which each word tells the next one."""
    rng = np.random.default_rng(5)
    size = 60
    follow = rng.permutation(np.arange(2, 42))
    rows = []
    for _ in range(120):
        w = [int(rng.integers(2, 42))]
        while len(w) < size - 1:
            w.append(int(follow[w[-1] - 2]))
        rows.append([*w, G.END])
    ids, offsets = np.array(rows, np.int32).ravel(), np.arange(0, size * 121, size)
    start = G.initial(np.bincount(ids, minlength=G.WORDS).astype(float))
    half = 60 * size
    learnt = G.train_on(G.train_on(start, ids[:half], offsets[:61], 8), ids[:half], offsets[:61], 8)
    before, after = (G.text_scores(w, ids[half:], offsets[60:] - half).sum() for w in (start, learnt))
    assert after > 0.85 * before


def test_every_training_text_is_learnt_from_once(spark, monkeypatch):
    rows = [(200 + k, prose(k, 60 + k), "en") for k in range(40)]
    docs, averaged, seen = documents(spark, rows), G.averaged, []

    def noted(session, trained):
        total, weight = averaged(session, trained)
        seen.append(weight)
        return total, weight

    monkeypatch.setattr(G, "averaged", noted)
    G.train(docs, G.Counts(G.word_counts(docs)))
    assert len(seen) == G.ROUNDS and all(seen) and sum(seen) == brute(rows)[0]


def test_gradients_of_all_classes_at_once_equal_those_class_by_class():
    w, rng = model(), np.random.default_rng(9)
    y = np.concatenate([rng.integers(0, 40, 50), rng.integers(0, G.WORDS, 30)])  # a class of many chunks, and classes of none
    h = rng.normal(size=(len(y), G.HIDDEN)).astype(np.float32)
    wo, bo, dh = G.member_gradients(w, h, y, np.float32(0.5))
    for c in range(G.CLASSES):
        rows = np.flatnonzero(y // G.MEMBERS == c)
        x = h[rows] @ w["wo"][c] + w["bo"][c]
        q = np.exp(x) / np.exp(x).sum(axis=1, keepdims=True) if len(rows) else x
        q[np.arange(len(rows)), y[rows] % G.MEMBERS] -= 1
        q *= np.float32(0.5)
        assert np.allclose(wo[c], h[rows].T @ q, atol=1e-5) and np.allclose(bo[c], q.sum(0), atol=1e-5)
        assert np.allclose(dh[rows], q @ w["wo"][c].T, atol=1e-5)


def test_sums_of_repeated_rows():
    rng = np.random.default_rng(11)
    rows = np.concatenate([rng.integers(0, G.WORDS, 300), np.full(50, 3)])
    values = rng.normal(size=(len(rows), 5))
    found, sums = G.sums_by_row(values, rows)
    assert (found == np.unique(rows)).all() and np.allclose(sums, [values[rows == r].sum(0) for r in found])


def test_shares_of_rows_far_apart_and_close_by():
    at = np.arange(50) % 8
    for far in (1, 200):
        x = np.random.default_rng(12).normal(size=(50, 8)) + far * np.arange(50)[:, None]
        e = np.exp(x - x.max(axis=1, keepdims=True))
        want = np.log10(e[np.arange(50), at] / e.sum(axis=1))
        assert np.allclose(G.log10_share(x.astype(np.float32), at), want, atol=1e-3)


def test_products_are_made_once_a_class_and_exponentials_once_for_all(monkeypatch):
    w, rng, calls, plain = model(), np.random.default_rng(13), [], G.log10_share
    monkeypatch.setattr(G, "log10_share", lambda x, at: calls.append(len(at)) or plain(x, at))
    G.log10_of(w, rng.normal(size=(500, G.HIDDEN)).astype(np.float32), rng.integers(0, G.WORDS, 500))
    assert calls == [500, 500]


def test_sums_of_short_and_long_runs_equal_reduceat_bit_for_bit():
    rng = np.random.default_rng(14)
    size = np.array([1, 2, 3, 1, 40, 2, 9, 300, 1, 2])
    starts = np.cumsum(size) - size
    for shape in ((), (5,), (4, 6)):
        values = rng.normal(size=(size.sum(), *shape)).astype(np.float32)
        assert (G.sums_from(values, starts) == np.add.reduceat(values, starts, axis=0)).all()


def test_a_steps_parts_are_whole_pieces_of_memory():
    """And the states are those of steps made lane by lane, for any number of lanes."""
    w, rng = model(), np.random.default_rng(15)
    for lanes in (1, 3, 20):
        x, begins, h0 = rng.integers(0, G.WORDS, (6, lanes)), rng.random((6, lanes)) < 0.2, rng.normal(size=(lanes, G.HIDDEN)).astype(np.float32)
        states, saved = G.run_window(w, x, begins, h0)
        assert states.shape == (6, lanes, G.HIDDEN) and all(a.shape[2] == lanes and a[0, : G.HIDDEN].flags.c_contiguous for a in saved)
        h, d, one = h0.astype(float), G.HIDDEN, lambda v: 1 / (1 + np.exp(-v))
        for t in range(6):
            h = np.where(begins[t][:, None], 0, h)
            given, into = w["x"][x[t]].astype(float), h @ w["u"].astype(float)
            r, z = one(given[:, :d] + into[:, :d]), one(given[:, d : 2 * d] + into[:, d : 2 * d])
            n = np.tanh(given[:, 2 * d :] + r * into[:, 2 * d :])
            h = (1 - z) * n + z * h
            assert np.allclose(states[t], h, atol=1e-5)
