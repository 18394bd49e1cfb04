from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest

from stocktake.llm import packing as P

from .cases import documents, prose, texts

FILE = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(t):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(FILE).encode(t or "", add_special_tokens=False).ids, 0]


def check(rows, found, capacity):
    """All pieces of all documents, each once; sequences gapless from 0 and within the capacity."""
    want = defaultdict(int)
    for i, t, _ in rows:
        ids = whole_ids(t)
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[i, k, at, len(part), crc32(np.array(part, "<u4").tobytes())] += 1
    got, sequences = defaultdict(int), defaultdict(list)
    for r in found:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(k[3] * n for k, n in want.items()) // capacity)


def test_hard_cases(spark):
    used, least = check(texts(), P.pack_documents(documents(spark), FILE).collect(), P.CAPACITY)
    assert used <= least + 1


def test_many_shards_stay_near_the_bound(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 100)
    monkeypatch.setattr(P, "EPOCHS", 1)
    rows = [(k, prose(k, 5 + (k * 37) % 90), "en") for k in range(250)]
    used, least = check(rows, P.pack_documents(documents(spark, rows), FILE, 256).collect(), 256)
    assert used <= 1.03 * least + 1


def test_pieces_of_over_half_a_sequence(spark, monkeypatch):
    """No two of them share a bin: the levels must end."""
    monkeypatch.setattr(P, "SHARD", 8)
    monkeypatch.setattr(P, "EPOCHS", 1)
    rows = [(k, "the " * 150, "en") for k in range(20)]
    used, _ = check(rows, P.pack_documents(documents(spark, rows), FILE, 256).collect(), 256)
    assert used == 20


def test_empty_table(spark):
    assert P.pack_documents(documents(spark, []), FILE).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_crossover_keeps_every_piece(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 100, 200)
    one, two = P.founders(lengths, 128, rng)[:2]
    child = P.crossover(lengths, one, two, 128, rng)
    assert (child.bin >= 0).all() and np.bincount(child.bin, weights=lengths).astype(int).tolist() == child.fill
    assert max(child.fill) <= 128 and min(child.fill) > 0


def test_evolution_gains_on_its_founders():
    """Triples that fill a bin exactly, which best-fit alone misses."""
    rng = np.random.default_rng(4)
    cuts = np.sort(rng.integers(26, 50, (60, 2)), axis=1)
    lengths = np.concatenate([cuts[:, 0], cuts[:, 1], 128 - cuts.sum(axis=1)])
    population = P.founders(lengths, 128, rng)
    before = max(p.fitness() for p in population)
    assert P.evolve(lengths, population, 128, rng, 400)[0].fitness() > before
