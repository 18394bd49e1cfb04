import random

import numpy as np
import public_tokenizers
import pyarrow as pa

from stocktake.llm import pieces as P

from .cases import documents, texts

FILE = public_tokenizers.path("piece_bpe_32k.model")


def brute_score(known, text):
    """Best total score by dynamic programming over all substrings."""
    best = [0.0] + [-np.inf] * len(text)
    longest = max(map(len, known.scores))
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - longest), end):
            got = known.scores.get(text[begin:end].replace(" ", P.SPACE)) if P.SPACE not in text[begin:end] else None
            if got:
                best[end] = max(best[end], best[begin] + got[1])
        if text[end - 1] not in known.singles:
            best[end] = max(best[end], best[end - 1] + known.lowest * len(text[end - 1].encode()))
    return best[-1]


def score_of(known, ids):
    scores = {i: s for i, s in known.scores.values()}
    return sum(known.lowest if i in known.byte_ids else scores[i] for i in ids)


def test_segmentation_is_the_best_scored():
    known, rng = P.vocabulary(FILE), random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice(["the", "ing", " ", "  ", "a", "Z", "é", "日", "\U0001f600", "\n", "▁", "er", "9"]) for _ in range(rng.randint(0, 25)))
        assert np.isclose(score_of(known, known.segment(text)), brute_score(known, text)), text


def test_units_give_the_whole_texts_segmentation():
    known = P.vocabulary(FILE)
    rows = [t or "" for _, t, _ in texts() if len(t or "") < 5000]
    ids, offsets = known.encode(pa.array(rows))
    for t, a, b in zip(rows, offsets[:-1], offsets[1:], strict=True):
        assert np.isclose(score_of(known, ids[a:b].tolist()), score_of(known, known.segment(" " + t)) if t else 0.0)


def test_round_trip_of_hard_cases(spark):
    found = P.piece_digests(documents(spark), FILE).collect()
    assert len(found) == len(texts()) and all(r.round_trip for r in found)
    back = P.decode_pieces(P.encode_pieces(documents(spark), FILE), FILE).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(i), t or "") for i, t, _ in texts())
    assert P.piece_digests(documents(spark, []), FILE).count() == 0
