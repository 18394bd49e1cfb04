import hashlib

import numpy as np
import pyarrow as pa

from stocktake.llm import fingerprint as F

from .cases import documents, prose, texts


def one(text):
    return F.fingerprints(pa.array([text]))[0]


def test_hard_cases_equal_brute_force(spark):
    rows = sorted(texts(), key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    found = F.fingerprint_documents(documents(spark)).collect()
    want = []
    for k, (i, t, _) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        changed = F.edited(t, after)
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), one(t), one(changed), F.likeness(one(t), one(changed)), F.likeness(one(t), one(after))))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_small_blocks_equal_one_block(spark, monkeypatch):
    from stocktake.llm import blocks

    rows = [(k, prose(k, 40), "en") for k in range(60)]
    whole = sorted(map(tuple, F.fingerprint_documents(documents(spark, rows)).collect()))
    plain = blocks.ordered_blocks
    monkeypatch.setattr(F, "ordered_blocks", lambda df, guests: plain(df, guests, 7))
    assert sorted(map(tuple, F.fingerprint_documents(documents(spark, rows)).collect())) == whole


def test_empty_table_and_single_row(spark):
    assert F.fingerprint_documents(documents(spark, [])).count() == 0
    r = F.fingerprint_documents(documents(spark, [(5, "abcdefgh", "en")])).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1.0


def test_likeness_tells_edits_from_other_texts():
    near, far = [], []
    for k in range(20):
        a, b = prose(k, 300), prose(100 + k, 300)
        near.append(F.likeness(one(a), one(F.edited(a, b))))
        far.append(F.likeness(one(a), one(b)))
    assert min(near) > 0.3 and np.mean(near) > 0.45 and max(far) < 0.2


def test_equal_substrings_share_phrases_whatever_their_offset():
    a = prose(1, 400)
    b = "another beginning " + a[7:]
    names = []
    for t in (a, b):
        data = np.frombuffer(t.encode(), np.uint8).astype(np.uint64) + np.uint64(1)
        row = np.zeros(len(data), np.int64)
        for _ in range(F.LEVELS):
            data, row = F.phrases(data, row)
        names.append(set(data.tolist()))
    assert len(names[0] & names[1]) > 0.9 * len(names[0])


def test_batches_do_not_matter():
    rows = [t for _, t, _ in texts()]
    assert F.fingerprints(pa.array(rows)) == [one(t or "") for t in rows]


def test_distinct_values_by_sorting():
    from stocktake.llm.text import distinct

    for n in (0, 1, 5, 3000):
        values = np.random.default_rng(n).integers(0, 1 << 10, n).astype(np.uint64) << np.uint64(50)
        assert np.array_equal(distinct(values), np.unique(values))
