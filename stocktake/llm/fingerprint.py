"""Document fingerprints by locally consistent parsing.

A text's bytes are names. Each of ``LEVELS`` rounds names phrases: runs of one name become one; deterministic
coin tossing (the lowest bit in which a name differs from the one before, and its value) is
repeated until labels are few; a phrase starts at each local minimum of the labels, and at the text's start. A
phrase's name is a hash of the names in it. Where a phrase starts depends on few names around
it, so equal substrings are parsed alike but for their edges, wherever they stand.

The fingerprint holds the ``SKETCH`` smallest hashes (32 bits, hexadecimal) of the distinct phrase names of
the last two levels; two fingerprints' likeness is the share of common ones among the smallest of their union,
an estimate of the Jaccard index of the phrases.

Defined cases: a null text is empty; an empty text has the empty fingerprint, which is like itself (1) and nothing
else (0); the next document is the next row by ``doc_id`` and text (nulls first), the last row's is the
first row, a single row's itself. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stocktake.llm.blocks import ordered_blocks
from stocktake.llm.text import bytes_of, distinct, mixed, rows_at, slices, text_rows

LEVELS, SKETCH = 3, 48
#: Rounds of coin tossing that bring 64-bit names down to fewer than 6 labels.
TOSSES = 4
#: Bytes of text parsed at a time.
PARSE_BYTES = 1 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)


def phrases(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: names and rows of the phrases."""
    if not len(names):
        return names, row
    start = np.concatenate([[True], (names[1:] != names[:-1]) | (row[1:] != row[:-1])])
    at = np.flatnonzero(start)
    run = np.diff(np.append(at, len(names))).astype(np.uint64)
    names, row = np.where(run > 1, mixed(names[at] + STEP * run), names[at]), row[at]
    head = np.concatenate([[True], row[1:] != row[:-1]])
    label = names
    for _ in range(TOSSES):
        before = np.concatenate([label[:1], label[:-1]])
        before[head] = ~label[head]
        differ = label ^ before
        low = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.uint64)
        label = low << np.uint64(1) | (label >> low & np.uint64(1))
    left = np.concatenate([[True], label[1:] < label[:-1]])
    right = np.concatenate([label[:-1] < label[1:], [False]])
    last = np.concatenate([head[1:], [True]])
    begins = np.flatnonzero(head | (left & right & ~last))
    length = np.diff(np.append(begins, len(names)))
    out = np.full(len(begins), STEP)
    for k in range(int(length.max())):
        live = np.flatnonzero(length > k)
        out[live] = mixed(out[live] * STEP + names[begins[live] + k])
    return out, row[begins]


def fingerprints(text: pa.Array) -> list[str]:
    data, offsets = bytes_of(text)
    names, row = data.astype(np.uint64) + np.uint64(1), rows_at(offsets)
    values, owners = [], []
    for level in range(LEVELS):
        names, row = phrases(names, row)
        if level >= LEVELS - 2:
            values.append(mixed(names ^ np.uint64(level)) >> np.uint64(32))
            owners.append(row)
    both = distinct(np.concatenate(owners).astype(np.uint64) << np.uint64(32) | np.concatenate(values)) if len(data) else np.empty(0, np.uint64)
    owner = (both >> np.uint64(32)).astype(np.int64)
    first = np.searchsorted(owner, np.arange(len(text) + 1))
    digits = (both & np.uint64(0xFFFFFFFF)).astype(">u4").tobytes().hex()
    return [digits[8 * a : 8 * min(b, a + SKETCH)] for a, b in zip(first[:-1], first[1:], strict=True)]


def likeness(one: str, two: str) -> float:
    if one == two:
        return 1.0
    a, b = ({x[i : i + 8] for i in range(0, len(x), 8)} for x in (one, two))
    union = sorted(a | b)[:SKETCH]
    return sum(x in a and x in b for x in union) / len(union)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row."""

    def rows_of(ids: list, texts: list[str], prints: list[str]) -> pa.RecordBatch:
        """For all rows but the last, which only follows."""
        changed = [edited(t, f) for t, f in zip(texts[:-1], texts[1:], strict=True)]
        changed_prints: list[str] = []
        for part in slices([pa.RecordBatch.from_arrays([pa.array(changed, pa.string())], ["text"])], limit=PARSE_BYTES):
            changed_prints += fingerprints(part.column(0))
        columns = {
            "doc_id": pa.array(ids[:-1], pa.int64()),
            "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            "fingerprint": pa.array(prints[:-1], pa.string()),
            "edited_fingerprint": pa.array(changed_prints, pa.string()),
            "near_edited": pa.array([likeness(a, b) for a, b in zip(prints[:-1], changed_prints, strict=True)], pa.float64()),
            "near_next": pa.array([likeness(a, b) for a, b in zip(prints[:-1], prints[1:], strict=True)], pa.float64()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row whose successor has not come yet: block, id, text, fingerprint
        ended = None  # the block whose guest has come
        for batch in slices(batches, limit=PARSE_BYTES):
            prints = fingerprints(batch.column(1))
            group: list[tuple] = [held] if held else []
            for block, guest, doc_id, text, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(0).to_pylist(), batch.column(1).to_pylist(), prints, strict=True):
                if guest and block == ended:
                    continue  # rows with the doc_id of the first guest
                group.append((block, doc_id, text, own))
                if guest:
                    ended = block
                    yield rows_of([g[1] for g in group], [g[2] for g in group], [g[3] for g in group])
                    group = []
            if len(group) > 1:
                yield rows_of([g[1] for g in group], [g[2] for g in group], [g[3] for g in group])
            held = group[-1] if group else None

    rows = ordered_blocks(text_rows(docs), guests=True).select("doc_id", "text", "block", "guest")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(parse, schema)
