"""Token ids in files of Simple-8b words, and back.

A file is a row of segments, each for some whole documents: magic, counts, document ids
(and which are null), lengths, the first word of each block of ``BLOCK`` ids, the words, and the
exceptions. A 64-bit word holds a selector (4 bits) and as many ids as fit in 60 bits at the selector's
width; the encoder takes the most ids that fit. Selector 0 is the escape: its word points at an
exception, a whole 64-bit number. Blocks are coded apart and their offsets are stored, so all
blocks are coded, and decoded, side by side in numpy.

Defined cases: a null or empty text is the end id alone; a null ``doc_id`` comes first and stays null; rows
with the same ``doc_id`` follow one another by text; an empty table writes no file. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktake.llm.blocks import ordered_blocks
from stocktake.llm.files import create, opened
from stocktake.llm.text import scratch, slices, stored, text_rows
from stocktake.llm.tokens import encoder

MAGIC = b"S8BTOK01"
END_ID = 2
#: Ids of a block.
BLOCK = 1024
#: Ids of a word and their width, by selector; selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
PAD = int(COUNTS.max())
POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (uint64), the first word of every block (and their end), and exceptions, of uint64 values."""
    values = values.astype(np.uint64)
    blocks = -(-len(values) // BLOCK)
    grid = np.zeros((blocks, BLOCK + PAD), np.uint64)
    grid[:, :BLOCK] = np.concatenate([values, np.zeros(blocks * BLOCK - len(values), np.uint64)]).reshape(blocks, BLOCK)
    if len(values) and values.max() >> np.uint64(52):
        width = np.searchsorted(POWERS, grid, side="right").astype(np.uint8)
    else:  # such numbers are exact as doubles
        width = np.frexp(grid.astype(np.float64))[1].astype(np.uint8)
    # The selector of the most values that fit, for a word that would start at each place.
    choice = np.zeros((blocks, BLOCK), np.uint8)
    widest: dict[int, np.ndarray] = {1: width}
    for count in sorted(set(COUNTS.tolist()) - {1}):
        base = max(c for c in widest if c >= count - c)
        part = widest[base]
        span = part.shape[1] - (count - base)
        widest[count] = np.maximum(part[:, :span], part[:, count - base : count - base + span])
    for selector in range(len(COUNTS) - 1, 0, -1):
        fits = widest[int(COUNTS[selector])][:, :BLOCK] <= WIDTHS[selector]
        np.copyto(choice, np.uint8(selector), where=fits)  # ends with the smallest selector, so with the most values, that fits
    step = COUNTS[choice]
    begins = np.zeros((blocks, BLOCK), bool)
    at, live = np.zeros(blocks, np.int64), np.arange(blocks)
    while len(live):
        begins[live, at] = True
        at = at + step[live, at]
        more = at < BLOCK
        live, at = live[more], at[more]
    if blocks and len(values) % BLOCK:
        begins[-1, len(values) % BLOCK :] = False
    row, place = np.nonzero(begins)
    selectors = choice[row, place]
    words, exceptions = selectors.astype(np.uint64) << np.uint64(60), np.empty(0, np.uint64)
    for selector in np.unique(selectors):
        own = np.flatnonzero(selectors == selector)
        if selector == 0:
            exceptions = grid[row[own], place[own]]
            words[own] |= np.arange(len(own), dtype=np.uint64)
            continue
        for k in range(int(COUNTS[selector])):
            if WIDTHS[selector]:
                words[own] |= grid[row[own], place[own] + k] << np.uint64(k * int(WIDTHS[selector]))
    return words, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=blocks))]).astype(np.int64), exceptions


def decode(words: np.ndarray, first: np.ndarray, exceptions: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of :func:`encode`'s output."""
    blocks = len(first) - 1
    selectors = (words >> np.uint64(60)).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(COUNTS[selectors])])
    block = np.repeat(np.arange(blocks), np.diff(first))
    place = block * (BLOCK + PAD) + before[:-1] - before[first[:-1]][block]
    out = np.zeros(blocks * (BLOCK + PAD), np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for selector in np.unique(selectors):
        own = np.flatnonzero(selectors == selector)
        if selector == 0:
            out[place[own]] = exceptions[payload[own].astype(np.int64)]
            continue
        width = int(WIDTHS[selector])
        for k in range(int(COUNTS[selector])):
            if width:
                out[place[own] + k] = payload[own] >> np.uint64(k * width) & np.uint64((1 << width) - 1)
    return out.reshape(blocks, BLOCK + PAD)[:, :BLOCK].ravel()[:n]


def segment(doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> bytes:
    words, first, exceptions = encode(ids)
    head = np.array([len(lengths), len(ids), len(first), len(words), len(exceptions)], "<u8")
    known = doc_ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
    plain = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
    return b"".join([MAGIC, head.tobytes(), known.tobytes(), plain.tobytes(), lengths.astype("<i8").tobytes(), first.astype("<i8").tobytes(), words.astype("<u8").tobytes(), exceptions.astype("<u8").tobytes()])


def segments(file) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """``doc_ids, lengths, ids`` of each segment of an open file."""
    while head := file.read(len(MAGIC) + 40):
        if not head.startswith(MAGIC):
            raise ValueError("not a token file")
        docs, n, firsts, words, exceptions = (int(x) for x in np.frombuffer(head, "<u8", 5, len(MAGIC)))
        take = lambda count, kind: np.frombuffer(file.read(count * np.dtype(kind).itemsize), kind)
        known, plain, lengths, first = take(docs, "u1"), take(docs, "<i8"), take(docs, "<i8"), take(firsts, "<i8")
        ids = decode(take(words, "<u8"), first, take(exceptions, "<u8"), n)
        yield pa.array(plain, pa.int64(), mask=known == 0), lengths, ids


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Writes the files, in ascending ``doc_id``; returns ``block, part, path, n_ids, n_docs`` of every file."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, total, rows, path = None, None, 0, 0, ""
        result: list[tuple] = []

        def close() -> None:
            if out is not None:
                out.close()
                result.append((now, path, total, rows))

        for batch in slices(batches):
            block = batch.column(2).to_numpy(zero_copy_only=False)
            for part in np.unique(block):  # ascending, as the rows are
                own = batch.slice(int(np.searchsorted(block, part)), int((block == part).sum()))
                if part != now:
                    close()
                    now, total, rows = int(part), 0, 0
                    out, path = create(folder, f"tokens-{now:08d}")
                ids, offsets = encoder(tokenizer).encode(own.column(1))
                ids = np.insert(ids, offsets[1:], end_id)
                lengths = np.diff(offsets) + 1
                out.write(segment(own.column(0), ids, lengths))
                total, rows = total + len(ids), rows + len(lengths)
        close()
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in result], k) for i, k in enumerate(kinds)], ["block", "path", "n_ids", "n_docs"])

    rows = ordered_blocks(text_rows(docs)).select("doc_id", "text", "block")
    return rows.mapInArrow(write, "block int, path string, n_ids long, n_docs long")


def read_tokens(files: DataFrame) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens, ids_crc32`` from the files of ``files (block, path, n_ids)``."""
    # One row a file (thousands of documents): the running total is over the files only.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("start"))
    tasks = max(1, min(files.count(), 100_000))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with opened(path) as file:
                    for doc_ids, lengths, ids in segments(file):
                        ends = np.cumsum(lengths)
                        plain = ids.astype("<u4")
                        crc = [crc32(plain[e - n : e].tobytes()) for e, n in zip(ends, lengths, strict=True)]
                        yield pa.RecordBatch.from_arrays([doc_ids, pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(lengths.sum())

    return placed.repartition(tasks, "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    root = scratch(docs.sparkSession)
    return read_tokens(stored(write_tokens(docs, tokenizer, f"{root}/tokens", end_id), root, "files"))
