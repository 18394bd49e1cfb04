"""SentencePiece-style encoding and decoding: an Aho-Corasick automaton drives one Viterbi pass.

The automaton over all pieces reports, at each end position, every piece that ends there (its own
node's and those along the output links); each relaxes the best score of that position from the best score
where it begins. The result is the segmentation of the largest total score of the vocabulary file's
scores; among equal scores the longest last piece. A character that is no piece itself may be spelt
with byte pieces, each at ``FALLBACK`` under the lowest score. A literal U+2581 is always spelt so, and decoding
gives back every text exactly.

No piece has a space after another character, so the pass works on units that begin with a
run of spaces; equal units are segmented once in a worker.

The public vocabulary file is of a merge-ranked (BPE) kind. The ids here are the best-scored segmentation
over it, which is not what applying its merges gives.

Defined cases: a null or empty text has no pieces; rows are encoded alike whatever their
``doc_id``. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from stocktake.llm.text import bytes_of, flat, row_sums, rows_at, slices, text_rows

SPACE = "▁"
FALLBACK = -10.0
#: Distinct units kept by a worker between batches.
KEPT_UNITS = 1 << 20

_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The worker's automaton of a vocabulary file (built once per worker process)."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary.of_file(path)
    return _vocabularies[path]


class Vocabulary:
    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: list[int], size: int) -> None:
        """``pieces``: id, text (spaces as U+2581), score; ``byte_ids``: the id of each byte value."""
        import ahocorasick

        self.byte_ids, self.scores = byte_ids, {text: (i, score) for i, text, score in pieces}
        self.lowest = min((score for _, _, score in pieces if score > -1e8), default=0.0) + FALLBACK
        self.automaton = ahocorasick.Automaton()
        self.spelt = [b""] * size
        for i, text, score in pieces:
            self.automaton.add_word(text.replace(SPACE, " "), (i, len(text), score))
            self.spelt[i] = text.replace(SPACE, " ").encode()
        for value, i in enumerate(byte_ids):
            self.spelt[i] = bytes([value])
        self.automaton.make_automaton()
        self.singles = {text.replace(SPACE, " ") for _, text, _ in pieces if len(text) == 1}
        sizes = np.array([len(x) for x in self.spelt], np.int64)
        self.spelt_sizes, self.spelt_first = sizes, np.cumsum(sizes) - sizes
        self.spelt_bytes = np.frombuffer(b"".join(self.spelt), np.uint8)
        self.kept: dict[str, np.ndarray] = {}

    @classmethod
    def of_file(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        byte_ids = [0] * 256
        pieces = []
        for i in range(size):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append((i, model.id_to_piece(i), model.get_score(i)))
        return cls(pieces, byte_ids, size)

    def segment(self, unit: str) -> list[int]:
        """Ids of the best segmentation of a text with plain spaces."""
        n = len(unit)
        best, back = [0.0] + [-np.inf] * n, [(0, -1)] * (n + 1)
        done = 0  # positions up to here are final

        def settle(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                char = unit[done - 1]
                if char not in self.singles:
                    score = best[done - 1] + self.lowest * len(char.encode())
                    if score > best[done]:
                        best[done], back[done] = score, (done - 1, -1)

        for end, (piece, length, score) in self.automaton.iter(unit):
            settle(end)
            begin = end + 1 - length
            score += best[begin]
            if score > best[end + 1] or score == best[end + 1] and begin < back[end + 1][0]:
                best[end + 1], back[end + 1] = score, (begin, piece)
        settle(n)
        out: list[int] = []
        while n:
            begin, piece = back[n]
            out.extend([piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(unit[begin:n].encode())])
            n = begin
        return out[::-1]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of the texts (null: empty), and row offsets. A space is put before every text."""
        text = pc.fill_null(flat(text), "")
        filled = pc.not_equal(pc.binary_length(text), 0)
        split = pc.and_(filled, pc.invert(pc.match_substring(text, "\x00")))
        begun = pc.if_else(split, pc.replace_substring_regex(pc.binary_join_element_wise(" ", text, ""), "( +)", "\x00\\1"), "")
        lists = flat(pc.split_pattern(begun, "\x00"))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        row = rows_at(offsets - offsets[0])
        encoded = lists.flatten().dictionary_encode()
        codes, known = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary.to_pylist()
        if len(self.kept) > KEPT_UNITS:
            self.kept.clear()
        for unit in known:
            if unit not in self.kept:
                self.kept[unit] = np.array(self.segment(unit), np.uint32)
        ids = [self.kept[u] for u in known]
        sizes = np.array([len(x) for x in ids], np.int64)
        table, first, n = np.concatenate([*ids, np.empty(0, np.uint32)]), np.cumsum(sizes) - sizes, sizes[codes]
        out = table[np.repeat(first[codes] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        counts = np.bincount(row, weights=n, minlength=len(text)).astype(np.int64)
        odd = np.flatnonzero(pc.and_(filled, pc.invert(split)).to_numpy(zero_copy_only=False))
        if len(odd):
            parts = np.split(out, np.cumsum(counts)[:-1])
            for r in odd:
                parts[r] = np.array(self.segment(" " + text[int(r)].as_py()), np.uint32)
                counts[r] = len(parts[r])
            out = np.concatenate(parts)
        return out, np.concatenate([[0], np.cumsum(counts)])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts' bytes, without the space put before them, and row offsets."""
        n = self.spelt_sizes[ids]
        data = self.spelt_bytes[np.repeat(self.spelt_first[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        sizes = row_sums(n, offsets)
        keep = np.ones(len(data), bool)
        keep[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
        return data[keep], np.concatenate([[0], np.cumsum(np.maximum(sizes - 1, 0))])


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """Per row: ``doc_id, ids`` (array of int)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, offsets = vocabulary(path).encode(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return text_rows(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of ``encoded (doc_id, ids)``: ``doc_id, text``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pc.fill_null(batch.column(1), [])
            offsets = lists.offsets.to_numpy().astype(np.int64)
            data, ends = vocabulary(path).decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0])
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: ``doc_id, n_pieces, ids_crc32`` (little-endian unsigned 32-bit ids), ``round_trip`` (decoding gives the text back)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            known = vocabulary(path)
            ids, offsets = known.encode(batch.column(1))
            data, ends = known.decode(ids, offsets)
            text, wanted = bytes_of(batch.column(1))
            plain = ids.astype("<u4")
            same = [b - a == d - c and bool((data[a:b] == text[c:d]).all()) for a, b, c, d in zip(ends[:-1], ends[1:], wanted[:-1], wanted[1:], strict=True)]
            crc = [crc32(plain[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "n_pieces", "ids_crc32", "round_trip"])

    return text_rows(docs).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")
