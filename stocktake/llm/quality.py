"""Quality rules by distribution divergence.

Every document's character-class and common-word histograms are compared with
references of each language by Jensen-Shannon distance (base 2, square root, 0 to 1).
The references are corpus statistics over all documents that pass the base rules:
per language the sums of the character-class histograms, and the shares of its
most common words, counted exactly. Documents full of symbols, or of repetitions counted without regard to
case, make no reference.

The largest distances kept are learnt from the same documents, by one rule for every language and both
histograms: the ``LIMIT_SHARE`` quantile of the distances of a language's reference documents to its own
reference (those beyond the length guard concerned). The word limit also stays below what a text without any
common word reaches.

Defined cases: a null or empty text has no words and fails the base rules; a null
``lang`` contributes to no reference but is judged like any other row; a row is
kept if some language's limit allows it; repeated rows are judged alike; documents below the
length guards are not judged by the histogram concerned; a language without reference documents
beyond a guard has no such limit and is left out; a language whose common words cover
too little of its text (unspaced scripts) has no word limit, and a text is not judged by words if that language's
characters are the nearest and allow it; with no limit (empty table, no language) the base rules alone decide. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktake.llm.text import bytes_of, mixed, row_sums, rows_at, scratch, slices, stored, text_rows, words
from stocktake.llm.tokens import drop_encoders

# The character classes, as rows of (name, characters). Bytes of 128 and more
# are `wide`; UTF-8 continuation bytes are not counted; the rest is `other`.
CLASSES = [
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("digit", "0123456789"),
    ("space", " "),
    ("break", "\t\n\r\v\f"),
    ("stop", ".,;:!?"),
    ("quote", "'\"()-_/@+"),
    ("symbol", "#*$%&|<>"),
]
WIDE, OTHER, SKIP = len(CLASSES), len(CLASSES) + 1, len(CLASSES) + 2
N_CLASSES = len(CLASSES) + 2
CLASS_OF = np.full(256, OTHER, np.int64)
for _i, (_, _chars) in enumerate(CLASSES):
    CLASS_OF[np.frombuffer(_chars.encode(), np.uint8)] = _i
CLASS_OF[128:192] = SKIP
CLASS_OF[192:] = WIDE
SYMBOL = [n for n, _ in CLASSES].index("symbol")
SPACES = np.frombuffer(b" \t\n\r\v\f", np.uint8)

#: Common words of a language's reference.
COMMON_WORDS = 48
#: A language whose common words make less than this share of its text is judged by characters alone.
MIN_COVERED = 0.1
#: Length guards: histograms of shorter texts are too noisy to judge.
MIN_CHARS, MIN_WORDS = 200, 80
#: Share of a language's reference documents that lies within its limits.
LIMIT_SHARE = 0.995
#: The word limit is at most this share of the distance of a text without any common word.
MAX_REACHED = 0.95
#: Distances are counted in steps of 1 / STEPS, rounded up.
STEPS = 1000
#: Bytes of text whose words are held at a time, and rows of word counts that a task folds.
QUALITY_BYTES, HELD_ROWS = 1 << 20, 1 << 18
#: Documents with more symbols than this share of their words make no reference.
MAX_REFERENCE_SYMBOLS = 0.1


def repeated_words(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row, how many words lie in a 3-word window that the row holds twice or more."""
    covered = np.zeros(len(codes), bool)
    if len(codes) >= 3:
        row = rows_at(offsets)
        at = np.flatnonzero(row[:-2] == row[2:])
        parts = [row[at], codes[at], codes[at + 1], codes[at + 2]]
        key = np.zeros(len(at), np.uint64)
        for part in parts:
            key = mixed(key ^ part.astype(np.uint64))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        for part in parts:  # neighbours in hash order count only if the windows themselves are equal
            same &= part[order[1:]] == part[order[:-1]]
        start = at[np.concatenate([order[1:][same], order[:-1][same]])]
        for k in range(3):
            covered[start + k] = True
    return row_sums(covered, offsets)


def duplicate_lines(text: pa.Array) -> np.ndarray:
    """Per row, lines (split at \\n) with a word that equal an earlier line of the row."""
    lists = pc.split_pattern(text, "\n")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lines = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False)
    codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = rows_at(offsets)[worded]
    distinct = np.unique(row << 32 | codes[worded])
    return np.bincount(row, minlength=len(text)) - np.bincount(distinct >> 32, minlength=len(text))


def class_counts(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per row: code points by character class, and code points inside words."""
    data, offsets = bytes_of(text)
    kind = CLASS_OF[data]
    row = rows_at(offsets)
    counts = np.bincount(row * (N_CLASSES + 1) + kind, minlength=len(text) * (N_CLASSES + 1)).reshape(len(text), -1)[:, :N_CLASSES]
    return counts, row_sums((kind != SKIP) & ~np.isin(data, SPACES), offsets)


def base_of(text: pa.Array) -> dict[str, np.ndarray]:
    codes, offsets, _ = words(text)
    classes, word_chars = class_counts(text)
    n_words, repeats = np.diff(offsets), repeated_words(codes, offsets)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": classes[:, SYMBOL],
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeats,
        "base_failed": (n_words < 50) | (100 * repeats > 50 * n_words),
        "classes": classes,
    }


def judged_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slices that a task of the rules holds one at a time, beside nothing that packing left in its worker."""
    drop_encoders()
    return slices(batches, limit=QUALITY_BYTES)


def makes_reference(codes: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Per row (codes of its words without regard to case), whether it counts for the reference of its language."""
    n_words = np.diff(offsets)
    return (n_words >= 50) & (2 * repeated_words(codes, offsets) <= n_words) & (classes[:, SYMBOL] <= MAX_REFERENCE_SYMBOLS * n_words)


def references(docs: DataFrame) -> dict[str, tuple[np.ndarray, dict[str, float]]]:
    """Per language: shares of the character classes, and shares of its common words (none if they cover too little).

    One pass over all documents. What reaches the driver is bounded by the number of
    languages times ``COMMON_WORDS`` and the classes.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return folded(count(batches))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in judged_slices(batches):
            text, lang = batch.column(1), batch.column(2)
            codes, offsets, known = words(text, lower=True)
            classes, _ = class_counts(text)
            good = makes_reference(codes, offsets, classes)
            row, langs = rows_at(offsets), np.array(lang.to_pylist(), object)
            for name in {x for x in langs if x is not None}:
                own = good & (langs == name)
                if not own.any():
                    continue
                times = np.bincount(codes[own[row]], minlength=len(known))
                found = np.flatnonzero(times)
                sums = np.append(classes[own].sum(axis=0), times.sum())
                word = pa.concat_arrays([known.take(pa.array(found)), pa.nulls(len(sums), pa.string())])
                kind = pa.concat_arrays([pa.nulls(len(found), pa.int32()), pa.array([*range(N_CLASSES), -1], pa.int32())])
                n = pa.array(np.concatenate([times[found], sums]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(n), pa.string()), word, kind, n], ["lang", "word", "kind", "n"])

    sums = text_rows(docs, "lang").mapInArrow(scan, "lang string, word string, kind int, n long").groupBy("lang", "word", "kind").agg(F.sum("n").alias("n"))
    sums = stored(sums, scratch(docs.sparkSession), "word_counts")
    # The most common words of a language: numbered only at the levels of n (eighths of powers of two) that hold them.
    counts = sums.filter("word is not null").withColumn("level", F.floor(F.log2("n") * 8))
    before = Window.partitionBy("lang").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    levels = counts.groupBy("lang", "level").agg(F.count("*").alias("words")).withColumn("more", F.coalesce(F.sum("words").over(before), F.lit(0)))
    high = levels.filter(F.col("more") < COMMON_WORDS).select("lang", "level")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.join(F.broadcast(high), ["lang", "level"]).withColumn("rank", rank).filter(F.col("rank") <= COMMON_WORDS)
    kinds: dict[str, dict[int, int]] = {}
    for r in sums.filter("kind is not null").collect():
        kinds.setdefault(r.lang, {})[r.kind] = r.n
    common: dict[str, dict[str, float]] = {}
    for r in top.orderBy("lang", "rank").collect():
        common.setdefault(r.lang, {})[r.word] = r.n / kinds[r.lang][-1]
    found = {}
    for name, n in sorted(kinds.items()):
        classes, shares = np.array([n[k] for k in range(N_CLASSES)], float), common.get(name, {})
        found[name] = (classes / max(classes.sum(), 1.0), shares if sum(shares.values()) >= MIN_COVERED else {})
    return found


def folded(counts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task added up by their keys as they come; a task holds ``HELD_ROWS`` of them, and gives them out when folding no longer helps."""
    held, rows = [], 0

    def fold() -> pa.Table:
        table = pa.Table.from_batches(held).group_by(["lang", "word", "kind"], use_threads=False).aggregate([("n", "sum")])
        return table.select(["lang", "word", "kind", "n_sum"]).rename_columns(["lang", "word", "kind", "n"])

    for batch in counts:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD_ROWS:
            table = fold()
            if table.num_rows > HELD_ROWS // 2:
                yield from table.to_batches()
                held, rows = [], 0
            else:
                held, rows = table.to_batches(), table.num_rows
    if held:
        yield from fold().to_batches()


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of the rows of ``p`` to the distribution ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


class Distances:
    """Distances of texts to the references of each language."""

    def __init__(self, refs: dict[str, tuple[np.ndarray, dict[str, float]]]) -> None:
        self.langs = list(refs)
        self.words = sorted({w for _, shares in refs.values() for w in shares})
        place = {w: i for i, w in enumerate(self.words)}
        self.chars = [classes for classes, _ in refs.values()]
        # Of each language: where its common words are in the histogram, and their shares.
        self.common = [(np.array([place[w] for w in shares], np.int64), np.array(list(shares.values()))) for _, shares in refs.values()]

        self.worded = [bool(shares) for _, shares in refs.values()]

    def shares(self, codes: np.ndarray, offsets: np.ndarray, dictionary: pa.Array) -> np.ndarray:
        """Per row, the share of each of ``words`` among its words (in lower case)."""
        n, size = len(offsets) - 1, len(self.words) + 1
        at = pc.fill_null(pc.index_in(dictionary, pa.array(self.words, pa.string())), size - 1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.bincount(rows_at(offsets) * size + at[codes], minlength=n * size).reshape(n, -1) / np.maximum(np.diff(offsets)[:, None], 1)

    def char(self, classes: np.ndarray, k: int) -> np.ndarray:
        return js_distance(classes / np.maximum(classes.sum(axis=1, keepdims=True), 1), self.chars[k])

    def word(self, hist: np.ndarray, k: int) -> np.ndarray:
        own, q = self.common[k]
        with_rest = lambda x: np.column_stack([x, np.maximum(1 - x.sum(axis=1), 0)])  # noqa: E731  all other words count as one
        return js_distance(with_rest(hist[:, own]), with_rest(q[None])[0])

    def farthest_word(self, k: int) -> float:
        """The word distance of a text without any common word of the language."""
        return float(self.word(np.zeros((1, len(self.words) + 1)), k)[0])


#: Per language, the largest char and word distance that is kept (None: nothing to learn it from).
Limits = dict[str, tuple[float | None, float | None]]


def limits(docs: DataFrame, refs: dict[str, tuple[np.ndarray, dict[str, float]]]) -> Limits:
    """One pass over all documents. What reaches the driver: at most ``STEPS + 1`` counts a language and histogram."""
    far = Distances(refs)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in judged_slices(batches):
            text, out = batch.column(1), []
            codes, offsets, known = words(text, lower=True)
            classes, _ = class_counts(text)
            good, hist = makes_reference(codes, offsets, classes), far.shares(codes, offsets, known)
            langs, n_words = np.array(batch.column(2).to_pylist(), object), np.diff(offsets)
            for k, name in enumerate(far.langs):
                own = good & (langs == name)
                for kind, rows, distance in (
                    (0, own & (classes.sum(axis=1) >= MIN_CHARS), lambda r, k=k: far.char(classes[r], k)),
                    (1, own & (n_words >= MIN_WORDS) & far.worded[k], lambda r, k=k: far.word(hist[r], k)),
                ):
                    if rows.any():
                        steps, n = np.unique(np.ceil(distance(rows) * STEPS).astype(np.int64), return_counts=True)
                        out += [(name, kind, int(x), int(c)) for x, c in zip(steps, n, strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["lang", "kind", "step", "n"])

    counted: dict[tuple[str, int], list[tuple[int, int]]] = {}
    if refs:
        found = text_rows(docs, "lang").mapInArrow(scan, "lang string, kind int, step long, n long").groupBy("lang", "kind", "step").agg(F.sum("n").alias("n"))
        for r in found.collect():
            counted.setdefault((r.lang, r.kind), []).append((r.step, r.n))

    def quantile(counts: list[tuple[int, int]]) -> float:
        steps, n = np.array(sorted(counts)).T
        return float(steps[np.searchsorted(np.cumsum(n), LIMIT_SHARE * n.sum())]) / STEPS

    out = {}
    for k, name in enumerate(far.langs):
        char, word = (quantile(counted[name, kind]) if (name, kind) in counted else None for kind in (0, 1))
        out[name] = (char, None if word is None else min(word, MAX_REACHED * far.farthest_word(k)))
    return out


class Judge:
    """Verdicts of the base rules, references and limits over one Arrow array of texts."""

    def __init__(self, refs: dict[str, tuple[np.ndarray, dict[str, float]]], most: Limits) -> None:
        self.far = Distances(refs)
        self.most = [most[name] for name in self.far.langs]

    def __call__(self, text: pa.Array) -> dict[str, np.ndarray]:
        base, n = base_of(text), len(text)
        n_words, classes = base["n_words"], base.pop("classes")
        codes, offsets, dictionary = words(text, lower=True)
        hist = self.far.shares(codes, offsets, dictionary)
        of_char = {k: self.far.char(classes, k) for k, (m, _) in enumerate(self.most) if m is not None}
        of_word = {k: self.far.word(hist, k) for k, (_, m) in enumerate(self.most) if m is not None}
        char_d = np.min(list(of_char.values()), axis=0) if of_char else np.zeros(n)
        word_d = np.min(list(of_word.values()), axis=0) if of_word else np.zeros(n)
        odd_char = np.all([d > self.most[k][0] for k, d in of_char.items()], axis=0) if of_char else np.zeros(n, bool)
        odd_word = np.all([d > self.most[k][1] for k, d in of_word.items()], axis=0) if of_word else np.zeros(n, bool)
        if of_char and of_word and not all(self.far.worded):  # texts nearest to a language that has no common words
            near = np.array(list(of_char))[np.argmin(list(of_char.values()), axis=0)]
            allowed = char_d <= np.array([self.most[k][0] or 0.0 for k in range(len(self.most))])[near]
            odd_word &= np.array(self.far.worded)[near] | ~allowed
        odd = ((classes.sum(axis=1) >= MIN_CHARS) & odd_char) | ((n_words >= MIN_WORDS) & odd_word)
        return base | {"kept": ~base["base_failed"] & ~odd, "char_distance": char_d, "word_distance": word_d}


def judge_of(docs: DataFrame) -> Judge:
    refs = references(docs)
    return Judge(refs, limits(docs, refs))


def quality_rules(docs: DataFrame, judge: Judge | None = None) -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``kept``, and the distances to the nearest reference."""
    judge = judge_of(docs) if judge is None else judge

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in judged_slices(batches):
            columns = {"doc_id": batch.column(0)} | judge(batch.column(1))
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], list(columns))

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double"
    return text_rows(docs).mapInArrow(run, schema)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep; all columns as they were."""
    judge = judge_of(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in judged_slices(batches):
            text = pc.fill_null(batch.column(batch.schema.get_field_index("text")), "")
            yield batch.filter(pa.array(judge(text)["kept"]))

    return docs.mapInArrow(run, docs.schema)
