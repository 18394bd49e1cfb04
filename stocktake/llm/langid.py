"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts of up to ``ORDER`` bytes with the counts of the byte that
followed. A byte costs ``-log2`` of its probability in the longest context the language
knows; where the byte is new there, the escape's cost (method C: distinct successors over all
plus distinct) and the cost in the next shorter context, down to a uniform byte. The statistics are
frozen after training, so a text's code length in a language is exact: the sum over all its bytes.
The shortest code wins; ``score`` is its share of ``2 ** -length`` over the languages.

The pipeline's filter also rejects texts that no learned language explains: of at least ``MIN_BYTES`` bytes, with more
bits a byte in the best language than ``SLACK`` times what ``LIMIT_SHARE`` of that language's training texts stay within.

Trained on every labelled document that is not held out, and so are the limits: counts are summed in Spark, and only
the trees (distinct contexts and bytes, which grow far slower than the texts) reach the driver and the tasks. A-Z count as a-z.

Defined cases: a null ``lang`` is not learned from; a null ``doc_id`` counts as held out; a text
that is null or has no letter is ``und`` with score 0, as is every text where nothing was learned; equal code
lengths give the language first by name; repeated rows are predicted alike. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.llm.text import bytes_of, row_sums, scratch, slices, stored, text_rows

#: Bytes of the longest context.
ORDER = 3
#: Bytes of text worked on at a time (each takes some forty bytes of arrays), and grams whose counts a task holds.
TEXT_BYTES, HELD_GRAMS = 2 << 20, 1 << 21
#: A prediction under this score is rejected by the pipeline's filter.
MIN_SCORE = 0.5
UNKNOWN = "und"
#: The limit of bits a byte: this share of a language's training texts is within it, times a slack for texts that weren't learned from.
LIMIT_SHARE, SLACK = 0.995, 1.75
#: Shorter texts are not judged by bits a byte.
MIN_BYTES = 200

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = True


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id's text leaves 1 by 3 (or there is no id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte, the ``ORDER`` bytes before it in its text (0 before its start) and itself, as one number."""
    data = FOLD[data].astype(np.uint32)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = data.copy()
    for k in range(1, ORDER + 1):
        back = np.zeros_like(data)
        back[k:] = data[:-k] if k < len(data) else data[:0]
        out |= np.where(place >= k, back, 0).astype(np.uint32) << np.uint32(8 * k)
    return out


class Model:
    """Code lengths in bits, per order: of the known grams (context and byte), and of escapes from the known contexts."""

    def __init__(self, langs: list[str], gram: np.ndarray, lang: np.ndarray, n: np.ndarray) -> None:
        self.langs, self.grams, self.cost, self.contexts, self.escape = langs, [], [], [], []
        size = len(langs)
        for k in range(ORDER + 1):
            mask = np.uint32((1 << 8 * (k + 1)) - 1)
            known, at = np.unique(gram & mask, return_inverse=True)
            count = np.zeros((len(known), size))
            np.add.at(count, (at, lang), n)
            contexts, of = np.unique(known >> np.uint32(8) << np.uint32(8), return_inverse=True)  # the byte's place left empty
            # The context of a gram of order k: its first k bytes.
            total, distinct = np.zeros((len(contexts), size)), np.zeros((len(contexts), size))
            np.add.at(total, of, count)
            np.add.at(distinct, of, (count > 0).astype(float))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2(total + distinct) - np.log2(distinct), 0.0)
                own = np.log2((total + distinct)[of]) - np.log2(count)
            shorter = np.full((len(known), size), 8.0) if k == 0 else self.cost[k - 1][np.searchsorted(self.grams[k - 1], known & np.uint32((1 << 8 * k) - 1))]
            self.grams.append(known)
            self.cost.append(np.where(count > 0, own, escape[of] + shorter).astype(np.float32))
            self.contexts.append(contexts)
            self.escape.append(escape.astype(np.float32))

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Cost of every gram's last byte, per language."""
        out = np.zeros((len(gram), len(self.langs)))
        rest = np.arange(len(gram))
        for k in range(ORDER, -1, -1):
            own = gram[rest] & np.uint32((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(self.grams[k], own), len(self.grams[k]) - 1)
            hit = self.grams[k][at] == own
            out[rest[hit]] += self.cost[k][at[hit]]
            rest, own = rest[~hit], own[~hit]
            context = own >> np.uint32(8) << np.uint32(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            seen = self.contexts[k][at] == context
            out[rest[seen]] += self.escape[k][at[seen]]
        out[rest] += 8.0
        return out

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Exact code length of every text (rows) in every language (columns)."""
        known, at = np.unique(grams(data, offsets), return_inverse=True)
        bits = self.bits(known)
        return np.column_stack([row_sums(bits[:, i][at], offsets) for i in range(len(self.langs))])


def training_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, text, lang`` of the documents to learn from."""
    rows = text_rows(docs, F.col("lang").cast("string").alias("lang"))
    return rows.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``grams, counts``."""
    known, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return known, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def train(rows: DataFrame) -> Model | None:
    """Context trees from all training rows; ``None`` where there is nothing to learn."""

    def batch_of(held: dict[str, list]) -> pa.RecordBatch:
        sums = {lang: merged(parts) for lang, parts in held.items()}
        langs = pa.array([lang for lang, (g, _) in sums.items() for _ in range(len(g))], pa.string())
        columns = [np.concatenate([s[i] for s in sums.values()]).astype(np.int64) for i in range(2)]
        return pa.RecordBatch.from_arrays([langs, *map(pa.array, columns)], ["lang", "gram", "n"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        for batch in slices(batches, limit=TEXT_BYTES):
            names = np.array(batch.column(2).to_pylist(), object)
            for lang in sorted(set(names)):
                own = batch.filter(pa.array(names == lang))
                parts = held.setdefault(lang, [])
                parts.append(np.unique(grams(*bytes_of(own.column(1))), return_counts=True))
                size += len(parts[-1][0])
            if size > HELD_GRAMS:
                held = {lang: [merged(parts)] for lang, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > HELD_GRAMS // 2:
                    yield batch_of(held)
                    held, size = {}, 0
        if held:
            yield batch_of(held)

    counted = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if not len(counted):
        return None
    langs = sorted(counted["lang"].unique())
    counted = counted.sort_values(["lang", "gram"])
    return Model(langs, counted["gram"].to_numpy(np.uint32), counted["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(), counted["n"].to_numpy(float))


def lettered(text: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a letter of any script."""
    has = row_sums(LETTER[FOLD[data]], offsets) > 0
    for r in np.flatnonzero(~has & (row_sums(data >= 128, offsets) > 0)):
        has[r] = any(c.isalpha() for c in text[int(r)].as_py())
    return has


def predictions(model: Model | None, text: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score, and the code lengths in all languages."""
    data, offsets = bytes_of(text)
    if model is None:
        return [UNKNOWN] * len(text), np.zeros(len(text)), np.zeros((len(text), 1))
    lengths, has = model.lengths(data, offsets), lettered(text, data, offsets)
    best = lengths.argmin(axis=1)
    share = 1.0 / np.exp2(np.maximum(lengths.min(axis=1, keepdims=True) - lengths, -1000.0)).sum(axis=1)
    names = [model.langs[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
    return names, np.where(has, share, 0.0), lengths


def identify_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""
    model = train(training_rows(docs)) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=TEXT_BYTES):
            langs, scores, _ = predictions(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    return text_rows(docs, held_out(F.col("doc_id")).alias("held_out")).mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


#: What the filter's pass tells of a text: bits a byte in the language told and in its label's (null for a short text).
TOLD = [("lang", "string"), ("score", "double"), ("bits", "double"), ("own", "double")]


def told_of(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with a column ``told``."""
    shared, langs = docs.sparkSession.sparkContext.broadcast(model), {} if model is None else {x: i for i, x in enumerate(model.langs)}

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=TEXT_BYTES):
            text = batch.column(batch.schema.get_field_index("text"))
            names, scores, lengths = predictions(shared.value, text)
            size = np.diff(bytes_of(text)[1])
            label = np.array([langs.get(x, -1) for x in batch.column(batch.num_columns - 1).to_pylist()], np.int64)
            bits, own = (x / np.maximum(size, 1) for x in (lengths.min(axis=1), lengths[np.arange(len(label)), label]))
            short = size < MIN_BYTES
            columns = [pa.array(names, pa.string()), pa.array(scores), pa.array(bits, mask=short), pa.array(own, mask=short | (label < 0))]
            told = pa.StructArray.from_arrays(columns, [name for name, _ in TOLD])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], told], [*batch.schema.names[:-1], "told"])

    fields = ", ".join(f"{name}: {kind}" for name, kind in TOLD)
    schema = T.StructType([*docs.schema.fields, T.StructField("told", T.StructType.fromDDL(fields))])
    return docs.withColumn("told", F.col("lang").cast("string")).mapInArrow(tell, schema)


def learned_limits(told: DataFrame) -> dict[str, float]:
    """Per language, the limit of bits a byte: from all its training texts, in their label's own tree (one number a language)."""
    learned = told.filter(F.col("told.own").isNotNull() & ~held_out(F.col("doc_id").cast("long")))
    found = learned.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.percentile_approx("told.own", LIMIT_SHARE, 10_000).alias("bits")).collect()
    return {r["lang"]: SLACK * r["bits"] for r in found}


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is told with at least ``min_score`` and whose text is within its limit; all columns as they were.

    Every text is weighed once; what was told of it is stored beside it, and the limits and the filter read that.
    """
    told = stored(told_of(docs, train(training_rows(docs))), scratch(docs.sparkSession), "told")
    limits = learned_limits(told)
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("told.lang")] if limits else F.lit(None).cast("double")
    strange = F.coalesce(F.col("told.bits") > limit, F.lit(False))
    return told.filter((F.col("told.lang") != UNKNOWN) & (F.col("told.score") >= min_score) & ~strange).select(*docs.columns)
