"""Ranked lexical search over posting lists in geometric blocks.

Documents are cut into segments; every segment has an index of its own over the terms of the queries. A term's posting
list in it is clustered by document similarity: leaders spread over the list take the documents nearest to them by the
cosine of their score vectors, and each cluster is a block. A block's summary is the coordinatewise maximum of its
documents' scores by term, so the sum of the summary over a query's terms is an exact upper bound of each document's
score. A block is skipped only if that bound can't enter the ten best found so far; otherwise its documents
are scored exactly. The same bound of a whole list (its greatest score) tells which lists of a query need no
visit: terms that together can't reach the tenth best score.

All arithmetic is in 64-bit integers. A task runs the queries over its segments one after the other and keeps ten documents
a query; these are merged in two steps (by query and a salt of the document, then by query). Queries are
taken in blocks of bounded size, each against all rows.

Defined cases: null texts and texts without a term hold nothing and are never found; a query without a term, or
that finds nothing, has no rows; repeated documents and queries are ranked one by one; equal scores go by ascending
``doc_id``, a null one last. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktake.llm.text import bytes_of, rows_at, scratch, slices, stored, text_rows, words

#: Documents of a block, on average.
BLOCK_DOCS = 8
#: Cells (documents x terms) of a segment; the terms come from the queries at hand.
CELLS, LEAST_DOCS = 1 << 23, 256
#: Terms of a block of queries, counted by query.
QUERY_TERMS = 1 << 16
#: First step of the merge: groups of a query's documents.
SALTS = 64
LAST = np.iinfo(np.int64).max  # a null doc_id

#: Bytes of terms: ASCII letters (lower-cased) and digits, and all bytes of other characters; the rest are spaces.
TERM_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def terms_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """A code per term, row offsets, and the distinct terms."""
    data, offsets = bytes_of(text)
    clean = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(offsets), pa.py_buffer(TERM_BYTES[data]))
    return words(clean)


def query_terms(queries: DataFrame) -> DataFrame:
    """``item_id`` and the distinct ``terms`` of every query that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            code, offsets, distinct = terms_of(batch.column("text"))
            pairs = np.unique(rows_at(offsets) * max(len(distinct), 1) + code)
            row = pairs // max(len(distinct), 1)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            terms = distinct.take(pa.array(pairs % max(len(distinct), 1))).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), terms)], ["item_id", "terms"])

    rows = queries.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "item_id long, terms array<string>").filter(F.size("terms") > 0)


def forward_rows(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats), and the vocabulary's ``terms`` (numbers) in the text with their counts ``tf``."""
    known = pa.array(vocabulary, pa.large_string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            code, offsets, distinct = terms_of(batch.column("text"))
            number = pc.fill_null(pc.index_in(distinct, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            term = number[code]
            hit = term >= 0
            pairs, tf = np.unique(rows_at(offsets)[hit] * len(known) + term[hit], return_counts=True)
            ends = pa.array(np.searchsorted(pairs // len(known), np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(ends, pa.array(pairs % len(known), pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))],
                ["doc_id", "n", "terms", "tf"],
            )

    return text_rows(docs).mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")


def weights(forward: DataFrame, terms: int) -> tuple[np.ndarray, int, int]:
    """Weight of each term, number of documents with a term, and all their terms with repeats."""
    whole = forward.agg(F.count_if(F.col("n") > 0).alias("count"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    held = {r.term: r["count"] for r in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    w = [math.floor(1000 * math.log((2 * whole["count"] + 2) / (2 * held.get(t, 0) + 1))) for t in range(terms)]
    return np.array(w, np.int64), whole["count"], whole["length"]


class Segment:
    """Documents as rows of scores by term, and for each term asked for its blocks."""

    def __init__(self, doc_id: np.ndarray, scores: np.ndarray, related: list[np.ndarray]) -> None:
        self.doc_id, self.scores, self.related = doc_id, scores, related
        self.most = scores.max(0)
        self.norm = np.sqrt((scores.astype(np.float32) ** 2).sum(1, dtype=np.float32))
        self.blocks: dict[int, tuple[list[np.ndarray], np.ndarray, np.ndarray]] = {}

    def blocks_of(self, term: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Documents of each block of the term's list, summaries over the terms related to it, and each block's first ``doc_id``."""
        if term not in self.blocks:
            docs = np.flatnonzero(self.scores[:, term])
            vectors = self.scores[np.ix_(docs, self.related[term])]
            leaders = np.arange(0, len(docs), BLOCK_DOCS)
            if len(leaders) > 1:
                unit = vectors.astype(np.float32) / self.norm[docs][:, None]
                block = (unit @ unit[leaders].T).argmax(1)
            else:
                block = np.zeros(len(docs), np.int64)
            order = np.argsort(block, kind="stable")
            starts = np.flatnonzero(np.diff(block[order], prepend=-1))
            members = np.split(docs[order], starts[1:])
            self.blocks[term] = members, np.maximum.reduceat(vectors[order], starts, axis=0), np.minimum.reduceat(self.doc_id[docs[order]], starts)
        return self.blocks[term]


class Search:
    """The queries' ten best documents so far, over any number of segments."""

    def __init__(self, queries: list[np.ndarray], terms: int, k: int) -> None:
        self.queries, self.k = queries, k
        holders: list[list[np.ndarray]] = [[] for _ in range(terms)]
        for q in queries:
            for t in q:
                holders[t].append(q)
        self.related = [np.unique(np.concatenate(h)) if h else np.empty(0, np.int64) for h in holders]
        self.places = [{int(t): np.searchsorted(self.related[t], q) for t in q} for q in queries]
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in queries]  # scores (highest first), doc_ids
        self.scored = self.skipped = 0

    def least(self, i: int) -> tuple[int, int]:
        """The score and doc_id that a document must come before to be among the best."""
        score, doc_id = self.best[i]
        return (int(score[-1]), int(doc_id[-1])) if len(score) == self.k else (0, -1)

    def take(self, i: int, segment: Segment, docs: np.ndarray) -> None:
        """Score documents exactly and keep the best."""
        self.scored += len(docs)
        score = segment.scores[np.ix_(docs, self.queries[i])].sum(1)
        score, doc_id = np.concatenate([self.best[i][0], score]), np.concatenate([self.best[i][1], segment.doc_id[docs]])
        order = np.lexsort((doc_id, -score))[: self.k]
        order = order[score[order] > 0]
        self.best[i] = score[order], doc_id[order]

    def run(self, segment: Segment) -> None:
        for i, q in enumerate(self.queries):
            most = segment.most[q]
            seen = np.zeros(len(segment.doc_id), bool)
            order = np.argsort(-most, kind="stable")
            # What the lists from here on can give to a document that is in none before.
            rest = np.cumsum(most[order][::-1])[::-1]
            for j, place in enumerate(order):
                score, doc_id = self.least(i)
                if most[place] == 0 or rest[j] < score:
                    break
                term = int(q[place])
                members, summaries, first = segment.blocks_of(term)
                bound = summaries[:, self.places[i][term]].sum(1)
                live = np.flatnonzero((bound > score) | ((bound == score) & (first < doc_id)))
                if len(self.best[i][0]) < self.k and len(live) > 1:  # the most promising block sets a level for the others
                    live = live[np.argsort(-bound[live], kind="stable")]
                    self.visit(i, segment, seen, members[live[0]])
                    score, doc_id = self.least(i)
                    live = live[(bound[live] > score) | ((bound[live] == score) & (first[live] < doc_id))]
                self.skipped += len(members) - len(live)
                if len(live):
                    self.visit(i, segment, seen, np.concatenate([members[b] for b in live]))

    def visit(self, i: int, segment: Segment, seen: np.ndarray, docs: np.ndarray) -> None:
        docs = docs[~seen[docs]]
        seen[docs] = True
        if len(docs):
            self.take(i, segment, docs)


def contributions(w: np.ndarray, tf: np.ndarray, n: np.ndarray, count: int, length: int) -> np.ndarray:
    m = 10 + 90 * n * count // max(length, 1)
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def best_by_task(forward: DataFrame, item_ids: list[int | None], queries: list[np.ndarray], stats: tuple[np.ndarray, int, int], k: int) -> DataFrame:
    """``item, item_id, doc_id, score``: the ``k`` best documents of every query in each task."""
    w, count, length = stats
    most_docs = max(LEAST_DOCS, CELLS // len(w))

    def segments(batches: Iterator[pa.RecordBatch], related: list[np.ndarray]) -> Iterator[Segment]:
        doc_id, scores, filled = np.empty(most_docs, np.int64), np.zeros((most_docs, len(w)), np.int64), 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, most_docs - filled)
                start += part.num_rows
                terms, tf = part.column("terms"), part.column("tf").flatten().to_numpy()
                ends = terms.offsets.to_numpy().astype(np.int64)
                row, t = rows_at(ends - ends[0]), terms.flatten().to_numpy()
                n = part.column("n").to_numpy()
                doc_id[filled : filled + part.num_rows] = pc.fill_null(part.column("doc_id"), LAST).to_numpy(zero_copy_only=False)
                scores[filled + row, t] = contributions(w[t], tf, n[row], count, length)
                filled += part.num_rows
                if filled == most_docs:
                    yield Segment(doc_id, scores, related)
                    scores[:], filled = 0, 0
        if filled:
            yield Segment(doc_id[:filled], scores[:filled], related)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(queries, len(w), k)
        for segment in segments(batches, search.related):
            search.run(segment)
        for i, (score, doc_id) in enumerate(search.best):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(score), pa.int32()), pa.array([item_ids[i]] * len(score), pa.int64()), pa.array(doc_id, mask=doc_id == LAST), pa.array(score)], ["item", "item_id", "doc_id", "score"]
                )

    return forward.filter(F.size("terms") > 0).mapInArrow(run, "item int, item_id long, doc_id long, score long")


def merged(found: DataFrame, k: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best of every query."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 10, query_terms_at_once: int = QUERY_TERMS) -> DataFrame:
    """Each query's ``k`` highest-scoring documents: ``item_id, rank, doc_id, score``."""
    spark, root = docs.sparkSession, scratch(docs.sparkSession)
    asked = stored(query_terms(queries), root, "queries")
    total = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first().n
    blocks = -(-total // query_terms_at_once)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == b).collect()  # about `query_terms_at_once` terms
        vocabulary = sorted({t for r in rows for t in r.terms})
        if not rows:
            continue
        number = {t: i for i, t in enumerate(vocabulary)}
        forward = stored(forward_rows(docs, vocabulary), root, f"forward_{b}")
        found = best_by_task(forward, [r.item_id for r in rows], [np.array(sorted(number[t] for t in r.terms), np.int64) for r in rows], weights(forward, len(vocabulary)), k)
        out = out.unionByName(merged(stored(found, root, f"found_{b}"), k))
    return out
