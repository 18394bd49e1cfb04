"""Exact n-gram Jaccard self-join of documents, and its connected groups.

A document's set holds the 64-bit hashes of its distinct word n-grams. Documents with
equal sets are one node. Sets whose Jaccard index reaches the threshold share an element
of their prefixes (the first ``n - ceil(t * n) + 1`` elements in one global order: elements
of many documents last, else by hash), so every link meets in a tile: the sets that hold one
prefix element, cut by size into bands of at most ``TILE`` sets. Bands whose sizes can't
reach the threshold aren't paired. Inside a tile every set has a parity bitmap as
wide as its size class; the bits in which two bitmaps differ bound the overlap from above, as does
what follows the tile's element in both orders, and only pairs that these bounds leave are
intersected exactly, as sorted arrays.

Large groups of near copies would make pairs by the square, so the join runs several times.
The first run tiles the sets by a few minimum hashes, and links only along a
spanning tree of every tile, of the candidates whose bitmaps differ least; that joins such groups cheaply, and a candidate
that fails the exact check hides few others there. The next one (``TREE_ROUNDS``) does the same over every prefix element, and only where ends aren't joined yet. The last run
looks at all pairs whose ends are still apart: what it adds makes the groups exact.

Defined cases: a text without words (null, empty, blanks) has an empty set, links with
nothing and is its own component; a text of fewer than ``size`` words is one n-gram; rows
with equal texts, or the same ``doc_id``, are linked as their sets are; the component is the
smallest ``doc_id`` of the linked rows, null only if all of them are null.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktake.llm.components import components
from stocktake.llm.text import distinct, hashes, mixed, most_counted, rows_at, scratch, slices, stored, text_rows, words

#: Bytes of text whose n-grams a task holds at a time (each word takes a dozen 8-byte numbers).
SHINGLE_BYTES = 4 << 20
#: Sets of a tile's band.
TILE = 512
#: Minimum hashes of the first run.
MINIMA = 6
#: An n-gram of more than this share of the documents of some slice may be put last in the global order.
COMMON_SHARE = 0.0002
#: Bound of the list of common n-grams that every task holds (8 bytes each). It orders elements, it drops none.
MOST_COMMON = 1 << 20
#: Runs over the prefix elements along spanning trees, before the run over all pairs left.
TREE_ROUNDS = 1
#: Sets looked for in one pass over the texts (16 bytes each in every task); more take more passes.
LOOKUP = 1 << 21
#: Bits of the narrowest bitmap.
LEAST_BITS = 512
STEP = np.uint64(0x9E3779B97F4A7C15)
SEEDS = mixed(np.arange(1, MINIMA + 1, dtype=np.uint64) * STEP) | np.uint64(1)


def shingle_sets(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes (uint64) of every row, and row offsets."""
    codes, offsets, known = words(text, lower=True)
    h = hashes(known)[codes]
    n = np.diff(offsets)
    row = rows_at(offsets)
    if len(h) >= size:
        grams = h[: len(h) - size + 1].copy()
        for k in range(1, size):
            grams = grams * STEP + h[k : len(h) - size + 1 + k]
        whole = row[: len(grams)] == row[size - 1 :]
        grams, owner = mixed(grams[whole]), row[: len(whole)][whole]
    else:
        grams, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        whole_text = []
        for r in short:  # the whole sequence as one n-gram
            g = np.uint64(n[r])
            for x in h[offsets[r] : offsets[r + 1]]:
                g = np.uint64((int(g) * int(STEP) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            whole_text.append(g)
        grams, owner = np.concatenate([grams, mixed(np.array(whole_text, np.uint64))]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
    counts = np.bincount(owner, minlength=len(text))
    ends = np.cumsum(counts)
    parts = [distinct(grams[e - c : e]) for c, e in zip(counts, ends, strict=True)]
    return (np.concatenate(parts) if parts else grams), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def set_key(grams: np.ndarray) -> int:
    """Names a set: 63 bits of a hash of its sorted elements; 0 for the empty set."""
    return (xxhash.xxh3_64_intdigest(grams.tobytes()) >> 1) | 1 if len(grams) else 0


def bitmap_bits(n: int) -> int:
    return max(LEAST_BITS, 1 << (n // 2).bit_length())


def bitmaps(grams: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Parity bitmaps of all sets, one after another, and their offsets in bytes.

    An element falls on bit ``gram % bits`` (a power of two from ``LEAST_BITS``) of its set's bitmap.
    """
    bits = np.array([bitmap_bits(int(n)) for n in np.diff(offsets)], np.int64)
    first = np.concatenate([[0], np.cumsum(bits)])
    place = first[rows_at(offsets)] + (grams & (np.repeat(bits, np.diff(offsets)) - 1).astype(np.uint64)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=int(first[-1])) & 1).astype(np.uint8)).tobytes(), first // 8


def folded(words_: np.ndarray, bits: int) -> np.ndarray:
    """A parity bitmap cut to fewer bits: elements that meet on a bit cancel out."""
    while len(words_) * 64 > bits:
        half = len(words_) // 2
        words_ = words_[:half] ^ words_[half:]
    return words_


def common_ngrams(docs: DataFrame, size: int, root: str) -> np.ndarray:
    """N-grams of so many documents that they go last in the global order (sorted; at most ``MOST_COMMON``)."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SHINGLE_BYTES):
            grams, _ = shingle_sets(batch.column(1), size)
            values, counts = np.unique(grams, return_counts=True)
            often = counts > max(2, COMMON_SHARE * batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], ["g", "n"])

    found = text_rows(docs).mapInArrow(scan, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    return np.sort(most_counted(stored(found, root, "common"), MOST_COMMON).toPandas()["g"].to_numpy(np.int64).view(np.uint64))


def is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def set_keys(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.array([set_key(grams[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)


def features(docs: DataFrame, size: int, t: Fraction, common: np.ndarray) -> DataFrame:
    """Per row: ``doc_id, n_shingles, node`` (its set's name), ``prefix`` (n-grams), ``minima`` (hashes), ``bits`` (its bitmap)."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SHINGLE_BYTES):
            grams, offsets = shingle_sets(batch.column(1), size)
            n, row = np.diff(offsets), rows_at(offsets)
            # The global order within each set: common n-grams after the others, else by hash (as they stand).
            ordered = grams[np.argsort(2 * row + is_in(grams, shared.value), kind="stable")]
            length = n - -(-t.numerator * n // t.denominator) + (n > 0)
            prefix = ordered[np.arange(len(grams)) - offsets[row] < length[row]]
            filled = np.flatnonzero(n)
            minima = np.zeros((len(n), MINIMA), np.uint64)
            for k, seed in enumerate(SEEDS if len(filled) else ()):
                minima[filled, k] = np.minimum.reduceat(mixed(grams * seed), offsets[filled])
            bits, ends = bitmaps(grams, offsets)
            columns = {
                "doc_id": batch.column(0),
                "n_shingles": pa.array(n),
                "node": pa.array(set_keys(grams, offsets)),
                "prefix": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(prefix.view(np.int64))),
                "minima": pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * MINIMA, pa.int32()), pa.array(minima.ravel().view(np.int64))),
                "bits": pa.array([bits[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return text_rows(docs).mapInArrow(scan, "doc_id long, n_shingles long, node long, prefix array<long>, minima array<long>, bits binary")


def tile_pairs(
    band: np.ndarray, node: np.ndarray, n: np.ndarray, place: np.ndarray, comp: np.ndarray, raw: list[np.ndarray], t: Fraction, tree: bool
) -> list[tuple[int, int]]:
    """A tile's pairs of nodes that sizes, places and bitmaps can't rule out, across its two bands (or within the one).

    The members come in order of size. ``place`` is where the tile's element stands in a set's order: of
    the tiles that a linked pair shares, the first has no common element before it, so what
    follows it bounds the overlap, and the pair is found there. With ``tree``, only the pairs of a spanning forest
    are kept, of those that differ least. Pairs with the same component are left out always.
    """
    num, den = t.numerator, t.denominator
    two = band.min() != band.max()
    found, after = [], n - place
    width = 0
    for i in range(len(node) - 1):
        last = int(np.searchsorted(n, n[i] * den // num, side="right"))  # sizes that can reach the threshold
        at = np.arange(i + 1, last)
        total = n[at] + n[i]
        most = np.minimum(after[at], after[i])
        at = at[(comp[at] != comp[i]) & (most * (num + den) >= num * total) & ((band[at] != band[i]) if two else True)]
        if not len(at):
            continue
        if len(raw[i]) != width:  # bitmaps cut to this width, each when it is first asked for
            width = len(raw[i])
            level, ready = np.empty((len(raw), width), np.uint64), np.zeros(len(raw), bool)
        for j in at[~ready[at]]:
            level[j] = folded(raw[j], width * 64)
        ready[at] = True
        differ = np.bitwise_count(level[at] ^ raw[i]).sum(axis=1, dtype=np.int64)
        total = n[at] + n[i]
        most = (total - differ) // 2
        may = most * (num + den) >= num * total
        if may.any():
            found.append((np.full(np.count_nonzero(may), i), at[may], (differ / total)[may]))
    if not found:
        return []
    a, b, far = (np.concatenate(c) for c in zip(*found, strict=True))
    if tree:
        kept = spanning_forest(a, b, far, comp)
        a, b = a[kept], b[kept]
    return list(zip(np.minimum(node[a], node[b]), np.maximum(node[a], node[b]), strict=True))


def spanning_forest(a: np.ndarray, b: np.ndarray, far: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Places of the edges ``(a, b)`` of a minimum spanning forest by ``far``; members of one component are joined already.

    In every round each tree takes its nearest edge to another one (Boruvka); the order of all edges is strict, so none closes a ring.
    """
    order = np.argsort(far, kind="stable")
    a, b = a[order], b[order]
    _, label = np.unique(comp, return_inverse=True)
    kept, left = [], np.arange(len(order))
    while True:
        left = left[label[a[left]] != label[b[left]]]
        if not len(left):
            return order[np.array(kept, np.int64)]
        nearest = np.full(len(comp), len(order))
        np.minimum.at(nearest, label[a[left]], left)
        np.minimum.at(nearest, label[b[left]], left)
        for e in np.unique(nearest[nearest < len(order)]):
            label[label == label[a[e]]] = label[b[e]]
            kept.append(e)


TILE_COLUMNS = ["key", "low", "high", "band", "node", "n", "place", "comp", "bits"]


def tiles_scan(t: Fraction, tree: bool):
    """Task function over rows sorted by tile and size: a tile's rows follow one another, across Arrow batches as well."""

    def pairs_of(rows: pa.Table) -> pa.RecordBatch:
        cut = [rows.column(c).to_numpy() for c in TILE_COLUMNS[:-1]]
        bits = rows.column("bits").to_pylist()
        changes = np.flatnonzero((cut[0][1:] != cut[0][:-1]) | (cut[1][1:] != cut[1][:-1]) | (cut[2][1:] != cut[2][:-1])) + 1
        out: set[tuple[int, int]] = set()
        for a, b in zip(np.concatenate([[0], changes]), np.concatenate([changes, [len(bits)]]), strict=True):
            if b - a > 1:
                out.update(tile_pairs(*(c[a:b] for c in cut[3:]), [np.frombuffer(x, np.uint64) for x in bits[a:b]], t, tree))
        pairs = np.array(sorted(out), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key, low, high = (rows.column(c).to_numpy() for c in ("key", "low", "high"))
            begun = int(np.flatnonzero((key == key[-1]) & (low == low[-1]) & (high == high[-1]))[0])  # the last tile may go on
            if begun:
                yield pairs_of(rows.slice(0, begun))
            held = rows.slice(begun).combine_chunks()
        if held is not None:
            yield pairs_of(held)

    return scan


def tiled(members: DataFrame, t: Fraction, tree: bool) -> DataFrame:
    """Candidate pairs of ``members (key, size, node, n, place, comp, bits)``; ``size``: how many sets hold the key.

    A key of up to ``TILE`` sets is one tile. The sets of a larger one are cut into bands by size, and
    bands are paired into tiles where their sizes can reach the threshold.
    """
    number = lambda c: F.lit(c).cast("int")
    small = members.filter(F.col("size") <= TILE).withColumns({c: number(0) for c in ("low", "high", "band")})
    ordered = Window.partitionBy("key").orderBy("n", "node")
    rank = F.row_number().over(ordered) - 1
    banded = members.filter(F.col("size") > TILE).withColumn("band", F.floor(rank / F.lit(TILE)).cast("int")).withColumn("first", rank % TILE == 0)
    if tree:  # a band's first set also ends the band before, which joins the bands of a key
        tiles = F.when(F.col("first") & (F.col("band") > 0), F.array("band", F.col("band") - 1)).otherwise(F.array("band"))
        large = banded.withColumn("low", F.explode(tiles)).withColumns({"high": F.col("low"), "band": F.col("low")})
    else:
        # Least and largest size of every band (one row for TILE sets), and which bands of the key it meets.
        spans = banded.groupBy("key", "band").agg(F.min("n").alias("least"), F.max("n").alias("most"))
        other = spans.select("key", F.col("band").alias("other"), F.col("least").alias("o_least"), F.col("most").alias("o_most"))
        near = F.greatest("least", "o_least") * t.numerator <= F.least("most", "o_most") * t.denominator
        meets = spans.join(other, "key").filter(near).select("key", "band", "other")
        large = banded.join(meets, ["key", "band"]).withColumns({"low": F.least("band", "other"), "high": F.greatest("band", "other")})
    scan = tiles_scan(t, tree)
    columns = [F.col(c).cast("long").alias(c) if c in ("n", "place") else F.col(c) for c in TILE_COLUMNS]
    one = small.select(*columns).repartition("key").sortWithinPartitions("key", "n", "node").mapInArrow(scan, "a long, b long")
    many = large.select(*columns).repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "n", "node").mapInArrow(scan, "a long, b long")
    return one.unionByName(many).distinct()


def overlaps(sets_a: pa.Array, sets_b: pa.Array) -> np.ndarray:
    """Intersection sizes of sorted arrays of distinct elements, pair by pair."""
    out = np.empty(len(sets_a), np.int64)
    for i, (a, b) in enumerate(zip(sets_a, sets_b, strict=True)):
        x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        out[i] = np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x)
    return out


def wanted_rows(batch: pa.RecordBatch, ids: np.ndarray, nameless: bool) -> pa.RecordBatch:
    """Rows whose ``doc_id`` is in a sorted array; with ``nameless`` also those without one."""
    null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
    hit = is_in(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), ids)
    return batch.filter(pa.array(np.where(null, nameless, hit)))


def sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node, grams`` of the wanted ``nodes (node, doc_id)``, by passes over the texts with at most ``LOOKUP`` of them each.

    ``doc_id`` is that of one row of the node (null if that row has none); only rows with such ids are cut into n-grams.
    """
    passes = max(1, -(-nodes.count() // LOOKUP))
    out = None
    for k in range(passes):
        part = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(passes)) == k) if passes > 1 else nodes
        rows = part.select("node", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("nameless")).toPandas()
        nameless = rows["nameless"].to_numpy(bool)
        ids = distinct(rows["doc_id"].to_numpy(np.int64)[~nameless])
        wanted = docs.sparkSession.sparkContext.broadcast((np.sort(rows["node"].to_numpy(np.int64)), ids, bool(nameless.any())))

        def scan(batches: Iterable[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            known, ids, nameless = wanted.value
            for batch in slices((wanted_rows(b, ids, nameless) for b in batches), limit=SHINGLE_BYTES):
                grams, offsets = shingle_sets(batch.column(1), size)
                names = set_keys(grams, offsets)
                hit = np.flatnonzero(is_in(names, known))
                hit = hit[np.unique(names[hit], return_index=True)[1]]
                yield pa.RecordBatch.from_arrays([pa.array(names[hit]), pa.array([grams[offsets[r] : offsets[r + 1]].tobytes() for r in hit], pa.binary())], ["node", "grams"])

        found = text_rows(docs).mapInArrow(scan, "node long, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))
        out = found if out is None else out.unionByName(found)
    return out


def verified(docs: DataFrame, named: DataFrame, pairs: DataFrame, size: int, t: Fraction, root: str, name: str) -> DataFrame:
    """The pairs that reach the threshold, by exact intersection; ``named (node, doc_id)`` tells a row of every node."""
    pairs = stored(pairs, root, f"{name}_pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = sets_of(docs, stored(nodes.join(named, "node"), root, f"{name}_nodes"), size)

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            both = overlaps(a, b)
            n = (np.array([len(x.as_buffer()) for x in a], np.int64) + np.array([len(x.as_buffer()) for x in b], np.int64)) // 8
            linked = both * t.denominator >= t.numerator * (n - both)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(linked)), batch.column(1).filter(pa.array(linked))], ["a", "b"])

    sided = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a").join(sets.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b")
    return stored(sided.select("a", "b", "ga", "gb").mapInArrow(exact, "a long, b long"), root, f"{name}_links")


def near_duplicate_groups(docs: DataFrame, size: int = 5, threshold: str = "0.8") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``, and the group's ``node``."""
    spark, t = docs.sparkSession, Fraction(threshold)
    root = scratch(spark)
    rows = stored(features(docs, size, t, common_ngrams(docs, size, root)), root, "features")
    sets = rows.filter("n_shingles > 0").dropDuplicates(["node"]).select("node", "doc_id", F.col("n_shingles").cast("int").alias("n"), "prefix", "minima", "bits")
    sets = stored(sets, root, "sets")

    shared, ids = Window.partitionBy("key"), sets.select("node", "doc_id")
    first = sets.select(F.explode(F.array_distinct("minima")).alias("key"), "node").withColumn("size", F.count("*").over(shared)).filter("size > 1")
    first = first.join(sets.select("node", "n", F.lit(0).alias("place"), F.col("node").alias("comp"), "bits"), "node")
    links = verified(docs, ids, tiled(first, t, True), size, t, root, "first")
    # Over all prefix elements: first along spanning trees again, which joins what is left of large groups by few pairs,
    # and then every pair of sets that aren't joined. An element whose sets are all joined is done with in the runs that follow.
    keyed = None
    for k, tree in enumerate([True] * TREE_ROUNDS + [False]):
        groups = stored(components(links, f"{root}/round_{k}"), root, f"components_{k}")
        joined = groups.withColumnRenamed("component", "comp")
        named = sets.join(joined, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        if keyed is None:
            shares = named.select(F.posexplode("prefix").alias("place", "key"), "node", "comp").withColumn("size", F.count("*").over(shared))
        else:
            shares = keyed.join(named.select("node", "comp"), "node")
        shares = shares.withColumn("many", F.min("comp").over(shared) < F.max("comp").over(shared)).filter("many")
        keyed = stored(shares.select("key", "place", "size", "node"), root, f"shared_prefixes_{k}")
        members = keyed.join(named.select("node", "n", "comp", "bits"), "node")
        # What is joined goes on as stars, so that only the new links take steps.
        links = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(verified(docs, ids, tiled(members, t, tree), size, t, root, f"round_{k}"))
    groups = components(links, f"{root}/last")

    named_rows = rows.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # A group's smallest doc_id, from one row per set: a large group of copies is folded before the shuffle.
    least = named_rows.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = named_rows.join(least, "component", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), F.col("component").alias("node"))


def keep_one_of_each_group(docs: DataFrame, size: int = 5, threshold: str = "0.8") -> DataFrame:
    """The document of the smallest ``doc_id`` of each group, and each document without words; all columns as they were.

    ``doc_id`` names a document: of rows that repeat one with the same text, one stays.
    """
    groups = near_duplicate_groups(docs, size, threshold)
    chosen = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("chosen")).distinct()
    return docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("chosen")), "left_semi").dropDuplicates(["doc_id", "text"])
