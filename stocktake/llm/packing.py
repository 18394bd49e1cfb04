"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

A document is its token ids and an end id. Longer ones than a sequence are cut into full pieces and a
last shorter one; full pieces are sequences of their own. The rest is packed in shards of about
``SHARD`` pieces, drawn by a hash. Every shard is evolved by ``ISLANDS`` islands, each a task row with
a population of packings. A crossover takes well-filled bins of one parent whole, injects them into
the other, takes out the bins there that hold a piece twice, and best-fits the displaced
pieces again. After each epoch the best packing of an island moves on to the next island of its shard, by
a shuffle. An island at the lower bound (all lengths over the capacity, rounded up) has
nothing left to gain and rests. When the shards are done, the pieces of bins that are not full enough are
packed again together, in fewer shards, until one shard is left; so the shards cost no bins.

Defined cases: a null or empty text is the end id alone; rows with the same ``doc_id`` are packed
as rows of their own; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktake.llm.text import scratch, slices, stored, text_rows
from stocktake.llm.tokens import encoder

END_ID = 0
CAPACITY = 2048
#: Bytes of text whose words and ids a task holds at a time.
ENCODED_BYTES = 4 << 20
#: Pieces of a shard, islands of a shard, epochs, and each island's packings and crossovers an epoch.
SHARD, ISLANDS, EPOCHS, POPULATION, CROSSOVERS = 2048, 2, 2, 4, 6
#: Bins with less than this share filled are packed again with those of other shards.
FULL = 0.98


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=ENCODED_BYTES):
            ids, offsets = encoder(tokenizer).encode(batch.column(1))
            doc, piece, start, length, crc = [], [], [], [], []
            for r, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                own = np.append(ids[a:b], END_ID).astype("<u4")
                for k, at in enumerate(range(0, len(own), capacity)):
                    part = own[at : at + capacity]
                    doc.append(r)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return text_rows(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Packing:
    """Pieces in bins: ``bin`` of every piece, ``fill`` of every bin."""

    def __init__(self, bin_: np.ndarray, fill: list[int]) -> None:
        self.bin, self.fill = bin_, fill

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first; then fuller ones (which leaves room in the others)."""
        f = np.array(self.fill, float)
        return -len(f), float((f * f).sum())


def best_fit(lengths: np.ndarray, order: np.ndarray, bin_: np.ndarray, fill: list[int], capacity: int) -> Packing:
    """Puts the pieces of ``order`` each into the fullest bin with room, or a new one.

    ``room[r]`` holds the bins with ``r`` places left, a bit mask tells which are not empty: the
    smallest room that suffices is the mask's lowest bit from the length on.
    """
    room: dict[int, list[int]] = {}
    mask = 0
    for b, used in enumerate(fill):
        room.setdefault(capacity - used, []).append(b)
        mask |= 1 << (capacity - used)
    for i in order:
        size = int(lengths[i])
        above = mask >> size
        if above:
            left = size + (above & -above).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                mask &= ~(1 << left)
        else:
            left, b = capacity, len(fill)
            fill.append(0)
        bin_[i] = b
        fill[b] += size
        room.setdefault(left - size, []).append(b)
        mask |= 1 << (left - size)
    return Packing(bin_, fill)


def renumbered(bin_: np.ndarray, lengths: np.ndarray) -> Packing:
    """Bins numbered anew, without empty ones; pieces of bin -1 keep it."""
    placed = bin_ >= 0
    out = np.full(len(bin_), -1, np.int64)
    kept, out[placed] = np.unique(bin_[placed], return_inverse=True)
    return Packing(out, np.bincount(out[placed], weights=lengths[placed], minlength=len(kept)).astype(int).tolist())


def crossover(lengths: np.ndarray, one: Packing, two: Packing, capacity: int, rng: np.random.Generator) -> Packing:
    """Well-filled bins of ``one``, whole, into ``two``; what they displace is best-fitted by decreasing length."""
    fill = np.array(one.fill)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    taken = np.isin(one.bin, rng.choice(good, max(1, len(good) // 2), replace=False))
    bins = two.bin.copy()
    bins[np.isin(bins, np.unique(bins[taken]))] = -1  # these bins hold a piece twice now: they go
    bins[taken] = len(two.fill) + one.bin[taken]
    child = renumbered(bins, lengths)
    loose = np.flatnonzero(child.bin < 0)
    return best_fit(lengths, loose[np.argsort(-lengths[loose], kind="stable")], child.bin, child.fill, capacity)


def evolve(lengths: np.ndarray, population: list[Packing], capacity: int, rng: np.random.Generator, crossovers: int) -> list[Packing]:
    least = -(-int(lengths.sum()) // capacity)
    for _ in range(crossovers):
        population.sort(key=Packing.fitness, reverse=True)
        if len(population[0].fill) <= least:
            break
        one, two = rng.choice(len(population), 2, replace=False)
        child = crossover(lengths, population[min(one, two)], population[max(one, two)], capacity, rng)
        if child.fitness() > population[-1].fitness():
            population[-1] = child
    return sorted(population, key=Packing.fitness, reverse=True)


def founders(lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> list[Packing]:
    """Best-fit packings: of decreasing lengths, and of that order with noise."""
    least, out = -(-int(lengths.sum()) // capacity), []
    for k in range(POPULATION):
        order = np.argsort(-lengths * (1 + 0.15 * k * rng.random(len(lengths))), kind="stable")
        out.append(best_fit(lengths, order, np.full(len(lengths), -1, np.int64), [], capacity))
        if len(out[0].fill) <= least:
            return out * POPULATION
    return out


def _epoch(capacity: int, epoch: int):
    """One epoch of every island row: its own packings (or founders), and the elite that moved in."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
                rng = np.random.default_rng([row["shard"] & 0x7FFFFFFF, row["island"], epoch])
                if row["packings"] is None:
                    population = founders(lengths, capacity, rng)
                else:
                    population = [renumbered(np.frombuffer(p, np.int32).astype(np.int64), lengths) for p in row["packings"]]
                    if row["elite"] is not None:
                        population[-1] = renumbered(np.frombuffer(row["elite"], np.int32).astype(np.int64), lengths)
                population = evolve(lengths, population, capacity, rng, CROSSOVERS)
                kept.append([p.bin.astype(np.int32).tobytes() for p in population])
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("island"), batch.column("ids"), batch.column("lengths"), pa.array(kept, pa.list_(pa.binary()))],
                ["shard", "island", "ids", "lengths", "packings"],
            )

    return run


def evolved_shards(items: DataFrame, shards: int, capacity: int, root: str, name: str) -> DataFrame:
    """``id, length, shard, bin`` of all ``items (id, length)`` after the islands' epochs."""
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(name)), F.lit(shards)))

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted((p["id"], p["length"]) for p in pieces_) for pieces_ in batch.column("pieces").to_pylist()]
            ids = pa.array([np.array([i for i, _ in r], np.int64).tobytes() for r in rows], pa.binary())
            lengths = pa.array([np.array([n for _, n in r], np.int32).tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("shard"), ids, lengths], ["shard", "ids", "lengths"])

    # A shard's pieces are drawn by a hash of an id of their own: about SHARD of them, however skewed the documents.
    grouped = dealt.groupBy("shard").agg(F.collect_list(F.struct("id", "length")).alias("pieces")).mapInArrow(gather, "shard long, ids binary, lengths binary")
    state = grouped.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).withColumn("packings", F.lit(None).cast("array<binary>")).withColumn("elite", F.lit(None).cast("binary"))
    kind = "shard long, island int, ids binary, lengths binary, packings array<binary>"
    columns = ["shard", "island", "ids", "lengths", "packings", "elite"]
    for epoch in range(EPOCHS):
        spread = state.select(columns).repartition(max(1, min(shards * ISLANDS, 4096)), "shard", "island")
        now = stored(spread.mapInArrow(_epoch(capacity, epoch), kind), root, f"{name}_epoch_{epoch}")
        # Migration: an island's elite goes to the next island of its shard.
        moved = now.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("packings")[0].alias("elite"))
        state = now.join(moved, ["shard", "island"])

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int32)
                options = [renumbered(np.frombuffer(p, np.int32).astype(np.int64), lengths.astype(np.int64)) for p in row["best"]]
                best = max(options, key=Packing.fitness)
                fill = np.array(best.fill)[best.bin]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(lengths.astype(np.int64)), pa.array(np.full(len(ids), row["shard"])), pa.array(best.bin), pa.array(fill)],
                    ["id", "length", "shard", "bin", "fill"],
                )

    best = now.groupBy("shard").agg(F.first("ids").alias("ids"), F.first("lengths").alias("lengths"), F.collect_list(F.col("packings")[0]).alias("best"))
    return stored(best.mapInArrow(unpack, "id long, length long, shard long, bin long, fill long"), root, f"{name}_packed")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    root = scratch(docs.sparkSession)
    cut = stored(pieces(docs, tokenizer, capacity).withColumn("id", F.monotonically_increasing_id()), root, "pieces")
    full = cut.filter(F.col("length") == capacity).select("id", (-F.col("id") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = cut.filter(F.col("length") < capacity).select("id", "length")
    done, level, count = [], 0, items.count()
    while count:
        shards = -(-count // SHARD)
        packed = evolved_shards(items, shards, capacity, root, f"level_{level}").withColumn("level", F.lit(level))
        loose = packed.filter(F.col("fill") < FULL * capacity)
        left = loose.count() if shards > 1 else 0
        # Where hardly any bin is full, packing the same pieces again would gain nothing: the bins stay.
        again = 0 < left <= count * 3 // 4
        done.append((packed.filter(F.col("fill") >= FULL * capacity) if again else packed).select("id", "length", "level", "shard", "bin"))
        items, count, level = loose.select("id", "length"), left if again else 0, level + 1
    placed = full
    if done:
        bins = done[0]
        for more in done[1:]:
            bins = bins.unionByName(more)
        # A bin holds at most `capacity` pieces, so its window is bounded.
        number = F.col("level") * F.lit(1 << 56) + F.col("shard") * F.lit(1 << 20) + F.col("bin")
        before = Window.partitionBy("sequence_id").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("sequence_id", number)
        placed = placed.unionByName(bins.select("id", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")))
    return cut.join(placed, "id").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
