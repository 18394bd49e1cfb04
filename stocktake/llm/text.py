"""Arrow helpers shared by the text operators: bounded slices, words, document spans.

Texts reach a task as Arrow batches. Every helper works on whole texts; a slice
bounds how many bytes are held in numpy arrays at a time, never how much of a text is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.session import scratch_root

#: Bytes of text worked on at a time inside a task (a longer single text is its own slice).
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id`` (long), ``text`` (null: empty) and the named columns; all other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *keep)


def stored(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write a table under ``root`` (shared storage) and read it back: cuts the lineage, survives lost executors."""
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    return scratch_root(spark)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Re-slice Arrow batches so that each holds at most about ``limit`` bytes of ``column``."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, used = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, used + limit, side="right")))
            yield batch.slice(start, stop - start)
            pa.default_memory_pool().release_unused()  # what the slice took is the system's again
            start, used = stop, int(ends[stop - 1])


def flat(array: pa.Array) -> pa.Array:
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def bytes_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string array in one numpy array, and the offsets of its rows (nulls are empty)."""
    text = flat(pc.fill_null(text, "")) if text.null_count else flat(text)
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    _, off, data = text.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32, len(text) + 1, text.offset * (8 if wide else 4)).astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])), offsets - offsets[0]


def split_lists(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Non-empty strings of a list array, with the offsets of each row in them."""
    lists = flat(lists)
    values = lists.flatten()
    raw = lists.offsets.to_numpy().astype(np.int64)
    filled = pc.not_equal(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(filled)])
    return values.filter(pa.array(filled)), before[raw - raw[0]]


def words(text: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+``: a code per word, row offsets, and the distinct words the codes point to."""
    text = pc.fill_null(text, "")
    values, offsets = split_lists(pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text))
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets, encoded.dictionary


def rows_at(offsets: np.ndarray) -> np.ndarray:
    """Row number of every element of a flat array with these row offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's elements (0 for an empty row)."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting: numpy's own ``unique`` goes through a hash table, which takes many times as long."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift, multiply) on uint64."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Longer words are hashed one by one.
LONG_WORD = 64


def hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash (uint64) of each string, byte by byte for all of them at once."""
    data, offsets = bytes_of(strings)
    size = np.diff(offsets)
    out = mixed(size.astype(np.uint64))
    live = np.flatnonzero(size <= LONG_WORD)
    for k in range(int(size[live].max()) if len(live) else 0):
        live = live[size[live] > k]
        x = (out[live] ^ data[offsets[live] + k]) * np.uint64(0x9E3779B97F4A7C15)
        out[live] = x ^ (x >> np.uint64(29))
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[offsets[i] : offsets[i + 1]].tobytes())
    return mixed(out)


def most_counted(counts: DataFrame, limit: int) -> DataFrame:
    """Rows of ``counts`` with the largest ``n``, at most ``limit`` of them.

    Cut at a level of ``n`` (eighths of powers of two), found from the number of rows at each level: a few hundred
    numbers reach the driver, where a sorted limit would send up to ``limit`` rows from each task.
    """
    level = F.floor(F.log2("n") * 8)
    left, cut = limit, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        left -= r["count"]
        if left < 0:
            break
        cut = r["level"]
    return counts.filter(level >= cut) if cut is not None else counts.filter(F.lit(False))
