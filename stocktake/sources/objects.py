"""List the objects of mapped folders, distributed over folders and ranges of names, into raw listing entries.

Only the mapped folders are listed, non-recursive, in the tasks that hold their rows: the driver never sees an
object, and nothing else under a bucket is touched. A folder comes in pages (see
:mod:`stocktake.sources.paging`). A task lists at most ``RANGE_ENTRIES`` of one range of names; what is left is cut into
ranges for the tasks of the next round, so a folder of any size is listed by many tasks that hold a page each.
Every round is written to shared scratch storage, and the entries are read from there: a folder is listed once, whatever
is made of the entries later. Every name counts: zero-byte objects, ``_SUCCESS``, names that begin with a dot. A
folder that does not exist is just empty.

``write_objects`` puts objects of lines where ``list_folders`` finds them, by tasks that share them evenly.

``with_content_hash`` adds the MD5 of the content for objects that were listed, read in pieces by
tasks that share the objects evenly. A store's own ETags come with an ``s3://`` scan and with inventory reports
(:func:`stocktake.sources.readers.read_inventory`). Compare listings of the same ``hash_kind`` only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.operators.listing import mapped_folders
from stocktake.schemas import RAW_ENTRY
from stocktake.session import scratch_root
from stocktake.sources.paging import Pager, opened_store, pager_of

#: Where ``<bucket>/<key>`` lies; ``{account}`` stands for the account.
S3_STORE = "s3://"
READ_BYTES = 8 << 20
#: Entries that a task lists of one range in a round, and ranges that the rest is cut into.
RANGE_ENTRIES, RANGES = 100_000, 64
ENTRY_KINDS = [("account", pa.string()), ("bucket", pa.string()), ("key", pa.string()), ("last_modified", pa.timestamp("us", "UTC")), ("size", pa.int64()), ("etag", pa.string())]


def _listed(pager: Pager, after: str | None, last: str | None, most: int) -> Iterator[tuple[list, list[tuple]]]:
    """Pages of a range, and at the end the ranges left when ``most`` entries have been listed."""
    done = 0
    while True:
        limit = min(pager.page_entries, most - done) if pager.page_entries else 1 << 62
        page = pager.page(after, last, limit)
        done += len(page)
        yield page, []
        if len(page) < limit:
            return
        after = page[-1].name
        if done >= most:
            ends = [*pager.cuts(after, last, RANGES - 1), last]
            yield [], list(zip([after, *ends[:-1]], ends, strict=True))
            return


def list_folders(long_map: DataFrame, accounts: list[str] | None = None, store: str = S3_STORE, tasks: int | None = None, range_entries: int | None = None) -> DataFrame:
    """Objects directly under each mapped folder -> ``account, bucket, key, last_modified, size, etag``.

    A sub-folder is an entry whose key ends in ``/``, of size 0, as a store's folder marker; so
    it is no file, and shows up in the sub-folder report.
    """
    folders = mapped_folders(long_map, accounts)
    spark, most = folders.sparkSession, range_entries or RANGE_ENTRIES
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    root = scratch_root(spark)

    def list_(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*ENTRY_KINDS, ("prefix", pa.string()), ("after", pa.string()), ("last", pa.string())]
        for batch in batches:
            for account, bucket, prefix, after, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for page, rest in _listed(pager_of(store, account, bucket, prefix), after, last, most):
                    n, left = len(page), len(rest)
                    columns = [
                        [account] * (n + left), [bucket] * (n + left), [prefix + e.name for e in page] + [None] * left, [e.last_modified for e in page] + [None] * left,
                        [e.size for e in page] + [None] * left, [e.etag for e in page] + [None] * left, [None] * n + [prefix] * left, [None] * n + [r[0] for r in rest], [None] * n + [r[1] for r in rest],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, kinds, strict=True)], [name for name, _ in kinds])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_ENTRY.fields) + ", prefix string, after string, last string"
    ranges = folders.select("account", "bucket", "prefix", F.lit(None).cast("string").alias("after"), F.lit(None).cast("string").alias("last"))
    paths = []
    while True:
        paths.append(f"{root}/round_{len(paths)}")
        ranges.repartition(tasks).mapInArrow(list_, schema).write.parquet(paths[-1])
        ranges = spark.read.schema(schema).parquet(paths[-1]).where("prefix IS NOT NULL").select("account", "bucket", "prefix", "after", "last")
        if ranges.isEmpty():
            break
    return spark.read.schema(schema).parquet(*paths).where("key IS NOT NULL").select(*RAW_ENTRY.fieldNames())


def digest_of(stream, part_bytes: int | None = None) -> str:
    """MD5 of a content; from ``part_bytes`` on, as stores name an upload in parts of that size: MD5 of the parts' MD5s, and their number."""
    whole, parts, filled = hashlib.md5(), [], 0
    part = hashlib.md5()
    while piece := stream.read(READ_BYTES if part_bytes is None else min(READ_BYTES, part_bytes - filled)):
        whole.update(piece)
        if part_bytes is not None:
            part.update(piece)
            filled += len(piece)
            if filled == part_bytes:
                parts.append(part.digest())
                part, filled = hashlib.md5(), 0
    if not parts:
        return whole.hexdigest()
    parts += [part.digest()] if filled else []
    return f"{hashlib.md5(b''.join(parts)).hexdigest()}-{len(parts)}"


def with_content_hash(raw: DataFrame, store: str = S3_STORE, part_bytes: int | None = None) -> DataFrame:
    """The entries with ``etag`` set to the MD5 of the object's content (folder entries keep theirs).

    ``part_bytes`` gives the digests of uploads in parts of that size instead (contents below it have plain MD5s), to
    be compared with a listing that holds those."""

    def hashed(account: str, bucket: str, key: str) -> str:
        system, root = opened_store(store, account, bucket)
        path = f"{root.rstrip('/')}/{key}"
        with system.open_input_stream(path) as stream:
            return digest_of(stream, part_bytes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = zip(*(batch.column(c).to_pylist() for c in ("account", "bucket", "key", "etag")), strict=True)
            etags = [etag if key.endswith("/") else hashed(account, bucket, key) for account, bucket, key, etag in named]
            yield batch.set_column(batch.schema.get_field_index("etag"), "etag", pa.array(etags, pa.string()))

    # Dealt out by object, so that a folder with many objects is read by many tasks.
    return raw.select(*RAW_ENTRY.fieldNames()).repartition(F.col("account"), F.col("bucket"), F.col("key")).mapInArrow(run, RAW_ENTRY)


def write_objects(lines: DataFrame, order: list[str], store: str, bucket: str, tasks: int | None = None) -> int:
    """Writes each ``key`` of ``lines (key, text, ...)`` as one object: its texts by ``order``, each ended by a line feed. Returns how many.

    The keys are dealt evenly to ``tasks``, however few bytes they hold: a small object costs its creation, not its size. An
    object is written beside the bucket and moved to its place when it is whole, so a task that runs again, or
    twice, leaves the same objects. A line without a key is in none.
    """
    tasks = tasks or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened_store(store, "", bucket)
        attempt = f"{root.rstrip('/')}_unfinished/{uuid.uuid4().hex}"
        system.create_dir(attempt, recursive=True)
        now, out, done = None, None, 0

        def close() -> None:
            if out is not None:
                out.close()
                path = f"{root.rstrip('/')}/{now}"
                system.create_dir(path.rpartition("/")[0], recursive=True)
                system.move(f"{attempt}/{done}", path)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != now:
                    close()
                    done += out is not None
                    now, out = key, system.open_output_stream(f"{attempt}/{done}")
                out.write(text.encode() + b"\n")
        close()
        yield pa.RecordBatch.from_arrays([pa.array([done + (out is not None)], pa.int64())], ["n"])

    dealt = lines.filter("key IS NOT NULL").repartition(tasks, "key").sortWithinPartitions("key", *order).select("key", "text")
    return dealt.mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
