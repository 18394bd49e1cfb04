"""WARC files of pages, and their reading by boundary-chain verification.

Writing: one record a page. Of pages with equal payloads of ``MIN_REVISIT`` bytes or more, the one of the
largest ``page_id`` is a response; the others are revisit records without a block that name it.

Reading: a file is cut into chunks, each scanned by one task. Wherever the record magic stands, the
task parses a header and emits a candidate: its offset and its successor's (header and content end).
Candidates inside payloads look the same. Only the chain from the file's start tells them apart: in each
chunk a candidate's successors are followed to where they leave it; pointer jumping over these
chunk-to-chunk links, by doubling, finds the offset at which the file's chain enters each chunk; and the
records reached from there are read. All else is payload.

Defined cases: a null ``html`` is empty, a null ``url`` is left empty, a null ``page_id`` stays null and is
largest of none; rows that repeat a page's id and payload are of the same type; an empty
table writes no file. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.files import create, opened
from stocktake.llm.text import scratch, stored

# Fixed values of the format.
MAGIC, HEADER_END, RECORD_END = b"WARC/1.0\r\n", b"\r\n\r\n", b"\r\n\r\n"
PROFILE = "http://netpreservation.org/warc/1.0/revisit/identical-payload-digest"
MIN_REVISIT = 1000
#: Bytes of a file and of a chunk; a record may be longer than either.
FILE_BYTES, CHUNK_BYTES = 64 << 20, 4 << 20
#: A header is read in steps of this many bytes.
HEADER_BYTES = 4096


def record(page_id: int | None, url: str, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One record. A revisit (``refers_to`` given) has no block, and names the payload's length."""
    name = "" if page_id is None else str(page_id)
    kind = "response" if refers_to is None else "revisit"
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", "WARC-Target-URI: " + " ".join(url.split()), f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>", f"X-Payload-Length: {size}"]
        payload = b""
    return "\r\n".join([*lines, f"Content-Length: {len(payload)}"]).encode() + HEADER_END + payload + RECORD_END


def header_of(head: bytes) -> dict[str, str] | None:
    """Fields (lower-case names) of a header without its magic line; ``None`` if it is none."""
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return fields if fields.get("content-length", "").isdigit() else None


def revisits_of(pages: DataFrame, root: str) -> DataFrame:
    """``page_id, digest, size, refers_to`` of the pages to be written as revisits."""
    keys = pages.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size")).filter(F.col("size") >= MIN_REVISIT)
    groups = keys.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return stored(keys.join(groups, ["digest", "size"]).filter("page_id <> refers_to OR page_id IS NULL").distinct().select("page_id", "digest", "refers_to"), root, "revisits")


def write_warc(pages: DataFrame, folder: str, root: str) -> DataFrame:
    """Writes the archives; returns ``path, size, records`` of every file."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    revisits = revisits_of(rows, root)
    keyed = rows.withColumn("digest", F.sha1("payload")).alias("p")
    same = F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.digest") == F.col("r.digest"))
    typed = keyed.join(revisits.alias("r"), same, "left").select("p.page_id", "p.url", "p.payload", "p.digest", "r.refers_to")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, records = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is not None and size >= FILE_BYTES:
                    out.close()
                    done.append((path, size, records))
                    out = None
                if out is None:
                    (out, path), size, records = create(folder, "pages"), 0, 0
                data = record(page_id, url, payload, len(payload), digest, refers_to)
                out.write(data)
                size, records = size + len(data), records + 1
        if out is not None:
            out.close()
            done.append((path, size, records))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "size", "records"])

    return typed.mapInArrow(write, "path string, size long, records long")


def _header_at(data: bytes, at: int, file, base: int, size: int) -> tuple[dict[str, str], int] | None:
    """Fields and end offset (in the file) of the header whose magic stands at ``data[at]``; reads on where ``data`` ends in it."""
    end = data.find(HEADER_END, at)
    head = data[at:end] if end >= 0 else data[at:]
    if end < 0:
        place = base + len(data)
        while end < 0 and place < size:
            file.seek(place)
            more = file.read(HEADER_BYTES)
            place += len(more)
            head += more
            end = head.find(HEADER_END)
        if end < 0:
            return None
        head, end = head[:end], at + end
    fields = header_of(head[len(MAGIC) :])
    return None if fields is None else (fields, base + end + len(HEADER_END))


def candidates(data: bytes, file, base: int, stop: int, size: int) -> dict[int, int]:
    """Candidate offset -> successor offset, for every magic that begins in ``[base, stop)``."""
    found, at = {}, data.find(MAGIC)
    while 0 <= at and base + at < stop:
        if got := _header_at(data, at, file, base, size):
            after = got[1] + int(got[0]["content-length"]) + len(RECORD_END)
            if after <= size:
                found[base + at] = after
        at = data.find(MAGIC, at + 1)
    return found


def chunk_links(chunks: DataFrame) -> DataFrame:
    """Scans ``chunks (path, size, begin, stop)``: ``path, at, leaves`` per candidate, where its chain leaves the chunk."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, begin, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with opened(path) as file:
                    file.seek(begin)
                    data = file.read(min(size, stop + len(MAGIC)) - begin)
                    links = candidates(data, file, begin, stop, size)
                leaves: dict[int, int] = {}
                for at in sorted(links, reverse=True):  # successors lie behind, so they are known already
                    after = links[at]
                    if after >= stop:
                        leaves[at] = after
                    elif after in leaves:
                        leaves[at] = leaves[after]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(leaves), pa.string()), pa.array(list(leaves), pa.int64()), pa.array(list(leaves.values()), pa.int64())], ["path", "at", "leaves"])

    return chunks.select("path", "size", "begin", "stop").mapInArrow(scan, "path string, at long, leaves long")


def entries(files: DataFrame, links: DataFrame, rounds: int, root: str) -> DataFrame:
    """``path, at``: where each file's chain enters its chunks, by pointer jumping from offset 0."""
    starts = files.select("path", F.lit(0).cast("long").alias("at"))
    # Only offsets that some chain leaves for can be entered: one or a few a chunk.
    targets = links.select("path", F.col("leaves").alias("at")).unionByName(starts).distinct()
    jump = stored(links.join(targets, ["path", "at"]), root, "jumps_0")
    reached = starts.join(jump, ["path", "at"], "left_semi")
    for k in range(rounds):
        hops = jump.select("path", "at", F.col("leaves").alias("next"))
        onward = reached.join(hops, ["path", "at"]).select("path", F.col("next").alias("at"))
        reached = stored(reached.unionByName(onward).distinct(), root, f"reached_{k + 1}")
        if k + 1 < rounds:
            far = jump.select("path", F.col("at").alias("next"), "leaves")
            jump = stored(hops.join(far, ["path", "next"]).select("path", "at", "leaves"), root, f"jumps_{k + 1}")
    return reached


def read_warc(files: DataFrame, root: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per record of the archives ``files (path, size)``: ``page_id, payload_bytes, payload_digest, record_type, refers_to, url``."""
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(chunk_bytes).cast("long")))
    chunks = files.filter("size > 0").select("path", "size", cut.alias("begin")).withColumn("stop", F.least("size", F.col("begin") + chunk_bytes))
    counts = chunks.groupBy("path").count().agg(F.max("count"), F.sum("count")).first()
    most, total = counts[0] or 1, counts[1] or 1
    tasks = max(1, min(total, 100_000))
    links = stored(chunk_links(chunks.repartition(tasks, "path", "begin")), root, "links")
    entered = entries(files.filter("size > 0"), links, max(1, most.bit_length()), root)
    begin = F.col("at") - F.col("at") % chunk_bytes
    work = entered.join(files.select("path", "size"), "path").filter("at < size").withColumn("stop", F.least("size", begin + chunk_bytes))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
        number = lambda x: int(x) if x.lstrip("-").isdigit() else None
        for batch in batches:
            for path, at, size, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                with opened(path) as file:
                    file.seek(at)
                    base, data = at, file.read(stop - at)
                    while at < stop:
                        fields, place = _header_at(data, at - base, file, base, size)
                        length = int(fields["content-length"])
                        block = data[place - base : place - base + length]
                        if len(block) < length:
                            file.seek(place)
                            block = file.read(length)
                        at = place + length + len(RECORD_END)
                        revisit = fields.get("warc-type") == "revisit"
                        rows.append(
                            (
                                number(fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")),
                                int(fields["x-payload-length"]) if revisit else length,
                                fields["warc-payload-digest"].removeprefix("sha1:") if revisit else hashlib.sha1(block).hexdigest(),
                                fields["warc-type"],
                                number(fields["warc-refers-to"].removeprefix("<urn:page:").removesuffix(">")) if revisit else None,
                                fields.get("warc-target-uri", ""),
                            )
                        )
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    return work.select("path", "at", "size", "stop").repartition(tasks, "path", "at").mapInArrow(read, schema)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    root = scratch(pages.sparkSession)
    files = stored(write_warc(pages, f"{root}/archives", root), root, "files")
    return read_warc(files, root)
