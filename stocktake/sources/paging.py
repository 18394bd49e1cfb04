"""Pages of a folder's entries, in order of their names.

A pager gives one bounded page at a time: the first entries behind a name, up to a last name. So a task
holds a page, never a folder, and a folder can be cut into ranges of names that several tasks list.

* files (a local or mounted store): names are streamed from the directory, the page's ones kept in a heap;
  only these are asked for size and time
* ``s3://`` with ``boto3`` installed: list calls by start name, with the store's ETags and real sizes
* any other store Arrow opens: Arrow lists a folder in one call, so a folder is one page
"""

from __future__ import annotations

import datetime
import functools
import heapq
import os
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple, Protocol
from urllib.parse import quote

from pyarrow import fs

try:
    import boto3
except ImportError:
    boto3 = None

#: Behind every name that begins with the text before it.
END = "\U0010ffff"
#: Names that a directory's ranges are cut by.
SAMPLE_NAMES = 4096


class Entry(NamedTuple):
    """An entry of a folder; a sub-folder's name ends in a slash."""

    name: str
    last_modified: datetime.datetime | None
    size: int | None
    etag: str | None


class Pager(Protocol):
    #: Entries of a page, at most; none if the store has no pages.
    page_entries: int | None

    def page(self, after: str | None, last: str | None, limit: int) -> list[Entry]:
        """The first ``limit`` entries whose name is behind ``after`` and not behind ``last`` (none: no bound), by name.

        Fewer than ``limit`` mean that there are no more."""
        ...

    def cuts(self, after: str, last: str | None, most: int) -> list[str]:
        """At most so many names, ascending, that cut the range behind ``after`` into about equal parts."""
        ...


@functools.lru_cache(maxsize=64)
def opened_store(store: str, account: str, bucket: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a bucket; a worker opens each once."""
    escaped = quote if re.match("[a-zA-Z][a-zA-Z0-9+.-]*:", store) else str  # a plain path is no URI
    return fs.FileSystem.from_uri(store.replace("{account}", escaped(account)) + escaped(bucket))


@functools.lru_cache(maxsize=64)
def s3_client(account: str):
    """A client by the account's profile if there is one, else by the default credentials."""
    session = boto3.Session()
    return boto3.Session(profile_name=account).client("s3") if account in session.available_profiles else session.client("s3")


def pager_of(store: str, account: str, bucket: str, prefix: str) -> Pager:
    if store == "s3://" and boto3 is not None:
        return S3Pager(s3_client(account), bucket, prefix)
    system, root = opened_store(store, account, bucket)
    path = f"{root.rstrip('/')}/{prefix}"
    return FilePager(path) if isinstance(system, fs.LocalFileSystem) else ArrowPager(system, path)


def inside(name: str, after: str | None, last: str | None) -> bool:
    return (after is None or name > after) and (last is None or name <= last)


@dataclass
class FilePager:
    path: str
    page_entries: int | None = 50_000

    def names(self) -> Iterator[str]:
        try:
            with os.scandir(self.path) as found:
                for e in found:
                    if e.is_dir():
                        yield e.name + "/"
                    elif e.is_file():
                        yield e.name
        except (FileNotFoundError, NotADirectoryError):
            return

    def page(self, after: str | None, last: str | None, limit: int) -> list[Entry]:
        entries = []
        for name in heapq.nsmallest(limit, (x for x in self.names() if inside(x, after, last))):
            try:
                about = os.stat(f"{self.path}/{name}")
            except FileNotFoundError:  # gone since; its place in the page is kept, so that the page stays full
                entries.append(Entry(name, None, None, None))
                continue
            time = datetime.datetime.fromtimestamp(about.st_mtime_ns // 1000 / 1e6, datetime.timezone.utc)
            entries.append(Entry(name, time, 0 if name.endswith("/") else about.st_size, None))
        return entries


    def cuts(self, after: str, last: str | None, most: int) -> list[str]:
        # Quantiles of a sample of the names: it decides how even the parts are, not what they hold.
        sample, rng, n = [], random.Random(self.path), 0
        for name in self.names():
            if inside(name, after, last):
                n += 1
                if len(sample) < SAMPLE_NAMES:
                    sample.append(name)
                elif (place := rng.randrange(n)) < SAMPLE_NAMES:
                    sample[place] = name
        sample = sorted(set(sample))
        return sample[:: -(-len(sample) // most)][1:] if sample else []


@dataclass
class ArrowPager:
    system: fs.FileSystem
    path: str
    page_entries: int | None = None

    def page(self, after: str | None, last: str | None, limit: int) -> list[Entry]:
        kinds = (fs.FileType.File, fs.FileType.Directory)
        found = [f for f in self.system.get_file_info(fs.FileSelector(self.path, recursive=False, allow_not_found=True)) if f.type in kinds]
        folder = [f.type == fs.FileType.Directory for f in found]
        entries = [Entry(f.base_name + "/" * d, f.mtime, 0 if d else f.size, None) for f, d in zip(found, folder, strict=True)]
        return sorted(e for e in entries if inside(e.name, after, last))[:limit]

    def cuts(self, after: str, last: str | None, most: int) -> list[str]:
        return []


@dataclass
class S3Pager:
    """Keys directly under the prefix as they are (a key that ends in a slash keeps its size), deeper ones as sub-folders."""

    client: object
    bucket: str
    prefix: str
    page_entries: int | None = 1000

    def page(self, after: str | None, last: str | None, limit: int) -> list[Entry]:
        asked = {"Bucket": self.bucket, "Prefix": self.prefix, "Delimiter": "/", "MaxKeys": limit}
        if after is not None:
            # Behind a sub-folder means behind all that lies in it.
            asked["StartAfter"] = self.prefix + after + (END if after.endswith("/") else "")
        answer = self.client.list_objects_v2(**asked)
        names = lambda key: key[len(self.prefix) :]
        entries = [Entry(names(o["Key"]), o["LastModified"], o["Size"], o["ETag"]) for o in answer.get("Contents", [])]
        entries += [Entry(names(p["Prefix"]), None, 0, None) for p in answer.get("CommonPrefixes", [])]
        entries.sort()
        kept = [e for e in entries if inside(e.name, after, last)]
        # A short answer of a store is no end: go on behind it until the page is full or the range is over.
        if len(kept) == len(entries) and answer.get("IsTruncated") and entries and len(kept) < limit:
            kept += self.page(entries[-1].name, last, limit - len(kept))
        return kept

    def cuts(self, after: str, last: str | None, most: int) -> list[str]:
        return cuts_behind(after, last, most)


def cuts_behind(name: str, last: str | None, most: int) -> list[str]:
    """Names behind ``name`` where the rest of its folder may be cut, ascending: at each place of the name the greater signs of its kind.

    Like the wheels of a counter, so numbered names are cut evenly: all cuts at digits, and as many at letters
    as are left. Any cut is right, whatever the names; a range that is still too long is cut again."""
    kinds = ["0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"]
    at = [{name[:k] + s for k in range(len(name)) for s in kind if name[k] in kind and s > name[k]} for kind in kinds]
    digits = sorted(c for c in at[0] if inside(c, name, last))[:most]
    letters = sorted(c for c in at[1] | at[2] if inside(c, name, last))
    room = most - len(digits)
    return sorted(digits + (letters[:: -(-len(letters) // room)] if room and letters else []))
