"""Folders in pages and ranges: every pager, the rounds of a hot folder, and names that are hard to cut."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from stocktake.operators import listing as L
from stocktake.operators import uri_map as M
from stocktake.sources import objects as O
from stocktake.sources import paging as G
from tests import fixtures as X

WHEN = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


class FakeStore:
    """A store's list call over a dict of keys: at most ``most`` answers a call, deeper keys as common prefixes."""

    def __init__(self, keys, most=7):
        self.keys, self.most, self.calls = keys, most, 0

    def list_objects_v2(self, Bucket, Prefix, Delimiter, MaxKeys, StartAfter=""):
        self.calls += 1
        found, prefixes = [], []
        for key in sorted(k for k in self.keys if k.startswith(Prefix) and k > StartAfter):
            deep = key[len(Prefix) :].find(Delimiter)
            if deep >= 0:
                common = key[: len(Prefix) + deep + 1]
                if common not in prefixes:
                    if len(found) + len(prefixes) == min(MaxKeys, self.most):
                        return self.answer(found, prefixes, True)
                    prefixes.append(common)
                continue
            if len(found) + len(prefixes) == min(MaxKeys, self.most):
                return self.answer(found, prefixes, True)
            found.append({"Key": key, "LastModified": WHEN, "Size": self.keys[key], "ETag": f'"{key}"'})
        return self.answer(found, prefixes, False)

    def answer(self, found, prefixes, more):
        return {"Contents": found, "CommonPrefixes": [{"Prefix": p} for p in prefixes], "IsTruncated": more}


def everything(pager, most=10, after=None, last=None):
    """All entries of a range by rounds, as the tasks do it."""
    out, ranges, rounds = [], [(after, last)], 0
    while ranges:
        rest, rounds = [], rounds + 1
        for a, z in ranges:
            for page, more in O._listed(pager, a, z, most):
                out += page
                rest += more
        ranges = rest
    return out, rounds


def test_store_pages_and_ranges_cover_a_folder_once():
    rng = random.Random(1)
    names = {f"part-{k:05d}.csv" for k in range(150)} | {"".join(rng.choice("aZ09-_. é/") for _ in range(rng.randrange(1, 9))) for _ in range(150)}
    keys = {f"f/{n}": k for k, n in enumerate(sorted(n for n in names if not n.startswith("/")))} | {"f/": 3, "other/x": 1, "f0": 1}
    store = FakeStore(keys)
    pager = G.S3Pager(store, "b", "f/", page_entries=9)
    found, rounds = everything(pager)
    top = {k[2:]: v for k, v in keys.items() if k.startswith("f/") and "/" not in k[2:]}
    folders = {k[2:].split("/")[0] + "/" for k in keys if k.startswith("f/") and "/" in k[2:]}
    assert sorted(e.name for e in found) == sorted([*top, *folders]) and rounds > 2
    assert all(e.size == top[e.name] and e.etag == f'"f/{e.name}"' for e in found if e.name in top)  # the marker keeps its size


def test_files_page_like_the_store(tmp_path):
    names = [f"{k:04d}" for k in range(120)] + ["a b", "_x", ".y", "é", "z%20"]
    for n in names:
        (tmp_path / n).write_text(n)
    (tmp_path / "sub").mkdir()
    pager = G.FilePager(str(tmp_path), page_entries=8)
    found, rounds = everything(pager, most=20)
    assert sorted(e.name for e in found) == sorted([*names, "sub/"]) and rounds > 1
    assert all(e.size == len(e.name.encode()) for e in found if e.name != "sub/")
    assert [e.name for e in pager.page("0005", "0008", 10)] == ["0006", "0007", "0008"]
    assert G.FilePager(str(tmp_path / "none")).page(None, None, 5) == []
    from pyarrow import fs

    whole = G.ArrowPager(fs.LocalFileSystem(), str(tmp_path))
    assert [e.name for e in everything(whole)[0]] == sorted(e.name for e in found)


@pytest.mark.parametrize("name", ["part-00999", "zzz", "é", "a", "-"])
def test_cuts_are_behind_the_name_in_order(name):
    cuts = G.cuts_behind(name, None, 10)
    assert cuts == sorted(cuts) and all(c > name for c in cuts) and len(cuts) <= 10
    if name == "part-00999":
        assert {"part-01", "part-02", "part-1", "part-9"} <= set(G.cuts_behind(name, None, 63))
    assert all(c <= "q" for c in G.cuts_behind(name, "q", 10))


def test_hot_folder_is_listed_by_many_tasks(spark, tmp_path):
    os.makedirs(tmp_path / "b" / "hot" / "deep")
    os.makedirs(tmp_path / "b" / "small")
    for k in range(3000):
        (tmp_path / "b" / "hot" / f"part-{k:05d}").write_text("x" * (k % 7))
    (tmp_path / "b" / "small" / "one").write_text("1")
    long = M.materialize(M.unpivot_map(M.clean_map(X.wide_map(spark, [("s3://b/hot",), ("s3://b/small",), ("s3://b/none",)], ["pro"]))))
    raw = O.list_folders(long, store=f"file://{tmp_path}/", tasks=4, range_entries=250)
    by = {r["bucket"] + "/" + r["folder"]: r for r in raw.groupBy("bucket", F.substring_index("key", "/", 1).alias("folder")).agg(F.count("*").alias("n"), F.countDistinct("key").alias("d"), F.sum("size").alias("s")).collect()}
    assert (by["b/hot"]["n"], by["b/hot"]["d"], by["b/hot"]["s"]) == (3001, 3001, sum(k % 7 for k in range(3000))) and by["b/small"]["n"] == 1
    # The rest behind the first 250 entries lies in the files of later rounds, written by several tasks.
    files = raw.where("key LIKE 'hot/%'").groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(files) > 3 and max(r["count"] for r in files) < 3001
    assert sorted(r["name"] or "" for r in L.extract_listing(raw, long).where("prefix <> 'hot/'").collect()) == ["", "one"]
