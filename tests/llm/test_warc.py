import hashlib

from stocktake.llm import warc as W
from stocktake.llm.text import scratch, stored

BIG = "<p>" + "wörd " * 400
FAKE = "x" * 300 + "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 7\r\n\r\npayload\r\n\r\n" * 3 + "WARC/1.0\r\nContent-Length: 900000000\r\n\r\n" + "WARC/1.0\r\nno header"
PAGES = [
    (1, "http://a/1", BIG),
    (2, "http://a/2", BIG),
    (3, None, BIG),
    (4, "http://a b\r\nx", "small"),
    (5, "http://a/5", "small"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "http://a/8", FAKE),
    (9, "http://a/9", FAKE * 5),
    (10, "http://a/10", "é" * 20000),
    (10, "http://a/10", "é" * 20000),
    (None, "http://a/n", "y" * 2000),
    (-3, "http://a/m", "y" * 2000),
    (11, "http://a/11", "z" * 1000),
    (12, "http://a/12", "z" * 1000),
    (13, "http://a/13", "z" * 999),
    (14, "http://a/14", "z" * 999),
]


def brute():
    last = {}
    for i, _, html in PAGES:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            last[data] = max(i, last.get(data, i))
    out = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        response = last.get(data, i) == i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if response else "revisit", None if response else last[data]))
    return sorted(out, key=repr)


def pages(spark, rows=None):
    rows = PAGES if rows is None else rows
    return spark.createDataFrame([(i, u, h, 1, "p") for i, u, h in rows], "page_id long, url string, html string, size long, path string")


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_hard_cases(spark):
    assert result(W.warc_round_trip(pages(spark))) == brute()
    assert result(W.warc_round_trip(pages(spark, []))) == []


def test_chains_over_many_small_chunks_and_files(spark, monkeypatch):
    """Records over several chunks, chunks without a record's start, magic across a chunk's end, and in payloads."""
    root = scratch(spark)
    files = stored(W.write_warc(pages(spark).coalesce(1), f"{root}/archives", root), root, "files")
    assert files.count() == 1
    for size in (3000, 30000):
        assert result(W.read_warc(files, scratch(spark), size)) == brute()


def test_candidates_hold_the_false_ones_too(spark):
    root = scratch(spark)
    files = stored(W.write_warc(pages(spark).coalesce(1), f"{root}/archives", root), root, "files")
    f = files.first()
    with W.opened(f.path) as file:
        data = file.read(f.size)
        found = W.candidates(data, file, 0, f.size, f.size)
    assert f.records == len(PAGES) < len(found)
