import base64
import gzip
import hashlib
import io
import os
import random

import pytest

from skyquarry.llm import queries, warc


def brute(rows, least=0):
    best: dict = {}
    for i, _, html in rows:
        p = (html or "").encode()
        best[p] = max(best.get(p, i), i)
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        again = len(p) >= least and best[p] != i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", best[p] if again else None))
    return sorted(out)


def got(df):
    return sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect())


ODD = [(1, "http://a.example/x", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b.example/\r\nWARC-Type: evil", ""), (4, "http://a.example/x", None), (5, "no url", "body\r\n\r\nWARC/1.0\r\n\r\n"), (6, "http://é.example/ü?q#f", "ü" * 9000), (7, "http://a.example/x", "x" * 300_000), (8, "", "\x00\x01\r\n")]


def test_query_matches_brute_force(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(queries.op6_warc(spark, small)) == brute(rows)


def test_awkward_pages(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "clash", 5) for r in ODD], "page_id long, url string, html string, sha1 string, row_id int")
    assert got(warc.archived(pages, str(tmp_path / "a"))) == brute(ODD)
    assert got(warc.archived(pages, str(tmp_path / "b"), least_bytes=11)) == brute(ODD, 11)
    assert warc.archived(pages.limit(0), str(tmp_path / "c")).count() == 0
    twice = warc.archived(pages.where("page_id = 7").union(pages.where("page_id = 7")), str(tmp_path / "d")).collect()
    assert sorted(r["record_type"] for r in twice) == ["response", "revisit"] and {r["page_id"] for r in twice} == {7}
    nameless = warc.archived(spark.createDataFrame([(None, "u", "z"), (None, "u", "q")], "page_id long, url string, html string"), str(tmp_path / "e")).collect()
    assert [r["page_id"] for r in nameless] == [None, None]


def test_archives_are_plain_records_in_index_order(spark, tmp_path):
    pages = spark.createDataFrame(ODD, "page_id long, url string, html string").repartition(3)
    found = [r.asDict() for r in warc.archived(pages, str(tmp_path / "w")).collect()]
    keys = [(r["url_key"], r["timestamp"], r["page_id"]) for r in found]
    assert keys == sorted(keys)
    payload = {i: (h or "").encode() for i, _, h in ODD}
    for r in found:
        with gzip.open(r["archive"].removeprefix("file:")) as f:
            raw = f.read()[r["offset"] : r["offset"] + r["length"]]
        assert raw.startswith(b"WARC/1.0\r\n") and raw.endswith(b"\r\n\r\n")
        if r["record_type"] == "response":
            assert raw.split(b"\r\n\r\n", 2)[2] == payload[r["page_id"]] + b"\r\n\r\n"


def test_a_damaged_archive_is_refused(spark, tmp_path):
    pages = spark.createDataFrame(ODD, "page_id long, url string, html string").coalesce(1)
    warc.write(pages, str(tmp_path / "w"))
    (name,) = [x for x in os.listdir(tmp_path / "w") if x.endswith(".gz")]
    raw = gzip.decompress((tmp_path / "w" / name).read_bytes()).replace(b"<p>one</p>", b"<p>two</p>")
    (tmp_path / "w" / f".{name}.crc").unlink(missing_ok=True)
    (tmp_path / "w" / name).write_bytes(gzip.compress(raw))
    with pytest.raises(Exception, match="damaged"):
        warc.index(spark, str(tmp_path / "w")).collect()


def test_loser_tree_merges_like_a_sort():
    rng = random.Random(3)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(k)]
        assert list(warc.loser_tree([iter(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


def test_members_after_one_another_are_read():
    data = gzip.compress(b"a" * 10) + gzip.compress(b"") + gzip.compress(b"b" * 200_000)
    assert io.BufferedReader(warc._Gunzip(memoryview(data))).read() == b"a" * 10 + b"b" * 200_000


def test_rows_that_repeat_in_full_are_one_response_and_revisits(spark, tmp_path, monkeypatch):
    """More copies than a block, copies of a null id, and rows that differ in their url alone."""
    monkeypatch.setattr(warc, "BLOCK", 7)
    rows = [(7, "u", "same")] * 30 + [(7, "v", "same")] * 2 + [(3, "u", "same")] * 4 + [(None, None, None)] * 9 + [(1, None, "x"), (1, "w", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name, df in (("a", pages.repartition(5)), ("b", pages.coalesce(1))):
        found = [r.asDict() for r in warc.archived(df, str(tmp_path / name)).collect()]
        assert sorted((r["page_id"], r["payload_bytes"]) for r in found if r["page_id"]) == sorted((i, len(h)) for i, _, h in rows if i)
        assert len(found) == len(rows)
        # of the largest id and then the last url, in whatever order the rows come
        assert sorted((r["page_id"] or 0, r["url_key"], r["payload_bytes"]) for r in found if r["record_type"] == "response") == [(0, "", 0), (1, "w", 1), (7, "v", 4)]
        assert {(r["page_id"], r["refers_to"]) for r in found if r["record_type"] == "revisit"} == {(7, 7), (3, 7), (None, None), (1, 1)}
