"""WARC writing, normalising and reading: exact round trips and damage."""

from __future__ import annotations

import gzip
import hashlib
import json
import zlib

import pytest

from tradeflow.llm import warc
from tradeflow.llm.common import scratch_path

LONG, OTHER = "<p>" + "ä long page " * 20, "<p>" + "another page " * 30
ROWS = [(5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, None, LONG), (None, "http://a/none", LONG), (3, "http://a/3", LONG),
        (1, "http://a/1", None), (2, "http://a/2", ""), (4, "http://a/4\r\nX-Evil: 1", "short"), (6, "http://a/6", "short"),
        (7, "http://a/7", OTHER), (8, "http://a/8", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (10, "u", "x" * 3_000_000)]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*r, "payload", 1) for r in ROWS],
                                 "page_id long, url string, html string, record_type string, n long").repartition(3)


def expected():
    least = {}
    for i, _, h in ROWS:
        if i is not None and len((h or "").encode()) >= 100:
            least[h] = min(i, least.get(h, i))
    out = []
    for i, _, h in ROWS:
        data = (h or "").encode()
        first = least.get(h) if len(data) >= 100 else None
        again = first is not None and i != first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(pages):
    index = warc.archive_pages(pages)
    found = warc.read_records(index).collect()
    assert sorted((tuple(r)[1:2] + tuple(r)[3:7] for r in found), key=str) == expected()
    text = {i: h for i, _, h in ROWS}
    for r in found:
        assert r.payload is None if r.record_type == "revisit" else r.payload.decode() == (text[r.page_id] or "")
        assert r.url is None or "\r" not in r.url
    for archive in {r.archive for r in found}:
        path = archive.removeprefix("file:")
        own = sorted((r for r in index.collect() if r.archive == archive), key=lambda r: r.offset)
        data = open(path, "rb").read()
        assert [json.loads(x)["offset"] for x in open(path + ".idx")] == [r.offset for r in own]
        assert sum(r.length for r in own) == len(data) and own[0].offset == 0
        for r in own:  # every record is one member
            gz = zlib.decompressobj(31)
            assert gz.decompress(data[r.offset:r.offset + r.length]).startswith(b"WARC/1.1\r\n")
            assert gz.eof and not gz.unused_data


def test_archives_are_split_and_whole_streams(spark, pages):
    made = warc.write_monolithic(warc.with_revisits(pages).coalesce(1), scratch_path(spark, "t"), archive_bytes=2000).collect()
    assert len(made) > 1 and sum(r.records for r in made) == len(ROWS)
    for r in made:
        gz = zlib.decompressobj(31)
        gz.decompress(open(r.archive.removeprefix("file:"), "rb").read())
        assert gz.eof and not gz.unused_data


def test_empty(pages):
    assert warc.read_records(warc.archive_pages(pages.limit(0))).collect() == []


def test_damage_fails(spark, tmp_path):
    record = warc.record_bytes(1, "u", b"x" * 500, hashlib.sha256(b"x" * 500).hexdigest(), "response", None, "r", "1970-01-01T00:00:00Z")
    whole = gzip.compress(record * 3)
    cases = {"cut": whole[:-20], "noise": b"\x00" * 50, "no record": gzip.compress(b"hello\r\n\r\n"),
             "short": gzip.compress(record[:-30]), "fine": whole + gzip.compress(record), "nothing": b""}
    for name, data in cases.items():
        path = tmp_path / f"{name}.warc.gz"
        path.write_bytes(data)
        index = warc.normalise(spark.createDataFrame([(str(path),)], "archive string"), str(tmp_path / "out"))
        if name in ("fine", "nothing"):
            assert warc.read_records(index).count() == (4 if name == "fine" else 0)
        else:
            with pytest.raises(Exception, match=name):
                index.collect()
