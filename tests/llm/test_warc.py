"""WARC archives: records, monolithic streams, members of their own, and the index."""

import gzip
import json

import fixtures

from seriesmill.llm import queries, warc
from seriesmill.session import work_path

BIG = "<p>" + "x" * 200
PAGES = [
    (1, "http://a/é b\r\nX: y", BIG),
    (2, None, BIG),
    (3, "http://c", "short"),
    (4, "http://d", "short"),
    (5, "http://e", None),
    (6, "http://f", ""),
    (7, "http://g", "é\r\n\r\n日本" * 40),
    (8, "http://h", "é\r\n\r\n日本" * 40),
    (1, "http://a", BIG),  # a repeated page
    (None, "http://n", BIG),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def wanted(rows):
    least = {}
    for key, _, html in rows:
        if key is not None:
            least[html] = min(least.get(html, key), key)
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        first = least.get(html)
        later = len(data) >= 100 and key is not None and key > first
        out.append((key, len(data), fixtures.sha(data), "revisit" if later else "response", first if later else None))
    return sorted(out, key=str)


def test_round_trip_edges(spark):
    got = sorted((tuple(r) for r in warc.round_trip(pages(spark)).collect()), key=str)
    assert got == wanted(PAGES)
    clash = pages(spark).selectExpr("*", "1 digest", "2 refers_to", "3 is_revisit", "4 path", "5 payload_bytes", "6 n")
    assert sorted((tuple(r) for r in warc.round_trip(clash).collect()), key=str) == wanted(PAGES)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_archives_and_index(spark):
    folder = work_path(spark, "warc-test")
    archives = warc.write_archives(warc.with_fates(pages(spark)), folder + "/mono", archive_bytes=300)
    assert archives.agg({"records": "sum"}).first()[0] == len(PAGES)
    index = warc.normalise(archives, folder + "/records")
    entries = index.collect()
    assert len(entries) == len(PAGES) and len({e["path"] for e in entries}) == archives.count()
    for path in {e["path"] for e in entries}:
        files, name = warc.storage(path)
        data = files.open_input_stream(name, compression=None).read()
        own = sorted((e for e in entries if e["path"] == path), key=lambda e: e["offset"])
        assert sum(e["length"] for e in own) == len(data)
        for e in own:
            record = gzip.decompress(data[e["offset"] : e["offset"] + e["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        files, name = warc.storage(path + ".index")
        lines = files.open_input_stream(name, compression=None).read().decode().splitlines()
        assert [json.loads(x)["offset"] for x in lines] == [e["offset"] for e in own]
    payloads = {(r["page_id"], r["record_type"]): r["payload"] for r in warc.read_records(index).collect()}
    assert payloads[7, "response"] == PAGES[6][2].encode() and payloads[8, "revisit"] is None
    one = warc.read_records(index.filter("page_id = 7")).collect()
    assert [bytes(r["payload"]) for r in one] == [PAGES[6][2].encode()]


def test_inflating_in_chunks(monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "CHUNK", 7)
    own, http = warc.header({"page_id": 1, "url": None, "digest": "d", "payload_bytes": 300, "is_revisit": False, "refers_to": None})
    record = own + http + b"\r\n" * 150 + b"\r\n\r\n"
    path = tmp_path / "two.gz"
    path.write_bytes(gzip.compress(record * 2) + gzip.compress(record))
    with open(path, "rb") as file:
        found = [b"".join(block) for _, _, block in warc.records(warc.Inflated(file))]
    assert found == [http + b"\r\n" * 150] * 3


def test_op6_over_the_pages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{fixtures.SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = sorted((tuple(r) for r in queries.op6_warc(spark, fixtures.SF).collect()), key=str)
    assert got == wanted(rows)
