"""WARC: round trips, revisits, pushed filters and foreign archives."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.queries import QUERIES

LONG = "x" * 120


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_query_on_odd_pages(spark, tmp_path):
    rows = [(3, "u", LONG), (1, None, LONG), (2, "u\r\nX: 1", LONG), (4, "u", "short"), (5, "u", "short"), (6, "u", None),
            (7, "u", "é\r\n\r\nbody" + LONG), (8, "u", ""), (3, "u", LONG), (None, "u", LONG), (9, "u", "y" * 99), (10, "u", "y" * 99)]
    pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r) for r in QUERIES["op8_warc"](spark, str(tmp_path)).collect()), key=repr)
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        first = min(same) if same else None
        again = len(raw) >= 100 and len([1 for _, _, h in rows if (h or "").encode() == raw]) > 1 and page != first
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=repr)


def test_empty_table(spark, tmp_path):
    warc.write(warc.page_records(pages(spark, []), "2024-01-01T00:00:00Z"), str(tmp_path / "w"))
    assert warc.read(spark, str(tmp_path / "w")).count() == 0


def test_filters_are_pushed_and_payloads_skipped(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write(warc.page_records(pages(spark, [(i, f"http://h/{i}", f"{i} {LONG}") for i in range(50)]), "2024-01-01T00:00:00Z"), folder)
    df = warc.read(spark, folder).filter("record_type = 'response' AND target_uri = 'http://h/7'")
    assert "Filter" not in df._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0].replace("PushedFilters", "")
    assert [bytes(r.payload).decode() for r in df.collect()] == [f"7 {LONG}"]
    assert warc.read(spark, folder, payload=False).filter(F.col("payload").isNotNull()).count() == 0
    assert warc.read(spark, folder).filter("target_uri LIKE 'http://h/1%'").count() == 11


def test_unlisted_files_are_not_read(spark, tmp_path):
    folder = tmp_path / "w"
    warc.write(warc.page_records(pages(spark, [(1, "u", LONG)]), "2024-01-01T00:00:00Z"), str(folder))
    (folder / "lost.warc.gz").write_bytes(next(folder.glob("*.warc.gz")).read_bytes())
    assert warc.read(spark, str(folder)).count() == 1
    with pytest.raises(Exception, match="never overwritten"):
        warc.page_records(pages(spark, [(1, "u", LONG)]), "x").write.format("warc").mode("overwrite").save(str(folder))


def plain(kind, uri, block, extra=""):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\n{extra}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    records = [plain("warcinfo", "a", b"software: x"), plain("resource", "b", b"data", "X-Note: one\r\n two\r\n"), plain("response", "c", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody", "Content-Type: application/http\r\n")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    rows = warc.read(spark, str(tmp_path)).collect()
    assert sorted((r.record_type, bytes(r.payload)) for r in rows) == sorted(2 * [("warcinfo", b"software: x"), ("resource", b"data"), ("response", b"body")])
    assert {r.fields.get("X-Note") for r in rows if r.record_type == "resource"} == {"one two"}
    assert warc.read(spark, str(tmp_path)).filter("record_type = 'response'").count() == 2
    (tmp_path / "c.warc").write_bytes(records[0][:-9])
    with pytest.raises(Exception, match="cut short"):
        warc.read(spark, str(tmp_path)).collect()


def test_members_are_ordinary_gzip():
    raw = warc.record_bytes({"record_type": "resource", "payload": b"p" * 1000, "fields": [("K", "v")]})
    assert gzip.decompress(warc.member(raw) * 2) == raw * 2
