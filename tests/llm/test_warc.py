"""Operator 11: archives against the rules of the contract, the formats and a plain Zstandard reader."""

import hashlib
import random

import pytest
import zstandard

from driftcheck.llm.warc import RECORD, filesystem, frames, lookup, op11_warc, page_records, parse, read_archives, seek_table, write_archives

SCHEMA = "page_id long, url string, html string, payload string, archive int, digest string"


def expected(rows):
    """Row by row, by the words of the contract."""
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        first = min(same) if same and len(body) >= 100 else None
        revisit = first is not None and page != first
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def pages(seed=1, n=150):
    rng = random.Random(seed)
    bodies = ["", None, "x" * 99, "x" * 100, "é" * 50, "é" * 49, "a\r\n\r\nWARC/1.1\r\n" * 10, "<html>" + "word " * 300_000, "ü\x00" * 400]
    rows = [(i, rng.choice(["http://a.example/", None, "http://b.example/ü ?q=\n1", ""]), rng.choice(bodies[:7] + [f"<html>{i}" + "y" * rng.randint(0, 300)] * 3)) for i in range(n)]
    rows += [(None, "http://c.example/", "x" * 100), (None, None, "z" * 200), (None, None, "z" * 200), (3, "u", "w" * 150), (3, "u", "w" * 150), (-5, "v", "w" * 150), (900, "l", bodies[7]), (901, "l", bodies[7]), (902, "n", bodies[8])]
    return rows


@pytest.fixture
def table_dir(spark, tmp_path):
    spark.createDataFrame([(*r, "p", 1, "d") for r in pages()], SCHEMA).repartition(6).write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def test_query(spark, table_dir):
    out = op11_warc(spark, table_dir)
    assert out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, out.collect()), key=str) == expected(pages())


def test_archives_are_whole(spark, tmp_path):
    """Small frames and archives: plain Zstandard reads each as a whole, the seek table names every frame, the index every record."""
    rows = [r for r in pages(2) if r[0] is not None]
    records = page_records(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    index = write_archives(records, f"file://{tmp_path}/a", frame_bytes=2000, archive_bytes=4000)
    got = {(r.archive, r.frame, r.offset): r for r in read_archives(index).collect()}
    assert len(got) == len(rows) == index.count()
    archives = {r.archive for r in index.select("archive").distinct().collect()}
    assert len(archives) > 3
    for archive in archives:
        _, path = filesystem(archive)
        with open(path, "rb") as f:
            raw = f.read()
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        parts = [zstandard.ZstdDecompressor().decompress(raw[a : a + n]) for a, n, _ in seek_table(archive)]
        assert b"".join(parts) == whole and [len(p) for p in parts] == [p for _, _, p in seek_table(archive)]
        at, names = 0, []
        while at < len(whole):
            row, at = parse(whole, at)
            if row:
                names.append(row["record_id"])
        assert names == [r.record_id for r in sorted((r for r in got.values() if r.archive == archive), key=lambda r: (r.frame, r.offset))]
    by_id = {f"urn:page:{p}": (h or "").encode() for p, _, h in rows if p not in (3,)}
    for r in got.values():
        if r.record_type == "response" and r.record_id in by_id:
            assert bytes(r.payload) == by_id[r.record_id]
    assert {(r.record_id, r.archive, r.frame, r.offset) for r in index.collect()} == {(r.record_id, *k) for k, r in got.items()}


def test_lookup_reads_the_named_records(spark, tmp_path):
    rows = [(i, f"http://h.example/{i}", f"page {i} " * 40) for i in range(200)]
    index = write_archives(page_records(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)), str(tmp_path / "b"), frame_bytes=5000)
    assert frames(index).count() > 20
    ids = spark.createDataFrame([("urn:page:7",), ("urn:page:150",), ("urn:page:150",), ("urn:page:999",), (None,)], "record_id string")
    found = {r.record_id: bytes(r.payload).decode() for r in lookup(index, ids).collect()}
    assert found == {"urn:page:7": "page 7 " * 40, "urn:page:150": "page 150 " * 40}


def test_damaged_payload_is_an_error(spark, tmp_path):
    from driftcheck.llm.warc import record

    row = {"record_id": "urn:page:1", "record_type": "response", "target_uri": None, "payload": b"abc", "payload_bytes": 3, "payload_digest": hashlib.sha256(b"abc").hexdigest(), "refers_to": None}
    raw = record(row)
    assert parse(raw, 0)[0]["payload"] == b"abc" and parse(raw, 0)[1] == len(raw)
    with pytest.raises(ValueError, match="digest"):
        parse(raw.replace(b"abc", b"abd"), 0)
    with pytest.raises(ValueError, match="no WARC record"):
        parse(raw, 2)


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    rows = [(i, None, "q" * 200 + str(i)) for i in range(20)]
    records = page_records(spark.createDataFrame(rows, "page_id long, url string, html string"))
    index = write_archives(records, str(tmp_path / "c"))
    write_archives(records, str(tmp_path / "c"))
    assert read_archives(index).count() == 20


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    out = op11_warc(spark, str(tmp_path))
    assert out.collect() == [] and len(RECORD) == 10
