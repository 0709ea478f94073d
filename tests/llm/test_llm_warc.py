"""WARC archives: round trip, ZIP directories against the standard library, ZIP64, spread reads."""

import hashlib
import io
import zipfile

import brute
import pytest

from ledgerloom.llm import common, queries, warc

SCHEMA = "page_id long, url string, html string, digest string, payload string"
BIG = "<p>é\r\n\r\n" + "x" * 200


def rows():
    return [(1, "http://a\r\nX: y", BIG, "-", "-"), (2, None, BIG, "-", "-"), (3, "u", None, "-", "-"),
            (4, "u", "", "-", "-"), (5, "u", "short", "-", "-"), (6, "u", "short", "-", "-"),
            (None, "u", BIG, "-", "-"), (None, "u", "z" * 150, "-", "-"), (2, None, BIG, "-", "-"),
            (7, "u", "\U0001f600" * 50_000, "-", "-"), (0, "u", "y" * 100, "-", "-"),
            (8, "u", "y" * 100, "-", "-"), (1, "again", BIG, "-", "-")]


def expected():
    found = []
    first = {}
    for page, _, html, *_ in rows():
        raw = (html or "").encode()
        if page is not None:
            first[raw] = min(first.get(raw, page), page)
    for page, _, html, *_ in rows():
        raw = (html or "").encode()
        other = first.get(raw)
        again = len(raw) >= 100 and other is not None and page != other
        found.append((page, len(raw), hashlib.sha256(raw).hexdigest(),
                      "revisit" if again else "response", other if again else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("options", [{}, {"archive_records": 2}, {"archive_bytes": 300}])
def test_round_trip(spark, tmp_path, options):
    common.ship(spark)
    pages = spark.createDataFrame(rows(), SCHEMA).repartition(2)
    archives = warc.write_archives(pages, str(tmp_path / "w"), **options)
    got = warc.read_records(archives, range_bytes=400).collect()
    seen = []
    for r in got:
        if r.record_type == "response":
            assert r.payload_length == len(r.payload)
            assert r.payload_digest == hashlib.sha256(r.payload).hexdigest()
        seen.append((r.page_id, r.payload_length, r.payload_digest, r.record_type, r.refers_to))
    assert sorted(seen, key=repr) == expected()
    assert sum(a.records for a in archives.collect()) == len(rows())
    for archive in archives.collect():
        with zipfile.ZipFile(archive.path) as packed:
            assert packed.testzip() is None
            assert {i.compress_type for i in packed.infolist()} == {zipfile.ZIP_STORED}


def test_no_pages(spark, tmp_path):
    common.ship(spark)
    archives = warc.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert archives.count() == 0 and warc.read_records(archives).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_members(monkeypatch, wide):
    if wide:  # as if the archive were too large for the plain fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 40)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    raw = io.BytesIO()
    bodies = {f"folder/é{i}": bytes([65 + i]) * (30 + 50 * i) for i in range(5)}
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as packed:
        for name, body in bodies.items():
            packed.writestr(name, body)
        packed.writestr("squeezed", b"a" * 500, zipfile.ZIP_DEFLATED)
        packed.comment = b"a comment"
    data = raw.getvalue()
    assert (b"PK\x06\x06" in data) == wide
    found = warc.members(lambda at, n: data[at:at + n], len(data))
    assert {k: data[at:at + n] for k, (at, n) in found.items()} == bodies


def test_damaged_archives_raise():
    with pytest.raises(ValueError):
        warc.members(lambda at, n: b"x" * n, 100)


def test_op2_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op2_warc(spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for page in pages:
        r = got[page.page_id]
        assert r.payload_digest == brute.sha(page.html or "")
        assert r.payload_bytes == len((page.html or "").encode())
