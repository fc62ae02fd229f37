import hashlib
import io
import zipfile
from collections import Counter, defaultdict

import pytest
from tables import SF_SMALL

from cartographer.llm import queries, warc_zip


def brute(rows):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        same = groups[html or ""]
        latest = max((p for p in same if p is not None), default=None)
        revisit = len(data) >= warc_zip.REVISIT_BYTES and len(same) > 1 and page != latest
        out[(page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", latest if revisit else None)] += 1
    return out


def as_counter(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def frame(spark, rows):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("clash") for c in ("digest", "size", "of", "latest", "path", "offset", "length", "n", "refers_to")}).repartition(3)


BIG, ACCENTS = "x" * 1500, "é" * 600
ROWS = [(1, "http://a", BIG), (2, None, BIG), (3, "http://b c\nd", BIG), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""),
        (8, "u", ACCENTS), (9, "u", ACCENTS), (9, "u", ACCENTS), (None, "u", BIG), (None, None, None), (None, "u", "y" * 2000), (None, "u", "y" * 2000),
        (10, "ü", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (11, "u", "z" * 3_000_000), (12, "u", "x" * 999), (13, "u", "x" * 999)]


def test_query(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    assert as_counter(queries.op9_warc_zip(spark, SF_SMALL)) == brute(pages)


@pytest.mark.parametrize("package", [1, 64 << 20])
def test_awkward_rows(spark, monkeypatch, package):
    monkeypatch.setattr(warc_zip, "PACKAGE_BYTES", package)
    records = warc_zip.archive_and_read(frame(spark, ROWS), payloads=True)
    assert as_counter(warc_zip.digest(records, "long")) == brute(ROWS)
    payloads = Counter(bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect())
    kept = {(p, h or "") for (p, _, h), k in zip(ROWS, [0] * len(ROWS), strict=True)}
    assert set(payloads) == {h for _, h in kept}


def test_empty_table(spark):
    assert warc_zip.archive_and_read(frame(spark, [])).count() == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_are_zip_files(zip64):
    out = io.BytesIO()
    writer = warc_zip.PackageWriter(out, zip64)
    members = {warc_zip.ARCHIVE: [b"one", b"two" * 1000], warc_zip.INDEX: [b""], "third": [b"x"]}
    places = []
    for name, parts in members.items():
        writer.begin(name)
        places += [(name, writer.write(p), p) for p in parts]
        writer.end()
    size = writer.close()
    with zipfile.ZipFile(io.BytesIO(out.getvalue())) as z:  # another reader agrees
        assert z.testzip() is None
        assert {n: z.read(n) for n in z.namelist()} == {n: b"".join(p) for n, p in members.items()}
    found = warc_zip.central_directory(out, size)
    for name, at, part in places:
        assert warc_zip.read_range(out, found[name][0] + at, len(part)) == part


def test_reads_other_writers_and_comments():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("stored", b"abc")
        z.writestr("packed", b"a" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = warc_zip.END_SIG + b" in a comment"
    found = warc_zip.central_directory(out, len(out.getvalue()))
    assert found.keys() == {"stored"}  # only stored members can be range-read
    assert warc_zip.read_range(out, found["stored"][0], 3) == b"abc"


def test_many_members_need_zip64():
    out = io.BytesIO()
    writer = warc_zip.PackageWriter(out)
    for i in range(70_000):
        writer.begin(str(i))
        writer.write(b"%d" % i)
        writer.end()
    found = warc_zip.central_directory(out, writer.close())
    assert len(found) == 70_000
    assert warc_zip.read_range(out, found["69999"][0], 5) == b"69999"


@pytest.mark.parametrize("data", [b"", b"not a zip", warc_zip.END_SIG * 9])
def test_broken_packages_raise(data):
    with pytest.raises((ValueError, IndexError)):
        warc_zip.central_directory(io.BytesIO(data), len(data))
