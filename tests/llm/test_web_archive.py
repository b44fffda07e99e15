"""Web archives: round trips, ZIP64 directories, damaged packages."""

import base64
import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from orderloom.llm import web_archive as wa

PAGES = "page_id bigint, url string, html string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def read_back(spark, rows, **settings):
    frame = rows if not isinstance(rows, list) else spark.createDataFrame(rows, PAGES)
    return [tuple(r) for r in wa.read_records(wa.read_index(wa.write_archives(frame, **settings))).collect()]


def test_round_trip_with_revisits(spark):
    rows = [(i, f"https://example.org/{i}", f"<p>{i % 7} é\r\n\r\n</p>") for i in range(60)]
    found = read_back(spark, rows)
    assert len(found) == 60
    for page_id, url, kind, n_bytes, sha, refers_to, payload in found:
        html = rows[page_id][2].encode()
        last = max(i for i in range(60) if i % 7 == page_id % 7)
        assert (url, n_bytes, sha) == (rows[page_id][1], len(html), digest(html))
        assert (kind, refers_to) == (("response", None) if page_id == last else ("revisit", last))
        assert payload == (bytearray(html) if kind == "response" else None)


def test_odd_rows(spark, with_clashes):
    rows = [
        (None, None, None), (None, "u", "only null"), (3, "", ""), (5, "http://a b\r\nX: y%0A", "same"),
        (5, "http://other", "same"), (4, "http://other", "same"), (None, "n", "same"), (6, "z", "x" * 3_000_000),
    ]
    frame = with_clashes(spark.createDataFrame(rows, PAGES)).selectExpr("*", "1 AS payload", "'s' AS sha1", "2 AS package")
    found = read_back(spark, frame)
    assert sorted(((r[0], r[1], r[3], r[2], r[5]) for r in found), key=repr) == sorted(
        [
            (None, None, 0, "revisit", 3), (None, "u", 9, "response", None), (3, "", 0, "response", None),
            (5, "http://a b\r\nX: y%0A", 4, "response", None), (5, "http://other", 4, "response", None),
            (4, "http://other", 4, "revisit", 5), (None, "n", 4, "revisit", 5), (6, "z", 3_000_000, "response", None),
        ],
        key=repr,
    )


def test_small_payloads_are_no_revisits(spark):
    found = read_back(spark, [(1, "a", "ab"), (2, "b", "ab"), (3, "c", "abc"), (4, "d", "abc")], min_bytes=3)
    assert {(r[0], r[2], r[5]) for r in found} == {
        (1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None),
    }


def test_empty_table(spark):
    assert read_back(spark, []) == []


def test_a_few_records_by_the_index(spark):
    rows = [(i, f"https://example.org/{i}", f"page {i}") for i in range(30)]
    index = wa.read_index(wa.write_archives(spark.createDataFrame(rows, PAGES)))
    found = wa.read_records(index.where("url IN ('https://example.org/3', 'https://example.org/17')")).collect()
    assert {(r["page_id"], bytes(r["payload"])) for r in found} == {(3, b"page 3"), (17, b"page 17")}


def test_many_packages(spark, monkeypatch):
    monkeypatch.setattr(wa._Package, "full", property(lambda self: self.n_records >= 4))
    package, rows = None, []
    # The writer's own loop, in this process.
    import tempfile

    folder = tempfile.mkdtemp(prefix="packages-")
    for i in range(10):
        package = package or wa._Package(folder)
        data = f"page {i}".encode()
        package.add(f"u{i}", digest(data), False, wa.record(i, f"u{i}", data, digest(data), None, False))
        if package.full:
            rows.append(package.close())
            package = None
    rows.append(package.close())
    assert [r[1] for r in rows] == [4, 4, 2]
    frame = spark.createDataFrame(rows, wa.PACKAGES)
    assert sorted(r["page_id"] for r in wa.read_records(wa.read_index(frame)).collect()) == list(range(10))


def package_bytes(members, monkeypatch=None, limit=None, comment=b"", prefix=b""):
    out = io.BytesIO()
    if limit is not None:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", limit)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data, method in members:
            z.writestr(name, data, compress_type=method)
        z.comment = comment
    return prefix + out.getvalue()


def source_of(data):
    return pa.PythonFile(io.BytesIO(data), mode="r")


MEMBERS = [
    ("archive/data.warc.gz", b"0123456789" * 9, zipfile.ZIP_STORED),
    ("pages/pages.jsonl", b"{}" * 50, zipfile.ZIP_DEFLATED),
    ("indexes/index.cdxj", b"k 0 {}\n", zipfile.ZIP_STORED),
    ("folder/", b"", zipfile.ZIP_STORED),
]


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("comment", [b"", b"a PK\x05\x06 comment" * 30])
@pytest.mark.parametrize("prefix", [b"", b"#!/bin/sh\n" * 7])
def test_directories(monkeypatch, limit, comment, prefix):
    data = package_bytes(MEMBERS, monkeypatch, limit, comment, prefix)
    if limit == 0:
        assert wa.END64 in data and wa.LOCATOR64 in data
    found = wa.stored_members(source_of(data))
    assert [m.name for m in found] == ["archive/data.warc.gz", "indexes/index.cdxj"]
    assert [data[m.offset : m.offset + m.length] for m in found] == [MEMBERS[0][1], MEMBERS[2][1]]


def test_package_without_members():
    assert wa.stored_members(source_of(package_bytes([]))) == []


@pytest.mark.parametrize("damage", [lambda d: b"", lambda d: d[:-5], lambda d: d.replace(wa.CENTRAL, b"PK\x09\x09"), lambda d: b"not a package"])
def test_damaged_packages_fail(damage):
    with pytest.raises(ValueError):
        wa.stored_members(source_of(damage(package_bytes(MEMBERS))))


def test_damaged_records_fail():
    data = wa.record(1, "u", b"payload", digest(b"payload"), None, False)
    assert wa.parse_record(data)[-1] == wa.parse_record(wa._gzipped(data))[-1] == b"payload"
    with pytest.raises(ValueError):
        wa.parse_record(data.replace(b"payload\r\n", b"Payload\r\n"))
    with pytest.raises(ValueError):
        wa.parse_record(b"something else")


def test_index_beyond_the_archive_fails():
    line = '{"filename": "data.warc.gz", "offset": "80", "length": "99"}'
    data = package_bytes([MEMBERS[0], ("indexes/index.cdxj", f"u 0 {line}\n", zipfile.ZIP_STORED)])
    with pytest.raises(ValueError):
        list(wa.package_entries(source_of(data)))
