"""The archive converter: round trips, both ARC versions, odd rows, and files from elsewhere."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections import defaultdict

import pytest

from marelake.llm import warc
from marelake.session import shared_dir

PAGES = "page_id long, url string, html string, kind string, record_id int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)


def by_hand(rows, min_bytes=0):
    """Per row what the contract says; of equal rows one is the response."""
    groups = defaultdict(list)
    for i, (page, _, html) in enumerate(rows):
        groups[(html or "").encode()].append((page is None, page, i))
    out = []
    for body, held in groups.items():
        held.sort(key=lambda x: (x[0], x[1] or 0))
        for n, (_, page, _) in enumerate(held):
            again = n > 0 and len(body) >= min_bytes
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
            out.append((page, len(body), digest, "revisit" if again else "response", held[0][1] if again else None))
    return sorted(out, key=repr)


ODD = [
    (7, "http://a/?q=x y\né", "<p>ü</p>"), (3, None, "<p>ü</p>"), (3, "http://b", "<p>ü</p>"), (9, "http://c", None), (2, "", ""),
    (None, None, "<p>ü</p>"), (11, "http://d", "HTTP/1.1 500 No\r\n\r\nWARC/1.1\r\n\r\n\n\nhttp://e 0.0.0.0 20200101000000 text/html 3\nabc"),
    (12, "http://f 1.2.3.4 20200101000000 text/html 5", "\0\r\n" * 9), (13, "http://g", "long " * 300_000), (14, "http://g", "long " * 300_000),
]


@pytest.mark.parametrize("archive_bytes", [1, 1 << 26])
@pytest.mark.parametrize("min_bytes", [0, 5])
def test_pages_come_back(spark, archive_bytes, min_bytes):
    got = warc.archive_pages(pages(spark, ODD).repartition(3), min_bytes, archive_bytes).collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(ODD, min_bytes)


def test_no_pages(spark):
    assert warc.archive_pages(pages(spark, [])).collect() == []


def test_many_copies_of_one_payload(spark):
    rows = [(i, f"http://x/{i}", "the same" if i % 3 else f"page {i}") for i in range(3000)]
    got = warc.archive_pages(pages(spark, rows).repartition(16)).collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(rows)


def test_files_are_archives(spark):
    arc = warc.write_arc(pages(spark, ODD).coalesce(1), shared_dir(spark, "t"), archive_bytes=1)
    out = warc.convert(spark, arc, shared_dir(spark, "t"), archive_bytes=1 << 20)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(arc).collect()]
    assert len(files) == len(ODD)
    versions = set()
    for data in files:
        assert data.endswith(warc.END_MARK)
        records = list(warc.arc_records(data))
        assert [r["filedesc"] for r in records] == [True, False] and not any(r["cut"] for r in records)
        assert sum(len(r["content"]) for r in records) < len(gzip.decompress(data))
        versions.add(records[1]["version"])
    assert versions == {1, 2}
    found = [r for f in spark.read.format("binaryFile").load(out).collect() for r in warc.warc_records(bytes(f.content))]
    assert {f["warc-type"] for f, _ in found} == {"warcinfo", "response", "revisit"}
    ids = [f["warc-record-id"] for f, _ in found]
    assert len(set(ids)) == len(ids)
    for fields, block in found:
        assert len(block) == int(fields["content-length"])
        if fields["warc-type"] == "revisit":
            assert fields["warc-refers-to"] in ids and fields["warc-profile"] == warc.REVISIT_PROFILE and block.endswith(b"\r\n\r\n")
            assert fields["warc-warcinfo-id"] in ids


def test_conversion_names_records_alike(spark):
    arc = warc.write_arc(pages(spark, ODD).coalesce(1), shared_dir(spark, "t"))
    twice = [
        sorted(r.record_id for r in warc.read_warc(spark, warc.convert(spark, arc, shared_dir(spark, "t"))).collect()) for _ in range(2)
    ]
    assert twice[0] == twice[1] and len(twice[0]) == len(ODD)


BLOCK_1 = f"1 0 InternetArchive\n{warc.ARC_FIELDS[1]}\n".encode()
OLD_1 = (
    b"filedesc://old.arc 0.0.0.0 19961231 text/plain %d\n%s" % (len(BLOCK_1), BLOCK_1)
    + b"\n\nhttp://x/a b c 10.0.0.1 199612312359 text/html; charset=x 22\nHTTP/1.0 200 OK\r\n\r\nabc"
    + b"\n\nthis line is no header\nftp://y/ 10.0.0.2 19961399000000 text/plain 4\nabcd"
    + b"\ndns:z 10.0.0.3 1997 text/dns 500\ncut off"
)
OLD_2 = (
    b"filedesc://two.arc 0.0.0.0 19970101000000 text/plain 200 - - 0 two.arc 9\n2 0 Other"
    + b"\nhttp://w/ 10.0.0.4 19970102030405 text/html 302 ABC http://new place/ 77 two.arc 25\nHTTP/1.0 302 Found\r\n\r\nabc"
    + b"\nhttp://v/ 10.0.0.4 19970102030405 text/html - - - - two.arc 22\nHTTP/1.0 200 OK\r\n\r\nxyz"
)


def test_old_archives_of_both_versions():
    records = list(warc.arc_records(OLD_1))
    assert [(r["url"], r["mime"], r["cut"]) for r in records[1:]] == [
        ("http://x/a b c", "text/html; charset=x", False), ("ftp://y/", "text/plain", False), ("dns:z", "text/dns", True)]
    kinds = list(warc.converted(OLD_1))
    assert [(r["kind"], r["warc_date"]) for r in kinds] == [
        ("warcinfo", "1996-12-31T00:00:00Z"), ("response", "1996-12-31T23:59:00Z"), ("resource", warc.NO_DATE), ("resource", "1997-01-01T00:00:00Z")]
    two = list(warc.converted(gzip.compress(OLD_2[:60]) + gzip.compress(OLD_2[60:])))
    assert [(r["version"], r["url"], r["content"][r["head"]:]) for r in two[1:]] == [(2, "http://w/", b"abc"), (2, "http://v/", b"xyz")]
    assert len({r["record_id"] for r in kinds + two}) == 7


def test_old_archives_convert(spark, tmp_path):
    (tmp_path / "a.arc").write_bytes(OLD_1)
    (tmp_path / "b.arc.gz").write_bytes(gzip.compress(OLD_2))
    (tmp_path / "c.arc").write_bytes(b"")
    out = warc.read_warc(spark, warc.convert(spark, str(tmp_path), shared_dir(spark, "t"))).collect()
    got = {r.uri: (r.kind, r.payload_bytes, r.payload_digest, r.page_id) for r in out}
    assert got["http://x/a b c"][:3] == got["http://w/"][:3] or {got["http://x/a b c"][0], got["http://w/"][0]} == {"response", "revisit"}
    assert got["http://w/"][1:3] == (3, warc.sha1(b"abc")) and got["dns:z"][:2] == ("resource", 7) and len(got) == 5
    assert all(v[3] is None for v in got.values())


@pytest.mark.parametrize("cuts", [[], [60], "records", "some"])
def test_archives_packed_in_any_way_give_the_same_records(cuts):
    """One member, members that cut records, a member per record, and records of which two share a member."""
    plain = list(warc.arc_records(OLD_1))
    if isinstance(cuts, str):
        cuts = [r["offset"] for r in plain][1 :: 1 if cuts == "records" else 2]
    places = [0, *cuts, len(OLD_1)]
    data = b"".join(gzip.compress(OLD_1[a:b]) for a, b in zip(places, places[1:], strict=False)) + warc.END_MARK
    got = list(warc.arc_records(data))
    drop = lambda r: {k: v for k, v in r.items() if k not in ("packed", "skip")}
    assert [drop(r) for r in got] == [drop(r) for r in plain]
    for r in got:
        if "packed" in r:
            assert gzip.decompress(r["packed"])[r["skip"] : r["skip"] + len(r["content"])] == r["content"]
    assert all(p is not None for *_, p in warc.members(data)) and [x[2] for x in warc.members(gzip.compress(b"x" * 200_000), most=1000)] == [None]
