"""Web archives: legacy ARC files are converted to WARC files, with revisits for repeated payloads, and read back.

*ARC.*  A file opens with a version block (``filedesc://``), whose first line names the version; the version fixes the
fields of every later header line: five in version 1, ten in version 2.  A header line ends in the declared length of
what follows, and only that length says where a record ends.  Addresses may hold spaces, so a line is matched from its
right end by the pattern of its version.

*Conversion.*  A WARC record needs what ARC never stored, and gets it from what is there: its identifier is a version 5
UUID of (archive name, offset, address, time), so that a repeated conversion names records alike; its date is the ARC
time stamp, completed to the second; its type follows the content (version block: warcinfo, HTTP response: response,
anything else: resource); payload and block digests are SHA-1 of the bytes.  Of responses with equal payloads (digest and
length) of at least ``min_bytes`` the one with the smallest page id is the response and the others become revisits,
which hold the HTTP header alone.  Records of unequal digests share no task: the rows that decide are narrow, and
the contents, still packed as they lay in the archive, are dealt by record identifier, which no other row has.

*Files.*  A task packs its records into archives of about ``archive_bytes``, one gzip member per record, and hands each
archive as one row to Spark's text sink, one row per file: Spark's commit protocol decides which files exist, so a
lost executor leaves none behind that is read.  The sink ends each file with a separator, which is here an empty gzip
member, the end mark of blocked gzip files.  Archives are read by Spark's ``binaryFile`` source, one record at a time.

Defined results: null html is the empty payload; a null url is written as ``urn:page:`` and the id; characters that a
header line can't hold are percent-encoded in the address; a page without id has none in the result, follows all others
in the order and may be a response; of rows with equal id and payload, the one with the smallest record identifier
counts as first; a page longer than an archive has an archive of its own; an empty table gives archives without records;
other columns are not read.  A record that its file cuts off is converted with the bytes that are there and marked
``WARC-Truncated``; lines that no header pattern fits are passed over until one does.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import io
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marelake.session import shared_dir

from .common import arrow_schema, store

# The header fields of both ARC versions, the time pages without one were fetched, WARC names.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_LINES = {
    1: re.compile(rb"(?P<url>.*) (?P<ip>\S+) (?P<date>\d{4,14}) (?P<mime>.*) (?P<length>\d+)"),
    2: re.compile(rb"(?P<url>.*) (?P<ip>\S+) (?P<date>\d{4,14}) (?P<mime>.*) (?P<code>\d+|-) (?P<checksum>\S+) (?P<location>.*) (?P<offset>\d+|-) (?P<file>\S+) (?P<length>\d+)"),
}
FETCHED = "20240101000000"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"

#: identifiers of converted records are UUIDs below this one
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:marelake:arc-to-warc")
END_MARK = gzip.compress(b"", mtime=0)
INDEX = "record_id string, kind string, uri string, date string, page_id long, payload_digest string, payload_bytes long"
CONTENT = "record_id string, kind string, uri string, ip string, date string, mime string, info_id string, cut boolean, skip int, size int, packed binary"
RECORDS = "record_id string, kind string, uri string, date string, page_id long, payload_digest string, payload_bytes long, refers_to_id string"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# files of gzip members


def member(record: bytes) -> bytes:
    """One gzip member; without a name or a time, so that equal records give equal bytes."""
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class _Archives:
    """Cuts a run of records into archives of bounded size; ``head(number)`` opens each."""

    def __init__(self, head: Callable[[int], bytes], archive_bytes: int):
        self.head, self.most, self.number = head, archive_bytes, 0
        self.parts: list[bytes] = []
        self.offset = self.packed = 0

    def room_for(self, more: int) -> Iterator[pa.RecordBatch]:
        """The archive so far, if it is full; afterwards an archive is open."""
        if self.parts and self.packed + more // 4 > self.most:
            yield from self.close()
        if not self.parts:
            self.offset = self.packed = 0
            self.add(self.head(self.number))

    def add(self, record: bytes) -> None:
        self.parts.append(member(record))
        self.packed += len(self.parts[-1])
        self.offset += len(record)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            data, self.parts, self.number = b"".join(self.parts), [], self.number + 1
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["archive"])


def _task() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def write_files(df: DataFrame, pack: Callable, path: str) -> str:
    """Archives that ``pack`` makes of the batches of ``df``, one file each."""
    rows = df.mapInArrow(pack, "archive binary").select(F.col("archive").cast("string").alias("value"))
    sink = rows.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", END_MARK.decode("latin-1"))
    sink.text(path)
    return path


def read_files(spark: SparkSession, path: str, rows: Callable[[bytes], Iterator[tuple]], schema: str, batch_bytes: int = 1 << 22) -> DataFrame:
    """The tuples that ``rows`` makes of each archive, in batches of about ``batch_bytes`` of their binary fields."""
    target = arrow_schema(T._parse_datatype_string(schema))

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held, strict=True), target, strict=True)], schema=target)

    def run(batches):
        for b in batches:
            for content in b.column("content"):
                held, size = [], 0
                for row in rows(content.as_py()):
                    held.append(row)
                    size += 200 + sum(len(x) for x in row if isinstance(x, bytes))
                    if size >= batch_bytes:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def opened(data: bytes) -> io.BufferedReader:
    """An archive's bytes, gzip or plain, as one stream."""
    raw = io.BytesIO(data)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if data[:2] == b"\x1f\x8b" else io.BufferedReader(raw)


# legacy archives


def header_address(url: str | None, page_id: int | None) -> str:
    if url is None:
        return f"urn:page:{'' if page_id is None else page_id}"
    return urllib.parse.quote(url, safe="%:/?#[]@!$&'()*+,;=-._~|{}^`\"<>\\")


def version_block(name: str, version: int) -> bytes:
    """The record that opens an ARC file."""
    body = f"{version} 0 marelake\n{ARC_FIELDS[version]}\n\n"
    more = f"text/plain 200 - - 0 {name} {len(body)}" if version == 2 else f"text/plain {len(body)}"
    return f"filedesc://{name} 0.0.0.0 {FETCHED} {more}\n{body}".encode()


def arc_record(version: int, url: str, name: str, offset: int, content: bytes) -> bytes:
    """A record with the header line of its version, led by the line break that parts records."""
    more = f"text/html 200 - - {offset} {name} {len(content)}" if version == 2 else f"text/html {len(content)}"
    return f"\n{url} 0.0.0.0 {FETCHED} {more}\n".encode() + content


def http_response(page_id: int | None, html: str | None) -> bytes:
    body = (html or "").encode()
    known = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n{known}\r\n".encode() + body


def write_arc(pages: DataFrame, path: str, archive_bytes: int = 1 << 26) -> str:
    """``pages`` as ARC files below ``path``; archives of a task are of version 1 and 2 in turn."""

    def pack(batches):
        name = f"pages-{_task():06d}-%d.arc"
        files = _Archives(lambda n: version_block(name % n, n % 2 + 1), archive_bytes)
        for b in batches:
            for page_id, url, html in zip(*(b.column(c) for c in ("page_id", "url", "html")), strict=True):
                content = http_response(key := page_id.as_py(), html.as_py())
                yield from files.room_for(len(content))
                n = files.number
                files.add(arc_record(n % 2 + 1, header_address(url.as_py(), key), name % n, files.offset, content))
        yield from files.close()

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return write_files(narrow, pack, path)


def members(data: bytes, begin: int = 0, most: int = 1 << 26) -> Iterator[tuple[int, int, bytes | None]]:
    """(begin, end, content) of each gzip member; the last has no content if it unpacks to more than ``most`` bytes."""
    view = memoryview(data)
    while begin < len(data):
        unpack, at, parts, size = zlib.decompressobj(31), begin, [], 0
        while not unpack.eof and at < len(data):
            parts.append(unpack.decompress(view[at : at + (1 << 16)]))
            size += len(parts[-1])
            at += 1 << 16
            if size > most:
                yield begin, len(data), None
                return
        end = min(at, len(data)) - len(unpack.unused_data)
        yield begin, end, b"".join(parts)
        begin = end


def arc_records(data: bytes) -> Iterator[dict]:
    """The records of one ARC file: header fields, offset, content, and whether the file ends inside it.

    Where a gzip member holds one record, the record has it as ``packed``, with ``skip`` bytes before the content.
    Files that are plain, or packed otherwise, are read as one stream.
    """
    state = {"at": 0, "version": 1, "archive": ""}
    if data[:2] != b"\x1f\x8b":
        yield from _arc_stream(io.BufferedReader(io.BytesIO(data)), state)
        return
    for begin, end, plain in members(data):
        before = dict(state)
        found = [] if plain is None else list(_arc_stream(io.BytesIO(plain), state))
        after = plain and plain[found[0]["skip"] - before["at"] + len(found[0]["content"]) if found else 0 :]
        if plain is None or len(found) > 1 or any(r["cut"] for r in found) or after.strip():
            yield from _arc_stream(opened(data[begin:]), before)
            return
        state["at"] = before["at"] + len(plain)
        for r in found:
            yield r | {"packed": data[begin:end], "skip": r["skip"] - before["at"]}


def _arc_stream(stream, state: dict) -> Iterator[dict]:
    """Records of a stream; ``state`` carries offset, version and name of the archive over its parts."""
    while line := stream.readline():
        here = state["at"]
        state["at"] += len(line)
        head = line.rstrip(b"\r\n")
        opens = head.startswith(b"filedesc://")
        found = (ARC_LINES[2].fullmatch(head) or ARC_LINES[1].fullmatch(head)) if opens else ARC_LINES[state["version"]].fullmatch(head)
        if found is None:
            continue
        length, skip = int(found["length"]), state["at"]
        content = stream.read(length)
        state["at"] += len(content)
        if opens:
            first = content.split(b"\n", 1)[0].split()
            state["version"] = int(first[0]) if first and first[0] in (b"1", b"2") else 1
            state["archive"] = found["url"][len(b"filedesc://"):].decode("utf-8", "replace")
        yield {
            "archive": state["archive"], "offset": here, "filedesc": opens, "version": state["version"], "content": content, "cut": len(content) < length,
            "skip": skip, **{k: found[k].decode("utf-8", "replace") for k in ("url", "ip", "date", "mime")},
        }


# conversion


def warc_date(stamp: str) -> str:
    """An ARC time stamp as a WARC date; a shorter stamp counts from the start of what it names."""
    full = stamp + "00000101000000"[len(stamp):]
    try:
        return dt.datetime.strptime(full, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return NO_DATE


def record_id(archive: str, offset: int, url: str, stamp: str) -> str:
    return f"urn:uuid:{uuid.uuid5(NAMESPACE, f'{archive} {offset} {url} {stamp}')}"


def head_length(content: bytes) -> int:
    """Bytes of an HTTP response before its body; 0 if it is none."""
    if not content.startswith(b"HTTP/"):
        return 0
    at = content.find(b"\r\n\r\n")
    return len(content) if at < 0 else at + 4


def page_of(head: bytes) -> int | None:
    found = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
    return int(found[1]) if found else None


def converted(data: bytes) -> Iterator[dict]:
    """What the WARC record of each ARC record will say, before revisits are known."""
    info = ""
    for r in arc_records(data):
        key = record_id(r["archive"], r["offset"], r["url"], r["date"])
        if r["filedesc"]:
            info, kind, head = key, "warcinfo", 0
        else:
            head = head_length(r["content"])
            kind = "response" if head else "resource"
        yield r | {"record_id": key, "kind": kind, "info_id": info, "head": head, "warc_date": warc_date(r["date"])}


def _index_rows(data: bytes) -> Iterator[tuple]:
    for r in converted(data):
        if r["kind"] == "response":
            payload = r["content"][r["head"]:]
            yield r["record_id"], r["kind"], r["url"], r["warc_date"], page_of(r["content"][: r["head"]]), sha1(payload), len(payload)


def _content_rows(data: bytes) -> Iterator[tuple]:
    for r in converted(data):
        content, packed, skip = r["content"], r.get("packed"), r["skip"]
        if r["kind"] == "warcinfo":
            content, packed = f"software: marelake\r\nformat: WARC File Format 1.1\r\nisPartOf: {r['archive']}\r\ndescription: ARC version {r['version']}\r\n".encode(), None
        if packed is None:
            packed, skip = member(content), 0
        yield r["record_id"], r["kind"], r["url"], r["ip"], r["warc_date"], r["mime"], r["info_id"], r["cut"], skip, len(content), packed


def revisits(index: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(record_id, to_id, to_uri, to_date) of responses whose payload an earlier one holds."""
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "uri", "date")).alias("first")
    held = index.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes").agg(first, F.count(F.lit(1)).alias("n"))
    repeated = held.where("n > 1").select("payload_digest", "payload_bytes", *[F.col(f"first.{c}").alias(f"to_{c}") for c in ("record_id", "uri", "date")])
    later = index.select("record_id", "payload_digest", "payload_bytes").join(repeated, ["payload_digest", "payload_bytes"])
    return later.where("record_id <> to_record_id").select("record_id", F.col("to_record_id").alias("to_id"), "to_uri", "to_date")


def warc_record(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields.items() if v]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _as_warc(row: dict, to: dict | None) -> bytes:
    content = zlib.decompress(row["packed"], 31)[row["skip"] : row["skip"] + row["size"]]
    kind = "revisit" if to else row["kind"]
    head = head_length(content) if kind in ("response", "revisit") else 0
    block = content[:head] if to else content
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<{row['record_id']}>", "WARC-Date": row["date"]}
    if kind == "warcinfo":
        return warc_record(fields | {"Content-Type": "application/warc-fields"}, block)
    fields |= {
        "WARC-Target-URI": row["uri"], "WARC-IP-Address": None if row["ip"] == "0.0.0.0" else row["ip"],
        "WARC-Warcinfo-ID": f"<{row['info_id']}>" if row["info_id"] else None, "WARC-Payload-Digest": f"sha1:{sha1(content[head:])}",
        "WARC-Block-Digest": f"sha1:{sha1(block)}", "WARC-Truncated": "unspecified" if row["cut"] else None,
        "Content-Type": "application/http; msgtype=response" if head else row["mime"],
    }
    if to:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<{to['to_id']}>", "WARC-Refers-To-Target-URI": to["to_uri"], "WARC-Refers-To-Date": to["to_date"]}
    return warc_record(fields, block)


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0, archive_bytes: int = 1 << 26) -> str:
    """WARC files below ``warc_path`` of the ARC files below ``arc_path``.

    The archives are read twice: once for the narrow index that decides on revisits, once for their contents.
    """
    index = store(read_files(spark, arc_path, _index_rows, INDEX), "arc_index")
    # every record identifier is there once, so neither side has a hot key
    later = revisits(index, min_bytes).hint("shuffle_hash")
    rows = read_files(spark, arc_path, _content_rows, CONTENT).join(later, "record_id", "left")

    def pack(batches):
        task = _task()

        def head(n):
            name = f"converted-{task:06d}-{n}.warc"
            own = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<{record_id(name, 0, '', '')}>", "WARC-Date": warc_date(FETCHED), "WARC-Filename": name, "Content-Type": "application/warc-fields"}
            return warc_record(own, b"software: marelake\r\nformat: WARC File Format 1.1\r\n")

        files = _Archives(head, archive_bytes)
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in b.schema.names}
                record = _as_warc(row, row if row["to_id"] else None)
                yield from files.room_for(len(record))
                files.add(record)
        yield from files.close()

    return write_files(rows, pack, warc_path)


# reading back


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of one WARC file."""
    stream = opened(data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip().lower()] = v.strip()
        yield fields, stream.read(int(fields.get("content-length", 0)))


def _record_rows(data: bytes) -> Iterator[tuple]:
    for fields, block in warc_records(data):
        kind = fields["warc-type"]
        if kind not in ("response", "revisit", "resource"):
            continue
        head = 0 if kind == "resource" else head_length(block)
        payload = block[head:]
        said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind != "revisit" and said != sha1(payload):
            raise ValueError(f"{fields['warc-record-id']}: its payload has another digest than its header says")
        yield (
            fields["warc-record-id"].strip("<>"), kind, fields.get("warc-target-uri"), fields["warc-date"], page_of(block[:head]), said,
            None if kind == "revisit" else len(payload), fields.get("warc-refers-to", "").strip("<>") or None,
        )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response, revisit and resource; payload bytes of a revisit and the page it refers to come from the
    record it names.  A payload that does not fit its digest is an error.
    """
    found = store(read_files(spark, path, _record_rows, RECORDS), "warc_records")
    named = found.where("kind = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full"))
    others = found.where("kind <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    again = found.where("kind = 'revisit'").join(named, "refers_to_id", "left").withColumn("payload_bytes", F.col("full"))
    return others.unionByName(again.select(others.columns))


def archive_pages(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = 1 << 26) -> DataFrame:
    """``pages`` written as ARC, converted to WARC and read back: page, payload digest and bytes, type, page referred to."""
    spark = pages.sparkSession
    arc = write_arc(pages, shared_dir(spark, "arc"), archive_bytes)
    warc = convert(spark, arc, shared_dir(spark, "warc"), min_bytes, archive_bytes)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")
