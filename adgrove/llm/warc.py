"""Legacy ARC archives as WARC archives.

ARC files start with a version block that names the version (1 or 2) and with it the fields of each record's header
line; a record is that line and as many bytes as it declares. The converter writes one gzip member per WARC record,
with what ARC lacks made from what it has: record ids from source and offset, dates, types, block and payload digests,
and revisit records for equal payloads.

Damaged stretches (a header line that does not fit, a block or gzip member that is cut off) cost no more than themselves:
reading goes on at the next header line or member, and ``damages`` lists place, length and reason.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm.common import arrow_schema, map_arrow, table
from adgrove.llm.files import read_all, write_new
from adgrove.operators.scratch import Scratch
from adgrove.operators.skew import join_spread

#: Bytes of records after which a task starts a new file, so a file can be read as one piece.
ROLL = 16 << 20
#: Payloads of at least this many bytes are written once; equal ones become revisits.
REVISIT_FROM = 0
#: Header line in which a page's id travels inside the HTTP block.
KEY = "X-Page-Id"

# The fields of a record's header line by ARC version.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"),
}
LENGTH = "Archive-length"
NEEDED = ("URL", "IP-address", "Archive-date", "Content-type")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def gz(data: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damage(NamedTuple):
    """Bytes that are no record: where (in the gzip file for members, else in the unpacked data), how many, and why."""

    offset: int
    size: int
    reason: str


def _note(damages: list[Damage] | None, offset: int, size: int, reason: str) -> None:
    """Adds a damage to the list; without a list it is an error."""
    if damages is None:
        raise ValueError(f"{reason} at byte {offset}")
    damages.append(Damage(offset, size, reason))


def gunzip(data: bytes, damages: list[Damage] | None = None) -> bytes:
    """All members of a gzip file, or the bytes themselves where they are not compressed.

    With a list for ``damages`` members that can't be unpacked are noted and left out, else they raise.
    """
    if data[:2] != b"\x1f\x8b":
        return data
    view, at, parts = memoryview(data), 0, []
    while at < len(data) and data[at: at + 2] == b"\x1f\x8b":
        reader, start, held = zlib.decompressobj(31), at, []
        try:
            # Fed in short pieces: what a member leaves over of its last piece is copied.
            while not reader.eof:
                piece = view[at: at + 8192]
                if not piece:
                    raise zlib.error("cut off")
                held.append(reader.decompress(piece))
                at += len(piece)
            at -= len(reader.unused_data)
            parts += held
        except zlib.error:
            following = data.find(b"\x1f\x8b\x08", start + 1)
            at = len(data) if following < 0 else following
            _note(damages, start, at - start, "a gzip member is cut off or damaged")
    return b"".join(parts)


class ArcRecord(NamedTuple):
    offset: int
    version: int
    fields: dict[str, str]
    block: bytes


#: What a header line looks like in any version: address, host, date, other fields, length.
HEADER = re.compile(rb"\n(?=[A-Za-z][A-Za-z0-9+.\-]*:[^ \r\n]* [^ \r\n]+ (?:\d{14}|\d{12}) [^\r\n]* \d+\r?\n)")


def declared_fields(block: bytes, version: int) -> tuple[str, ...] | None:
    """Fields that a version block names in its second line, else those of its version; None for neither."""
    lines = block.decode("utf-8", "surrogateescape").splitlines()
    named = tuple(lines[1].split()) if len(lines) > 1 else ()
    if named[-1:] == (LENGTH,) and len(set(named)) == len(named) and set(NEEDED) <= set(named):
        return named
    return FIELDS.get(version)


def header_fields(line: str, names: tuple[str, ...]) -> dict[str, str] | str:
    """Fields of a header line by name, or what is wrong with it."""
    parts = line.split(" ")
    # A content type may hold spaces in sloppy files: what is too much belongs to it.
    extra = len(parts) - len(names)
    if extra < 0:
        return f"{len(parts)} fields where {len(names)} are declared"
    kind = names.index("Content-type")
    parts[kind: kind + extra + 1] = [" ".join(parts[kind: kind + extra + 1])]
    fields = dict(zip(names, parts))
    if not re.fullmatch(r"[0-9]{1,18}", fields[LENGTH]):
        return "no length"
    return fields if re.fullmatch(r"[0-9]{12}|[0-9]{14}", fields["Archive-date"]) else "no archive date"


def parse_arc(data: bytes, damages: list[Damage] | None = None) -> Iterator[ArcRecord]:
    """Records of an uncompressed ARC file, the version block first.

    A malformed line, a short block or a missing version block raises; with a list for ``damages`` it is noted there, and
    reading goes on at the next line that looks like a header. Without a version block nothing can be read.
    """
    at, version, names = 0, None, ()
    while at < len(data):
        stop = data.find(b"\n", at)
        if stop < 0:
            stop = len(data)
        line = data[at:stop].rstrip(b"\r").decode("utf-8", "surrogateescape")
        if not line:
            at = stop + 1
            continue
        parts = line.split(" ")
        if version is None:
            size = parts[-1]
            block = data[stop + 1: stop + 1 + int(size)] if re.fullmatch(r"[0-9]{1,18}", size) else b""
            first = re.match(rb"[0-9]{1,9}(?=[ \r\n])", block)
            names = declared_fields(block, int(first[0])) if first and line.startswith("filedesc://") else None
            if names is None:
                _note(damages, at, len(data) - at, "no version block")
                return
            version = int(first[0])
            # The block's own line has the fields of version 1 in many files of later versions.
            fields = header_fields(line, FIELDS[1] if len(parts) == len(FIELDS[1]) else names)
        else:
            fields = header_fields(line, names)
        reason = fields if isinstance(fields, str) else None
        if reason is None:
            size = int(fields[LENGTH])
            block = data[stop + 1: stop + 1 + size]
            reason = "the record is cut off" if len(block) != size else None
        if reason is None:
            yield ArcRecord(at, version, fields, block)
            at = stop + 1 + size
        else:
            following = HEADER.search(data, min(stop, len(data)))
            resume = following.end() if following else len(data)
            _note(damages, at, resume - at, reason)
            at = resume


def arc_version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 adgrove\n{' '.join(FIELDS[version])}\n".encode()
    line = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    if version == 2:
        line += ["200", "-", "-", "0", name]
    return f"{' '.join(line)} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, name: str, offset: int, url: str, date: str, block: bytes) -> bytes:
    line = [url, "0.0.0.0", date, "text/html"]
    if version == 2:
        line += ["200", sha1(block), "-", str(offset), name]
    return f"{' '.join(line)} {len(block)}\n".encode() + block + b"\n"


def iso_date(date: str) -> str:
    """WARC date of an ARC date; the 12-digit form has no seconds."""
    d = date.ljust(14, "0")
    if not re.fullmatch(r"\d{14}", d):
        raise ValueError(f"{date} is no archive date")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def record_id(source: str, offset: int) -> str:
    """Stable id of the record at a place of a source."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{offset}')}>"


def http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """Head (with its blank line) and payload of an HTTP response block."""
    if not block.startswith(b"HTTP/"):
        return None
    m = re.search(rb"\r?\n\r?\n", block)
    return (block[: m.end()], block[m.end():]) if m else (block, b"")


def head_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?mi)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "surrogateescape") if m else None


def page_key(head: bytes) -> int | None:
    """The page id in an HTTP head; None where there is none or it is no 64-bit integer."""
    text = head_field(head, KEY) or ""
    key = int(text) if re.fullmatch(r"-?[0-9]{1,19}", text) else None
    return key if key is not None and -(1 << 63) <= key < 1 << 63 else None


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of every record of an uncompressed WARC file."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "surrogateescape").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        size = int(fields["content-length"])
        block = data[stop + 4: stop + 4 + size]
        if len(block) != size or data[stop + 4 + size: stop + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut off")
        yield fields, block
        at = stop + 8 + size


def to_warc(source: str, record: ArcRecord, revisit: tuple[str, str, str, int | None] | None) -> bytes:
    """WARC record of an ARC record. ``revisit``: id, URL, date and key of the record with the same payload."""
    f, parts = record.fields, http_parts(record.block)
    fields = [("WARC-Record-ID", record_id(source, record.offset)), ("WARC-Date", iso_date(f["Archive-date"]))]
    if f["URL"].startswith("filedesc://"):
        info = f"software: adgrove\r\nformat: WARC File Format 1.1\r\narc-version: {record.version}\r\n".encode()
        return warc_record(
            [("WARC-Type", "warcinfo"), *fields, ("WARC-Filename", source.rsplit("/", 1)[-1]),
             ("Content-Type", "application/warc-fields")], info,
        )
    if f["IP-address"] not in ("0.0.0.0", "-"):
        fields.append(("WARC-IP-Address", f["IP-address"]))
    fields.append(("WARC-Target-URI", f["URL"]))
    block = record.block
    if parts is None:
        kind, payload, mime = "resource", block, f["Content-type"]
    else:
        kind, payload, mime = "response", parts[1], "application/http;msgtype=response"
    fields.append(("WARC-Payload-Digest", f"sha1:{sha1(payload)}"))
    if revisit is not None:
        kind, block = "revisit", parts[0] if parts else b""
        first, url, date, key = revisit
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", first), ("WARC-Refers-To-Target-URI", url),
                   ("WARC-Refers-To-Date", date), ("WARC-Truncated", "length"),
                   ("X-Payload-Length", str(len(payload)))]
        if key is not None:
            fields.append(("X-Refers-To-Key", str(key)))
    fields += [("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Type", mime)]
    return warc_record([("WARC-Type", kind), *fields], block)


def write_arc(
    pages: DataFrame, folder: str, scratch: Scratch, date: str = "20200101000000", roll: int = ROLL
) -> DataFrame:
    """ARC files of (page_id, url, html) rows, one response each; rows (path, records) of the files written.

    NULL html is an empty payload, a NULL or empty url is ``about:blank``; bytes that would break a header line are
    percent-encoded. Files of both versions are written in turn.
    """
    schema = arrow_schema("path string, records bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        held = records = files = 0
        version, name = 1, "pages.arc"

        def flush() -> pa.RecordBatch:
            path = write_new(folder, f"pages-v{version}", ".arc.gz", b"".join(parts))
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records])], schema=schema)

        for batch in batches:
            for key, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if not parts:
                    version = 1 + files % 2
                    raw = arc_version_block(name, version, date)
                    parts.append(gz(raw))
                    held = len(raw)
                body = (html or "").encode("utf-8", "surrogatepass")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(body)}\r\n"
                head += "" if key is None else f"{KEY}: {key}\r\n"
                target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "about:blank"
                raw = arc_record(version, name, held, target, date, head.encode() + b"\r\n" + body)
                parts.append(gz(raw))
                held, records = held + len(raw), records + 1
                if held >= roll:
                    yield flush()
                    parts, held, records, files = [], 0, 0, files + 1
        if parts:
            yield flush()

    return scratch.cut(pages.select("page_id", "url", "html").mapInArrow(run, "path string, records bigint"))[0]


INDEX = ("path string, offset bigint, record_id string, uri string, date string, key bigint, payload_bytes bigint, "
         "digest string")


def _index() -> object:
    schema = arrow_schema(INDEX)

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path in batch.column("path").to_pylist():
            rows = []
            for r in parse_arc(gunzip(read_all(path), []), []):
                if r.fields["URL"].startswith("filedesc://"):
                    continue
                head, payload = http_parts(r.block) or (b"", r.block)
                rows.append((path, r.offset, record_id(path, r.offset), r.fields["URL"], iso_date(r.fields["Archive-date"]),
                             page_key(head), len(payload), sha1(payload)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema
            )

    return step


def convert(spark: SparkSession, arcs: DataFrame, folder: str, scratch: Scratch, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """WARC files of the ARC files in ``arcs`` (column path); rows (path, records) of the files written.

    Of equal payloads of at least ``revisit_from`` bytes the record with the largest key (an integer in the HTTP
    header ``X-Page-Id``; records without one come before all others) is written whole, of equal keys each; the
    others become revisits of it. Damaged stretches are left out, ``damages`` lists them. Payloads stay in their files: only index rows are shuffled, a file is converted
    by one task, and files are bounded by the roll size of their writer.
    """
    files = max(1, arcs.count())
    index, seen = scratch.cut(
        map_arrow(arcs.select("path").repartition(files, "path"), _index, INDEX), rows=F.count(F.lit(1))
    )
    number = F.col("key")
    place = F.struct(
        number.isNotNull().alias("known"), number.alias("number"), "path", "offset", "record_id", "uri", "date", "key"
    )
    shared = (
        index.where(F.col("payload_bytes") >= revisit_from)
        .groupBy("digest", "payload_bytes").agg(F.max(place).alias("whole"), F.count(F.lit(1)).alias("weight"))
        .where("weight > 1")
    )
    again = (
        join_spread(index, shared, ["digest", "payload_bytes"], "weight", seen["rows"] or 1)
        .where((F.col("path") != F.col("whole.path")) | (F.col("offset") != F.col("whole.offset")))
        .where(number.isNull() | (number < F.col("whole.number")))
        .select("path", "offset", F.col("whole.record_id").alias("first"), F.col("whole.uri").alias("first_uri"),
                F.col("whole.date").alias("first_date"), F.col("whole.key").alias("first_key"))
    )
    of_file = again.groupBy("path").agg(
        F.collect_list(F.struct("offset", "first", "first_uri", "first_date", "first_key")).alias("revisits")
    )
    work = arcs.select("path").join(of_file, "path", "left").repartition(files, "path").select("path", "revisits")
    return scratch.cut(map_arrow(work, _rewriter(folder), "path string, records bigint"))[0]


def _rewriter(folder: str):
    def make():
        schema = arrow_schema("path string, records bigint")

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, revisits in zip(*(c.to_pylist() for c in batch.columns)):
                known = {o: rest for o, *rest in (r.values() for r in revisits or [])}
                parts = [gz(to_warc(path, r, known.get(r.offset))) for r in parse_arc(gunzip(read_all(path), []), [])]
                made = write_new(folder, "converted", ".warc.gz", b"".join(parts))
                yield pa.RecordBatch.from_arrays([pa.array([made]), pa.array([max(0, len(parts) - 1)])], schema=schema)

        return step

    return make


DAMAGES = "path string, packed boolean, offset bigint, size bigint, reason string"


def _damages() -> object:
    schema = arrow_schema(DAMAGES)

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path in batch.column("path").to_pylist():
            members: list[Damage] = []
            lines: list[Damage] = []
            for _ in parse_arc(gunzip(read_all(path), members), lines):
                pass
            rows = [(path, True, *d) for d in members] + [(path, False, *d) for d in lines]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return step


def damages(arcs: DataFrame) -> DataFrame:
    """What ``convert`` leaves out of the ARC files in ``arcs`` (column path): place, length and reason of each stretch.

    ``packed`` tells a gzip member (place in the file) from a stretch of the unpacked data. Files without damage have no rows.
    """
    return map_arrow(arcs.select("path").repartition(max(1, arcs.count()), "path"), _damages, DAMAGES)


RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
           "record_id string, refers_to_id string, uri string, date string")


def _records() -> object:
    schema = arrow_schema(RECORDS)

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path in batch.column("path").to_pylist():
            rows = []
            for f, block in parse_warc(gunzip(read_all(path))):
                if f["warc-type"] == "warcinfo":
                    continue
                digest = f["warc-payload-digest"].removeprefix("sha1:")
                head, payload = http_parts(block) or (b"", block)
                if f["warc-type"] == "revisit":
                    size = int(f["x-payload-length"])
                else:
                    size = len(payload)
                    if sha1(payload) != digest:
                        raise ValueError(f"{path}: {f['warc-record-id']} does not match its digest")
                first = f.get("x-refers-to-key")
                rows.append((page_key(head), size, digest, f["warc-type"],
                             None if first is None else int(first), f["warc-record-id"], f.get("warc-refers-to"),
                             f["warc-target-uri"], f["warc-date"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema
            )

    return step


def read_warc(files: DataFrame) -> DataFrame:
    """Records of the WARC files in ``files`` (column path), without their payloads; digests are checked."""
    return map_arrow(files.select("path").repartition(max(1, files.count()), "path"), _records, RECORDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an ARC file into a WARC file, read back."""
    scratch = Scratch(spark)
    arcs = write_arc(table(spark, sf_dir, "pages"), f"{scratch.folder}/arc", scratch)
    warcs = convert(spark, arcs, f"{scratch.folder}/warc", scratch)
    return read_warc(warcs).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, cast(strlen(body) as bigint) as payload_bytes, sha1(body) as h from p),
g as (select *, max(page_id) over (partition by h, payload_bytes) as whole from d)
select page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((cast('0x' || substr(h, 5 * (i // 4) + 1, 5) as integer) >> cast(15 - 5 * (i % 4) as integer)) & 31) + 1, 1)
    for i in range(32)], '') as payload_digest,
  case when page_id < whole then 'revisit' else 'response' end as record_type,
  case when page_id < whole then whole end as refers_to
from g
"""
