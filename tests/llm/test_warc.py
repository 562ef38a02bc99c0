import base64
import hashlib
import random

import pytest

from adgrove.llm import warc
from adgrove.operators.scratch import Scratch


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def through(spark, rows, roll=4000, **options):
    scratch = Scratch(spark)
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, record_type string")
    arcs = warc.write_arc(pages, f"{scratch.folder}/arc", scratch, roll=roll)
    return warc.convert(spark, arcs, f"{scratch.folder}/warc", scratch, **options)


def test_pages_round_trip(spark):
    rng = random.Random(2)
    bodies = ["<p>é</p>", "", None, "x" * 100_000, "a\r\n\r\nb\nHTTP/1.1 200 OK\r\n\r\n", "filedesc://x 1 2 3 4\n", "<b>1</b>"]
    rows = [(i, rng.choice(("http://a/b c\n", "http://é/?q=1", None, "", "dns:x")), rng.choice(bodies), "x") for i in range(60)]
    rows += [(None, "http://n/", "<b>1</b>", "y"), (7, "http://r/", "same", "z"), (7, "http://r/", "same", "z")]
    files = through(spark, rows)
    assert files.count() > 2
    got = warc.read_warc(files)
    out = [tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    largest = {}
    for p, _, h, _ in rows:
        b = (h or "").encode()
        largest[b] = max(largest.get(b, -1), -1 if p is None else p)
    want = []
    for p, _, h, _ in rows:
        b = (h or "").encode()
        again = (-1 if p is None else p) < largest[b]
        want.append((p, len(b), b32(b), "revisit" if again else "response", largest[b] if again else None))
    assert sorted(out, key=str) == sorted(want, key=str)
    records = got.collect()
    ids = {r.record_id: r for r in records}
    assert len(ids) == len(records)
    for r in records:
        if r.record_type == "revisit":
            assert ids[r.refers_to_id].record_type == "response"
            assert ids[r.refers_to_id].payload_digest == r.payload_digest
        assert r.date == "2020-01-01T00:00:00Z" and " " not in r.uri


def test_short_payloads_are_written_whole(spark):
    got = warc.read_warc(through(spark, [(1, "http://a/", "ab", ""), (2, "http://a/", "ab", "")], revisit_from=3)).collect()
    assert [r.record_type for r in got] == ["response", "response"]


def test_no_pages(spark):
    assert warc.read_warc(through(spark, [])).collect() == []


def test_both_versions_and_malformed_records():
    for version in (1, 2):
        block = b"HTTP/1.0 404 no\r\nX: y\r\n\r\n\x00\xff binary"
        data = warc.arc_version_block("a.arc", version, "19990102030405")
        at = len(data)
        data += warc.arc_record(version, "a.arc", at, "http://x/", "199901020304", block)
        info, record = warc.parse_arc(data)
        assert info.version == version and record.offset == at and record.block == block
        (fields, _), = warc.parse_warc(warc.to_warc("a.arc", info, None))
        assert fields["warc-type"] == "warcinfo"
        (fields, body), = warc.parse_warc(warc.to_warc("a.arc", record, None))
        assert body == block and fields["warc-date"] == "1999-01-02T03:04:00Z" and fields["warc-type"] == "response"
        assert fields["warc-payload-digest"] == "sha1:" + b32(b"\x00\xff binary")
        assert fields["warc-record-id"] == warc.record_id("a.arc", at)
        with pytest.raises(ValueError):
            list(warc.parse_arc(data[:-5]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"http://x/ 1 2 text/html 3\nabc\n"))
    sloppy = warc.arc_version_block("a", 1, "19990102030405") + b"dns:x 0.0.0.0 19990102030405 text/dns; charset=x 3\nabc\n"
    record = list(warc.parse_arc(sloppy))[1]
    assert record.fields["Content-type"] == "text/dns; charset=x"
    (fields, body), = warc.parse_warc(warc.to_warc("a", record, None))
    assert fields["warc-type"] == "resource" and body == b"abc"


def test_gzip_members():
    parts = [b"", b"a" * 100_000, b"b"]
    assert warc.gunzip(b"".join(map(warc.gz, parts))) == b"".join(parts)
    with pytest.raises(ValueError):
        warc.gunzip(warc.gz(b"abc" * 999)[:-3])


def arc(version, blocks, date="19990102030405"):
    data = warc.arc_version_block("a.arc", version, date)
    for i, b in enumerate(blocks):
        data += warc.arc_record(version, "a.arc", len(data), f"http://x/{i}", date, b)
    return data


def test_fields_come_from_the_version_block():
    body = b"7 0 old crawler\nIP-address URL Archive-date Robots Content-type Archive-length\n"
    data = b"filedesc://a 0.0.0.0 19990102030405 text/plain %d\n" % len(body) + body + b"\n"
    data += b"1.2.3.4 http://x/ 19990102030405 yes text/html; a=b 3\nabc\n"
    info, record = warc.parse_arc(data)
    assert info.version == 7 and record.block == b"abc"
    assert record.fields == {"IP-address": "1.2.3.4", "URL": "http://x/", "Archive-date": "19990102030405", "Robots": "yes",
                             "Content-type": "text/html; a=b", "Archive-length": "3"}


@pytest.mark.parametrize("version", [1, 2])
def test_reading_goes_on_after_damage(version):
    blocks = [f"HTTP/1.1 200 OK\r\n\r\nbody {i} ".encode() * 5 for i in range(6)]
    data = arc(version, blocks)
    at = {r.fields["URL"]: r.offset for r in warc.parse_arc(data)}
    one, three = at["http://x/1"], at["http://x/3"]
    bad = data[:one] + data[one:].replace(b" 19990102030405 ", b" 1999 ", 1)
    bad = bad.replace(b"http://x/3 0.0.0.0 19990102030405 text/html", b"http://x/3")
    bad = bad[:-30]
    found = []
    urls = [r.fields["URL"] for r in warc.parse_arc(bad, found)]
    assert [u for u in urls if u.startswith("http")] == ["http://x/0", "http://x/2", "http://x/4"]
    assert len(found) == 3 and found[0].offset == one and found[0].reason == "no archive date"
    assert [bad[d.offset: d.offset + 10] for d in found] == [b"http://x/1", b"http://x/3", b"http://x/5"]
    assert found[-1].reason == "the record is cut off" and found[-1].offset + found[-1].size == len(bad)
    # Junk between records, and a length that is too short, cost no other record.
    junk = data[:three] + b"junk here\n\n" + data[three:]
    found = []
    assert len(list(warc.parse_arc(junk, found))) == 7 and [d.offset for d in found] == [three]
    for nothing in (b"", b"\n\n"):
        assert list(warc.parse_arc(nothing, [])) == []
    for none in (b"x", b"filedesc://a 0.0.0.0 19990102030405 text/plain x\n", b"http://x/ 1 19990102030405 t 3\nabc\n"):
        found = []
        assert list(warc.parse_arc(none, found)) == [] and found == [warc.Damage(0, len(none), "no version block")]


def test_damaged_gzip_members():
    members = [warc.gz(bytes([65 + i]) * 9000) for i in range(4)]
    broken = members[1][:20] + b"\xff\xff\xff" + members[1][23:]
    found = []
    data = warc.gunzip(members[0] + broken + members[2] + members[3][:-6], found)
    assert data == b"A" * 9000 + b"C" * 9000
    assert found[0].offset == len(members[0]) and found[-1].offset == sum(map(len, (members[0], broken, members[2])))


def test_damaged_archive_is_converted_and_reported(spark, tmp_path):
    blocks = [b"HTTP/1.1 200 OK\r\nX-Page-Id: %s\r\n\r\nsame" % k for k in (b"5", b"none", b"9", b"99999999999999999999")]
    data = arc(1, blocks).replace(b"http://x/0 0.0.0.0 19990102030405", b"http://x/0 0.0.0.0 never")
    (tmp_path / "bad.arc").write_bytes(data)
    (tmp_path / "empty.arc").write_bytes(b"")
    (tmp_path / "none.arc").write_bytes(b"what is this")
    scratch = Scratch(spark)
    arcs = spark.createDataFrame([(str(tmp_path / n),) for n in ("bad.arc", "empty.arc", "none.arc")], "path string")
    got = warc.read_warc(warc.convert(spark, arcs, f"{scratch.folder}/warc", scratch)).collect()
    assert sorted(((r.uri, r.page_id, r.record_type, r.refers_to) for r in got), key=str) == [
        ("http://x/1", None, "revisit", 9), ("http://x/2", 9, "response", None), ("http://x/3", None, "revisit", 9)
    ]
    listed = sorted((r.path.rsplit("/", 1)[-1], r.packed, r.reason) for r in warc.damages(arcs).collect())
    assert listed == [("bad.arc", False, "no archive date"), ("none.arc", False, "no version block")]
