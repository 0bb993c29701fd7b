"""WARC archives: round trips, segments and broken records."""

import base64
import gzip
import hashlib
import random

import pytest

from tripflow.llm import warc


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def write(spark, tmp_dir, rows, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    warc.write_archive(spark, df, f"{tmp_dir}/w", "page_id", "url", "html", **kw)
    return warc.read_archive(spark, f"{tmp_dir}/w")


ROWS = [(1, "http://a/", "same"), (2, None, "same"), (3, "http://c/\r\nX: y", "same"), (4, "http://d/", None), (5, "http://e/", ""),
        (6, "u", "é" * 70_000), (7, "u", "é" * 70_000), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n0\r\n\r\n" * 4000), (9, "u", "x" * 32_768),
        (None, "u", "without an id"), (None, "u", "same"), (10, "u", "twice " * 9000), (10, "u", "twice " * 9000)]


@pytest.mark.parametrize("segment", [warc.SEGMENT, 300])
def test_round_trip(spark, tmp_dir, segment):
    got = write(spark, tmp_dir, ROWS, segment=segment)
    largest = {}
    for i, _, html in ROWS:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    want = []
    for i, _, html in ROWS:
        raw, owner = (html or "").encode(), largest.get(html or "")
        own = owner is None or owner == i
        want.append((i, "response" if own else "revisit", None if own else owner, b32(raw), len(raw), True, raw if own else None))
    rows = [(warc.row_id(r.record_id), r.record_type, warc.row_id(r.refers_to), r.payload_digest, r.payload_bytes, r.complete,
             None if r.payload is None else bytes(r.payload)) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_small_payloads_are_never_revisits(spark, tmp_dir):
    got = write(spark, tmp_dir, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "long" * 9), (4, "u", "long" * 9)], revisit_least=10)
    assert sorted((warc.row_id(r.record_id), r.record_type) for r in got.collect()) == [
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_empty_table(spark, tmp_dir):
    assert write(spark, tmp_dir, []).count() == 0


def test_archives_are_gzip_files_of_whole_records(spark, tmp_dir):
    write(spark, tmp_dir, ROWS[:5])
    content = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{tmp_dir}/w").collect())
    text = gzip.decompress(content)
    assert text.count(b"WARC/1.1\r\n") == 5 and text.endswith(b"\r\n\r\n")
    assert len(list(warc.parse(content))) == 5


def test_chunked_framing():
    rnd = random.Random(1)
    for n in (0, 1, 15, 16, 17, 1000):
        payload = rnd.randbytes(n)
        assert warc.dechunked(warc.chunked(payload, 16)) == payload
    for broken in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc\r\n", b"0\r\n\r\nrest", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def segments(payload=b"p" * 1000, size=300):
    block = warc.HTTP_HEAD + warc.chunked(payload)
    first = {"WARC-Type": "response", "WARC-Record-ID": "<o>", "WARC-Payload-Digest": f"sha1:{b32(payload)}"}
    cuts = range(0, len(block), size)
    return [("<o>", k + 1, len(block) if k + 1 == len(cuts) else None, first if k == 0 else {}, block[at:at + size]) for k, at in enumerate(cuts)]


def test_segments_are_verified():
    whole = segments()
    assert [(r[5], r[6]) for r in warc.reassembled(iter(whole))] == [(1000, True)]
    lost = [whole[:1] + whole[2:], whole[1:], whole[:-1], [*whole[:-1], (*whole[-1][:2], 7, *whole[-1][3:])]]
    for broken in lost:
        assert [r[6] for r in warc.reassembled(iter(broken))] == [False]
    twice = [s for s in whole for _ in range(2)]
    assert [r[6] for r in warc.reassembled(iter(twice))] == [True, True]


def test_wrong_digest_is_not_complete():
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<o>", "WARC-Payload-Digest": "sha1:" + b32(b"other")}
    assert warc._decoded(fields, warc.HTTP_HEAD + warc.chunked(b"this"))[6] is False
    with pytest.raises(ValueError):
        list(warc.parse(b"no record\r\n\r\n"))
