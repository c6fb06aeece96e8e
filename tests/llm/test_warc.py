import hashlib
import struct

import pytest
import zstandard

from encore.llm import warc as W

SCHEMA = "page_id long, url string, html string, digest string, size int"


def brute(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        big = len(data) >= 1000
        keeper = max(same) if same and big else i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if i != keeper else "response", keeper if i != keeper else None))
    return sorted(out, key=str)


def pages():
    long = "<p>é " + "x" * 1200
    return [(1, "http://a/é b\r\nX: y", long), (2, None, long), (9, "u", long), (3, "u", None), (4, "u", ""), (5, "u", "short"),
            (6, "u", "short"), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 90), (8, "u", "y" * 1000), (10, "u", "y" * 1000), (11, "u", "z" * 999), (12, "u", "z" * 999)]


def test_round_trip_equals_brute_force(spark):
    rows = pages()
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    assert sorted((tuple(r) for r in W.warc_round_trip(frame).collect()), key=str) == brute(rows)


def test_empty_null_and_repeated_rows(spark):
    assert W.warc_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "q" * 1000
    rows = [(None, None, long, None, None), (3, None, long, None, None), (3, None, long, None, None), (None, None, "a", None, None)]
    got = W.warc_round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got) == [
        ("3", "response", None), ("3", "revisit", 3), ("None", "response", None), ("None", "revisit", 3)]


def archive(payloads, dictionary=b""):
    writer = W.ArchiveWriter(dictionary)
    for i, p in enumerate(payloads):
        writer.add(W.record(i, "http://x/", p, hashlib.sha1(p).hexdigest(), None, False))
    return writer.bytes()


def test_archive_layout_and_dictionary():
    samples = [b"<html><body>%d some repeated text %d</body></html>" % (i, i * 7) for i in range(2000)]
    dictionary = W.train_dictionary(samples)
    data = archive(samples[:20], dictionary)
    assert struct.unpack_from("<II", data) == (0x184D2A5D, len(dictionary))
    assert [r["payload"] for r in W.read_archive(data)] == samples[:20]
    assert len(list(W.frames(data))) == 20
    packed = zstandard.ZstdCompressor().compress(dictionary)
    again = struct.pack("<II", W.SKIPPABLE, len(packed)) + packed + data[8 + len(dictionary):]
    assert [r["payload"] for r in W.read_archive(again)] == samples[:20]
    with pytest.raises(W.WarcError):
        list(W.read_archive(data[8 + len(dictionary):]))  # no dictionary


@pytest.mark.parametrize("spoil", [
    lambda d: d[:-3], lambda d: d + b"xyz", lambda d: d[:40] + bytes([d[40] ^ 255]) + d[41:], lambda d: b"\x5d\x2a\x4d\x18\xff\xff\xff\x7f" + d])
def test_damaged_archives_are_refused(spoil):
    with pytest.raises(W.WarcError):
        list(W.read_archive(spoil(archive([b"payload " * 40, b"other"]))))


@pytest.mark.parametrize("change", [
    (b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC-Date: ", b"WARC-Dote: "), (b"payload", b"pAyload"), (b"\r\n\r\n", b"\r\n")])
def test_bad_records_are_refused(change):
    p = b"payload"
    good = W.record(1, "u", p, hashlib.sha1(p).hexdigest(), None, False)
    frame = zstandard.ZstdCompressor().compress
    assert next(W.read_archive(frame(good)))["payload"] == p
    with pytest.raises(W.WarcError):
        list(W.read_archive(frame(good.replace(*change))))
