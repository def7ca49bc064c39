"""Archives: round trips, and faults that the reader has to find."""

import struct
from collections import Counter
from dataclasses import replace

import pytest
import zstandard

from bookledger.llm.warc import (
    DICTIONARY_MAGIC,
    ArchiveError,
    Record,
    archive_frames,
    archive_round_trip,
    page_id_of,
    parse_record,
    read_archives,
    read_frames,
    record_bytes,
    revisits,
    sha1_base32,
    write_archives,
)

from . import brute

SCHEMA = "page_id long, url string, html string, payload string, top long, kind string, n long"
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pages(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(partitions)


ROWS = [(i, f"http://a/{i}", "<p>" + "same" * (i % 5)) for i in range(60)] + [
    (70, None, None), (71, "u\r\nWARC-Type: x", ""), (72, "é 東", "é東😀\r\n\r\nWARC/1.1\r\n"), (73, "u", "long " * 200_000),
    (-3, "neg", "<p>"), (5, "again", "<p>same"),
]


def test_round_trip(spark, tmp_path):
    got = archive_round_trip(pages(spark, ROWS), f"file://{tmp_path}/a")
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == Counter(brute.warc([(r[0], r[2]) for r in ROWS]))


def test_payloads_come_back_whole(spark, tmp_path, monkeypatch):
    from bookledger.llm import warc

    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5_000)
    folder = f"file://{tmp_path}/a"
    written = write_archives(revisits(pages(spark, ROWS)), folder).collect()
    assert sum(r["n_records"] for r in written) == len(ROWS) and len(written) > 3
    assert len(list((tmp_path / "a").glob("*.warc.zst"))) == len(written)
    records = read_archives(spark, folder).withColumn("page_id", page_id_of("record_id")).collect()
    html = {(r[0], len((r[2] or "").encode())): (r[2] or "").encode() for r in ROWS}
    for r in records:
        expected = html[r["page_id"], r["payload_bytes"]]
        assert r["payload"] == (expected if r["record_type"] == "response" else None) and r["error"] is None
    # A task that runs again leaves the same files.
    again = write_archives(revisits(pages(spark, ROWS)), folder).collect()
    assert {r["archive"] for r in again} == {r["archive"] for r in written}
    assert read_archives(spark, folder).count() == len(ROWS)


def test_null_ids_and_an_empty_table(spark, tmp_path):
    rows = [(None, "a", "x"), (None, "b", "x"), (1, "c", "x"), (None, "d", "y")]
    got = archive_round_trip(pages(spark, rows), f"file://{tmp_path}/a").collect()
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == Counter({(None, "revisit", 1): 2, (1, "response", None): 1, (None, "response", None): 1})
    nothing = archive_round_trip(pages(spark, rows).where("false"), f"file://{tmp_path}/b")
    assert nothing.collect() == []


def test_small_payloads_are_all_responses(spark):
    found = revisits(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), least_bytes=3)
    assert {(r["page_id"], r["kind"]) for r in found.collect()} == {
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response"),
    }


def record(payload=b"hello", **changes):
    fields = dict(
        kind="response", record_id="urn:x-page:1", target="http://a", payload_digest=sha1_base32(payload),
        payload_bytes=len(payload), refers_to=None, payload=payload,
    )
    return Record(**(fields | changes))


DATE = "2024-01-01T00:00:00Z"


def test_records_parse_back():
    assert parse_record(record_bytes(record(), DATE)) == record()
    again = replace(record(), kind="revisit", refers_to="urn:x-page:2", payload=None)
    assert parse_record(record_bytes(again, DATE)) == again


@pytest.mark.parametrize(
    ("old", "new"),
    [
        (b"WARC/1.1", b"WARC/9.9"), (b"WARC-Date: 2024", b"WARC-Date: 24"), (b"Content-Length: 5", b"Content-Length: 6"),
        (b"WARC-Type: response", b"WARC-Type: other"), (b"WARC-Record-ID: <", b"WARC-Record-ID: "), (b"WARC-Date: ", b"X-Date: "),
        (b"hello", b"hallo"), (b"hello", b"hell"), (b"hello", b"hello!"), (b"HTTP/1.1", b"FTP/1.1"),
        (b"Content-Type: application", b"WARC-Type: application"), (b"Content-Type: application", b"no colon application"),
        (b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: sha1:A"), (b"\r\n\r\n", b"\r\n"),
    ],
)
def test_faults_in_records(old, new):
    with pytest.raises(ArchiveError):
        parse_record(record_bytes(record(), DATE).replace(old, new))


@pytest.fixture
def records():
    return [record_bytes(record(f"page {i} some common words here and there".encode() * 9, record_id=f"urn:x-page:{i}"), DATE) for i in range(200)]


def test_dictionary_frame_leads(records):
    frames = list(archive_frames(records))
    assert struct.unpack("<I", frames[0][:4])[0] == DICTIONARY_MAGIC and len(frames) == 201
    archive = b"".join(frames)
    assert [r for _, _, r in read_frames(archive)] == records
    # The dictionary may be compressed, and other skippable frames may stand between records.
    packed = zstandard.ZstdCompressor().compress(frames[0][8:])
    other = struct.pack("<II", 0x184D2A50, 3) + b"abc"
    archive = struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed + other + other.join(frames[1:])
    assert [r for _, _, r in read_frames(archive)] == records
    without = list(read_frames(b"".join(frames[1:])))
    assert len(without) == 200 and all(isinstance(r, ArchiveError) for _, _, r in without)


def test_few_records_have_no_dictionary(records):
    frames = list(archive_frames(records[:3]))
    assert len(frames) == 3 and [r for _, _, r in read_frames(b"".join(frames))] == records[:3]
    assert list(archive_frames([])) == []


def test_damaged_archives(records):
    frames = list(archive_frames(records))
    broken = bytearray(frames[5])
    broken[-1] ^= 255
    found = [r for *_, r in read_frames(b"".join([*frames[:5], bytes(broken), *frames[6:]]))]
    assert isinstance(found[4], ArchiveError) and found[:4] + found[5:] == records[:4] + records[5:]
    found = [r for *_, r in read_frames(b"".join(frames)[:-3])]
    assert found[:-1] == records[:-1] and isinstance(found[-1], ArchiveError)
    found = [r for *_, r in read_frames(b"".join(frames[:3]) + b"junk")]
    assert found[:2] == records[:2] and isinstance(found[2], ArchiveError)


def test_reader_reports_or_fails(spark, tmp_path, records):
    from pyspark.errors import PythonException

    bad = records[0].replace(b"WARC/1.1", b"WARC/9.9")
    (tmp_path / "a.warc.zst").write_bytes(b"".join(archive_frames([records[1], bad, records[2]])))
    rows = read_archives(spark, f"file://{tmp_path}", strict=False).orderBy("offset").collect()
    assert [r["error"] is None for r in rows] == [True, False, True]
    with pytest.raises(PythonException):
        read_archives(spark, f"file://{tmp_path}").collect()
