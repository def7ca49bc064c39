"""WARC archives under Zstandard: one frame a record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookledger.llm.common import BROADCAST_ROWS, keep, spread_lookup

#: Fixed values of the formats.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

#: Payload bytes after which a task begins the next archive, and bytes of a dictionary and its sample.
ARCHIVE_BYTES = 32_000_000
DICTIONARY_BYTES = 16_384
SAMPLE_BYTES = 400_000
LEVEL = 3


class ArchiveError(ValueError):
    """An archive or record that breaks a rule of its format."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- records


@dataclass(frozen=True)
class Record:
    kind: str
    record_id: str
    target: str
    payload_digest: str
    payload_bytes: int
    refers_to: str | None
    payload: bytes | None


def _header_text(value: str) -> str:
    """Control characters, which would end a header line, are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value)


def record_bytes(record: Record, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {record.payload_bytes}\r\n\r\n"
    block = http.encode() + (record.payload or b"")
    headers = [
        VERSION,
        f"WARC-Type: {record.kind}",
        f"WARC-Record-ID: <{record.record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_header_text(record.target)}",
        f"WARC-Payload-Digest: sha1:{record.payload_digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if record.kind == "revisit":
        headers += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{record.refers_to}>"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(text: bytes, first: str) -> dict[str, str]:
    lines = text.decode("utf-8", "strict").split("\r\n")
    if not lines[0].startswith(first):
        raise ArchiveError(f"begins with {lines[0][:40]!r}")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ArchiveError(f"header line {line[:40]!r}")
        if name.strip().lower() in out:
            raise ArchiveError(f"header {name} twice")
        out[name.strip().lower()] = value.strip()
    return out


def _length(headers: dict[str, str]) -> int:
    if not re.fullmatch(r"[0-9]+", headers.get("content-length", "")):
        raise ArchiveError(f"content length {headers.get('content-length')!r}")
    return int(headers["content-length"])


def _bare_id(value: str) -> str:
    if not re.fullmatch(r"<[^<>\s]+>", value):
        raise ArchiveError(f"record id {value!r}")
    return value[1:-1]


def parse_record(data: bytes) -> Record:
    """One whole record; every header, length and digest in it has to be right."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise ArchiveError("no end of headers")
    headers = _headers(head, VERSION)
    if missing := [name for name in REQUIRED if name not in headers]:
        raise ArchiveError(f"no header {', '.join(missing)}")
    if not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?Z", headers["warc-date"]):
        raise ArchiveError(f"date {headers['warc-date']!r}")
    length = _length(headers)
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"block of {len(rest) - 4} bytes, its header says {length}")
    block = rest[:length]
    if headers.get("warc-block-digest", sha := f"sha1:{sha1_base32(block)}") != sha:
        raise ArchiveError("block digest differs")
    http_head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise ArchiveError("no end of HTTP headers")
    payload_bytes = _length(_headers(http_head, "HTTP/"))
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "")
    refers_to = None
    if kind == "response":
        if len(payload) != payload_bytes:
            raise ArchiveError(f"payload of {len(payload)} bytes, its header says {payload_bytes}")
        if digest != f"sha1:{sha1_base32(payload)}":
            raise ArchiveError("payload digest differs")
    elif kind == "revisit":
        if payload or headers.get("warc-profile") != REVISIT_PROFILE or not digest.startswith("sha1:"):
            raise ArchiveError("revisit with a payload, or without profile or digest")
        refers_to = _bare_id(headers.get("warc-refers-to", ""))
    else:
        raise ArchiveError(f"record type {kind!r}")
    return Record(
        kind, _bare_id(headers["warc-record-id"]), headers.get("warc-target-uri", ""), digest.removeprefix("sha1:"),
        payload_bytes, refers_to, payload if kind == "response" else None,
    )


# ---------------------------------------------------------------- frames


def _train(samples: list[bytes]):
    """A dictionary from an archive's first records, or None where these are too few."""
    import zstandard

    if len(samples) < 16:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=400, d=8)
    except zstandard.ZstdError:
        return None


def archive_frames(records: Iterable[bytes]) -> Iterator[bytes]:
    """The dictionary frame, if there is one, then a frame for each record."""
    import zstandard

    records, samples, size = iter(records), [], 0
    for record in records:
        samples.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    dictionary = _train(samples)
    if dictionary is not None:
        data = dictionary.as_bytes()
        yield struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data
    compressor = zstandard.ZstdCompressor(LEVEL, dict_data=dictionary, write_checksum=True, write_content_size=True)
    for record in samples:
        yield compressor.compress(record)
    for record in records:
        yield compressor.compress(record)


def _frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its block headers, without decoding it."""
    import zstandard

    try:
        end = at + zstandard.frame_header_size(data[at : at + 18])
        checksum = zstandard.get_frame_parameters(data[at : at + 18]).has_checksum
    except zstandard.ZstdError as error:
        raise ArchiveError(f"frame header: {error}") from None
    last = False
    while not last:
        if end + 3 > len(data):
            raise ArchiveError("frame breaks off")
        header = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = header & 1, header >> 1 & 3, header >> 3
        if kind == 3:
            raise ArchiveError("reserved block type")
        end += 3 + (1 if kind == 1 else size)
    end += 4 * checksum
    if end > len(data):
        raise ArchiveError("frame breaks off")
    return end


def read_frames(archive: bytes) -> Iterator[tuple[int, int, bytes | ArchiveError]]:
    """(offset, length, record) of every frame that holds one; an error ends what can be read of it.

    A leading skippable frame of the dictionary's kind is loaded, compressed or not; other
    skippable frames are passed over. A frame that is whole but doesn't decode leaves the
    frames behind it readable; one that breaks off is the archive's last.
    """
    import zstandard

    data, at, dictionary = memoryview(archive), 0, None
    decompressor = zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            magic = int.from_bytes(data[at : at + 4], "little")
            if magic in SKIPPABLE:
                size = int.from_bytes(data[at + 4 : at + 8], "little")
                end = at + 8 + size
                if at + 8 > len(data) or end > len(data):
                    raise ArchiveError("skippable frame breaks off")
                if at == 0 and magic == DICTIONARY_MAGIC:
                    content = bytes(data[8:end])
                    if content[:4] == FRAME_MAGIC:
                        content = zstandard.ZstdDecompressor().decompress(content, max_output_size=1 << 24)
                    dictionary = zstandard.ZstdCompressionDict(content)
                    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
                at = end
                continue
            if bytes(data[at : at + 4]) != FRAME_MAGIC:
                raise ArchiveError("no frame")
            end = _frame_end(data, at)
        except (ArchiveError, zstandard.ZstdError) as error:
            yield at, len(data) - at, ArchiveError(str(error))
            return
        frame = data[at:end]
        wanted = zstandard.get_frame_parameters(frame).dict_id
        try:
            if wanted and (dictionary is None or dictionary.dict_id() != wanted):
                raise ArchiveError(f"dictionary {wanted} is missing")
            record: bytes | ArchiveError = decompressor.decompressobj().decompress(frame)
        except (ArchiveError, zstandard.ZstdError) as error:
            record = ArchiveError(str(error))
        yield at, end - at, record
        at = end


# ---------------------------------------------------------------- Spark


def _page_uri(page_id: int | None) -> str:
    return f"urn:x-page:{'none' if page_id is None else page_id}"


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows with ``payload``, ``kind`` and ``top``, the page that holds their payload.

    Of equal payloads of at least ``least_bytes`` the row with the largest page_id is the response,
    and rows that repeat its id are responses, too; null ids come last. Payloads are compared by
    length and SHA-256. Only the duplicated ones, by digest, meet the rows again: as a broadcast
    where they are few, otherwise by a join that spreads large groups.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    content = F.struct(F.octet_length("payload").alias("bytes"), F.sha2("payload", 256).alias("sha"))
    keyed = rows.withColumn("content", content)
    large = keyed.where(F.octet_length("payload") >= least_bytes)
    groups = large.groupBy("content").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
    copied = keep(groups.where("n > 1"))
    if copied.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined = keyed.join(F.broadcast(copied), "content", "left")
    else:
        # A fixed order in every partition, so that a task writes the same archives when it is run again.
        joined = spread_lookup(keyed, copied, "content", "n").sortWithinPartitions("page_id", "url")
    own = F.col("top").isNull() | F.col("page_id").eqNullSafe(F.col("top"))
    kind: Column = F.when(own, F.lit("response")).otherwise(F.lit("revisit"))
    return joined.select("page_id", "url", "payload", kind.alias("kind"), "top")


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes ``revisits``' rows to ``part-*.warc.zst`` and returns ``archive, n_records, bytes``, a kept table.

    Each task streams its rows into archives of bounded size. Their names come from partition and
    number, and an archive gets its name when it is whole, so a task that runs again or twice leaves
    the same files. ``folder`` is one that pyarrow's file systems and Spark both reach.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder)
        partition, number = TaskContext.get().partitionId(), 0

        def encoded() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    page_id, url, payload, kind, top = (c[i].as_py() for c in batch.columns)
                    again = kind == "revisit"
                    yield record_bytes(
                        Record(
                            kind, _page_uri(page_id), url, sha1_base32(payload), len(payload),
                            _page_uri(top) if again else None, None if again else payload,
                        ), date,
                    )

        waiting = encoded()
        first = next(waiting, None)
        while first is not None:
            count, size, following = 0, 0, None

            def one_archive(record: bytes | None) -> Iterator[bytes]:
                nonlocal count, size, following
                while record is not None:
                    if count and size + len(record) > ARCHIVE_BYTES:
                        following = record
                        return
                    count, size = count + 1, size + len(record)
                    yield record
                    record = next(waiting, None)

            name = f"{base}/part-{partition:06d}-{number:05d}.warc.zst"
            draft = f"{base}/.draft-{uuid.uuid4().hex}"
            written = 0
            with store.open_output_stream(draft) as out:
                for frame in archive_frames(one_archive(first)):
                    out.write(frame)
                    written += len(frame)
            if store.get_file_info(name).type == fs.FileType.NotFound:
                store.move(draft, name)
            else:
                store.delete_file(draft)
            yield pa.RecordBatch.from_pylist([{"archive": name, "n_records": count, "bytes": written}])
            first, number = following, number + 1

    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    return keep(records.mapInArrow(run, "archive string, n_records long, bytes long"))


def read_archives(spark: SparkSession, folder: str, strict: bool = True, payloads: bool = True) -> DataFrame:
    """The records of all ``*.warc.zst`` in a folder, one row each.

    ``archive, offset, length, record_type, record_id, target_uri, refers_to, payload_digest,
    payload_bytes, payload, error``. strict: the first fault fails the read; otherwise it is a row with
    ``error`` and as far as possible the rest is read. Revisits have no payload; without
    ``payloads`` responses have none either, but are checked all the same.
    """
    schema = pa.schema(
        [
            ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()),
            ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("error", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    path = batch.column(0)[i].as_py()
                    for offset, length, data in read_frames(batch.column(1)[i].as_py()):
                        row: dict = {"archive": path, "offset": offset, "length": length}
                        try:
                            if isinstance(data, ArchiveError):
                                raise data
                            r = parse_record(data)
                        except (ArchiveError, UnicodeDecodeError) as error:
                            if strict:
                                raise ArchiveError(f"{path} at {offset}: {error}") from None
                            yield row | {"error": str(error)}
                            continue
                        yield row | {
                            "record_type": r.kind, "record_id": r.record_id, "target_uri": r.target, "refers_to": r.refers_to,
                            "payload_digest": r.payload_digest, "payload_bytes": r.payload_bytes,
                            "payload": r.payload if payloads else None,
                        }

        waiting, weight = [], 0
        for row in rows():
            waiting.append(row)
            weight += 300 + len(row.get("payload") or b"")
            if weight > 4_000_000:
                yield pa.RecordBatch.from_pylist(waiting, schema=schema)
                waiting, weight = [], 0
        if waiting:
            yield pa.RecordBatch.from_pylist(waiting, schema=schema)

    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").schema(
            "path string, modificationTime timestamp, length long, content binary"
        ).load(folder)
    )
    return files.select("path", "content").mapInArrow(
        run,
        "archive string, offset long, length long, record_type string, record_id string, target_uri string, "
        "refers_to string, payload_digest string, payload_bytes long, payload binary, error string",
    )


def page_id_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^urn:x-page:(-?\d+)$", 1).try_cast("long")


def archive_round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page, from archives.

    Writes a record for each row, then reads and checks the archives. Null pages have empty
    payloads; null ids are read back as null; rows that repeat a page are records of their own; an
    empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    write_archives(revisits(pages), folder)
    records = read_archives(spark, folder, payloads=False)
    return records.select(
        page_id_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_id_of(F.col("refers_to")).alias("refers_to"),
    )
