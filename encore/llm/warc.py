"""WARC archives in zstandard: a dictionary in a leading skippable frame, one
frame per record.

An archive is: one skippable frame (magic 0x184D2A5D) whose content is the
dictionary, then one zstandard frame per record, each compressed with that
dictionary and carrying its content size and checksum.  ``read_archive``
takes the dictionary from the leading frame (which may itself be a zstandard
frame, or be missing), decodes frame by frame, and validates version line,
mandatory headers, block length and payload digest of every record.

Writing a table: of pages with equal payloads of at least ``min_revisit``
bytes the one with the largest id is a response, the others are revisits of it
(header block only); smaller ones are all responses.  The rows are dealt over
archives by size; each task writes whole archive files into the shared folder
under names that depend on the archive alone, first under a name of the
attempt, so a task that runs twice leaves the same files.

Defined cases: a null or empty payload has no bytes and is a response; a null
URL has no target header; a null id is written as ``null`` and read back as
null, and never is what others refer to while a row with an id is equal;
repeated rows get a record each, all but one of them revisits of their own id.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import Workspace, texts_of

#: Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
SKIPPABLE_RANGE = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEVEL = 3
DICT_SIZE = 32768
#: Pages that the dictionary is trained on, about (8 KB of each).
DICT_PAGES = 200
#: Payload bytes of one archive, about (a larger record has one of its own).
ARCHIVE_BYTES = 4 << 20
#: Most tasks that write archives, each one archive after another.
MOST_TASKS = 100_000


class WarcError(ValueError):
    """A record or frame that is not as the format says."""


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def _header(fields: list[tuple[str, str]]) -> bytes:
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8") + b"\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP head alone."""
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = head if revisit else head + payload
    name = "null" if page_id is None else str(page_id)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"),
              ("WARC-Date", "2024-01-30T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{'null' if refers_to is None else refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields) + block + b"\r\n\r\n"


class ArchiveWriter:
    def __init__(self, dictionary: bytes):
        import zstandard

        self.parts = [dictionary_frame(dictionary)] if dictionary else []
        extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.frame = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_checksum=True, **extra)

    def add(self, data: bytes) -> None:
        self.parts.append(self.frame.compress(data))

    def bytes(self) -> bytes:
        return b"".join(self.parts)


def _leading_dictionary(data: bytes) -> tuple[bytes, int]:
    """(dictionary, where the records begin)."""
    import zstandard

    if len(data) < 8:
        return b"", 0
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        return b"", 0
    if 8 + size > len(data):
        raise WarcError("the dictionary frame ends beyond the archive")
    content = data[8:8 + size]
    if size >= 4 and struct.unpack_from("<I", content)[0] == ZSTD_MAGIC:
        content = zstandard.ZstdDecompressor().decompress(content)
    return content, 8 + size


def frames(data: bytes) -> Iterator[bytes]:
    """The content of each frame after the dictionary."""
    import zstandard

    dictionary, at = _leading_dictionary(data)
    extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    reader = zstandard.ZstdDecompressor(**extra)
    view = memoryview(data)
    while at < len(data):
        if len(data) - at < 8:
            raise WarcError("trailing bytes after the last frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE_RANGE:
            at += 8 + size
            continue
        try:
            one = reader.decompressobj()
            out = one.decompress(view[at:])
        except zstandard.ZstdError as error:
            raise WarcError(f"frame at byte {at}: {error}") from error
        if not one.eof:
            raise WarcError(f"frame at byte {at} is cut off")
        yield out
        at = len(data) - len(one.unused_data)


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names) and block of one record, validated."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        raise WarcError("no end of the headers")
    lines = head.split(b"\r\n")
    if lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError(f"not a WARC version: {lines[0][:20]!r}")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise WarcError(f"not a header: {line[:60]!r}")
        headers[name.decode("utf-8").strip().lower()] = value.decode("utf-8").strip()
    for name in MANDATORY:
        if name not in headers:
            raise WarcError(f"no {name}")
    if not headers["content-length"].isascii() or not headers["content-length"].isdigit():
        raise WarcError("content-length is not a number")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"content-length {size} does not match the record of {len(rest)} bytes")
    return {"headers": headers, "block": rest[:size]}


def _number(urn: str | None) -> int | None:
    if urn is None or not urn.startswith("<urn:page:"):
        return None
    text = urn[len("<urn:page:"):-1]
    return None if text == "null" else int(text)


def read_archive(data: bytes) -> Iterator[dict]:
    """Every record: page_id, url, payload (None for a revisit), payload_bytes,
    payload_digest, record_type, refers_to."""
    for frame in frames(data):
        one = parse_record(frame)
        headers = one["headers"]
        head, found, payload = one["block"].partition(b"\r\n\r\n")
        if not found or not head.startswith(b"HTTP/"):
            raise WarcError("no HTTP head")
        size = next((int(x.split(b":")[1]) for x in head.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")), None)
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        revisit = headers["warc-type"] == "revisit"
        if not revisit and (size != len(payload) or hashlib.sha1(payload).hexdigest() != digest):
            raise WarcError(f"payload of {headers['warc-record-id']} does not match its length or digest")
        if revisit and payload:
            raise WarcError(f"{headers['warc-record-id']} is a revisit with a payload")
        yield {"page_id": _number(headers["warc-record-id"]), "url": headers.get("warc-target-uri"),
               "payload": None if revisit else payload, "payload_bytes": size, "payload_digest": digest,
               "record_type": headers["warc-type"], "refers_to": _number(headers.get("warc-refers-to")) if revisit else None}


def train_dictionary(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICT_SIZE, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b""


def _write_archives(folder: str, dictionary):
    """Rows come sorted by archive; returns the names of the files written."""

    def run(batches):
        import uuid

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        writer, current, names, records = None, None, [], []

        def finish():
            path = f"{root}/part-{current:08d}.warc.zst"
            trial = f"{path}.{uuid.uuid4().hex}.tmp"
            with store.open_output_stream(trial) as out:
                out.write(writer.bytes())
            if store.get_file_info(path).type != fs.FileType.NotFound:
                store.delete_file(path)  # an earlier attempt of this task: the same records
            store.move(trial, path)
            names.append(current)
            records.append(count)

        count = 0
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            rows = zip(*(cols[c].to_pylist() for c in ("archive", "page_id", "url", "digest", "keeper", "revisit")), texts_of(batch), strict=True)
            for archive, page_id, url, digest, keeper, revisit, payload in rows:
                if archive != current:
                    if writer:
                        finish()
                    writer, current, count = ArchiveWriter(dictionary.value), archive, 0
                writer.add(record(page_id, url, payload, digest, keeper, revisit))
                count += 1
        if writer:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(records, pa.int64())], ["archive", "records"])

    return run


def _read_archives(batches):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for data in batch.column(0):
            rows = []
            for one in read_archive(data.as_buffer().to_pybytes()):
                rows.append([one[n] for n in names])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def write_pages(pages: DataFrame, folder: str, min_revisit: int = 1000) -> int:
    """Writes the archives of a table (page_id, url, html); returns the number
    of records written."""
    spark = pages.sparkSession
    ws = Workspace(spark, "warc")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("text"))
    keys = ws.put(rows.select("page_id", F.sha1(F.col("text").cast("binary")).alias("digest"), F.octet_length("text").cast("long").alias("size")))
    total, filled = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count_if(F.col("size") > 0)).first()
    archives = max(1, -(-int(total) // ARCHIVE_BYTES))
    # payloads that occur more than once: who answers for them
    keepers = ws.put(keys.where(F.col("size") >= min_revisit).groupBy("digest", "size").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("rows"),
        F.count("page_id").alias("with_id")).where("rows > 1"))

    # about DICT_PAGES pages chosen by hash, wherever they lie
    share = min(1.0, DICT_PAGES / max(1, filled))
    sample = rows.where(F.length("text") > 0).where(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    # of each a block of 8192 bytes that starts anywhere in it, by hash
    begin = F.pmod(F.xxhash64("url", "page_id", "text"), F.greatest(F.octet_length("text") - 8191, F.lit(1))).cast("int") + 1
    blocks = sample.select(F.substring(F.col("text").cast("binary"), begin, F.lit(8192)).alias("block")).limit(2 * DICT_PAGES)
    dictionary = train_dictionary([bytes(r["block"]) for r in blocks.collect()])
    shared = spark.sparkContext.broadcast(dictionary)  # DICT_SIZE bytes

    joined = rows.withColumn("digest", F.sha1(F.col("text").cast("binary"))).withColumn("size", F.octet_length("text").cast("long")).join(
        keepers, ["digest", "size"], "left")
    # equal ids among equal payloads: one of the repeated rows is the response
    joined = joined.withColumn("revisit", F.col("rows").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper")))
    twins = keys.join(keepers, ["digest", "size"]).where(F.col("page_id").eqNullSafe(F.col("keeper"))).groupBy("digest", "size").count().where("count > 1")
    if not twins.isEmpty():
        joined = _one_response(joined)
    dealt = joined.withColumn("archive", F.pmod(F.xxhash64("page_id", "url", "digest"), F.lit(archives)))
    dealt = dealt.select("archive", "page_id", "url", "text", "digest", "keeper", "revisit")
    # tasks by the number of archives, so that none grows with the table
    dealt = dealt.repartition(min(archives, MOST_TASKS), "archive").sortWithinPartitions("archive", "page_id")
    done = ws.put(dealt.mapInArrow(_write_archives(folder, shared), "archive long, records long"), text_batch=256)
    count = done.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    ws.drop(keys, keepers, done)
    return int(count)


def _one_response(joined: DataFrame) -> DataFrame:
    """Where repeated rows share the keeper's id, the first of them answers."""
    from pyspark.sql import Window

    order = Window.partitionBy("digest", "size", "page_id").orderBy("url")
    responders = joined.where(F.col("rows").isNotNull() & ~F.col("revisit"))
    picked = responders.withColumn("revisit", F.row_number().over(order) > 1)
    return joined.where(F.col("rows").isNull() | F.col("revisit")).unionByName(picked)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in a folder, validated, payloads checked
    but not returned."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    return files.mapInArrow(_read_archives, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def warc_round_trip(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """Writes the pages into archives in the shared folder, reads them back
    and returns one row per record."""
    spark = pages.sparkSession
    ws = Workspace(spark, "warc-read")
    folder = f"{ws.base}/archives"
    written = write_pages(pages, folder, min_revisit)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if not written:
        return spark.createDataFrame([], schema).drop("url")
    return ws.put(read_pages(spark, folder).drop("url"), text_batch=1)
