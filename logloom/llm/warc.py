"""WARC archives compressed with Zstandard: one dictionary, one frame per record.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary; every record is one Zstandard frame with content size and checksum.
Archives roll over at a bounded size, so that a reader's task holds one archive.
Writers use names of their own for every attempt and report them as rows; Spark
commits that manifest, and archives that it doesn't list (of failed attempts) are
deleted before anything is read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, pick, remove, text_or_empty

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
#: Payloads under this size are never revisits.
MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
#: The dictionary is trained on so many pages, those with the least hashes, of at most so many bytes each.
DICTIONARY_PAGES, DICTIONARY_PAGE_BYTES, DICTIONARY_BYTES = 200, 1 << 16, 1 << 15
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")


class WarcError(ValueError):
    """An archive, frame or record that breaks the format."""


# Records ---------------------------------------------------------------------


def _header_value(value: str) -> str:
    """One line: control characters and spaces at either end can't stand in a header."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value).strip()


def make_record(kind: str, record_id: str, headers: dict[str, str], block: bytes) -> bytes:
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE, **headers, "Content-Length": str(len(block))}
    head = "".join(f"{k}: {_header_value(v)}\r\n" for k, v in named.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(record_id: str, url: str | None, payload: bytes, payload_sha1: str, refers_to: str | None) -> bytes:
    """A response, or a revisit (the HTTP head only) of the record ``refers_to``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    digest = "sha1:" + base64.b32encode(bytes.fromhex(payload_sha1)).decode()
    headers = {"WARC-Target-URI": url or record_id, "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": digest}
    if refers_to is None:
        return make_record("response", record_id, headers, http + payload)
    return make_record("revisit", record_id, {**headers, "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<{refers_to}>"}, http)


def parse_headers(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"bad header line {line[:80]!r}")
        if name.lower() in found:
            raise WarcError(f"header {name} stands twice")
        found[name.lower()] = value.strip()
    return found


def parse_length(headers: dict[str, str]) -> int:
    value = headers.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise WarcError(f"bad Content-Length {value[:40]!r}")
    return int(value)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record that fills ``data`` exactly."""
    version, _, rest = data.partition(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError(f"bad version line {version[:40]!r}")
    head, end, _ = rest.partition(b"\r\n\r\n")
    if not end:
        raise WarcError("the header block doesn't end")
    headers = parse_headers(head)
    if missing := [x for x in REQUIRED if x not in headers]:
        raise WarcError(f"no header {', '.join(missing)}")
    start, length = len(version) + 2 + len(head) + 4, parse_length(headers)
    if len(data) != start + length + 4 or data[-4:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length {length} doesn't fit a record of {len(data)} bytes")
    return headers, data[start : start + length]


def parse_page(data: bytes) -> tuple | None:
    """A response's or revisit's fields, checked; None for other kinds."""
    headers, block = parse_record(data)
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, end, body = block.partition(b"\r\n\r\n")
    if not end or not head.startswith(b"HTTP/"):
        raise WarcError("the block doesn't start with an HTTP head")
    n = parse_length(parse_headers(head.partition(b"\r\n")[2]))
    label, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if label != "sha1":
        raise WarcError("no SHA-1 payload digest")
    sha1 = base64.b32decode(digest).hex()
    if kind == "response" and (len(body) != n or hashlib.sha1(body).hexdigest() != sha1):
        raise WarcError("payload length or digest is wrong")
    if kind == "revisit" and (body or "warc-refers-to" not in headers):
        raise WarcError("a revisit with a payload or without its original")
    name = lambda key: headers[key].removeprefix("<").removesuffix(">") if key in headers else None
    return name("warc-record-id"), kind, headers.get("warc-target-uri"), n, sha1, name("warc-refers-to"), body if kind == "response" else None


# Frames ----------------------------------------------------------------------


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame at ``at`` ends, from its block headers."""
    if bytes(data[at : at + 4]) != FRAME_MAGIC:
        raise WarcError(f"no frame at byte {at}")
    try:
        here = at + zstandard.frame_header_size(data[at : at + 18])
        last = False
        while not last:
            header = int.from_bytes(data[here : here + 3], "little")
            last, kind, size = header & 1, header >> 1 & 3, header >> 3
            if kind == 3 or here + 3 > len(data):
                raise WarcError(f"bad block at byte {here}")
            here += 3 + (1 if kind == 1 else size)
        here += 4 * bool(data[at + 4] & 4)
    except zstandard.ZstdError as error:
        raise WarcError(f"bad frame at byte {at}: {error}") from error
    if here > len(data):
        raise WarcError(f"the frame at byte {at} is torn")
    return here


def read_frames(content: bytes) -> Iterator[bytes]:
    """Each record's bytes; the dictionary comes from the leading skippable frame."""
    data, at, dictionary = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise WarcError("the dictionary frame is torn")
        raw = bytes(data[8 : 8 + size])
        raw = zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == FRAME_MAGIC else raw
        dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    known = dictionary.dict_id() if dictionary else 0
    while at < len(data):
        end = frame_end(data, at)
        frame = data[at:end]
        if zstandard.get_frame_parameters(frame).dict_id not in (0, known):
            raise WarcError(f"the frame at byte {at} needs another dictionary")
        try:
            yield decoder.decompress(frame)
        except zstandard.ZstdError as error:
            raise WarcError(f"bad frame at byte {at}: {error}") from error
        at = end


class ArchiveWriter:
    """Rolling archives in a folder that pyarrow's file systems can write."""

    def __init__(self, folder: str, dictionary: bytes, archive_bytes: int):
        self.files, self.folder = pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)
        self.dictionary, self.limit, self.out, self.count = dictionary, archive_bytes, None, 0
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.encoder = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=True)
        self.stem = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"

    def add(self, record: bytes) -> tuple | None:
        if self.out is None:
            self.name, self.size, self.records = f"{self.stem}-{self.count:04d}.warc.zst", 0, 0
            self.count += 1
            self.out = self.files.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            if self.dictionary:
                packed = zstandard.ZstdCompressor(level=LEVEL).compress(self.dictionary)
                self._write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
            self._write(self.encoder.compress(make_record("warcinfo", f"urn:uuid:{uuid.uuid4()}", {"Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")))
        self._write(self.encoder.compress(record))
        self.records += 1
        return self.close() if self.size >= self.limit else None

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> tuple | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        return self.name, self.records, self.size


# Spark -----------------------------------------------------------------------

MANIFEST = "file string, records long, bytes long"
RECORDS = "record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample; empty where the sample is too small."""
    short = pages.select("page_id", "html").filter((F.octet_length("html") > 0) & (F.octet_length("html") <= DICTIONARY_PAGE_BYTES))
    # ids first: of every partition only numbers compete, and no text but the sample's is sent
    chosen = [row["page_id"] for row in short.select("page_id").filter("page_id is not null").orderBy(F.xxhash64("page_id"), "page_id").limit(DICTIONARY_PAGES).collect()]
    texts = [row["html"].encode() for row in short.filter(F.col("page_id").isin(chosen)).select("html").limit(DICTIONARY_PAGES).collect()] if chosen else []
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes() if len(texts) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``sha1`` and ``original`` (a revisit's response, else null) for every page.

    Only payloads that stand twice are joined back; their hot digests are rows of
    the larger side, which adaptive execution splits.  Short payloads take no
    part in the join's keys, so empty pages, however many, don't meet in one task.
    """
    hashed = pages.withColumn("sha1", F.sha1(text_or_empty("html")))
    long = hashed.filter(F.octet_length("html") >= min_bytes)
    twice = long.groupBy("sha1").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # an unequal salt spreads the rows without a key, which the join must keep
    # nulls would meet in one task too, so a short payload has a key that nothing else can have
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    key = F.when(F.octet_length("html") >= min_bytes, F.col("sha1")).otherwise(alone)
    shared = twice.withColumnRenamed("sha1", "key")
    joined = hashed.withColumn("key", key).join(shared, "key", "left").select(*hashed.columns, "newest")
    return joined.withColumn("original", F.when(F.col("page_id").eqNullSafe(F.col("newest")), None).otherwise(F.col("newest"))).drop("newest")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` into ``folder``; returns the manifest.

    Of rows with equal payloads of at least ``min_bytes`` those with the largest
    page_id are responses (all of them, if it stands repeatedly) and the others
    revisit it.  Null html is an empty payload; a null url names the record itself;
    a null page_id gives the record id ``urn:page:`` and is a revisit only of a
    page with an id.  An empty table gives an empty manifest and no archive.
    """
    pages = pick(pages, "page_id", "url", "html")
    dictionary = train_dictionary(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            writer = writer or ArchiveWriter(folder, dictionary, archive_bytes)
            page_ids, originals = batch.column(0).to_pylist(), batch.column(4).to_pylist()
            for i, (page_id, original) in enumerate(zip(page_ids, originals)):
                payload = (batch.column(2)[i].as_py() or "").encode()
                name = lambda x: f"urn:page:{'' if x is None else x}"
                record = page_record(name(page_id), batch.column(1)[i].as_py(), payload, batch.column(3)[i].as_py(), None if original is None else name(original))
                done.append(writer.add(record))
        if writer:
            done.append(writer.close())
        rows = [x for x in done if x]
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "records", "bytes"), x)) for x in rows], schema=pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    spark = pages.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)
    marked = mark_revisits(pages, min_bytes).select("page_id", "url", "html", "sha1", "original")
    marked.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/_manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    for row in list_archives(spark, folder).select("path", "file").join(manifest, "file", "left_anti").collect():
        remove(spark, row["path"])  # left by a failed attempt
    return manifest


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``content`` and ``file`` of the archives; content is read only if used."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("path", "content", F.element_at(F.split("path", "/"), -1).alias("file"))


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every response and revisit of the archives in ``folder``.

    A broken frame, header, length or digest fails the read and names the archive.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = [pa.int64() if " long" in x else pa.binary() if " binary" in x else pa.string() for x in RECORDS.split(", ")]
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for record in read_frames(content.as_py()):
                    try:
                        row = parse_page(record)
                    except (WarcError, UnicodeDecodeError, ValueError) as error:
                        raise WarcError(f"{path.as_py()}: {error}") from error
                    if row:
                        rows.append(row)
                        size += len(record)
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return list_archives(spark, folder).select("path", "content").mapInArrow(read, RECORDS)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and read every record back."""
    folder = new_path(pages.sparkSession, "warc")
    write_archives(pages, folder)
    page_id = lambda c: F.expr(f"try_cast(substring({c}, 10) as bigint)")
    records = read_archives(pages.sparkSession, folder)
    return records.select(page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_id("refers_to").alias("refers_to"))
