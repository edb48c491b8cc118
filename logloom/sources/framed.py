"""A data source of Zstandard-framed logs: one file a session, any file over several tasks.

A file is a row of independent frames; the first holds the session's header.  Partitions
are byte ranges of files, and a task reads the frames that begin in its range.  It finds
them by hopping from block header to block header, which reads a few bytes for each
block and decompresses nothing.  A torn last frame is recovered by whole lines.

Paths are what ``pyarrow.fs`` opens (folders, or URIs of the stores that it knows); in
stores that only Spark reaches, ``logs.read_framed_log`` reads whole files.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from logloom.sources.logs import EVENT, FRAME_MAGIC, BrokenLog, compress_batch, recover_prefix

NAME, SUFFIX = "framed_log", ".jsonl.zst"
SCHEMA = "session string, frame long, place long, line string, torn boolean"
#: Compressed bytes of a partition, rows of a frame that is written.
PARTITION_BYTES, FRAME_ROWS = 32 << 20, 1000
_SAFE = re.compile(r"[A-Za-z0-9._-]+")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _exactly(file: pa.NativeFile, at: int, n: int, size: int) -> bytes | None:
    """``n`` bytes at ``at``; None where the file ends before."""
    if at + n > size:
        return None
    file.seek(at)
    return file.read(n)


def frame_end(file: pa.NativeFile, start: int, size: int) -> int | None:
    """Where the frame at ``start`` ends, from its headers alone; None for a torn one."""
    magic = _exactly(file, start, 4, size)
    if magic is None:
        return None
    if magic != FRAME_MAGIC:
        raise BrokenLog(f"no frame at byte {start}")
    descriptor = _exactly(file, start + 4, 1, size)
    if descriptor is None:
        return None
    flags = descriptor[0]
    if flags & 0x08:
        raise BrokenLog(f"reserved bit in the header at byte {start + 4}")
    single, checksum = bool(flags & 0x20), bool(flags & 0x04)
    content = (1 if single else 0, 2, 4, 8)[flags >> 6]
    at = start + 5 + (0 if single else 1) + (0, 1, 2, 4)[flags & 3] + content
    while True:
        header = _exactly(file, at, 3, size)
        if header is None:
            return None
        block = int.from_bytes(header, "little")
        kind = block >> 1 & 3
        if kind == 3:
            raise BrokenLog(f"reserved block type at byte {at}")
        at += 3 + (1 if kind == 1 else block >> 3)
        if at > size:
            return None
        if block & 1:
            break
    at += 4 if checksum else 0
    return at if at <= size else None


@dataclass
class ByteRange(InputPartition):
    """Frames of one file that begin from ``low`` to before ``high``."""

    path: str
    session: str
    low: int
    high: int


class FramedLogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        system, root = _opened(self.options["path"])
        step = int(self.options.get("partition_bytes", PARTITION_BYTES))
        header_only = self.options.get("header_only", "false").lower() == "true"
        infos = system.get_file_info(fs.FileSelector(root, recursive=True)) if system.get_file_info(root).type == fs.FileType.Directory else [system.get_file_info(root)]
        wanted = json.loads(self.options["sessions"]) if "sessions" in self.options else None
        out: list[InputPartition] = []
        for info in sorted(infos, key=lambda i: i.path):
            session = info.base_name.removesuffix(SUFFIX)
            if info.type != fs.FileType.File or not info.base_name.endswith(SUFFIX) or wanted is not None and session not in wanted:
                continue
            starts = [0] if header_only else range(0, info.size, step)
            out += [ByteRange(info.path, session, low, 1 if header_only else low + step) for low in starts if info.size]
        return out or [ByteRange("", "", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        import zstandard

        if not partition.path:
            return
        system, _ = _opened(self.options["path"])
        with system.open_input_file(partition.path) as file:
            size, at = file.size(), 0
            while at < min(partition.high, size):
                end = frame_end(file, at, size)
                if at >= partition.low:
                    file.seek(at)
                    data = file.read((size if end is None else end) - at)
                    data = recover_prefix(data) if end is None else zstandard.ZstdDecompressor().decompressobj().decompress(data)
                    lines = [x for x in data.split(b"\n") if x.strip()]
                    n = len(lines)
                    columns = [pa.array([partition.session] * n, pa.string()), pa.array([at] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(lines, pa.binary()).cast(pa.string()), pa.array([end is None] * n, pa.bool_())]
                    yield pa.RecordBatch.from_arrays(columns, names=["session", "frame", "place", "line", "torn"])
                if end is None:
                    break
                at = end


@dataclass
class Files(WriterCommitMessage):
    """Files that a task wrote, under their passing and their own names."""

    moves: list[tuple[str, str]]


class FramedLogWriter(DataSourceArrowWriter):
    """Files by session; they get their names when all tasks are done, so a retry leaves no second one."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.names = options, schema.fieldNames()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _opened(self.options["path"])
        most = int(self.options.get("frame_rows", FRAME_ROWS))
        system.create_dir(root, recursive=True)
        moves: list[tuple[str, str]] = []
        out, current, held = None, None, []
        session, line = self.names.index("session"), self.names.index("line")

        def flush() -> None:
            if held:
                out.write(compress_batch("".join(f"{x}\n" for x in held).encode()))
                held.clear()

        for batch in iterator:
            for name, text in zip(batch.column(session).to_pylist(), batch.column(line).to_pylist()):
                if name is None or not _SAFE.fullmatch(name):
                    raise ValueError(f"a session's name can't be a file's: {name!r}")
                if name != current:
                    if out is not None:
                        flush()
                        out.close()
                    current, passing = name, f"{root}/{name}.{uuid.uuid4().hex}.part"
                    moves.append((passing, f"{root}/{name}{SUFFIX}"))
                    out = system.open_output_stream(passing, compression=None)
                held.append(text)
                if len(held) >= most:
                    flush()
        if out is not None:
            flush()
            out.close()
        return Files(moves)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = _opened(self.options["path"])
        moves = [m for message in messages if message for m in message.moves]
        if len({to for _, to in moves}) < len(moves):
            raise ValueError("rows of a session must lie in one partition, together")
        for passing, to in moves:
            system.move(passing, to)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = _opened(self.options["path"])
        for message in filter(None, messages):
            for passing, _ in message.moves:
                system.delete_file(passing)


class FramedLog(DataSource):
    """Lines of framed logs (``SCHEMA``); options: path, sessions, partition_bytes, header_only, frame_rows.

    Sessions are chosen by an option and not by a pushed filter: the engine keeps what a
    Python source once accepted for all later queries of the same DataFrame.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return FramedLogReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return FramedLogWriter(dict(self.options), schema)


def read_lines(spark: SparkSession, path: str, sessions: list[str] | None = None, header_only: bool = False, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Lines of all logs under ``path`` with session, frame (its first byte), place in it, and torn.

    ``sessions`` are those whose files are read, all if None; ``header_only`` reads the
    first frame of each file and no more; ``partition_bytes`` is how much of a file one
    task reads.
    """
    spark.dataSource.register(FramedLog)
    options = {"path": path, "header_only": str(header_only).lower(), "partition_bytes": str(partition_bytes)}
    if sessions is not None:
        options["sessions"] = json.dumps(sessions)
    return spark.read.format(NAME).options(**options).load()


def read_events(spark: SparkSession, path: str, schema: str = EVENT, **options: object) -> DataFrame:
    """Events of all logs under ``path``; a line that doesn't fit the schema fails the query."""
    return read_lines(spark, path, **options).select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("e")).select("e.*")


def write_log(log: DataFrame, path: str, frame_rows: int = FRAME_ROWS) -> None:
    """Events (session_id, seq and others) as framed files, a file a session, in seq order."""
    log.sparkSession.dataSource.register(FramedLog)
    rows = log.repartition("session_id").sortWithinPartitions("session_id", "seq")
    lines = rows.select(F.col("session_id").cast("string").alias("session"), F.to_json(F.struct(*log.columns)).alias("line"))
    lines.write.format(NAME).mode("append").option("path", path).option("frame_rows", frame_rows).save()
