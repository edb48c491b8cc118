"""Session logs as JSON lines, plain or in Zstandard frames."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER = (
    "id string, version long, created_at long, cwd string, parent_session string, seed_length long,"
    " delegation_depth long, agent_preset string, revision string, generation long"
)
EVENT = (
    "session_id string, seq long, type string, time long, ignorable boolean, surface_op string, start_seq long, end_seq long,"
    " source_event_seqs array<long>, turn long, step long, data string"
)
#: Bytes of a log file that are given to the decompressor at once.
FEED_BYTES = 1 << 16
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"


class BrokenLog(ValueError):
    """A log file that isn't a sequence of Zstandard frames."""


def read_log(spark: SparkSession, path: str, schema: str = EVENT) -> DataFrame:
    """Events of JSON lines; a line that doesn't fit the schema fails the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_log(log: DataFrame, path: str, mode: str = "append") -> None:
    """Events as JSON lines; rows of a session stand in seq order."""
    log.sortWithinPartitions("session_id", "seq").write.mode(mode).json(path)


def partial_read(log: DataFrame, session_id: str, offset: int, length: int) -> DataFrame:
    """``length`` events of one session from ``offset`` on."""
    if offset < 0 or length < 0:
        raise ValueError("offset and length must not be negative")
    return log.filter((F.col("session_id") == session_id) & (F.col("seq") >= offset) & (F.col("seq") < offset + length)).orderBy("seq")


def scan_frames(content: bytes, max_frames: int | None = None) -> tuple[list[bytes], int | None]:
    """Complete frames' contents and where a torn last one starts (None: nowhere).

    ``max_frames`` stops early, which reads a header without its log.
    """
    import zstandard

    found, at = [], 0
    while at < len(content) and (max_frames is None or len(found) < max_frames):
        if content[at : at + 4] != FRAME_MAGIC[: len(content) - at]:
            raise BrokenLog(f"no frame at byte {at}")
        # a frame is fed in parts, so that what stands behind it is never copied
        engine, parts, end = zstandard.ZstdDecompressor().decompressobj(), [], at
        try:
            while not engine.eof and end < len(content):
                parts.append(engine.decompress(content[end : end + FEED_BYTES]))
                end = min(end + FEED_BYTES, len(content))
        except zstandard.ZstdError as error:
            raise BrokenLog(f"bad frame at byte {at}") from error
        if not engine.eof:
            return found, at
        found.append(b"".join(parts))
        at = end - len(engine.unused_data)
    return found, None


def recover_prefix(content: bytes) -> bytes:
    """What a torn frame still holds, up to the last whole line."""
    import zstandard

    out = io.BytesIO()
    try:
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content)) as reader:
            while chunk := reader.read(1 << 16):
                out.write(chunk)
    except zstandard.ZstdError:
        pass
    data = out.getvalue()
    return data[: data.rfind(b"\n") + 1]


def compress_batch(lines: bytes) -> bytes:
    """One checksummed frame."""
    import zstandard

    return zstandard.ZstdCompressor(write_checksum=True).compress(lines)


def read_framed_log(spark: SparkSession, path: str, schema: str = EVENT, recover: bool = True) -> DataFrame:
    """Events of Zstandard log files, one file to a task; a torn tail is recovered by lines."""
    files = spark.read.format("binaryFile").load(path)

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                frames, torn = scan_frames(content)
                if torn is not None and recover:
                    frames.append(recover_prefix(content[torn:]))
                for frame in filter(None, frames):
                    yield pd.DataFrame({"value": [x.decode() for x in frame.split(b"\n") if x.strip()]})

    text = files.select("content").mapInPandas(lines, "value string")
    return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("e")).select("e.*")
