"""Shared pieces of the training-data operators: column picking, scratch tables.

Scratch tables cut lineage.  They are Parquet tables in the folder that the
session names in ``spark.checkpoint.dir``, which all executors share, so a lost
executor costs a re-read and not a recomputation.  Only where the session names
no folder and runs on one machine (tests) is a temporary one made.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes that a Python task gets at once; the engine and the worker hold a batch more than once.
BATCH_BYTES = 8 << 20
#: 64-bit words of a Bloom filter at most (2 MB); more ids only let more others through.
BLOOM_WORDS = 1 << 18
BLOOM_BITS_EACH, BLOOM_HASHES = 10, 4
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; on one machine a fresh local one where none is named."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = "file://" + tempfile.mkdtemp(prefix="logloom-")
    return _local_dirs[app]


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_BYTES``; smaller ones stay as they are."""
    now = spark.conf.get(BATCH_CONF).lower()
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now)) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def new_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), "logloom", f"{label}-{uuid.uuid4().hex}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Hadoop's own file system layer."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Parquet tables that hold an operator's intermediate results."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}
        bound_batches(spark)

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` once and return it as read back from the shared folder."""
        path = new_path(self.spark, f"{self.label}-{name}")
        df.write.option("compression", "zstd").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, self.paths.pop(name))

    def keep(self, *names: str) -> None:
        """Drop all tables but those that the result still reads."""
        self.drop(*(name for name in list(self.paths) if name not in names))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly ``names`` of ``df``, whatever else it holds.

    Columns are addressed by position, so that an extra column whose name differs
    only in case, or one repeated, can't make a reference ambiguous.
    """
    bound_batches(df.sparkSession)
    columns = df.columns
    at = [columns.index(name) for name in names]
    plain = df.toDF(*(f"c{i}" for i in range(len(columns))))
    return plain.select(*(F.col(f"c{i}").alias(name) for i, name in zip(at, names)))


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def tasks_for(spark: SparkSession) -> int:
    """The partition count that the session asks for; it grows with the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Bloom filters ------------------------------------------------------------------


def _bloom_places(ids: np.ndarray, words: int) -> np.ndarray:
    """The bits of each id, a row for each hash."""
    out = []
    for i in range(1, BLOOM_HASHES + 1):
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i)
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        out.append((x >> np.uint64(32)) % np.uint64(64 * words))
    return np.stack(out)


def bloom_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the one long column of ``ids``, of bounded size.

    It spares a join's larger side the shuffle of rows that can't match; the join
    itself still decides.
    """
    ids = ids.toDF("id").filter("id is not null")
    words = min(BLOOM_WORDS, max(64, -(-ids.count() * BLOOM_BITS_EACH // 64)))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(_bloom_places(batch.column(0).to_numpy(), words))
            masks = np.uint64(1) << (places & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((places >> np.uint64(6)).astype(np.int32)), pa.array(masks.view(np.int64))], names=["word", "mask"])

    marked = ids.mapInArrow(mark, "word int, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(words, dtype=np.uint64)
    bits[marked.column(0).to_numpy()] = marked.column(1).to_numpy().view(np.uint64)
    return bits


def maybe_in(bits: np.ndarray, ids: pa.Array) -> np.ndarray:
    """Which ids the filter may hold; null ids it doesn't."""
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    places = _bloom_places(values, len(bits))
    held = ((bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)).all(axis=0)
    return held & ids.is_valid().to_numpy(zero_copy_only=False)


def filter_rows(rows: DataFrame, id_at: int, bits: np.ndarray) -> DataFrame:
    """Rows whose long id at position ``id_at`` the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe_in(bits, batch.column(id_at).cast(pa.int64()))))

    return rows.mapInArrow(run, rows.schema)


def change_with_few(rows: DataFrame, id_name: str, few: DataFrame, change: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str) -> DataFrame:
    """``change`` of ``rows`` left-joined with ``few``; only rows that may have a partner are shuffled.

    ``few`` has the id column and one more, which stands last in the batches that
    ``change`` gets; it is read twice, so save it before.  The others are changed
    where they are read, in the function that filters them.
    """
    names, added = rows.columns, next(c for c in few.columns if c != id_name)
    at, bits, empty = names.index(id_name), bloom_filter(few.select(id_name)), to_arrow_type(few.schema[added].dataType)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~maybe_in(bits, batch.column(at).cast(pa.int64()))))
            yield change(pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, empty)], names=[*batch.schema.names, "added"]))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(change, batches)

    # an added column can't be told from one of the same name, so all are numbered
    left = filter_rows(rows, at, bits).toDF(*(f"c{i}" for i in range(len(names))))
    right = few.select(F.col(id_name).alias("few_id"), F.col(added).alias("few_added"))
    joined = left.join(right, F.col(f"c{at}") == F.col("few_id"), "left").select(*left.columns, "few_added")
    return joined.mapInArrow(held, schema).unionAll(rows.mapInArrow(others, schema))
