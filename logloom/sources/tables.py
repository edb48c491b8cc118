"""Keyed tables and the task dataset, as Parquet and JSON under a folder."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.functions.records import blob_key, blob_shard, bucket_for

KEYED = "key string, value string, version long, deleted boolean"
INDEX = (
    "task_id string, status string, attempts int, selected_attempt_id string, integrity_flags array<string>,"
    " teacher struct<provider: string, model: string>, file_capture struct<git: boolean, coverage: string>,"
    " started_at string, finished_at string, dataset_dir string"
)


def latest(changes: DataFrame, key: str = "key", order: str = "version") -> DataFrame:
    """The last change of every key; deleted keys are gone."""
    newest = changes.groupBy(key).agg(F.max_by(F.struct(*changes.columns), order).alias("row")).select("row.*")
    return newest.filter(~F.coalesce(F.col("deleted"), F.lit(False))).drop("deleted")


def put(spark: SparkSession, folder: str, rows: DataFrame) -> None:
    """Append upserts (key, value, version)."""
    rows.select("key", "value", "version", F.lit(False).alias("deleted")).write.mode("append").parquet(folder)


def delete(spark: SparkSession, folder: str, keys: DataFrame) -> None:
    """Append deletions (key, version)."""
    keys.select("key", F.lit(None).cast("string").alias("value"), "version", F.lit(True).alias("deleted")).write.mode("append").parquet(folder)


def load(spark: SparkSession, folder: str) -> DataFrame:
    return latest(spark.read.schema(KEYED).parquet(folder))


def put_global(spark: SparkSession, folder: str, value: str, version: int) -> None:
    """Set a unit's one value beside its table."""
    spark.range(1).select(F.lit("").alias("key"), F.lit(value).alias("value"), F.lit(version).cast("long").alias("version"), F.lit(False).alias("deleted")).write.mode("append").parquet(f"{folder}-global")


def load_global(spark: SparkSession, folder: str) -> str | None:
    """The unit's one value as last set; None before."""
    try:
        row = load(spark, f"{folder}-global").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return row["value"]


def load_documents(spark: SparkSession, folder: str, versions: list[int]) -> DataFrame:
    """One JSON document per file; bad JSON and other versions read as absent."""
    text = spark.read.option("wholetext", True).text(folder)
    parsed = text.select(F.from_json("value", "version long, key string, value string").alias("d")).select("d.*")
    return parsed.filter(F.col("version").isin(versions) & F.col("key").isNotNull())


def write_tasks(tasks: DataFrame, root: str) -> None:
    """Append tasks to their buckets' folders; earlier calls' tasks stay until they come again.

    Nothing is rewritten: ``read_tasks`` takes each task's last version, so a task
    stands in its latest bucket alone.  Of one call's rows the last finished counts.
    """
    last = Window.partitionBy("task_id").orderBy(F.desc("finished_at"), F.desc("attempts"))
    newest = tasks.withColumn("nth", F.row_number().over(last)).filter("nth = 1").drop("nth")
    bucket = F.regexp_replace(bucket_for(F.col("status"), F.col("error_class")), "/", "_")
    newest.withColumn("written_ns", F.lit(time.time_ns())).withColumn("bucket", bucket).write.mode("append").partitionBy("bucket").parquet(f"{root}/tasks")


def read_tasks(spark: SparkSession, root: str) -> DataFrame:
    """Every task as last written, with its bucket."""
    rows = spark.read.parquet(f"{root}/tasks").withColumn("bucket", F.col("bucket").cast("string"))
    return rows.groupBy("task_id").agg(F.max_by(F.struct(*rows.columns), "written_ns").alias("row")).select("row.*").drop("written_ns")


def write_attempts(attempts: DataFrame, root: str) -> None:
    """Every attempt of every task, in a table of their own."""
    attempts.write.mode("append").parquet(f"{root}/attempts")


def append_index(entries: DataFrame, root: str) -> None:
    entries.write.mode("append").json(f"{root}/index")


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """All index lines; blank ones are skipped, a malformed one fails the query."""
    lines = spark.read.text(f"{root}/index").filter(F.trim("value") != "")
    return lines.select(F.from_json("value", INDEX, {"mode": "FAILFAST"}).alias("entry")).select("entry.*")


def put_blobs(blobs: DataFrame, root: str) -> DataFrame:
    """Contents under their digest, sharded by its first two digits; returns the keys."""
    keyed = blobs.select(blob_key(F.col("content")).alias("key"), "content").dropDuplicates(["key"]).withColumn("shard", blob_shard(F.col("key")))
    keyed.write.mode("append").partitionBy("shard").parquet(f"{root}/blobs")
    return keyed.select("key", F.octet_length("content").alias("bytes"))


def get_blobs(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """Contents of the keys; the shards of other keys aren't read."""
    stored = spark.read.parquet(f"{root}/blobs").withColumn("shard", F.col("shard").cast("string"))
    wanted = keys.select("key", blob_shard(F.col("key")).alias("shard")).distinct()
    return stored.join(wanted, ["shard", "key"], "left_semi").dropDuplicates(["key"]).select("key", "content")
