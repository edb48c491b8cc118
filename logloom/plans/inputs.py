"""Session logs derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.functions.records import utc_millis

#: Event kinds of the log that stand for the table's event types.
KINDS = {"view": "step/start", "click": "assistant/message", "error": "tool/call", "purchase": "tool/result", "signup": "step/end"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt evenly over a shuffle's tasks: heavy work on a narrow table, whose few bytes would give few tasks."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession) -> None:
    """Python tasks get at most 8 MB of whole rows at once, for work whose results outgrow its input."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)


def conversation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as sessions: a message a turn."""
    rows = table(spark, sf_dir, "conversations")
    return rows.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("seq"), F.concat("role", F.lit("/message")).alias("type"), F.col("turn").alias("turn"), "role", "text")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as sessions of its users.

    seq counts a user's events by event_id; turns have twenty events and steps five; a
    turn's last event is its end; the call id is the number in props modulo 4.
    """
    rows = table(spark, sf_dir, "events")
    seq = (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).cast("long")
    kinds = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    rows = rows.select(F.col("user_id").alias("session_id"), seq.alias("seq"), kinds[F.col("event_type")].alias("kind"), utc_millis(F.col("ts")).alias("time"), "value", "event_id",
                       (F.regexp_extract("props", r"(\d+)", 1).cast("long") % 4).cast("string").alias("call_id"))
    turn, step = F.floor(F.col("seq") / 20), F.floor(F.col("seq") / 5)
    kind = F.when(F.col("seq") % 20 == 19, "turn/end").otherwise(F.col("kind"))
    return rows.select(
        "session_id", "seq", kind.alias("type"), "time", turn.cast("long").alias("turn"), step.cast("long").alias("step"), "call_id", "value", "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("time") - 5).alias("first_token_time"), F.when(F.col("event_id") % 5 != 0, F.floor("value").cast("long")).alias("output_tokens"),
    )
