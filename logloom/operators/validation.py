"""Checks of stored logs; each returns the rows that break a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.text import strip_space

#: Fixed value: the largest integer that JSON readers keep exactly.
MAX_SAFE = 2**53 - 1
#: Fixed value: the reason of headers in a form that is read no more.
RETIRED_REASON = "fallback"


def gaps(log: DataFrame) -> DataFrame:
    """Events whose seq doesn't follow the one before; a session starts at 0."""
    before = F.lag("seq").over(Window.partitionBy("session_id").orderBy("seq"))
    return log.withColumn("expected", F.coalesce(before + 1, F.lit(0))).filter(F.col("seq") != F.col("expected")).select("session_id", "seq", "expected")


def unknown_types(log: DataFrame, known: DataFrame) -> DataFrame:
    """Events of a type that isn't known and isn't marked as ignorable, and retired headers.

    Reads ignorable and, where the log has it, reason: a request header whose reason is
    ``RETIRED_REASON`` is refused although its type is known.
    """
    unknown = log.join(known.select("type").distinct(), "type", "left_anti").filter(~F.coalesce(F.col("ignorable"), F.lit(False))).select("session_id", "seq", "type")
    if "reason" not in log.columns:
        return unknown
    retired = log.join(known.select("type").distinct(), "type", "left_semi").filter((F.col("type") == "request/header") & (F.col("reason") == RETIRED_REASON))
    return unknown.unionByName(retired.select("session_id", "seq", "type"))


def unsafe_integers(log: DataFrame, *columns: str) -> DataFrame:
    """Events with an integer that is negative or beyond the safe range."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.coalesce((F.col(c) < 0) | (F.col(c) > MAX_SAFE), F.lit(False))
    return log.filter(bad).select("session_id", "seq", *columns)


def incompatible_headers(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
    """Sessions that two stores describe differently."""
    other = right.select("id", *(F.col(c).alias(f"other_{c}") for c in columns))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"other_{c}"))
    return left.join(other, "id").filter(~same).select("id", *columns, *(f"other_{c}" for c in columns))


def invalid_todo_lists(lists: DataFrame, parallel: bool = False) -> DataFrame:
    """Lists (id, items of content and status) that are blank, repeat, or run several."""
    contents = F.transform("items", lambda x: strip_space(F.coalesce(x["content"], F.lit(""))))
    blank, repeats = F.array_contains(contents, ""), F.size(F.array_distinct(contents)) < F.size("items")
    running = F.size(F.filter("items", lambda x: x["status"] == "in_progress"))
    reason = F.when(blank, "blank").when(repeats, "repeated")
    reason = reason if parallel else reason.when(running > 1, "several in progress")
    return lists.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select("id", "reason")


def append_closers(log: DataFrame, kind: str = "turn/end") -> DataFrame:
    """A synthetic ``kind`` event behind every session whose last turn didn't end."""
    turns = log.filter(F.col("type").isin("turn/start", "turn/end"))
    last = turns.groupBy("session_id").agg(F.max_by("type", "seq").alias("state"), F.max_by("turn", "seq").alias("turn"))
    tail = log.groupBy("session_id").agg(F.max("seq").alias("seq"), F.max("time").alias("time"))
    closers = last.filter(F.col("state") == "turn/start").join(tail, "session_id").select("session_id", (F.col("seq") + 1).alias("seq"), F.lit(kind).alias("type"), "time", "turn")
    return log.unionByName(closers, allowMissingColumns=True)
