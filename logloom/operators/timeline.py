"""Timelines, neighbours, retention windows and pages."""

from __future__ import annotations

import base64
import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_NEIGHBOURS = 50
DAY_MS = 86_400_000
#: Fixed value: source of the message that a compaction leaves.
CHECKPOINT = "compact-checkpoint"


def neighbours(log: DataFrame, session_id: object, seq: int, before: int, after: int) -> DataFrame:
    """Events around one event, at most ``MAX_NEIGHBOURS`` on either side."""
    if not (0 <= before <= MAX_NEIGHBOURS and 0 <= after <= MAX_NEIGHBOURS):
        raise ValueError(f"before and after must be from 0 to {MAX_NEIGHBOURS}")
    return log.filter((F.col("session_id") == session_id) & F.col("seq").between(seq - before, seq + after)).orderBy("seq")


def lane(kind: Column) -> Column:
    """2 for tools, 1 for messages and compactions, 0 for all else."""
    return F.when(kind.isin("tool", "subtool"), 2).when(kind.isin("message", "compacted"), 1).otherwise(0)


def compress_idle(spans: DataFrame) -> DataFrame:
    """Start and end of every span with idle time before it taken out.

    spans: session_id, span_id, start, end.  Idle is what no earlier span of the
    session covers; spans stand by start, end and span_id.
    """
    order = Window.partitionBy("session_id").orderBy("start", "end", "span_id")
    covered = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    gaps = spans.withColumn("gap", F.greatest(F.lit(0).cast("long"), F.coalesce(F.col("start") - covered, F.lit(0).cast("long"))))
    moved = gaps.withColumn("removed", F.sum("gap").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return moved.select("session_id", "span_id", (F.col("start") - F.col("removed")).alias("start"), (F.col("end") - F.col("removed")).alias("end"), "removed")


def timeline_extent(spans: DataFrame) -> DataFrame:
    """Start and end over all spans of a session."""
    return spans.groupBy("session_id").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def turn_boundaries(spans: DataFrame) -> DataFrame:
    """Where each numbered turn of a session starts."""
    return spans.filter(F.col("turn").isNotNull()).groupBy("session_id", "turn").agg(F.min("start").alias("time"))


def attach_to_next_visible(records: DataFrame) -> DataFrame:
    """Hidden records with the seq of the next visible one (null behind the last)."""
    ahead = Window.partitionBy("session_id").orderBy("seq").rowsBetween(1, Window.unboundedFollowing)
    host = F.first(F.when(F.col("visible"), F.col("seq")), ignorenulls=True).over(ahead)
    return records.withColumn("host_seq", F.when(F.col("visible"), F.col("seq")).otherwise(host)).select("session_id", "seq", "visible", "host_seq")


def retain_deliveries(deliveries: DataFrame, days: int, records: int) -> DataFrame:
    """Deliveries of a task within ``days`` of its newest append, and of these the last ``records``.

    deliveries: task_id, place (append order), delivered_at (ms).
    """
    whole = Window.partitionBy("task_id")
    newest = F.max_by("delivered_at", "place").over(whole)
    recent = deliveries.withColumn("floor", newest - days * DAY_MS).filter(F.col("delivered_at") >= F.col("floor")).drop("floor")
    nth = F.row_number().over(whole.orderBy(F.desc("place")))
    return recent.withColumn("nth", nth).filter(F.col("nth") <= records).drop("nth")


def _cursor_key(order: list[tuple[str, bool]]) -> str:
    return json.dumps(order, separators=(",", ":"))


def _digest(key: str, payload: str) -> str:
    return hashlib.sha256(f"{key}|{payload}".encode()).hexdigest()[:16]


def cursor_of(order: list[tuple[str, bool]]) -> Column:
    """An opaque text for a row's place in an order of columns, (name, whether falling).

    base64url of the values as a JSON array of texts, a dot, and a digest of it together
    with the order, so that a cursor of another listing isn't taken.
    """
    values = F.to_json(F.array(*(F.col(c).cast("string") for c, _ in order)))
    coded = F.rtrim(F.translate(F.base64(F.encode(values, "UTF-8")), "+/\r\n", "-_"), F.lit("="))
    digest = F.substring(F.sha2(F.concat(F.lit(_cursor_key(order) + "|"), values).cast("binary"), 256), 1, 16)
    return F.concat(coded, F.lit("."), digest)


def read_cursor(cursor: str, order: list[tuple[str, bool]]) -> list[str | None]:
    """The values of a cursor; a ValueError for one that isn't whole, canonical or of this order."""
    coded, _, digest = cursor.partition(".")
    try:
        payload = base64.b64decode(coded + "=" * (-len(coded) % 4), altchars=b"-_", validate=True).decode()
        values = json.loads(payload)
    except ValueError as error:
        raise ValueError("broken cursor") from error
    if base64.urlsafe_b64encode(payload.encode()).decode().rstrip("=") != coded or _digest(_cursor_key(order), payload) != digest:
        raise ValueError("cursor of another listing")
    if not isinstance(values, list) or len(values) != len(order) or not all(v is None or isinstance(v, str) for v in values):
        raise ValueError("broken cursor")
    return values


def behind(rows: DataFrame, order: list[tuple[str, bool]], cursor: str) -> Column:
    """Whether a row stands behind a cursor; nulls are first in rising columns, last in falling ones."""
    found, same = F.lit(False), F.lit(True)
    for (name, falling), value in zip(order, read_cursor(cursor, order)):
        here = F.lit(value).cast(rows.schema[name].dataType)
        if value is None:
            later = F.lit(False) if falling else F.col(name).isNotNull()
        else:
            later = (F.col(name) < here) | F.col(name).isNull() if falling else F.coalesce(F.col(name) > here, F.lit(False))
        found = found | (same & later)
        same = same & F.col(name).eqNullSafe(here)
    return F.coalesce(found, F.lit(False))


def keyset_page(rows: DataFrame, order: list[tuple[str, bool]], limit: int, cursor: str | None = None) -> DataFrame:
    """The ``limit`` rows behind ``cursor`` in an order that tells all rows apart, each with its own cursor."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    rest = rows if cursor is None else rows.filter(behind(rows, order, cursor))
    by = [F.desc_nulls_last(c) if falling else F.asc_nulls_first(c) for c, falling in order]
    return rest.orderBy(*by).limit(limit).withColumn("cursor", cursor_of(order))


def newest_page(rows: DataFrame, key: str, limit: int, before: object | None = None) -> DataFrame:
    """The ``limit`` rows with the largest keys below the cursor, newest first."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    below = rows if before is None else rows.filter(F.col(key) < F.lit(before))
    return below.orderBy(F.desc(key)).limit(limit)


def conversation(surface: DataFrame) -> DataFrame:
    """What was said on the current surface: session_id, seq, role, text and checkpoint.

    Reads source_kind and text.  A user's message counts if a user wrote it or if it is
    a compaction's checkpoint; injected context, tools and empty texts don't.
    """
    checkpoint = F.coalesce(F.col("source_kind") == CHECKPOINT, F.lit(False)) & (F.col("type") == "user/message")
    said = (F.col("type") == "assistant/message") | (F.col("type") == "user/message") & F.col("source_kind").isin("user", CHECKPOINT)
    role = F.when(F.col("type") == "user/message", "user").otherwise("assistant")
    return surface.filter(said & (F.coalesce("text", F.lit("")) != "")).select("session_id", "seq", role.alias("role"), "text", checkpoint.alias("checkpoint"))
