"""The same folds over streams: state per session, kept by Spark.

State rows hold the version of their fold; a fold of another version starts anew and
is replayed from its source.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE_VERSION = 2
STATE = "version int, turns long, steps long, last_turn long, tool_ms long, calls map<string, long>"
VIEW = "session_id string, turns long, steps long, tool_ms long"


def apply_events(state: tuple, events: pd.DataFrame) -> tuple:
    """(turns, steps, last turn, tool time, open calls) after some events in order.

    A null turn isn't remembered and counts as new behind a numbered one; a null time
    adds nothing.
    """
    turns, steps, last, tool_ms, calls = state
    calls = dict(calls)
    for kind, time, turn, call in zip(events["type"], events["time"], events["turn"], events["call_id"]):
        turn, time, call = (None if pd.isna(x) else x for x in (turn, time, call))
        if kind == "step/end":
            turns, steps, last = turns + (last != turn), steps + 1, last if turn is None else int(turn)
        elif kind == "tool/call":
            calls[call or ""] = -1 if time is None else int(time)
        elif kind == "tool/result" and (call or "") in calls:
            began = calls.pop(call or "")
            tool_ms += max(0, int(time) - began) if time is not None and began >= 0 else 0
        elif kind == "turn/end":
            calls = {}
    return turns, steps, last, tool_ms, calls


def _update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    old = state.get if state.exists else None
    current = (0, 0, None, 0, {}) if old is None or old[0] != STATE_VERSION else (old[1], old[2], old[3], old[4], old[5] or {})
    events = pd.concat(list(batches), ignore_index=True).sort_values("seq")
    current = apply_events(current, events)
    state.update((STATE_VERSION, *current))
    yield pd.DataFrame({"session_id": [key[0]], "turns": [current[0]], "steps": [current[1]], "tool_ms": [current[3]]})


def stream_stats(events: DataFrame) -> DataFrame:
    """A stream's sessions with their counts so far, in update mode.

    Reads session_id, seq, type, time, turn and call_id; a session's events must come
    in seq order from batch to batch.
    """
    rows = events.select(F.col("session_id").cast("string").alias("session_id"), "seq", "type", "time", "turn", "call_id")
    return rows.groupBy("session_id").applyInPandasWithState(_update, VIEW, STATE, "update", GroupStateTimeout.NoTimeout)


def usable_states(states: DataFrame, headers: DataFrame) -> DataFrame:
    """Stored states that were folded from the very log which their session has now.

    Both read session_id, format_version, created_at, cwd, is_seeded and
    inherited_event_count.  An id names a slot that may be filled anew, so all of them
    must agree; a state without a format version proves nothing, and one without
    lineage is of an unseeded log.
    """
    names = {"format_version": None, "created_at": None, "cwd": None, "is_seeded": False, "inherited_event_count": 0}
    now = headers.select("session_id", *(F.col(c).alias(f"now_{c}") for c in names))
    plain = lambda c, default: F.col(c) if default is None else F.coalesce(c, F.lit(default))
    same = F.col("format_version").isNotNull()
    for c, default in names.items():
        same = same & plain(c, default).eqNullSafe(plain(f"now_{c}", default))
    return states.join(now, "session_id").filter(same).select(*states.columns)


def telemetry_records(events: DataFrame) -> DataFrame:
    """Events as telemetry records: severity, attributes and body."""
    severity = F.coalesce("severity", F.lit("INFO")) if "severity" in events.columns else F.lit("INFO")
    attributes = F.create_map(F.lit("session"), F.col("session_id").cast("string"), F.lit("type"), F.col("type"), F.lit("seq"), F.col("seq").cast("string"))
    return events.select(severity.alias("severity"), attributes.alias("attributes"), F.col("body"))


def mirror(records: DataFrame, path: str, checkpoint: str, redact=lambda column: column):
    """Store a stream of telemetry records under a folder, through a redaction hook.

    Each batch lies under its own number, so one that is retried replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("body", redact(F.col("body"))).write.mode("overwrite").json(f"{path}/batch={number}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
