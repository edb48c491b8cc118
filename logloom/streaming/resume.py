"""Session statistics over streams that resume from stored checkpoints.

A checkpoint row holds a session's fold: key, ver (of the fold), seq (the last event in
it) and val (JSON).  A stream starts from such rows as its initial state and skips what
they already hold; rows of another version, or of another log under the same id, are
left out, and their sessions are folded from their first event.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from logloom.streaming.folds import usable_states

KEY, VERSION = "sessionStats", 2
COUNTERS = ("turns", "steps", "llm_ms", "tool_ms", "ttft_ms", "ttft_steps", "decode_ms", "decode_tokens")
READS = {"seq": "long", "type": "string", "time": "long", "turn": "long", "step": "long", "call_id": "string", "first_token_time": "long", "output_tokens": "long"}
STATE = "seq long, val string"
FOLDED = "session_id string, seq long, val string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_state() -> dict:
    """The fold of no event: counters, the last turn that ended a step, the open step, calls without a result."""
    return dict.fromkeys(COUNTERS, 0) | {"last_turn": None, "open": None, "calls": []}


def _span(start: int | None, end: int | None) -> int:
    return 0 if start is None or end is None else max(0, end - start)


def apply_event(state: dict, event: dict) -> None:
    """Fold one event into ``state``.

    Null turns and steps never match an open step, and a null turn neither counts as
    new behind itself nor is remembered; null times add nothing; a null call id is an id
    like others; negative token numbers are none.
    """
    kind, time, turn = event["type"], event["time"], event["turn"]
    opened = state["open"]
    matches = opened is not None and None not in (turn, event["step"]) and opened[:2] == [turn, event["step"]]
    if kind == "step/start":
        state["open"] = [turn, event["step"], time, None]
    elif kind == "assistant/attempt" and matches:
        opened[3] = event["first_token_time"] if opened[3] is None else opened[3]
    elif kind == "assistant/message" and matches:
        first = event["first_token_time"] if opened[3] is None else opened[3]
        state["llm_ms"] += _span(opened[2], time)
        state["open"] = None
        if first is not None:
            tokens = event["output_tokens"]
            if opened[2] is not None:
                state["ttft_ms"] += _span(opened[2], first)
                state["ttft_steps"] += 1
            if tokens is not None and tokens >= 0:
                state["decode_ms"] += _span(first, time)
                state["decode_tokens"] += tokens
    elif kind == "tool/call":
        state["calls"] = [c for c in state["calls"] if c[0] != event["call_id"]] + [[event["call_id"], time]]
    elif kind == "tool/result":
        found = next((c for c in state["calls"] if c[0] == event["call_id"]), None)
        if found:
            state["calls"].remove(found)
            state["tool_ms"] += _span(found[1], time)
    elif kind == "step/end":
        state["turns"] += turn != state["last_turn"]
        state["steps"] += 1
        state["last_turn"] = state["last_turn"] if turn is None else turn
        state["open"] = None
    elif kind == "turn/end":
        state["calls"] = []


def read_event(text: str) -> dict:
    """An event from the JSON array of ``READS`` as text that it travels as."""
    return {c: v if v is None or READS[c] == "string" else int(v) for c, v in zip(READS, json.loads(text))}


class StatsProcessor(StatefulProcessor):
    """The fold of one session, kept by the state store.

    It gets rows and gives one, of few columns, as each cell is handed over by itself: a
    pandas frame for each session, or an event's columns, would cost many times the fold.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fold = handle.getValueState("fold", STATE)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.fold.update((initialState["seq"], initialState["val"]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, val = self.fold.get() or (-1, None)
        state = new_state() if val is None else json.loads(val)
        events = [read_event(r["event"]) for r in rows]
        for event in sorted((e for e in events if e["seq"] is not None), key=lambda e: e["seq"]):
            if event["seq"] > last:
                apply_event(state, event)
                last = event["seq"]
        val = json.dumps(state)
        self.fold.update((last, val))
        yield Row(session_id=key[0], seq=last, val=val)

    def close(self) -> None:
        pass


def resumed_stats(events: DataFrame, checkpoints: DataFrame | None = None) -> DataFrame:
    """A checkpoint row for each session and micro-batch that has events of it, with the eight counters.

    Args:
        events: a stream of session_id and ``READS``.  A session's events come in seq order
            from batch to batch; inside a batch they may stand in any order, and events up
            to the state's seq are skipped, so a retried or overlapping source counts once.
            A batch, which the source's own limits bound, holds what is in memory at once.
        checkpoints: at most one row a session (``latest_checkpoints``).

    The session's state store becomes RocksDB, which this operator needs.  Events with a
    null session_id are one session; a null seq can't be placed and is skipped.
    """
    spark = events.sparkSession
    spark.conf.set(_PROVIDER, _ROCKS)
    event = F.to_json(F.array(*(F.col(c).cast(kind).cast("string") for c, kind in READS.items())))
    rows = events.select(F.coalesce(F.col("session_id").cast("string"), F.lit("")).alias("session_id"), event.alias("event"))
    initial = None if checkpoints is None else checkpoints.select("session_id", "seq", "val").groupBy("session_id")
    folded = rows.groupBy("session_id").transformWithState(StatsProcessor(), FOLDED, "Update", "None", initial)
    counters = F.from_json("val", ", ".join(f"{c} long" for c in COUNTERS))
    return folded.select("session_id", F.lit(KEY).alias("key"), F.lit(VERSION).alias("ver"), "seq", "val", counters.alias("c")).select("session_id", "key", "ver", "seq", "val", "c.*")


def write_checkpoints(stats: DataFrame, folder: str, progress: str, report: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Run ``stats`` over what its source holds and store each batch under its own number.

    A batch that is retried replaces itself.  ``progress`` is the stream's own
    checkpoint folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")
        if report:
            report(batch, number)

    return stats.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start()


def latest_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """The stored row with the highest seq of each session; batches of one run rise in seq."""
    rows = spark.read.parquet(folder)
    columns = [c for c in rows.columns if c not in ("session_id", "batch")]
    last = rows.groupBy("session_id").agg(F.max_by(F.struct(*columns), F.struct("seq", "batch")).alias("row"))
    return last.select("session_id", "row.*")


def usable_checkpoints(checkpoints: DataFrame, stored_headers: DataFrame, headers: DataFrame) -> DataFrame:
    """Checkpoints of this fold's key and version whose session still has the log that they were folded from.

    Both headers are read as ``usable_states`` says: those that stood beside the
    checkpoints when they were written, and those of the logs now.
    """
    own = checkpoints.filter((F.col("key") == KEY) & (F.col("ver") == VERSION))
    names = ("format_version", "created_at", "cwd", "is_seeded", "inherited_event_count")
    joined = own.join(stored_headers.select("session_id", *names), "session_id")
    return usable_states(joined, headers).drop(*names)
