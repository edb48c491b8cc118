"""The model-visible surface of a session: appended events, and ranges replaced by one.

A replacement takes the place of an inclusive range of current events.  Which range
an event still stands in depends on all replacements before it, so the fold is one
pass over a session in seq order; a task passes over one session after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOLDED = "session_id string, seq long, surface string, position int, shadowed_by long, delta_tokens long"
_ARROW = pa.schema([("session_id", pa.string()), ("seq", pa.int64()), ("surface", pa.string()), ("position", pa.int32()), ("shadowed_by", pa.int64()), ("delta_tokens", pa.int64())])
_ROWS = 10_000


class CorruptSurface(ValueError):
    """A replacement names a range that isn't current."""


def fold_session(session: str | None, events: list[tuple]) -> Iterator[tuple]:
    """One session: surface (current, shadowed, log-only), place, replacement, token delta.

    ``events`` are (seq, op, start, end, tokens) in seq order.  Current events are linked
    to their neighbours.  A replacement walks its range once and takes it out, so the
    fold is linear in the session.
    """
    after: dict[int | None, int | None] = {None: None}  # None stands before the first and behind the last
    before: dict[int | None, int | None] = {None: None}
    tokens: dict[int, int] = {}
    shadowed: dict[int, int] = {}
    deltas: dict[int, int] = {}
    for seq, op, start, end, cost in events:
        seq, cost = int(seq), 0 if cost is None or cost != cost else int(cost)
        if op == "append":
            left, right, deltas[seq] = before[None], None, cost
        elif op == "replace":
            gone, at = [], start
            while at in after and at is not None:
                gone.append(at)
                if at == end:
                    break
                at = after[at]
            if not gone or gone[-1] != end:
                raise CorruptSurface(f"session {session}: replacement at {seq} has no current range {start}-{end}")
            left, right = before[gone[0]], after[gone[-1]]
            for x in gone:
                del after[x], before[x]
                shadowed[x] = seq
            deltas[seq] = cost - sum(tokens[x] for x in gone)
        else:
            continue
        after[left] = before[right] = seq
        after[seq], before[seq], tokens[seq] = right, left, cost
    place: dict[int, int] = {}
    at = after[None]
    while at is not None:
        place[at] = len(place)
        at = after[at]
    for seq, *_ in events:
        yield session, seq, "current" if seq in place else "shadowed" if seq in shadowed else "log-only", place.get(seq), shadowed.get(seq), deltas.get(seq)


def fold_sessions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The folds of sessions whose events come one after another; one session is held at once."""

    def sessions() -> Iterator[tuple]:
        name, events = None, []
        for batch in batches:
            for session, *event in zip(*(c.to_pylist() for c in batch.columns)):
                if events and session != name:
                    yield name, events
                    events = []
                name = session
                events.append(event)
        if events:
            yield name, events

    out: list[tuple] = []
    for session in sessions():
        for row in fold_session(*session):
            out.append(row)
            if len(out) == _ROWS:
                yield pa.record_batch(list(zip(*out)), schema=_ARROW)
                out = []
    if out:
        yield pa.record_batch(list(zip(*out)), schema=_ARROW)


def fold_surface(log: DataFrame) -> DataFrame:
    """Surface state of every event; reads surface_op, start_seq, end_seq and tokens.

    Sessions are dealt whole over the tasks and read in order from one stream of rows: a
    pandas frame for each of many short sessions would cost several times their fold.
    """
    rows = log.select(F.col("session_id").cast("string").alias("session_id"), "seq", "surface_op", "start_seq", "end_seq", "tokens")
    return rows.repartition("session_id").sortWithinPartitions("session_id", "seq").mapInArrow(fold_sessions, FOLDED)


def current_nodes(log: DataFrame, folded: DataFrame) -> DataFrame:
    """The events of ``log`` that stand on the surface at its end, with their position."""
    current = folded.filter(F.col("surface") == "current").select("session_id", "seq", "position")
    return log.withColumn("session_id", F.col("session_id").cast("string")).join(current, ["session_id", "seq"])


def context_breakdown(log: DataFrame, folded: DataFrame) -> DataFrame:
    """System, tool and message tokens of the current surface of every session.

    Reads type, tokens and, of request headers, tools_tokens.  The last system message
    in surface order that has tokens is the system's; all else that is visible, also
    other system messages, counts as messages; tools are those of the last header.
    """
    rows = current_nodes(log.select("session_id", "seq", "type", "tokens"), folded)
    system = F.max_by("tokens", F.when((F.col("type") == "system/message") & (F.col("tokens") > 0), F.col("position")))
    sums = rows.groupBy("session_id").agg(F.coalesce(system, F.lit(0)).cast("long").alias("system_tokens"), F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("all"))
    tools = F.max_by("tools_tokens", F.when(F.col("type") == "request/header", F.col("seq")))
    sessions = log.groupBy(F.col("session_id").cast("string").alias("session_id")).agg(F.coalesce(tools, F.lit(0)).cast("long").alias("tools_tokens"))
    none = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    joined = sessions.join(sums, "session_id", "left")
    return joined.select("session_id", none("system_tokens").alias("system_tokens"), "tools_tokens", (none("all") - none("system_tokens")).alias("message_tokens"))


def surface_balance(log: DataFrame, folded: DataFrame) -> DataFrame:
    """Open tool calls before and behind each event of the current surface, in its order.

    Reads type and n_calls of assistant messages.  Returns session_id, seq, position,
    open_before, open_behind and corrupt: a result before it had no call left, so its
    session's surface can't be cut anywhere from there on.
    """
    rows = current_nodes(log.select("session_id", "seq", "type", "n_calls"), folded)
    delta = F.when(F.col("type") == "assistant/message", F.coalesce("n_calls", F.lit(0))).when(F.col("type") == "tool/result", -1).otherwise(0)
    order = Window.partitionBy("session_id").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("delta", delta.cast("long")).withColumn("open_behind", F.sum("delta").over(order))
    return rows.select("session_id", "seq", "position", (F.col("open_behind") - F.col("delta")).alias("open_before"), "open_behind", (F.min("open_behind").over(order) < 0).alias("corrupt"))


def surface_intervals(folded: DataFrame) -> DataFrame:
    """session_id, seq and until of each surface event: visible from seq to before until (null: to the end)."""
    return folded.filter(F.col("surface") != "log-only").select("session_id", "seq", F.col("shadowed_by").alias("until"))


def visible_at(events: DataFrame, folded: DataFrame, target: str = "target_seq") -> DataFrame:
    """``events`` with visible: whether ``target`` stood on the surface when the event came.

    An as-of join of intervals on session and seq: no event meets more than one.
    """
    spans = surface_intervals(folded).withColumnsRenamed({"seq": target, "until": "_until"}).withColumn("_shown", F.lit(True))
    joined = events.withColumn("session_id", F.col("session_id").cast("string")).join(spans, ["session_id", target], "left")
    shown = F.col("_shown") & (F.col(target) < F.col("seq")) & (F.col("_until").isNull() | (F.col("_until") > F.col("seq")))
    return joined.withColumn("visible", F.coalesce(shown, F.lit(False))).drop("_until", "_shown")


def route_price(nodes: DataFrame, prices: list[dict]) -> DataFrame:
    """Tokens of a session on each route: attachments at the route's price, not by structure.

    nodes: session_id, seq, tokens, image_tokens, file_tokens, n_images, n_files.
    prices: route, image_price, file_price (None: the structural price stays) of each route.
    """
    # the routes of a node stand in an array of one literal, so no join is needed
    routes = F.array(*(F.struct(F.lit(r["route"]).alias("route"), F.lit(r["image_price"]).cast("long").alias("image_price"), F.lit(r["file_price"]).cast("long").alias("file_price")) for r in prices))
    each = nodes.select("*", F.inline(routes))
    image = F.coalesce(F.col("n_images") * F.col("image_price"), F.col("image_tokens"))
    file = F.coalesce(F.col("n_files") * F.col("file_price"), F.col("file_tokens"))
    total = F.col("tokens") - F.col("image_tokens") - F.col("file_tokens") + image + file
    return each.groupBy("session_id", "route").agg(F.sum(total).cast("long").alias("tokens"))


def refused_offloads(log: DataFrame, images: DataFrame, folded: DataFrame) -> DataFrame:
    """session_id, seq and reason of each session's first image offload that breaks a rule.

    ``log`` has session_id, seq, type and, of image offloads, targets (seq and indexes);
    ``images`` has session_id, seq and index of every image.  Targets are at least one,
    each once, on the surface at the offload, a user's message or a tool's result; their
    indexes are at least one, rising from 0 or more, of images that exist and that no
    earlier offload took.  Of several faults the first in this order is the reason.
    """
    log, images = (x.withColumn("session_id", F.col("session_id").cast("string")) for x in (log, images))
    offloads = log.filter(F.col("type") == "image/offload").select("session_id", "seq", "targets")
    seqs = F.transform("targets", lambda t: t["seq"])
    rising = lambda x: F.size(x) == F.size(F.filter(x, lambda v, i: F.coalesce(v > F.coalesce(F.get(x, i - 1), F.lit(-1)), F.lit(False))))
    unordered = F.exists("targets", lambda t: (F.coalesce(F.size(t["indexes"]), F.lit(-1)) <= 0) | ~F.coalesce(rising(t["indexes"]), F.lit(False)))
    reason = F.when(F.coalesce(F.size("targets"), F.lit(-1)) <= 0, "no targets").when(F.size(F.array_distinct(seqs)) < F.size("targets"), "repeated target")
    form = offloads.select("session_id", "seq", reason.alias("reason"), F.coalesce(unordered, F.lit(False)).alias("unordered"))
    targets = visible_at(offloads.select("session_id", "seq", F.explode("targets").alias("t")).select("session_id", "seq", F.col("t.seq").alias("target_seq"), F.col("t.indexes").alias("indexes")), folded)
    kinds = log.filter(F.col("type").isin("user/message", "tool/result")).select("session_id", F.col("seq").alias("target_seq"), F.lit(True).alias("kind"))
    targets = targets.join(kinds, ["session_id", "target_seq"], "left").withColumn("typed", F.col("kind").isNotNull())
    places = targets.groupBy("session_id", "seq").agg(F.min("visible").alias("visible"), F.min("typed").alias("typed"))
    marks = targets.select("session_id", "seq", F.col("target_seq"), F.explode("indexes").alias("index"))
    held = images.select("session_id", F.col("seq").alias("target_seq"), "index").distinct().withColumn("held", F.lit(True))
    marks = marks.join(held, ["session_id", "target_seq", "index"], "left")
    before = F.min("seq").over(Window.partitionBy("session_id", "target_seq", "index"))
    marks = marks.withColumn("again", before < F.col("seq")).groupBy("session_id", "seq").agg(F.count("held").alias("held"), F.count(F.lit(1)).alias("n"), F.max("again").alias("again"))
    rows = form.join(places, ["session_id", "seq"], "left").join(marks, ["session_id", "seq"], "left")
    reason = (
        F.coalesce("reason", F.when(~F.col("visible"), "not on the surface").when(~F.col("typed"), "of another type").when(F.col("unordered"), "indexes not rising")
        .when(F.col("held") < F.col("n"), "no such image").when(F.col("again"), "offloaded before"))
    )
    refused = rows.select("session_id", "seq", reason.alias("reason")).filter("reason is not null")
    return refused.groupBy("session_id").agg(F.min(F.struct("seq", "reason")).alias("first")).select("session_id", "first.seq", "first.reason")


def offload_images(log: DataFrame, images: DataFrame, folded: DataFrame) -> DataFrame:
    """``images`` with offloaded: whether an offload took them.

    Replay ends at a session's first refused offload (``refused_offloads``); it and
    later ones take nothing.
    """
    refused = refused_offloads(log, images, folded).select("session_id", F.col("seq").alias("end"))
    offloads = log.filter(F.col("type") == "image/offload").select(F.col("session_id").cast("string").alias("session_id"), F.col("seq").alias("at"), F.explode("targets").alias("t"))
    marks = offloads.join(refused, "session_id", "left").filter(F.col("end").isNull() | (F.col("at") < F.col("end")))
    marks = marks.select("session_id", F.col("t.seq").alias("seq"), F.explode("t.indexes").alias("index")).distinct().withColumn("offloaded", F.lit(True))
    joined = images.withColumn("session_id", F.col("session_id").cast("string")).join(marks, ["session_id", "seq", "index"], "left")
    return joined.withColumn("offloaded", F.coalesce("offloaded", F.lit(False)))


def surface_totals(log: DataFrame) -> DataFrame:
    """The running token total of a surface whose replaced messages are priced beforehand.

    ``log`` has session_id, seq, op, tokens, start_seq and end_seq.  A "meter" event
    claims the price of a range for the event right after it; an "append" adds its
    tokens; a "replace" adds its tokens less the claim, or nothing where no claim
    stands.  Adds delta, total and contradicts: a claim for another range, whose delta
    is null and counts nothing.  Other events, null ones too, change nothing.
    """
    order = Window.partitionBy("session_id").orderBy("seq")
    claim = F.lag(F.when(F.col("op") == "meter", F.struct("start_seq", "end_seq", "tokens"))).over(order)
    rows = log.withColumn("claim", claim)
    claimed = (F.col("op") == "replace") & F.col("claim").isNotNull()
    same = F.col("claim.start_seq").eqNullSafe(F.col("start_seq")) & F.col("claim.end_seq").eqNullSafe(F.col("end_seq"))
    rows = rows.withColumn("contradicts", F.coalesce(claimed & ~same, F.lit(False)))
    delta = F.when(F.col("op") == "append", F.col("tokens")).when(F.col("contradicts"), None).when(claimed, F.col("tokens") - F.col("claim.tokens")).otherwise(0)
    rows = rows.withColumn("delta", delta.cast("long")).drop("claim")
    return rows.withColumn("total", F.coalesce(F.sum("delta").over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0).cast("long")))
