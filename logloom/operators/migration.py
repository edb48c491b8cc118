"""Steps from one stored log version to the next; each takes and gives a log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CURRENT_VERSION = 4
#: Plugins whose messages have another kind from version 4 on, and those whose kind is their name.
RENAMED_PRODUCERS = {"compact": "compact-checkpoint", "tools-code-mode": "ptc-mode", "tools-ptc": "ptc-mode"}
SAME_PRODUCERS = (
    "agent-instructions", "session-reference", "team-message", "goal", "skill-invocation", "skill-catalog", "coordinator", "subagent-report", "subagent-settled",
    "webhook", "agent-message", "model-selection", "plan-mode", "time-context", "tmux-context", "user-approval", "repeat-tool-reminder", "tool-cordis",
    "cordis-host-runner", "tool-goal", "tool-jobs", "hooks-codex", "hooks-claude-code", "schedule",
)
#: Presets that version 3 renames, and the kind of its system messages.
PRESET_NAMES = {"code": "ptc"}
SYSTEM_KIND = "system-prompt"


def complete_envelope(log: DataFrame) -> DataFrame:
    """v0 to v1: optional envelope fields get their defaults."""
    filled = log.withColumn("ignorable", F.coalesce("ignorable", F.lit(False)))
    return filled.withColumn("source_event_seqs", F.coalesce("source_event_seqs", F.array().cast("array<bigint>")))


def check_references(log: DataFrame) -> DataFrame:
    """v1 to v2: a citation must name an earlier event; others fail the query."""
    bad = F.exists("source_event_seqs", lambda s: (s >= F.col("seq")) | (s < 0))
    message = F.concat(F.lit("bad citation at seq "), F.col("seq").cast("string"))
    return log.withColumn("seq", F.when(bad, F.raise_error(message).cast("long")).otherwise(F.col("seq")))


def insert_system_messages(log: DataFrame) -> DataFrame:
    """v2 to v3: the system prompt becomes messages of its own, and events get new numbers.

    Reads system_text of request/header events.  The first step/start is followed by
    an empty system message; a header whose prompt differs from the one before is
    preceded by a message with it, which replaces, and cites, the last.  A changed
    prompt outside an open step fails the query.  Every citation follows its event to
    the new number; the preset is renamed.
    """
    past = Window.partitionBy("session_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    kind = F.col("type")
    prompt = F.when(kind == "request/header", F.coalesce("system_text", F.lit("")))
    step = F.last(F.when(kind.isin("step/start", "step/end", "turn/end"), kind), ignorenulls=True).over(past)
    rows = log.withColumn("prompt", prompt).withColumn("known", F.coalesce(F.last(prompt, ignorenulls=True).over(past), F.lit(""))).withColumn("step_state", step)
    first = F.min(F.when(kind == "step/start", F.col("seq"))).over(Window.partitionBy("session_id"))
    rows = rows.withColumn("first_step", first)
    changed = F.coalesce(F.col("prompt") != F.col("known"), F.lit(False))
    outside = changed & ~F.coalesce(F.col("step_state") == "step/start", F.lit(False))
    message = F.concat(F.lit("changed prompt outside a step at seq "), F.col("seq").cast("string"))
    text = F.when(outside, F.raise_error(message)).when(changed, F.col("prompt")).otherwise("")
    opening = F.coalesce(F.col("seq") == F.col("first_step"), F.lit(False))
    rank = F.array_compact(F.array(F.when(changed, 0), F.lit(1), F.when(opening, 2)))
    both = rows.withColumn("text", F.coalesce(F.col("text"), F.lit(None).cast("string"))).withColumn("said", text).withColumn("rank", F.explode(rank))
    order = Window.partitionBy("session_id").orderBy("seq", "rank")
    both = both.withColumn("new_seq", F.row_number().over(order).cast("long") - 1).withColumn("system", F.col("rank") != 1)
    head = F.last(F.when(F.col("system"), F.col("new_seq")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    both = both.withColumn("head", head)
    names = both.filter("not system").select("session_id", F.col("seq").alias("cited"), F.col("new_seq").alias("new_cited"))
    cites = both.filter("not system").select("session_id", "new_seq", F.posexplode("source_event_seqs").alias("at", "cited")).join(names, ["session_id", "cited"])
    moved = cites.groupBy("session_id", "new_seq").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "new_cited"))), lambda x: x["new_cited"]).alias("moved"))
    joined = both.join(moved, ["session_id", "new_seq"], "left")
    preset = reduce(lambda c, pair: F.when(F.col("preset") == pair[0], pair[1]).otherwise(c), PRESET_NAMES.items(), F.col("preset"))
    none = F.array().cast("array<bigint>")
    own = lambda c: F.when(~F.col("system"), F.col(c))
    kept = {
        "seq": F.col("new_seq"), "type": F.when(F.col("system"), "system/message").otherwise(kind), "text": F.when(F.col("system"), F.col("said")).otherwise(F.col("text")),
        "source_event_seqs": F.when(F.col("system"), F.when(F.col("head").isNotNull(), F.array("head")).otherwise(none)).otherwise(F.coalesce("moved", none)),
        "preset": preset, "system_text": F.lit(None).cast("string"), "source_kind": F.when(F.col("system"), SYSTEM_KIND).otherwise(F.col("source_kind")), "plugin": own("plugin") if "plugin" in log.columns else None,
    }
    return joined.select(*(kept.get(c, F.col(c)).alias(c) for c in log.columns))


def rename_sources(log: DataFrame, producers: dict[str, str] | None = None) -> DataFrame:
    """v3 to v4: sources of kind plugin get their producer's kind; others stay.

    Reads source_kind and plugin, which is emptied.  A plugin without a kind of its own becomes
    ``plugin:`` and its name.  ``producers`` names further plugins' kinds.
    """
    if "plugin" not in log.columns:
        return log
    kinds = {x: x for x in SAME_PRODUCERS} | RENAMED_PRODUCERS | (producers or {})
    known = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))
    kind = F.when(F.col("source_kind") == "plugin", F.coalesce(known[F.col("plugin")], F.concat(F.lit("plugin:"), F.col("plugin")))).otherwise(F.col("source_kind"))
    return log.withColumn("source_kind", kind).withColumn("plugin", F.lit(None).cast("string"))


def child_facts(log: DataFrame) -> DataFrame:
    """v3 to v4: sessions with exactly one descriptor, and it; others have a placeholder."""
    descriptors = log.filter(F.col("type") == "subagent/descriptor").groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.max_by("text", "seq").alias("descriptor"))
    sessions = log.select("session_id").distinct().join(descriptors, "session_id", "left")
    return sessions.select("session_id", F.when(F.col("n") == 1, F.col("descriptor")).otherwise("unknown").alias("descriptor"))


STEPS = (complete_envelope, check_references, insert_system_messages, rename_sources)


def migrate(log: DataFrame, version: int) -> DataFrame:
    """A log of ``version`` brought to the current one, step by step."""
    if not 0 <= version <= CURRENT_VERSION:
        raise ValueError(f"unknown version {version}")
    return reduce(lambda df, step: step(df), STEPS[version:], log)
