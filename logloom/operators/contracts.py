"""Payload contracts of event types, checked on VARIANT values, and lossless JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.validation import MAX_SAFE

#: Payload members of recorded events, a type a line: required; optional; opaque.
PAYLOADS = """
agent-preset/selected: agentPreset
agent/inbox/spliced: target start inserted; removedCount outcome
approval/asked: id toolName; callId reason
approval/decided: id outcome
approval/policy: policy; source
assistant/chunk: turn step chunk
assistant/message: turn step message; usage interrupted
command/done: commandId kind; text sourceEventSeq
command/run: commandId name source; args
compaction/end: compactionId turn; sourceCommandId error
compaction/prune: shadowedRange shadowedSeqs shadowedTokenCount
compaction/start: compactionId turn; sourceCommandId
compaction/summary: compactionId summary shadowedRange shadowedSeqs shadowedTokenCount provider model; sourceCommandId maxTokens usage rawOutput llmStreamCall
feedback/record: text
goal/change: kind version operation; goal roundsStarted createdAt updatedAt cleared clearedAt
hook/invoked: turn point dialect handlerId; matcher
hook/result: turn point handlerId decision durationMs; exitCode stderrSummary
llm/retry: retryId turn step provider mode policyKey retry delayMs failure; maxRetries
llm/retry-started: retryId turn step retry
model/selection: provider model; reasoningEffort
permission/preset: preset
plan/mode: active
request/context: provider model; contextWindow
request/header: header reason; startsSeries
sandbox/mode: mode; source
schedule/change: version operation; schedule id acceptedAt
session/end-seed:
session/title: title messageSeqs source
session/title-llm-request: titleProvider messageSeqs route system messages maxTokens
step/end: turn step
step/start: turn step
subagent/descriptor: mode version provider; label agentProvider agentModel agentReasoningEffort persona toolFilter
subagent/model-selection-policy: allowedModels
team/member: version teamId member
team/message/delivered: version teamId messageId targetId
team/message/queued: version teamId message
team/task: version teamId task
todo/write: todos
tool-workflow/agent-end: runId seq outcome
tool-workflow/agent-start: runId seq label childId; phase
tool-workflow/run-end: runId stopReason
tool-workflow/run-start: runId name
tool/call: turn step callId name arguments
tool/code-dispatch: rootCallId parentCallId subCallId name arguments isError content; ; arguments
tool/code-dispatch-start: rootCallId parentCallId subCallId name arguments; ; arguments
tool/result: turn step message; error meta; meta
turn/end: turn reason
turn/start: turn
user/message: role id content source
"""


@dataclass(frozen=True)
class Contract:
    """Members that an object must and may have, those that nobody looks into, and contracts of others."""

    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    opaque: tuple[str, ...] = ()
    members: dict[str, Contract] = field(default_factory=dict)


def read_contracts(table: str = PAYLOADS) -> dict[str, Contract]:
    """Contracts by type from a table of lines as in ``PAYLOADS``."""
    out = {}
    for line in table.strip().splitlines():
        kind, _, members = line.partition(":")
        parts = [tuple(p.split()) for p in members.split(";")]
        out[kind] = Contract(*parts)
    return out


def _keys(value: Column) -> Column:
    """Members of a VARIANT object, sorted; null for any other value."""
    is_object = F.schema_of_variant(value).startswith("OBJECT")
    return F.when(F.coalesce(is_object, F.lit(False)), F.array_sort(F.map_keys(F.try_variant_get(value, "$", "map<string, variant>"))))


def _faults(value: Column, contract: Contract, path: str) -> list[Column]:
    """A struct (path, missing, unexpected) for the object and each one inside it that has a contract."""
    none = F.array().cast("array<string>")
    known = F.array(*map(F.lit, contract.required)) if contract.required else none
    allowed = F.array(*map(F.lit, (*contract.required, *contract.optional))) if contract.required or contract.optional else none
    keys = _keys(value)
    out = [F.struct(F.lit(path).alias("path"), F.array_except(known, F.coalesce(keys, none)).alias("missing"), F.array_except(F.coalesce(keys, none), allowed).alias("unexpected"), keys.isNull().alias("other"))]
    for name, inner in contract.members.items():
        if name not in contract.opaque:
            member = F.try_variant_get(value, f"$['{name}']", "variant")
            # an absent member is the outer object's fault
            out += [F.when(member.isNotNull(), fault) for fault in _faults(member, inner, f"{path}.{name}")]
    return out


def payload_violations(log: DataFrame, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """session_id, seq, type, path, problem, missing and unexpected of payloads that break their contract.

    Reads type, data (JSON text) and, where the log has it, ignorable.  Problems:
    "unlisted" (a type without contract, unless ignorable), "unreadable" (null, no JSON,
    or a repeated member), "not an object", "members" (the sorted lists say which).  Opaque members may hold
    anything; members with a contract of their own are checked under their path.
    """
    contracts = read_contracts() if contracts is None else contracts
    ignorable = F.coalesce(F.col("ignorable"), F.lit(False)) if "ignorable" in log.columns else F.lit(False)
    rows = log.select("session_id", "seq", "type", ignorable.alias("ignorable"), F.try_parse_json("data").alias("payload"))
    # types of one contract share a branch: its members decide, not its name
    branches: dict[str, tuple[Contract, list[str]]] = {}
    for kind, contract in contracts.items():
        branches.setdefault(repr(contract), (contract, []))[1].append(kind)
    faults = F.lit(None)
    for contract, kinds in branches.values():
        faults = F.when(F.col("type").isin(*kinds), F.filter(F.array(*_faults(F.col("payload"), contract, "$")), lambda f: f.isNotNull())).otherwise(faults)
    rows = rows.withColumn("faults", faults)
    listed = F.col("type").isin(*contracts)
    problem = F.when(~F.coalesce(listed, F.lit(False)), "unlisted").when(F.col("payload").isNull(), "unreadable")
    whole = rows.withColumn("problem", problem).filter((F.col("problem") == "unreadable") | (F.col("problem") == "unlisted") & ~F.col("ignorable"))
    none = F.lit(None).cast("array<string>")
    whole = whole.select("session_id", "seq", "type", F.lit("$").alias("path"), "problem", none.alias("missing"), none.alias("unexpected"))
    found = rows.filter(listed & F.col("payload").isNotNull()).select("session_id", "seq", "type", F.inline("faults"))
    kind = F.when(F.col("other"), "not an object").when((F.size("missing") > 0) | (F.size("unexpected") > 0), "members")
    shown = lambda c: F.when(~F.col("other"), F.array_sort(c)).alias(c)
    found = found.withColumn("problem", kind).filter("problem is not null").select("session_id", "seq", "type", "path", "problem", shown("missing"), shown("unexpected"))
    return whole.unionByName(found)


# Lossless JSON ------------------------------------------------------------------


class _Loss(str):
    """Stands for a value that reading and writing again would change."""


def _number(text: str) -> object:
    if text.lstrip("-").strip("0.") == "" and text[0] == "-":
        return _Loss("negative zero")
    return _Loss("unsafe integer") if len(text) > 17 or abs(int(text)) > MAX_SAFE else 0


def _fraction(text: str) -> object:
    value = float(text)
    if value == 0 and text[0] == "-":
        return _Loss("negative zero")
    return _Loss("no finite number") if value in (float("inf"), float("-inf")) else 0


def _refused(name: str) -> object:
    raise ValueError(f"{name} is no JSON")


def _members(pairs: list[tuple[str, object]]) -> dict[str, object]:
    out: dict[str, object] = {}
    for key, value in pairs:
        out[key] = _Loss("repeated member") if key in out else value
    return out


def _is_lone(text: str) -> bool:
    return any("\ud800" <= c <= "\udfff" for c in text)


def first_loss(text: str | None) -> tuple[str | None, str | None]:
    """Path and reason of the first value of a JSON text that doesn't survive a round trip."""
    if text is None:
        return "$", "no JSON"
    try:
        value = json.loads(text, object_pairs_hook=_members, parse_int=_number, parse_float=_fraction, parse_constant=_refused)
    except ValueError:
        return "$", "no JSON"
    except RecursionError:
        return "$", "nested too deeply"
    stack = [("$", value)]
    while stack:
        path, value = stack.pop()
        if isinstance(value, _Loss):
            return path, str(value)
        if isinstance(value, str) and _is_lone(value):
            return path, "lone surrogate"
        if isinstance(value, dict):
            lone = next((k for k in value if _is_lone(k)), None)
            if lone is not None:
                return f"{path}[{json.dumps(lone)}]", "lone surrogate"
            stack += [(f"{path}[{json.dumps(k)}]", v) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            stack += [(f"{path}[{i}]", v) for i, v in reversed(list(enumerate(value)))]
    return None, None


def lossy_payloads(log: DataFrame) -> DataFrame:
    """session_id, seq, path and reason of payloads (data, JSON text) that a reader would change.

    Negative zero, integers beyond 2^53 - 1, numbers too large to be finite, repeated
    members and lone surrogates; the first in document order is named.  Null and broken
    texts are "no JSON".  ``from_json`` and VARIANT would hide or refuse these silently.
    """

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [first_loss(text) for text in rows["data"]]
            rows = rows.assign(path=[p for p, _ in found], reason=[r for _, r in found])
            yield rows.loc[rows["reason"].notna(), ["session_id", "seq", "path", "reason"]]

    kind = log.schema["session_id"].dataType.simpleString()
    return log.select("session_id", "seq", "data").mapInPandas(check, f"session_id {kind}, seq long, path string, reason string")
