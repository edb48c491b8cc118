import random
from random import Random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from logloom.functions import records
from logloom.operators import filters, folds, lineage, migration, search, surface, timeline, validation
from logloom.streaming.folds import apply_events

LOG = "session_id string, seq long, type string, time long, turn long, step long, call_id string, first_token_time long, output_tokens long"


def random_log(seed, sessions=6, size=60):
    draw, rows = random.Random(seed), []
    kinds = ["step/start", "assistant/attempt", "assistant/message", "tool/call", "tool/result", "step/end", "turn/end", "other"]
    for s in range(sessions):
        for seq in range(size):
            time = seq * 10 + draw.randrange(-30, 30)
            token = time - draw.randrange(-5, 20) if draw.random() < 0.6 else None
            rows.append((f"s{s}", seq, draw.choice(kinds), time, seq // 20, seq // 6 + draw.randrange(2), draw.choice(["a", "b", "constructor"]), token, draw.choice([None, 3, 9])))
    return rows


def replay_stats(rows):
    t = dict.fromkeys(("turns", "steps", "llm_ms", "tool_ms", "ttft_ms", "ttft_steps", "decode_ms", "decode_tokens"), 0)
    last, opened, calls = None, None, {}
    for _, seq, kind, time, turn, step, call, token, output in rows:
        matches = opened is not None and opened[:2] == (turn, step)
        if kind == "step/start":
            opened = (turn, step, time, None)
        elif kind == "assistant/attempt" and matches and opened[3] is None:
            opened = (*opened[:3], token)
        elif kind == "assistant/message" and matches:
            first = opened[3] if opened[3] is not None else token
            t["llm_ms"] += max(0, time - opened[2])
            if first is not None:
                t["ttft_ms"], t["ttft_steps"] = t["ttft_ms"] + max(0, first - opened[2]), t["ttft_steps"] + 1
                if output is not None:
                    t["decode_ms"], t["decode_tokens"] = t["decode_ms"] + max(0, time - first), t["decode_tokens"] + output
            opened = None
        elif kind == "tool/call":
            calls[call] = time
        elif kind == "tool/result" and call in calls:
            t["tool_ms"] += max(0, time - calls.pop(call))
        elif kind == "step/end":
            t["turns"], t["steps"], last, opened = t["turns"] + (last != turn), t["steps"] + 1, turn, None
        elif kind == "turn/end":
            calls = {}
    return t


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stats_equal_a_replay(spark, seed):
    rows = random_log(seed)
    got = {r["session_id"]: r.asDict() for r in folds.session_stats(spark.createDataFrame(rows, LOG)).collect()}
    for s, row in got.items():
        row.pop("session_id")
        assert row == replay_stats([r for r in rows if r[0] == s])
        frame = pd.DataFrame([r for r in rows if r[0] == s], columns=[c.split()[0] for c in LOG.split(", ")])
        state = apply_events(apply_events((0, 0, None, 0, {}), frame[:25]), frame[25:])
        assert (state[0], state[1], state[3]) == (row["turns"], row["steps"], row["tool_ms"])


def test_filters(spark):
    sessions = spark.createDataFrame([("a", "/x", 1, None, True, False), ("b", None, 5, "a", False, True), ("c", "/y", 9, "a", False, False)], "id string, cwd string, created_at long, parent_session string, live boolean, persisted boolean")
    ids = lambda *clauses: [r["id"] for r in filters.filter_sessions(sessions, list(clauses)).orderBy("id").collect()]
    assert ids() == ["a", "b", "c"] and ids({"kind": "cwd", "values": ["/x", None]}) == ["a", "b"] and ids({"kind": "id", "values": []}) == []
    assert ids({"kind": "created-at", "from": 5}, {"kind": "parent", "values": ["a"]}) == ["b", "c"] and ids({"kind": "created-at", "from": 1, "to": 5}) == ["a", "b"]
    assert ids({"kind": "availability", "values": ["live", "persisted"]}) == ["a", "b"] and ids({"kind": "parent", "values": [None]}) == ["a"]
    for bad in ({"kind": "id", "values": [None]}, {"kind": "created-at", "from": 2, "to": 1}, {"kind": "created-at", "from": float("nan")}, {"kind": "availability", "values": ["x"]}, {"kind": "nope"}, {"kind": "id", "values": "a"}):
        with pytest.raises(filters.InvalidFilter):
            filters.filter_sessions(sessions, [bad])
    with pytest.raises(filters.InvalidFilter):
        filters.filter_events(sessions, [{"kind": "text", "text": "  "}])
    requested = spark.createDataFrame([("a",), ("c",), ("c",), ("zz",), ("b",)], "id string")
    shared = sessions.withColumn("cwd", F.when(F.col("id") != "b", "/x"))
    assert sorted(r["id"] for r in filters.authorized_ids(requested, shared, "a").collect()) == ["a", "c"]


def test_outline(spark):
    rows = [
        ("s", 0, "turn/start", 0, None, None), ("s", 1, "user/message", None, "hook", ["x"]), ("s", 2, "user/message", None, "user", [" "]), ("s", 3, "user/message", None, "user", ["ask  me"]),
        ("s", 4, "assistant/message", None, None, ["one"]), ("s", 5, "assistant/message", None, None, ["two"]), ("s", 6, "turn/start", 0, None, None), ("s", 7, "turn/end", None, None, None),
        ("s", 8, "turn/start", 1, None, None), ("s", 9, "assistant/message", None, None, ["lost"]),
    ]
    log = spark.createDataFrame(rows, "session_id string, seq long, type string, turn long, source_kind string, parts array<string>")
    assert [tuple(r) for r in folds.turn_outline(log).orderBy("turn").collect()] == [("s", 0, 0, "ask me", "two"), ("s", 1, 8, "", "")]


def test_balance_fails_on_an_orphan(spark):
    log = spark.createDataFrame([("s", 0, "assistant/message", 2), ("s", 1, "tool/result", 0), ("s", 2, "tool/result", 0)], "session_id string, seq long, type string, n_calls int")
    assert [(r["running"], r["balanced"]) for r in folds.tool_balance(log).orderBy("seq").collect()] == [(2, False), (1, False), (0, True)]
    with pytest.raises(Exception, match="result without a call"):
        folds.tool_balance(log.filter("seq > 0")).collect()


def test_streams_are_assembled(spark):
    block = "struct<type: string, text: string, id: string, name: string, arguments: string>"
    schema = f"message_id string, seq long, kind string, index int, block_type string, text string, id string, name string, arguments string, block {block}, value string"
    fields = ("index", "block_type", "text", "id", "name", "arguments", "block", "value")
    made = lambda m, *chunks: [(m, i, kind, *(more.get(f) for f in fields)) for i, (kind, more) in enumerate(chunks)]
    call = lambda part, i=1, name=None: ("tool-call-delta", {"index": i, "id": f"id{part}", "name": name, "arguments": part})
    text = lambda part, i=0: ("text-delta", {"index": i, "text": part})
    end = lambda i, *b: ("block-end", {"index": i, "block": b})
    rows = made("open", text("Hel"), call("{"), text("lo"), call('"a"', name="grep"), call("}", name=""), ("reasoning-delta", {"index": 2, "text": "hm"}), ("usage", {"value": "1"}), ("usage", {"value": "2"}))
    rows += made("closed", text("Hel"), end(0, "text", "Hello", None, None, None), text("!"), end(0, "text", "late", None, None, None), call("{"), ("finish", {"value": "max-tokens"}))
    rows += made("bare", ("block-start", {"index": 3, "block_type": "tool-call"}), end(1, "tool-call", None, "x", "ls", "[]"), ("finish", {"value": "stop"}))
    got = {r["message_id"]: (r["usage"], r["finish"], [tuple(b) for b in r["blocks"]]) for r in folds.assemble_stream(spark.createDataFrame(rows, schema)).collect()}
    assert got["open"] == ("2", None, [("text", "Hello", None, None, None), ("tool-call", None, "id}", "grep", '{"a"}'), ("reasoning", "hm", None, None, None)])
    assert got["closed"] == (None, "max-tokens", [("text", "Hello", None, None, None)])
    assert got["bare"] == (None, "stop", [("tool-call", None, "call-3", "", ""), ("tool-call", None, "x", "ls", "[]")])


def test_surface(spark):
    rows = [("s", 0, "append", None, None, 5), ("s", 1, "append", None, None, 6), ("s", 2, None, None, None, None), ("s", 3, "append", None, None, 7), ("s", 4, "replace", 0, 1, 2), ("s", 5, "replace", 4, 3, 1)]
    log = spark.createDataFrame(rows, "session_id string, seq long, surface_op string, start_seq long, end_seq long, tokens long")
    folded = surface.fold_surface(log)
    got = {r["seq"]: (r["surface"], r["position"], r["shadowed_by"], r["delta_tokens"]) for r in folded.collect()}
    assert got == {0: ("shadowed", None, 4, 5), 1: ("shadowed", None, 4, 6), 2: ("log-only", None, None, None), 3: ("shadowed", None, 5, 7), 4: ("shadowed", None, 5, -9), 5: ("current", 0, None, -8)}
    chains = sorted((r["seq"], r["replaced_by"], r["distance"]) for r in lineage.replacement_chains(folded).collect())
    assert chains == [(0, 4, 1), (0, 5, 2), (1, 4, 1), (1, 5, 2), (3, 5, 1), (4, 5, 1)]
    with pytest.raises(Exception, match="no current range"):
        surface.fold_surface(spark.createDataFrame([*rows, ("s", 6, "replace", 0, 5, 1)], log.schema)).collect()


def test_lineage(spark):
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", "gone"), ("f", "e"), ("x", "y"), ("y", "x"), ("z", "x")], "id string, parent string")
    got = {}
    for r in lineage.ancestors(nodes).collect():
        got.setdefault(r["id"], (r["outcome"], {}))[1][r["ancestor"]] = r["distance"]
    assert got["d"] == ("complete", {"c": 1, "b": 2, "a": 3}) and got["a"] == ("complete", {None: None})
    assert got["f"] == ("partial", {"e": 1}) and got["e"][0] == "partial" and got["x"] == ("cycle", {"y": 1, "x": 2}) and got["z"][0] == "cycle"
    tree = spark.createDataFrame([(1, None, 0), (2, 1, 9), (3, 1, 5), (4, 3, 1), (5, 2, 1), (6, 1, 5)], "id long, parent long, created_at long")
    assert [(r["id"], r["depth"]) for r in lineage.preorder(tree, 1).orderBy("place").collect()] == [(1, 0), (3, 1), (4, 2), (6, 1), (2, 1), (5, 2)]


def test_timeline(spark):
    spans = spark.createDataFrame([("s", 1, 0, 10), ("s", 2, 5, 8), ("s", 3, 30, 31), ("s", 4, 31, 40), ("s", 5, 50, 50)], "session_id string, span_id long, start long, end long")
    assert [(r["start"], r["end"]) for r in timeline.compress_idle(spans).orderBy("span_id").collect()] == [(0, 10), (5, 8), (10, 11), (11, 20), (20, 20)]
    day = timeline.DAY_MS
    rows = spark.createDataFrame([("t", 0, 0), ("t", 1, 9 * day), ("t", 2, 3 * day), ("t", 3, 10 * day)], "task_id string, place long, delivered_at long")
    assert sorted(r["place"] for r in timeline.retain_deliveries(rows, 5, 10).collect()) == [1, 3]
    assert [r["place"] for r in timeline.newest_page(rows, "place", 2, 3).collect()] == [2, 1]
    with pytest.raises(ValueError):
        timeline.neighbours(rows, "t", 0, 51, 0)


def test_search(spark):
    docs = spark.createDataFrame([("s", 0, "Red fox, red!"), ("s", 1, "fox"), ("t", 0, "red FOX hill hill hill"), ("t", 1, None)], "session_id string, seq long, text string")
    found = {(r["session_id"], r["seq"]): r["score"] for r in search.search(docs.na.fill(""), "fox red").collect()}
    assert set(found) == {("s", 0), ("t", 0)} and found["s", 0] > found["t", 0]
    with pytest.raises(ValueError):
        search.search(docs, " ,")


def test_validation(spark):
    log = spark.createDataFrame([("s", 0, "a", None), ("s", 2, "b", True), ("t", 1, "b", None)], "session_id string, seq long, type string, ignorable boolean")
    assert sorted(tuple(r) for r in validation.gaps(log).collect()) == [("s", 2, 1), ("t", 1, 0)]
    known = spark.createDataFrame([("a",)], "type string")
    assert [tuple(r) for r in validation.unknown_types(log, known).collect()] == [("t", 1, "b")]
    assert validation.unsafe_integers(log.withColumn("n", F.lit(2**53)), "n").count() == 3
    lists = spark.createDataFrame([(1, [("a", "in_progress"), ("b", "in_progress")]), (2, [("a", "x"), ("a", "y")]), (3, [(" ", "x")]), (4, [("a", "in_progress")])], "id long, items array<struct<content string, status string>>")
    assert {r["id"]: r["reason"] for r in validation.invalid_todo_lists(lists).collect()} == {1: "several in progress", 2: "repeated", 3: "blank"}


def test_migration(spark):
    schema = "session_id string, seq long, type string, text string, system_text string, source_event_seqs array<bigint>, preset string, source_kind string, plugin string, ignorable boolean"
    rows = [
        ("s", 0, "turn/start", None, None, [], "code", "user", None, None), ("s", 1, "step/start", None, None, [], "code", None, None, None), ("s", 2, "request/header", None, "be brief", [1], "code", None, None, None),
        ("s", 3, "user/message", "hi", None, [2], "code", "plugin", "compact", None), ("s", 4, "request/header", None, "be brief", [3], "other", "plugin", "mine", True), ("s", 5, "request/header", None, None, [0, 4], "other", "plugin", "goal", None),
    ]
    old = spark.createDataFrame(rows, schema)
    got = [(r["seq"], r["type"], r["text"], r["source_event_seqs"], r["preset"], r["source_kind"]) for r in migration.migrate(old, 0).orderBy("seq").collect()]
    assert got == [
        (0, "turn/start", None, [], "ptc", "user"), (1, "step/start", None, [], "ptc", None), (2, "system/message", "", [], "ptc", "system-prompt"), (3, "system/message", "be brief", [2], "ptc", "system-prompt"),
        (4, "request/header", None, [1], "ptc", None), (5, "user/message", "hi", [4], "ptc", "compact-checkpoint"), (6, "request/header", None, [5], "other", "plugin:mine"),
        (7, "system/message", "", [3], "other", "system-prompt"), (8, "request/header", None, [0, 6], "other", "goal"),
    ]
    with pytest.raises(Exception, match="bad citation"):
        migration.migrate(old.withColumn("source_event_seqs", F.array(F.lit(9).cast("long"))), 1).collect()
    with pytest.raises(Exception, match="outside a step"):
        migration.insert_system_messages(old.filter("seq <> 1").withColumn("source_event_seqs", F.array().cast("array<bigint>"))).collect()


def replayed_timing(events):
    """The timing of one session, event by event."""
    seen, settled, pending, since, completed = False, 0, None, None, None
    for kind, time, reason in events:
        if kind == "turn/start":
            completed = None
            since, pending = (time, pending) if seen else (since, time)
        elif kind == "subagent/descriptor":
            since = since if since is not None else pending
            seen, settled, pending, completed = True, 0, None, None
        elif kind == "turn/end":
            if not seen:
                pending = None
            elif since is not None:
                settled, since, completed = settled + max(0, time - since), None, reason == "completed"
    return settled, since, events[-1][1] if since is not None else None, completed


def test_subagent_timing_equals_a_replay(spark):
    draw, rows, expected = random.Random(5), [], {}
    for session in range(60):
        events = [(draw.choice(["turn/start", "turn/end", "user/message", "turn/start", "turn/end", "subagent/descriptor"]), draw.randrange(1000), draw.choice(["completed", "aborted", None])) for _ in range(draw.randrange(1, 14))]
        expected[session] = replayed_timing(events)
        rows += [(session, seq, *e) for seq, e in enumerate(events)]
    log = spark.createDataFrame(rows, "session_id long, seq long, type string, time long, reason string")
    assert {r[0]: tuple(r)[1:] for r in folds.subagent_timing(log).collect()} == expected


def test_runs_of_sequences(spark):
    lists = [[], [4], [1, 2], [1, 2, 3], [1, 2, 3, 5, 6, 9, 10, 11, 12], [3, 2, 1], [1, 1, 2, 3], list(range(20000))]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<bigint>").select("i", records.encode_ranges(F.col("x")).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in got] == [[], [[4]], [[1], [2]], [[1, 3]], [[1, 3], [5], [6], [9, 12]], [[3], [2], [1]], [[1], [1], [2], [3]], [[0, 19999]]]


def test_surface_totals(spark):
    rows = [
        (1, 0, "append", 10, None, None), (1, 1, "meter", 4, 0, 0), (1, 2, "replace", 6, 0, 0), (1, 3, "replace", 9, 2, 2), (1, 4, "meter", 2, 0, 2), (1, 5, None, 5, None, None),
        (1, 6, "replace", 8, 0, 2), (1, 7, "meter", 3, 0, 6), (1, 8, "replace", 8, 0, 5), (2, 0, "replace", 7, 0, 0),
    ]
    log = spark.createDataFrame(rows, "session_id long, seq long, op string, tokens long, start_seq long, end_seq long")
    got = surface.surface_totals(log).orderBy("session_id", "seq").select("delta", "total", "contradicts").collect()
    totals = [(10, 10), (0, 10), (2, 12), (0, 12), (0, 12), (0, 12), (0, 12), (0, 12), (None, 12), (0, 0)]
    assert [tuple(r) for r in got] == [(d, t, d is None) for d, t in totals]
    assert surface.surface_totals(log.limit(0)).count() == 0


def test_model_selection_and_policy(spark):
    rows, expected = [], {}
    for session in range(60):
        random = Random(session)
        used = pending = None
        for seq in range(random.randrange(1, 12)):
            kind = random.choice(["model/selection", "request/header", "other"])
            value = (random.choice("ab"), "m", random.choice([None, "low"]))
            rows.append((session, seq, kind, value))
            if kind == "model/selection":
                pending = value
            elif kind == "request/header":
                used, pending = value, None if pending == value else pending
        expected[session] = (used, pending or used)
    log = spark.createDataFrame(rows, "session_id long, seq long, type string, selection struct<provider: string, model: string, effort: string>")
    assert {r[0]: (r[1] and tuple(r[1]), r[2] and tuple(r[2])) for r in folds.model_selection(log).collect()} == expected
    kind = "subagent/model-selection-policy"
    rows = [(1, 0, kind, [("p", "m")]), (1, 1, kind, []), (2, 0, kind, []), (3, 0, "x", None), (4, 0, kind, [("p", "m"), ("p", "m")]), (5, 0, kind, [("", "m")]), (6, 0, kind, None)]
    log = spark.createDataFrame(rows, "session_id long, seq long, type string, allowed_models array<struct<provider: string, model: string>>")
    assert {r["session_id"]: r["valid"] for r in folds.model_policy(log).collect()} == {1: True, 2: False, 3: None, 4: False, 5: False, 6: False}
