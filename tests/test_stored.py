import dataclasses
import hashlib
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from logloom.functions import diff, retention, secrets
from logloom.operators import contracts, index, lineage, search, surface, timeline, validation
from logloom.sources import tables
from logloom.streaming import folds as stream_folds
from logloom.streaming import resume


def test_contracts_read_their_table():
    known = contracts.read_contracts()
    assert len(known) == len(contracts.PAYLOADS.split("\n")) - 2
    assert known["session/end-seed"] == contracts.Contract() and known["tool/result"].opaque == ("meta",)
    assert known["tool/code-dispatch"] == contracts.Contract(("rootCallId", "parentCallId", "subCallId", "name", "arguments", "isError", "content"), (), ("arguments",))


def test_payloads_against_contracts(spark):
    rows = [(1, "turn/end", '{"turn":1,"reason":null}'), (2, "turn/end", '{"turn":1,"b":1,"a":1}'), (3, "who/knows", "{}"), (4, "turn/end", "[]"), (5, "turn/end", "{"), (6, "turn/end", None),
            (7, "tool/result", '{"turn":1,"step":1,"message":{"x":1},"meta":{"any":{"thing":-0}}}'), (8, None, "{}"), (9, "session/end-seed", "{}")]
    log = spark.createDataFrame([("s", *r) for r in rows], "session_id string, seq long, type string, data string")
    got = {r["seq"]: (r["problem"], r["missing"], r["unexpected"]) for r in contracts.payload_violations(log).collect()}
    assert got == {2: ("members", ["reason"], ["a", "b"]), 3: ("unlisted", None, None), 4: ("not an object", None, None), 5: ("unreadable", None, None), 6: ("unreadable", None, None), 8: ("unlisted", None, None)}
    known = contracts.read_contracts()
    opaque = dataclasses.replace(known["tool/result"], members={"meta": contracts.Contract(("z",)), "message": contracts.Contract(("role",), ("y",))})
    found = contracts.payload_violations(log.filter("seq = 7"), known | {"tool/result": opaque}).collect()
    assert [(r["path"], r["missing"], r["unexpected"]) for r in found] == [("$.message", ["role"], ["x"])]
    ignored = contracts.payload_violations(log.withColumn("ignorable", F.lit(True)))
    assert {r["seq"] for r in ignored.collect()} == {2, 4, 5, 6}
    assert contracts.payload_violations(log.limit(0)).count() == 0


@pytest.mark.parametrize("text, found", [
    ('{"a":[1,2.5,"x",null,true,{"b":-1}]}', (None, None)), ('{"a":-0}', ('$["a"]', "negative zero")), ("[1,-0.0]", ("$[1]", "negative zero")), ("-0e7", ("$", "negative zero")),
    ("9007199254740991", (None, None)), ("[[9007199254740992]]", ("$[0][0]", "unsafe integer")), ("1" * 5000, ("$", "unsafe integer")), ("1e400", ("$", "no finite number")),
    ('{"a":1,"b":2,"a":3}', ('$["a"]', "repeated member")), ('{"x":"\\ud800"}', ('$["x"]', "lone surrogate")), ('"\\ud83d\\ude00"', (None, None)), ('{"\\udc00":1}', ('$["\\udc00"]', "lone surrogate")),
    ("[1,]", ("$", "no JSON")), ("NaN", ("$", "no JSON")), ("", ("$", "no JSON")), (None, ("$", "no JSON")), ("[" * 200_000, ("$", "nested too deeply")), ('{"b":-0,"a":1e999}', ('$["b"]', "negative zero")),
])
def test_first_loss(text, found):
    assert contracts.first_loss(text) == found


def walked(schema, value, path=()):
    """The removal rule by plain recursion: what is left (... for nothing) and the positions."""
    if schema["type"] == "secret":
        return ..., [(path, value is not ...)]
    if schema["type"] == "object":
        rest, found = dict(value) if isinstance(value, dict) else None, []
        for name, part in schema["members"].items():
            left, more = walked(part, rest.get(name, ...) if rest is not None else ..., (*path, name))
            found += more
            if rest is not None:
                rest.pop(name, None)
                if left is not ...:
                    rest[name] = left
        return value if rest is None else rest, found
    if schema["type"] == "dict" and isinstance(value, dict):
        parts = {k: walked(schema["inner"], v, (*path, k)) for k, v in sorted(value.items())}
        return {k: left for k, (left, _) in parts.items() if left is not ...}, [x for _, more in parts.values() for x in more]
    if schema["type"] == "array" and isinstance(value, list):
        parts = [walked(schema["inner"], v, (*path, str(i))) for i, v in enumerate(value)]
        return [None if left is ... else left for left, _ in parts], [x for _, more in parts for x in more]
    if schema["type"] == "union":
        found = {}
        for part in schema["list"]:
            for at, held in walked(part, value, path)[1]:
                found[at] = found.get(at, False) or held
        for part in schema["list"]:
            value, _ = walked(part, value, path)
        return value, list(found.items())
    return value, []


def test_secrets_go_by_schema(spark):
    secret, any_ = {"type": "secret"}, {"type": "any"}
    inner = {"type": "object", "members": {"token": secret, "note": any_}}
    schema = {"type": "object", "members": {"key": secret, "hosts": {"type": "dict", "inner": inner}, "list": {"type": "array", "inner": {"type": "union", "list": [inner, {"type": "object", "members": {"pin": secret, "token": any_}}]}}, "pins": {"type": "array", "inner": secret}}}
    draw = random.Random(3)

    def value(depth=0):
        kind = draw.randrange(6) if depth < 4 else 0
        if kind == 1:
            return [value(depth + 1) for _ in range(draw.randrange(3))]
        if kind > 1:
            return {draw.choice(["key", "hosts", "list", "pins", "token", "pin", "note", "other"]): value(depth + 1) for _ in range(draw.randrange(6))}
        return draw.choice([None, 1, "text", True, 2.5])

    values = [{"hosts": {"a": {"token": 1}, "b": {"token": None, "note": "n"}, "c": 3}, "list": [{"token": 1, "pin": 2, "x": 3}, 7], "pins": ["1", None], "key": {"deep": 1}}, {}, [1], "s", None] + [value() for _ in range(150)]
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, t string")
    got = {r["i"]: r for r in rows.select("i", secrets.strip_secrets(schema, F.col("t")).alias("s")).select("i", "s.*").collect()}
    for i, v in enumerate(values):
        left, found = walked(schema, v)
        assert json.loads(got[i]["value"]) == left, v
        assert [(tuple(x["path"]), x["set"]) for x in got[i]["secrets"]] == found, v
    broken = rows.select(secrets.strip_secrets(schema, F.lit("{")).alias("s")).first()["s"]
    assert broken["value"] is None and [tuple(x) for x in broken["secrets"]] == [(["key"], False)]


def test_hunks_rebuild_the_text_with_the_fewest_edits():
    draw = random.Random(1)

    def common(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    for _ in range(1500):
        a = [draw.choice("abc") for _ in range(draw.randrange(25))]
        b = list(a) if draw.random() < 0.6 else [draw.choice("abc") for _ in range(draw.randrange(25))]
        for _ in range(draw.randrange(4)):
            b.insert(draw.randrange(len(b) + 1), draw.choice("abcd"))
        old, new = ("".join(f"{x}\n" for x in t) for t in (a, b))
        found = diff.compare(old, new)
        assert diff.apply_hunks(old, found["hunks"]) == b and not found["coarse"]
        assert found["added"] + found["deleted"] == len(a) + len(b) - 2 * common(a, b)
        for h in found["hunks"]:
            kinds = [x[0] for x in h["lines"]]
            assert h["old_lines"] == len(kinds) - kinds.count("+") and h["new_lines"] == len(kinds) - kinds.count("-")
            assert len(kinds) - len("".join(kinds).lstrip(" ")) <= 3 and len(kinds) - len("".join(kinds).rstrip(" ")) <= 3


def test_hunks_of_absent_coarse_and_unfinished_texts():
    assert diff.compare(None, None) == diff.compare("", None) == {"hunks": [], "coarse": False, "added": 0, "deleted": 0}
    assert diff.compare("a", "a\n")["hunks"] == [] and diff.compare(None, "\n")["added"] == 1
    assert diff.compare(None, "a\nb")["hunks"] == [{"old_start": 0, "old_lines": 0, "new_start": 1, "new_lines": 2, "lines": ["+a", "+b"]}]
    far = diff.compare("a\nb\nc", "x\ny\nz", most=3)
    assert far["coarse"] and far["hunks"][0]["lines"] == ["-a", "-b", "-c", "+x", "+y", "+z"] and diff.apply_hunks("a\nb\nc", far["hunks"]) == ["x", "y", "z"]
    with pytest.raises(ValueError):
        diff.apply_hunks("other", far["hunks"])


LOG = "session_id string, seq long, type string, surface_op string, start_seq long, end_seq long, tokens long, n_calls int, targets array<struct<seq: long, indexes: array<int>>>"


def surface_log(spark, *events):
    """Events (type, op, range, calls, targets) of session s."""
    return spark.createDataFrame([("s", i, t, op, *(r or (None, None)), 1, calls, targets) for i, (t, op, r, calls, targets) in enumerate(events)], LOG)


def test_offloads_look_at_the_surface_of_their_own_time(spark):
    user, said = ("user/message", "append", None, 0, None), ("assistant/message", "append", None, 0, None)
    offload = lambda *targets: ("image/offload", None, None, 0, list(targets))
    images = spark.createDataFrame([("s", q, i) for q in range(9) for i in range(2)], "session_id string, seq long, index int")

    def run(*events):
        log = surface_log(spark, *events)
        folded = surface.fold_surface(log)
        refused = [(r["seq"], r["reason"]) for r in surface.refused_offloads(log, images, folded).collect()]
        return refused, sorted((r["seq"], r["index"]) for r in surface.offload_images(log, images, folded).collect() if r["offloaded"])

    replaced = ("user/message", "replace", (0, 1), 0, None)
    assert run(user, user, offload((0, [0])), replaced) == ([], [(0, 0)])
    assert run(user, user, replaced, offload((0, [0]))) == ([(3, "not on the surface")], [])
    assert run(user, user, replaced, offload((2, [0, 1]))) == ([], [(2, 0), (2, 1)])
    assert run(user, offload((2, [0])), user) == ([(1, "not on the surface")], [])
    assert run(said, offload((0, [0])))[0] == [(1, "of another type")]
    assert run(user, offload((0, [1, 0])))[0] == [(1, "indexes not rising")] and run(user, offload((0, [])))[0] == [(1, "indexes not rising")]
    assert run(user, offload((0, [-1, 0])))[0] == [(1, "indexes not rising")] and run(user, offload((0, [0]), (0, [1])))[0] == [(1, "repeated target")]
    assert run(user, offload())[0] == [(1, "no targets")] and run(user, offload((0, [2])))[0] == [(1, "no such image")]
    # the first refused one ends the replay
    assert run(user, offload((0, [0])), offload((0, [0])), offload((0, [1]))) == ([(2, "offloaded before")], [(0, 0)])


def test_balance_over_the_current_surface(spark):
    calls, result, said = ("assistant/message", "append", None, 2, None), ("tool/result", "append", None, 0, None), ("user/message", "append", None, 0, None)
    log = surface_log(spark, said, calls, result, result, said, ("user/message", "replace", (1, 3), 0, None), result)
    got = [(r["seq"], r["open_before"], r["open_behind"], r["corrupt"]) for r in surface.surface_balance(log, surface.fold_surface(log)).orderBy("position").collect()]
    assert got == [(0, 0, 0, False), (5, 0, 0, False), (4, 0, 0, False), (6, 0, -1, True)]


def test_search_through_an_index(spark, tmp_path):
    draw, words = random.Random(2), ["the", "that", "rare", "éclair", "x1", "common", "word", "two"]
    rows = [(i % 7, i // 7, " ".join(draw.choice(words) for _ in range(draw.randrange(30)))) for i in range(400)] + [(9, 0, None), (9, 1, ""), (9, 5000, "the far that")]
    docs = spark.createDataFrame(rows, "session_id long, seq long, text string")
    folder = str(tmp_path / "index")
    index.append(docs.filter("seq % 2 = 0"), folder, 1, buckets=8)
    index.append(docs.filter("seq % 2 = 1"), folder, 2, buckets=8)
    index.append(docs.filter("seq % 2 = 1"), folder, 2, buckets=8)
    for query in ("THE that", "ÉCLAIR, x1!", "nowhere the"):
        found = index.search_index(spark, folder, query, buckets=8)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, search.search(docs, query).collect())), query
    read = index.read_postings(spark, folder, ["rare"], buckets=8)
    bucket = spark.range(1).select(index.bucket_of(F.lit("rare"), 8)).first()[0]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and spark.read.parquet(f"{folder}/postings").select("bucket").distinct().count() > 1
    # the plan's scan lists the files of one bucket of each generation, no others
    scanned = read.select(F.input_file_name().alias("f")).distinct().collect()
    assert scanned and all(f"bucket={bucket}/" in r["f"] for r in scanned) and f"(bucket#" in plan
    with pytest.raises(ValueError):
        index.query_words(" ,")


def events(seed, n):
    draw, out = random.Random(seed), []
    for seq in range(n):
        kind = draw.choice(["step/start", "step/end", "assistant/message", "assistant/attempt", "tool/call", "tool/result", "turn/end", "user/message"])
        out.append((f"s{seed}", seq, kind, draw.choice([None, *range(100, 130)]), draw.choice([None, 1, 1, 2]), draw.choice([None, 1, 1]), draw.choice([None, "a", "b"]), draw.choice([None, 110, 90]), draw.choice([None, 3, -1])))
    return out


def test_resumed_fold_equals_the_whole_fold(spark, tmp_path):
    from logloom.operators import folds

    rows = [r for seed in range(12) for r in events(seed, 60)]
    schema = "session_id string, seq long, type string, time long, turn long, step long, call_id string, first_token_time long, output_tokens long"
    log, source = spark.createDataFrame(rows, schema), str(tmp_path / "source")

    def run(name, checkpoints=None, files=2):
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files).parquet(source)
        query = resume.write_checkpoints(resume.resumed_stats(stream, checkpoints), str(tmp_path / name), str(tmp_path / f"{name}-progress"))
        query.awaitTermination()
        return resume.latest_checkpoints(spark, str(tmp_path / name))

    for low, high in ((0, 14), (15, 29)):
        log.filter(F.col("seq").between(low, high)).repartition(3, "session_id").write.mode("append").parquet(source)
    half = run("half")
    assert half.filter("seq <> 29").count() == 0 and spark.read.parquet(str(tmp_path / "half")).select("batch").distinct().count() > 1
    # a stored fold with a mark shows that the resumed one goes on from it
    marked = half.withColumn("val", F.when(F.col("session_id") == "s3", F.regexp_replace("val", '"steps": [0-9]+', '"steps": 1000')).otherwise(F.col("val")))
    log.filter("seq > 29").write.mode("append").parquet(source)
    header = half.select("session_id", F.lit(1).alias("format_version"), F.lit(1).alias("created_at"), F.lit("/").alias("cwd"), F.lit(False).alias("is_seeded"), F.lit(0).alias("inherited_event_count"))
    kept = resume.usable_checkpoints(marked.withColumn("ver", F.when(F.col("session_id") == "s4", 1).otherwise(F.col("ver"))), header.withColumn("cwd", F.when(F.col("session_id") == "s5", "/x").otherwise(F.col("cwd"))), header)
    assert {f"s{i}" for i in range(12)} - {r["session_id"] for r in kept.collect()} == {"s4", "s5"}
    last = {r["session_id"]: tuple(r[c] for c in resume.COUNTERS) for r in run("last", kept, 100).collect()}
    expected = {r["session_id"]: tuple(r[c] for c in resume.COUNTERS) for r in folds.session_stats(log).collect()}
    assert last["s3"][1] >= 1000
    expected.pop("s3"), last.pop("s3")
    assert last == expected


def test_cursors_page_through_ties_and_nulls(spark):
    draw = random.Random(4)
    rows = [(i, draw.choice([None, 0.1 + 0.2, 1.5, -2.0]), draw.choice([None, "a", "ä\n", "b"])) for i in range(40)]
    frame = spark.createDataFrame(rows, "id long, score double, name string")
    order = [("score", True), ("name", False), ("id", False)]
    whole = [r["id"] for r in frame.orderBy(F.desc_nulls_last("score"), F.asc_nulls_first("name"), "id").collect()]
    found, cursor = [], None
    while True:
        page = timeline.keyset_page(frame, order, 7, cursor).collect()
        if not page:
            break
        found += [r["id"] for r in page]
        cursor = page[-1]["cursor"]
    assert found == whole
    with pytest.raises(ValueError):
        timeline.read_cursor(cursor, order[:2])
    for broken in (cursor[:-1], "x" + cursor, cursor.split(".")[0], "", "é.é", cursor.replace(".", "=.")):
        with pytest.raises(ValueError):
            timeline.read_cursor(broken, order)


def test_preorder_of_deep_wide_and_circular_trees(spark):
    rows = [(str(i), str(i - 1) if i else None, 0) for i in range(20)] + [("Z", "3", 1), ("ä", "3", 1), ("a", "3", 1), ("B", "3", 1), ("b", "3", 1), ("u", "v", 0), ("v", "u", 0), ("w", "gone", 0)]
    nodes = spark.createDataFrame(rows, "id string, parent string, created_at long")
    got = [(r["id"], r["depth"]) for r in lineage.preorder(nodes, "0").orderBy("place").collect()]
    assert got == [(str(i), i) for i in range(20)] + [(x, 4) for x in ("a", "ä", "b", "B", "Z")]
    assert [(r["id"], r["depth"], r["place"]) for r in lineage.preorder(nodes, "19").collect()] == [("19", 0, 0)]
    assert sorted((r["id"], r["place"]) for r in lineage.preorder(nodes, "u").collect()) == [("u", 0), ("v", 1)]
    assert lineage.preorder(nodes, "nobody").count() == 0


def test_event_texts_and_spoken_messages(spark):
    kind = "session_id string, seq long, type string, time long, surface string, " + ", ".join(f"{c} {t}" for c, t in search.TEXT_COLUMNS.items())
    text = [("text", " a ", None, None), ("tool-call", None, " grep ", "{}"), ("reasoning", "no", None, None)]
    rows = [(0, "assistant/message", text, None, None, None, None, None), (1, "tool/call", None, " ls ", " -l ", None, None, None), (2, "tool/result", text[:1], None, None, ("E", None), None, None),
            (3, "todo/write", None, None, None, None, [("pending", "x"), (None, " ")], None), (4, "turn/end", None, None, None, None, None, ("error", "bad")), (5, "turn/end", None, None, None, None, None, ("completed", "x")),
            (6, "system/message", text, None, None, None, None, None), (7, "turn/end", None, None, None, None, None, ("aborted", None))]
    log = spark.createDataFrame([("s", r[0], r[1], 0, "current", *r[2:]) for r in rows], kind)
    assert {r["seq"]: r["text"] for r in search.search_documents(log).collect()} == {0: "a\ngrep\n{}", 1: "ls\n-l", 2: "a\nE", 3: "pending\nx", 4: "error\nbad", 7: "aborted"}
    said = spark.createDataFrame([("s", 0, "user/message", "user", "hi"), ("s", 1, "user/message", "plugin:x", "no"), ("s", 2, "user/message", "compact-checkpoint", "sum"), ("s", 3, "assistant/message", None, "yes"), ("s", 4, "assistant/message", None, ""), ("s", 5, "system/message", None, "sys")], "session_id string, seq long, type string, source_kind string, text string")
    assert [(r["seq"], r["role"], r["checkpoint"]) for r in timeline.conversation(said).orderBy("seq").collect()] == [(0, "user", False), (2, "user", True), (3, "assistant", False)]


def test_todo_lists_and_retired_headers(spark):
    lists = spark.createDataFrame([(1, [("a", "pending"), (" a", "pending")]), (2, [("\t", "pending")]), (3, [("a", "in_progress"), ("b", "in_progress")]), (4, []), (5, [(None, "pending")])], "id int, items array<struct<content: string, status: string>>")
    assert {r["id"]: r["reason"] for r in validation.invalid_todo_lists(lists).collect()} == {1: "repeated", 2: "blank", 3: "several in progress", 5: "blank"}
    log = spark.createDataFrame([("s", 0, "request/header", "fallback", True), ("s", 1, "request/header", "changed", None), ("s", 2, "new/thing", "fallback", True), ("s", 3, "new/thing", None, None)], "session_id string, seq long, type string, reason string, ignorable boolean")
    known = spark.createDataFrame([("request/header",)], "type string")
    assert sorted(r["seq"] for r in validation.unknown_types(log, known).collect()) == [0, 3]


def test_fork_closes_what_was_open(spark):
    rows = [("turn/start", 1, None, None), ("step/start", 1, 1, None), ("tool/call", 1, 1, "a"), ("tool/call", 1, 1, "b"), ("tool/result", 1, 1, "a"), ("step/end", 1, 1, None), ("turn/end", 1, None, None)]
    log = spark.createDataFrame([("s", i, t, 10 * i, turn, step, call) for i, (t, turn, step, call) in enumerate(rows)], "session_id string, seq long, type string, time long, turn long, step long, call_id string")
    shape = lambda at: [(r["seq"], r["type"], r["time"], r["call_id"], r["reason"]) for r in lineage.fork(log, "s", at, "n").filter(F.col("seq") > at).orderBy("seq").collect()]
    assert shape(3) == [(4, "session/end-seed", 30, None, None), (5, "tool/result", 30, "a", "forked"), (6, "tool/result", 30, "b", "forked"), (7, "step/end", 30, None, "forked"), (8, "turn/end", 30, None, "forked")]
    assert shape(4)[1:] == [(6, "tool/result", 40, "b", "forked"), (7, "step/end", 40, None, "forked"), (8, "turn/end", 40, None, "forked")]
    assert shape(5)[1:] == [(7, "tool/result", 50, "b", "forked"), (8, "turn/end", 50, None, "forked")]
    assert shape(6) == [(7, "session/end-seed", 60, None, None)]


def test_large_members_become_references(spark):
    rows = [('{"a":"' + "é" * 40 + '","b":1,"c":[1,2]}',), ("[1]",), ("{",), (None,)]
    got = [r["s"] for r in spark.createDataFrame(rows, "t string").select(retention.spilled(F.col("t"), 50, 20).alias("s")).collect()]
    whole = json.loads(got[0]["payload"])
    content = ('"' + "é" * 40 + '"').encode()
    key = hashlib.sha256(content).hexdigest()
    assert whole["b"] == 1 and whole["c"] == [1, 2] and [(b["key"], bytes(b["content"])) for b in got[0]["blobs"]] == [(key, content)]
    assert {k: v for k, v in whole["a"].items() if k != "preview"} == {"blob": {"sha256": key, "bytes": 82, "path": f"blobs/{key[:2]}/{key}"}, "original_bytes": 82, "truncated": True}
    assert len(whole["a"]["preview"].encode()) <= 20 and json.loads(whole["a"]["preview"]).startswith("é")
    assert got[1]["payload"] == "[1]" and got[2]["payload"] is None and got[3]["payload"] is None and got[3]["blobs"] == []


def test_global_slot(spark, tmp_path):
    folder = str(tmp_path / "unit")
    assert tables.load_global(spark, folder) is None
    tables.put_global(spark, folder, "one", 1)
    tables.put_global(spark, folder, "two", 2)
    assert tables.load_global(spark, folder) == "two"


def test_streamed_counters_take_nulls():
    rows = pd.DataFrame({"type": ["step/end", "step/end", "step/end", "tool/call", "tool/result", "tool/call", "tool/result"], "time": [1, 2, 3, None, 5, 6, 9], "turn": [1, None, 1, 1, 1, 1, 1], "call_id": [None, None, None, "a", "a", None, None]})
    assert stream_folds.apply_events((0, 0, None, 0, {}), rows) == (2, 3, 1, 3, {})


def test_settings_are_parsed_once_and_dealt_out(spark, tmp_path):
    schema = {"type": "object", "members": {"a": {"type": "object", "members": {"b": {"type": "object", "members": {"c": {"type": "secret"}}}}}}}
    found = str(secrets.strip_secrets(schema, F.col("t")))
    assert found.count("try_parse_json") == 1 and found.count("try_variant_get") == 6  # a walk of its own for value and positions, one map for each of three levels
    spark.range(40).select(F.col("id").alias("c_custkey"), F.concat(F.lit("C"), "id").alias("c_name"), F.lit("M").alias("c_mktsegment")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    from logloom.plans import stored_queries  # noqa: F401
    from logloom.plans.queries import QUERIES

    found = QUERIES["nested_secrets"](spark, str(tmp_path))
    assert found.count() == 40 and found.select(F.spark_partition_id().alias("p")).distinct().count() == 4


def test_long_tours_are_contracted(spark, monkeypatch):
    monkeypatch.setattr(lineage, "SHORT", 16)
    sizes, ranked, draw = [], lineage._ranked, random.Random(5)
    monkeypatch.setattr(lineage, "_ranked", lambda tables, links: sizes.append(links.count()) or ranked(tables, links))
    # a chain, a bush, another tree, a circle and a child of nobody
    parents = {0: None} | {i: i - 1 for i in range(1, 30)} | {i: draw.randrange(i) for i in range(30, 120)} | {200: None, 201: 200, 202: 201, 300: 302, 301: 300, 302: 301, 400: 999}
    rows = [(i, p, draw.randrange(4)) for i, p in parents.items()]
    nodes = spark.createDataFrame(rows, "id long, parent long, created_at long").coalesce(2)
    born, want = {i: c for i, _, c in rows}, []

    def walk(node, depth):
        want.append((node, depth, len(want)))
        for child in sorted((i for i, p in parents.items() if p == node), key=lambda i: (born[i], str(i))):
            walk(child, depth + 1)

    walk(0, 0)
    got = sorted((tuple(r) for r in lineage.preorder(nodes, 0).select("id", "depth", "place").collect()), key=lambda r: r[2])
    assert got == want and sizes[0] <= 16 + 3  # the circle's steps may stay


def test_hunks_come_in_small_batches(spark, tmp_path):
    from logloom.plans import stored_queries  # noqa: F401
    from logloom.plans.queries import QUERIES

    n = 2 * diff.AT_ONCE + 5
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("One. Two! "), F.col("id").cast("string"), F.lit("? Four. Five.")).alias("text")).coalesce(1)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["document_hunks"](spark, str(tmp_path)).collect()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
    assert len({r["doc_id"] for r in found}) == len(found) == n and all(r["rebuilt"] for r in found)


def test_more_files_make_larger_batches_of_the_resumed_stats(spark, monkeypatch):
    from logloom.plans import queries, stored_queries

    ran, write, sf_dir = [], resume.write_checkpoints, "/root/testdata/sf0.001"
    monkeypatch.setattr(resume, "write_checkpoints", lambda *given: ran.append(write(*given)) or ran[-1])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = sorted(map(tuple, stored_queries.resumed_stats(spark, sf_dir).collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == sorted((str(r[0]), *r[1:]) for r in queries.session_stats(spark, sf_dir).collect())
    batches = [p["batchId"] for p in ran[0].recentProgress if p["numInputRows"]]
    assert 2 <= len(batches) <= 4


def test_ancestors_move_nodes_and_not_pairs(spark, monkeypatch):
    draw, sizes, save = random.Random(8), [], lineage.WorkTables.save

    def counted(self, name, df):
        sizes.append((table := save(self, name, df)).count())
        return table

    monkeypatch.setattr(lineage.WorkTables, "save", counted)
    # a chain, trees, walks into circles of several lengths, parents that aren't there, a node without an id
    parents = {i: i - 1 if i else None for i in range(40)} | {i: draw.choice([None, 39, 999, *range(100, i)]) for i in range(100, 140)}
    parents |= {start + i: start + (i + 1) % n for start, n in ((200, 1), (210, 2), (220, 3), (230, 7)) for i in range(n)} | {i: draw.choice([200, 210, 221, 233, *range(300, i)]) for i in range(300, 330)}
    expected = [(None, None, None, "complete")]
    for node in parents:
        way, at = [], node
        while (at := parents[at]) in parents and at not in way:
            way.append(at)
        outcome = "cycle" if at in way else "partial" if at is not None else "complete"
        expected += [(node, x, n, outcome) for n, x in enumerate(way, 1)] or [(node, None, None, outcome)]
    nodes = spark.createDataFrame([*parents.items(), (None, 5)], "id long, parent long")
    assert sorted(map(tuple, lineage.ancestors(nodes).collect()), key=repr) == sorted(expected, key=repr)
    assert max(sizes) <= len(parents) + 1


def test_surfaces_of_many_sessions_share_their_batches(spark):
    import pyarrow as pa

    draw, rows, expected = random.Random(9), [], {}
    for session in [None, *(f"s{i}" for i in range(120))]:
        shown, marks, place = [], {}, 0
        for seq in range(draw.randrange(1, 25)):
            kind, cost = draw.choice(["append", "append", "replace", None]), draw.choice([None, 1, 5])
            span = sorted(draw.choices(range(len(shown)), k=2)) if kind == "replace" and shown else None
            kind = None if kind == "replace" and span is None else kind
            rows.append((session, seq, kind, *((shown[span[0]][0], shown[span[1]][0]) if span else (None, None)), cost))
            marks[seq] = ["log-only", None, None, None]
            if kind:
                gone = shown[span[0] : span[1] + 1] if span else []
                for old, _ in gone:
                    marks[old][0], marks[old][2] = "shadowed", seq
                at = span[0] if span else len(shown)
                shown[at : at + len(gone)] = [(seq, cost or 0)]
                marks[seq] = ["current", None, None, (cost or 0) - sum(c for _, c in gone)]
        for place, (seq, _) in enumerate(shown):
            marks[seq][1] = place
        expected |= {(session, seq): tuple(m) for seq, m in marks.items()}
    schema = "session_id string, seq long, surface_op string, start_seq long, end_seq long, tokens long"
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # sessions run on from batch to batch
    try:
        got = surface.fold_surface(spark.createDataFrame(rows, schema).orderBy(F.rand(3))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(got) == len(rows) and {(r[0], r[1]): tuple(r[2:]) for r in got} == expected
    # before, each session came and went as a frame of its own
    batches = pa.Table.from_pylist([dict(zip(schema.replace(" string", "").replace(" long", "").split(", "), r)) for r in rows]).to_batches(50)
    assert len(batches) > 10 and len(list(surface.fold_sessions(iter(batches)))) == 1
