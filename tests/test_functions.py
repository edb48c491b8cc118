import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logloom.functions import records, redaction, retention, text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")


def run(spark, values, expr, kind="string"):
    return [r["x"] for r in column(spark, values, kind).select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_token_estimates(spark):
    assert run(spark, ["", None, "abcd", "abcde", "\U0001f600" * 5], text.text_tokens) == [4, 4, 5, 6, 6]
    blocks = [[("text", "abcde", None, None, None), ("tool-call", None, "n", "12345", None), ("image", None, None, None, '{"a":1}')]]
    kind = "array<struct<type string, text string, name string, arguments string, json string>>"
    assert run(spark, blocks, text.message_tokens, kind) == [6 + 7 + 6 + 4]


def test_join_preview_and_titles(spark):
    assert run(spark, [[" a ", "", None, " ", "b\n"]], text.join_text, "array<string>") == ["a\nb"]
    assert run(spark, [["a  b", "c　d"], ["x" * 9], ["x" * 11]], lambda c: text.preview(c, 10), "array<string>") == ["a b c d", "x" * 9, "x" * 9 + "…"]
    dirty = "\x1b]0;title\x07 \x1b[31mred\x1b[0m\x00‮  two\n​three \x1bMfour"
    assert run(spark, [dirty], text.clean_title) == ["red two three four"]
    assert run(spark, ["one  two three"], lambda c: text.fallback_title(c, 2, 100)) == ["one two"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20), st.integers(1, 12))
def test_utf8_truncation(spark, values, limit):
    expected = []
    for v in values:
        out = ""
        for c in v:
            if len((out + c).encode()) > limit:
                break
            out += c
        expected.append(out)
    assert run(spark, values, lambda c: text.truncate_utf8(c, limit)) == expected


def prune(blocks, threshold, head, tail, marker):
    points = [(b, p) for b, (kind, t) in enumerate(blocks) if kind == "text" for p in t]
    if len(points) <= threshold:
        return blocks
    gone = range(head, len(points) - tail)
    first, out = next(b for i, (b, _) in enumerate(points) if i in gone), []
    for b, (kind, t) in enumerate(blocks):
        if kind != "text":
            out.append((kind, t))
            continue
        before = "".join(p for i, (x, p) in enumerate(points) if x == b and i < head)
        after = "".join(p for i, (x, p) in enumerate(points) if x == b and i >= len(points) - tail)
        whole = before + (marker if b == first else "") + after
        if whole:
            out.append((kind, whole))
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["text", "text", "image"]), st.text(alphabet="ab\U0001f600", max_size=9)), max_size=5))
def test_pruning_across_blocks(spark, blocks):
    got = run(spark, [blocks], lambda c: text.prune_blocks(c, 12, 4, 3, "[.]"), "array<struct<type string, text string>>")[0]
    plain = [b for b in prune(blocks, 12, 4, 3, "[.]") if sum(len(t) for k, t in blocks if k == "text") <= 12 or b[0] != "text" or b[1]]
    assert [tuple(b) for b in got] == plain


def test_literal_filter_and_globs(spark):
    pattern = text.literal_pattern(" a.b\t(C) ")
    assert run(spark, ["x A.B   (c)", "aXb (c)", "a.b(c)"], lambda c: c.rlike(pattern)) == [True, False, False]
    with pytest.raises(ValueError):
        text.literal_pattern(" \n")
    paths = ["src/a.py", "src/x/a.py", "node_modules", "node_modules/p/i.js", "a.b", "aXb"]
    check = lambda p: run(spark, paths, lambda c: text.matches_glob(c, p))
    assert check("src/*.py") == [True, False, False, False, False, False]
    assert check("**/*.py") == [True, True, False, False, False, False]
    assert check("node_modules") == [False, False, True, True, False, False]
    assert check("a.b") == [False, False, False, False, True, False]
    assert check("src/**") == [True, True, False, False, False, False] and check("a?b") == [False] * 4 + [True, True]


def test_waits_and_buckets(spark):
    now = F.lit(1705276800000)
    values = ["3", " 2.5 ", "-1", "Mon, 15 Jan 2024 00:00:10 GMT", "Sun, 14 Jan 2024 00:00:00 GMT", "soon", "", None]
    assert run(spark, values, lambda c: records.retry_after_ms(c, now)) == [3000, 2500, None, 10000, 0, None, None, None]
    odd = ["Infinity", "NaN", "1e300", "9" * 400, "1d", "\t4\n"]
    assert run(spark, odd, lambda c: records.retry_after_ms(c, now)) == [None, None, 2**63 - 1, None, None, 4000]
    messages = ["429 Too Many Requests; retry-after: 7", "rate_limited", "status 4290, retry-after: 7", "Rate limit: Retry_After=5s"]
    assert run(spark, messages, lambda c: records.message_retry_after_ms(c, now)) == [7000, None, None, 5000]
    odd = ["429, Retry-After: Infinity", "429, Retry-After: " + "9" * 30 + "s"]
    assert run(spark, odd, lambda c: records.message_retry_after_ms(c, now)) == [None, 2**63 - 1]
    assert run(spark, messages, records.is_rate_limit) == [True, True, False, True]
    assert run(spark, ["SUCCESS", "TIMEOUT", "UNKNOWN", "ERROR"], lambda c: records.bucket_for(c, F.lit("infrastructure"))) == ["success", "failed", "invalid/unknown", "invalid/infrastructure-error"]


def test_names_references_and_times(spark):
    assert run(spark, ["a b/é", "ok-1_.x"], records.safe_name) == ["a~0020b~002F~00E9", "ok-1_.x"]
    names = ["", ".", "..", "~", "\U0001f600", "\U0001f601", "...", None]
    assert run(spark, names, records.safe_name) == ["~", "~002E", "~002E~002E", "~007E", "~D83D~DE00", "~D83D~DE01", "...", None]
    ids = ["s", 'q"\\é', "longer id with spaces", "\U0001f600"]
    assert run(spark, ids, lambda c: records.referenced_session(records.session_reference(c))) == ids
    assert run(spark, ["session:InMi", "session:InMi=", "other", "session:!"], records.referenced_session) == ["s", None, None, None]
    assert run(spark, [1706700000123], lambda c: records.iso_time(c), "long") == ["2024-01-31T11:20:00.123Z"]
    assert run(spark, [1706700000123], lambda c: records.zoned_time(c, "America/St_Johns"), "long") == ["2024-01-31T07:50:00-03:30[America/St_Johns]"]
    paths = ["a/B.TSX", "noext", "x.tar.gz", "c.d/e", "C:\\d.py\\main.PS1", ".env", "a.", None]
    assert run(spark, paths, records.file_language) == ["typescript", None, None, None, "powershell", "dotenv", None, None]
    assert run(spark, paths, records.read_language) == ["tsx", None, None, None, "ps1", "dotenv", None, None]
    zones = ["UTC", "utc", "europe/paris", "Etc/GMT", "Asia/Tokyo ", "", "CET", "Mars/Base", None]
    assert run(spark, zones, records.canonical_zone) == ["UTC", None, "Europe/Paris", "UTC", None, None, None, None, None]


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 30), max_size=20))
def test_ranges(spark, values):
    seqs = sorted(values)
    df = column(spark, [seqs], "array<bigint>").select(records.encode_ranges(F.col("v")).alias("e"))
    row = df.select("e", records.decode_ranges(F.col("e")).alias("d")).first()
    assert row["d"] == seqs
    runs, i = [], 0
    while i < len(seqs):
        j = i
        while j + 1 < len(seqs) and seqs[j + 1] == seqs[j] + 1:
            j += 1
        runs += [[seqs[i], seqs[j]]] if j - i >= 2 else [[x] for x in seqs[i : j + 1]]
        i = j + 1
    assert row["e"] == runs


def test_unordered_lists_stay(spark):
    assert run(spark, [[3, 1, 2]], records.encode_ranges, "array<bigint>") == [[[3], [1], [2]]]


def test_redaction_order_and_idempotence(spark):
    source = "mail a@b.org password = hunter2, key sk-abcdefghijklmnop Bearer abcdefghijkl secretword"
    once = redaction.redact_text(source, ["secretword", "secret"])
    assert "hunter2" not in once and "a@b.org" not in once and "secretword" not in once and "[redacted:literal]" in once
    assert redaction.redact_text(once, ["secretword", "secret"]) == once
    assert run(spark, [source, None], lambda c: redaction.redact(c, ["secretword"])) == [redaction.redact_text(source, ["secretword"]), None]
    alone = ["clean text", "-----BEGIN PRIVATE KEY-----x-----END PRIVATE KEY-----", "Bearer abcdefgh1", "ghp_0123456789ab", "PA\u017fSWORD = x", "to\u212aen:y", "api_key: z", "a@b.org", "the literal word", ""]
    assert run(spark, alone, lambda c: redaction.redact(c, ["literal"])) == [redaction.redact_text(x, ["literal"]) for x in alone]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abé", max_size=40), max_size=5), st.integers(0, 60))
def test_retention_budget(texts, budget):
    head, tail, omitted = retention.head_and_tail(texts, budget)
    cost = lambda parts: sum(math.ceil(len(t) / 4) + 4 for t in parts)
    assert cost(head) <= math.ceil(budget / 2) and cost(tail) <= budget // 2
    size = lambda parts: sum(len(t.encode()) for t in parts)
    assert size(texts) == size(head) + size(tail) + omitted
    assert "".join(texts).startswith("".join(head)) and "".join(texts).endswith("".join(tail))


def test_json_previews_numstat_and_diff(spark):
    whole = json.dumps({"a": "x" * 500, "b": [1] * 300, "c": {"d": "y" * 100}})
    short = run(spark, [whole, "not json " * 50, None], lambda c: retention.json_preview(c, 200))
    assert all(len(s.encode()) <= 200 and json.loads(s) is not None for s in short[:2]) and short[2] is None
    parsed = run(spark, ["3\t1\ta.py\x00-\t-\tb.bin\x000\t2\t\x00old\x00new\x00"], retention.numstat)[0]
    assert [tuple(r) for r in parsed] == [("a.py", None, 3, 1), ("b.bin", None, 0, 0), ("new", "old", 0, 2)]
    df = spark.createDataFrame([("a\nb\nc", "a\nx\nc\nd"), (None, "q")], "o string, n string")
    assert [tuple(r["d"]) for r in df.select(retention.text_diff(F.col("o"), F.col("n")).alias("d")).collect()] == [(1, 2, 1), (1, 1, 0)]


def test_secret_fields(spark):
    df = spark.createDataFrame([(("u", "p", None),)], "r struct<user string, password string, token string>")
    row = df.select(redaction.strip_fields(F.col("r"), ["password", "token"]).alias("x")).first()["x"]
    assert row["record"].asDict() == {"user": "u"} and [tuple(s) for s in row["secrets"]] == [("password", True), ("token", False)]


def test_heads_and_titles_of_all_documents(spark, tmp_path):
    from logloom.plans.queries import QUERIES

    texts = ["é" * 30, "語" * 25 + "x", "a" * 39 + "é", "plain", "", None, "ab 語" * 30, "w" * 70 + " two three four", "語" * 30 + " zwei drei vier", "x" * 59 + "é b c", "one two three four"]
    rows = [(i, t, (None, "ja", "de")[i % 3]) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    cut = lambda t, n: None if t is None else t.encode()[:n].decode("utf-8", "ignore")
    heads = {r["doc_id"]: r["head"] for r in QUERIES["utf8_heads_whole"](spark, str(tmp_path)).collect()}
    assert heads == {i: cut(t, 40) for i, t in enumerate(texts)}
    titles = {r["doc_id"]: r["title"] for r in QUERIES["fallback_titles_whole"](spark, str(tmp_path)).collect()}
    assert {i: t or "" for i, t in titles.items()} == {i: cut(" ".join((t or "").split()[:3]), 60).rstrip() for i, t in enumerate(texts)}


def test_session_mentions(spark):
    ids = ["a", "x]y\\z", "ü \n", "{}"]
    both = lambda c: records.referenced_sessions(F.concat(F.lit("to "), records.session_mention(c), F.lit("."), records.session_reference(c)))
    assert [(r["text"], [tuple(s) for s in r["sessions"]]) for r in run(spark, ids, both)] == [(f"to @{i}.@{i}", [(i, i)] * 2) for i in ids]
    long = "@[" + "n" * 100_000 + "](session:ImEi)"
    plain = ["", None, "no session: here, @[x](y)", "@[x](session:)", "session:zz", long, "@[\\](session:ImEi)"]
    got = run(spark, plain, records.referenced_sessions)
    assert [None if r is None else (r["text"], len(r["sessions"])) for r in got] == [
        ("", 0), None, (plain[2], 0), None, None, ("@" + "n" * 100_000, 1), ("@[\\](@a)", 1),
    ]


def test_prompt_tokens_and_headers(spark):
    kind = "array<struct<type string, text string, name string, arguments string, json string>>"
    blocks = [[], None, [("text", "abcde", None, None, None), ("text", None, None, None, None), ("image", None, None, None, '{"a":1}')]]
    assert run(spark, blocks, text.system_tokens, kind) == [0, 0, 3 + 4]
    assert run(spark, [None, "[]", "[12345]"], text.tools_tokens) == [0, 0, 2 + 4]
    kind = "struct<config string, adapter_defaults struct<reasoning_effort boolean, max_tokens boolean>, tools array<string>>"
    headers = [("c", None, []), ("c", (False, None), None), ("c", (None, True), ["t"])]
    got = run(spark, headers, records.canonical_header, kind)
    assert [(h["config"], h["adapter_defaults"], h["tools"]) for h in got] == [("c", None, None), ("c", None, None), ("c", (None, True), ["t"])]


def replayed_transcript(facts, messages, budget):
    """The rules step by step: one message or one cut at a time, sizes always of the whole JSON."""
    kept = [dict(m, now=m["text"], lost=0) for m in messages]
    size = lambda: len(retention._tag_safe({**facts, "conversation": [{"role": m["role"], "text": m["now"]} for m in kept]}).encode())
    bytes_of = lambda t: len(t.encode())
    gone = 0
    while size() > budget:
        at = next((i for i, m in enumerate(kept[:-1]) if not m["checkpoint"]), None)
        if at is None:
            break
        gone += bytes_of(kept.pop(at)["text"])
    while size() > budget:
        longest = max(kept, key=lambda m: bytes_of(m["now"]), default=None)
        if longest is None or not longest["now"]:
            return None
        limit, data, best = max(0, bytes_of(longest["now"]) - (size() - budget)), longest["text"].encode(), ("", bytes_of(longest["text"]))
        for n in range(limit + 1):
            ends = data[: (n + 1) // 2].decode("utf-8", "ignore") + data[len(data) - n // 2 :].decode("utf-8", "ignore")
            cut = f"{ends}\n[… omitted {len(data) - bytes_of(ends)} UTF-8 bytes …]"
            best = (cut, len(data) - bytes_of(ends)) if bytes_of(cut) <= limit else best
        if best[0] == longest["now"]:
            return None
        longest["now"], longest["lost"] = best
    return [m["now"] for m in kept], gone + sum(m["lost"] for m in kept), len(messages) - len(kept)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ab<é\U0001f600\n\"", min_size=1, max_size=90), st.booleans()), max_size=6), st.integers(0, 500))
def test_transcripts_against_a_replay(items, budget):
    facts = {"sessionId": "s", "label": "<l>", "cwd": None, "capturedThroughSeq": 3}
    messages = [{"role": "user", "text": t, "checkpoint": c} for t, c in items]
    got, want = retention.fit_transcript(facts, messages, budget), replayed_transcript(facts, messages, budget)
    assert (got is None) == (want is None)
    if got:
        data = json.loads(got[0])
        assert "<" not in got[0] and len(got[0].encode()) <= budget and {k: data[k] for k in facts} == facts
        assert ([m["text"] for m in data["conversation"]], got[5], got[4]) == want


def test_capped_and_bounded_columns(spark):
    session = F.struct(F.lit("s").alias("session_id"), F.lit("l").alias("label"), F.lit(None).cast("string").alias("cwd"), F.lit(None).cast("long").alias("captured_through_seq"))
    kind = "array<struct<role string, text string, checkpoint boolean>>"
    lists = [[("user", "x", True), ("user", "", False), ("assistant", None, False)], [], None]
    got = run(spark, lists, lambda v: retention.capped_transcript(session, v, 1000), kind)
    assert [(r["original"], r["retained"], r["compacted"], r["truncated"]) for r in got] == [(1, 1, True, False), (0, 0, False, False), (0, 0, False, False)]
    assert run(spark, lists, lambda v: retention.capped_transcript(session, v, 20), kind) == [None, None, None]
    blocks = [["a" * 4000, "b" * 4000], ["short", None], None]
    cut, whole, none = run(spark, blocks, lambda v: retention.bound_inline(v, F.lit("/at"), 300), "array<string>")
    assert cut["spilled"] and sum(map(retention._cost, [cut["text"]])) <= 300
    head, tail = cut["text"].split(retention.GAP)
    kept = len(head) + len(tail.rsplit("\n\n", 1)[0])
    assert cut["omitted_bytes"] == 8000 - kept and cut["text"].endswith(f"(Omitted {8000 - kept} bytes. Full formatted result stored at: /at. {retention.SPILL_HINT})")
    assert (whole["text"], whole["spilled"]) == ("short", False) and (none["text"], none["spilled"]) == ("", False)
    # a notice that doesn't fit leaves the result whole
    assert [r["spilled"] for r in run(spark, blocks, lambda v: retention.bound_inline(v, F.lit("/at"), 10), "array<string>")] == [False] * 3
    assert not run(spark, blocks, lambda v: retention.bound_inline(v, F.lit(None).cast("string"), 300), "array<string>")[0]["spilled"]


def test_mentions_are_parsed_once_and_dealt_out(spark, tmp_path):
    assert str(records.referenced_sessions(F.col("t"))).count("from_json") == 1
    assert str(records.referenced_session(F.col("t"))).count("from_json") == 1
    spark.range(40).select(F.col("id").alias("c_custkey"), F.concat(F.lit("C"), "id").alias("c_name"), F.lit("M").alias("c_mktsegment")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    from logloom.plans.queries import QUERIES

    found = QUERIES["session_mentions"](spark, str(tmp_path))
    assert found.count() == 40 and found.select(F.spark_partition_id().alias("p")).distinct().count() == 4


def test_titles_clean_a_text_once(spark):
    assert str(text.truncate_utf8(F.upper("t"), 20)).lower().count("upper(") == 1
    assert str(text.fallback_title(F.col("t"), 2, 20)).lower().count("rlike(") == 1
    texts = ["one two three", " a\n\n b  c", "a  b", "　", "", "\x1b[31mred\x1b[0m x y", "a​ b", None]
    assert run(spark, texts, lambda c: text.fallback_title(c, 2, 20)) == ["one two", "a b", "a b", "", "", "red x", "a b", None]
