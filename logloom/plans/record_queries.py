"""Registered queries of stored tables, single folds and record functions, each beside its DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import records, redaction, retention, text
from logloom.operators import filters, folds, lineage, search, timeline, validation
from logloom.plans.inputs import conversation_log, event_log, table
from logloom.plans.queries import query
from logloom.sources import logs, tables
from logloom.sources.scratch import work_folder
from logloom.streaming import folds as stream_folds


def _folder(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _one_of(number: Column, *values: str | None) -> Column:
    """The value whose place is ``number`` modulo their count."""
    return F.get(F.array(*(F.lit(v).cast("string") for v in values)), (number % len(values)).cast("int"))


def _renamed(log: DataFrame, **names: str) -> DataFrame:
    """``log`` with some of its types (their / as _) called otherwise."""
    pairs = F.create_map(*(F.lit(x) for old, new in names.items() for x in (old.replace("_", "/"), new)))
    return log.withColumn("type", F.coalesce(pairs[F.col("type")], "type"))


# Record functions ---------------------------------------------------------------


@query("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'tsx' WHEN 1 THEN 'sv' WHEN 2 THEN 'dotenv' WHEN 3 THEN NULL ELSE 'ps1' END AS name,
 CASE p_size % 5 WHEN 0 THEN 'typescript' WHEN 1 THEN 'system-verilog' WHEN 2 THEN 'dotenv' WHEN 3 THEN NULL ELSE 'powershell' END AS grammar FROM part""")
def read_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", _one_of(F.col("p_size"), "/a.b.TSX", "/x.svh", "/.env", "/a.js/Makefile", "\\dir\\main.PSM1")).alias("path"))
    return paths.select("p_partkey", records.read_language(F.col("path")).alias("name"), records.file_language(F.col("path")).alias("grammar"))


@query("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'UTC' WHEN 1 THEN 'Europe/Paris' WHEN 2 THEN 'UTC' WHEN 4 THEN 'Asia/Kolkata' END AS zone FROM part""")
def canonical_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _one_of(F.col("p_size"), "UTC", "europe/PARIS", "Etc/GMT", " Asia/Tokyo", "Asia/Calcutta", "Mars/Base")
    return table(spark, sf_dir, "part").select("p_partkey", records.canonical_zone(zones, {"Asia/Calcutta": "Asia/Kolkata"}).alias("zone"))


@query("""SELECT p_partkey, 'a.py' AS first_path, NULL::VARCHAR AS first_origin, p_size::BIGINT AS added, 2::BIGINT AS deleted,
 CASE WHEN p_size % 3 = 0 THEN p_name || '.new' ELSE p_name END AS second_path, CASE WHEN p_size % 3 = 0 THEN p_name END AS second_origin FROM part""")
def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = F.concat(F.lit("-\t-\t\0"), F.col("p_name"), F.lit("\0"), F.col("p_name"), F.lit(".new\0"))
    listing = F.concat(F.col("p_size").cast("string"), F.lit("\t2\ta.py\0"), F.when(F.col("p_size") % 3 == 0, renamed).otherwise(F.concat(F.lit("0\t1\t"), F.col("p_name"), F.lit("\0"))))
    found = table(spark, sf_dir, "part").select("p_partkey", retention.numstat(listing).alias("c"))
    first, second = F.get("c", F.lit(0)), F.get("c", F.lit(1))
    return found.select("p_partkey", first["path"].alias("first_path"), first["renamed_from"].alias("first_origin"), first["added"].alias("added"), first["deleted"].alias("deleted"), second["path"].alias("second_path"), second["renamed_from"].alias("second_origin"))


@query("""SELECT c_custkey, c_name || chr(10) || CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment || chr(10) ELSE '' END || 'end' AS text FROM customer""")
def joined_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.array(F.concat(F.lit("\n "), F.col("c_name"), F.lit(" \t")), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).otherwise("  "), F.lit(None).cast("string"), F.lit("end"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.join_text(parts).alias("text"))


@query("""SELECT s_suppkey, s_name AS name, s_acctbal > 0 AS key_set, false AS token_set FROM supplier""")
def stripped_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(F.col("s_name").alias("name"), F.when(F.col("s_acctbal") > 0, "k").alias("key"), F.lit(None).cast("string").alias("token"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", record.alias("r"))
    found = rows.select("s_suppkey", redaction.strip_fields(F.col("r"), ["key", "token"]).alias("x")).select("s_suppkey", "x.*")
    return found.select("s_suppkey", "record.*", F.get("secrets", F.lit(0))["set"].alias("key_set"), F.get("secrets", F.lit(1))["set"].alias("token_set"))


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 1 ELSE 0 END AS lane FROM events""")
def event_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.create_map(*(F.lit(x) for x in ("view", "tool", "click", "message", "error", "subtool", "purchase", "compacted", "signup", "step")))
    return table(spark, sf_dir, "events").select("event_id", timeline.lane(kinds[F.col("event_type")]).alias("lane"))


@query()
def bounded_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as one tool result of at most 200 tokens."""
    blocks = F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(blocks.alias("blocks"))
    place = F.concat(F.lit("/spill/"), records.spill_folder(F.col("conv_id").cast("string")), F.lit("/result.txt"))
    return rows.select("conv_id", retention.bound_inline(F.col("blocks"), place, 200).alias("r")).select("conv_id", "r.*")


@query()
def capped_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a reference of at most 1,500 bytes; each first turn is a checkpoint, every sixth was injected."""
    seq = F.col("seq")
    source = F.when(seq == 0, timeline.CHECKPOINT).when(seq % 6 == 4, "plugin:note").otherwise("user")
    log = conversation_log(spark, sf_dir)
    said = timeline.conversation(log.withColumn("source_kind", F.when(F.col("role") == "user", source)))
    messages = said.groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct("seq", "role", "text", "checkpoint"))).alias("m"))
    rows = log.groupBy("session_id").agg(F.max("seq").alias("turn")).join(messages, "session_id", "left")
    session = F.struct(F.col("session_id").cast("string").alias("session_id"), F.lit("label").alias("label"), F.lit(None).cast("string").alias("cwd"), F.col("turn").alias("captured_through_seq"))
    kind = "array<struct<role: string, text: string, checkpoint: boolean>>"
    plain = F.coalesce(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"), x["checkpoint"].alias("checkpoint"))), F.array().cast(kind))
    return rows.select(F.col("session_id").alias("conv_id"), retention.capped_transcript(session, plain, 1500).alias("t")).select("conv_id", "t.*")


# Filters and checks -------------------------------------------------------------


@query("""SELECT o_orderkey::VARCHAR AS id FROM orders WHERE o_orderkey IN (1, 5, 7, 999999999) AND (o_custkey % 3 = 0 OR o_orderstatus = 'F')
 UNION ALL SELECT o_orderkey::VARCHAR FROM orders WHERE (CASE WHEN o_custkey % 3 <> 0 THEN o_orderstatus END IS NULL OR o_orderstatus = 'P') AND epoch_ms(o_orderdate) < 852076800000""")
def lineage_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderstatus"))
    sessions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), parent.alias("parent_session"), records.utc_millis(F.col("o_orderdate")).alias("created_at"))
    listed = filters.filter_sessions(sessions, [{"kind": "id", "values": ["1", "5", "7", "999999999"]}, {"kind": "parent", "values": ["F", None]}])
    early = filters.filter_sessions(sessions, [{"kind": "parent", "values": ["P", None]}, {"kind": "created-at", "to": 852076799999}])
    return listed.select("id").unionAll(early.select("id"))


@query("""WITH t AS (SELECT l_orderkey AS id, CASE WHEN l_tax = 0 THEN '' WHEN l_linenumber % 4 = 0 THEN 'the same' ELSE l_shipdate::DATE::VARCHAR END AS c, CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END AS r FROM lineitem),
 g AS (SELECT id, bool_or(c = '') AS blank, count(DISTINCT c) < count(*) AS again, sum(r) AS running FROM t GROUP BY id)
 SELECT id, CASE WHEN blank THEN 'blank' WHEN again THEN 'repeated' ELSE 'several in progress' END AS reason FROM g WHERE blank OR again OR running > 1""")
def refused_todos(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = _one_of(F.col("l_suppkey"), "the same", " the same", "the same\t\n", "\u00a0the same")
    content = F.when(F.col("l_tax") == 0, _one_of(F.col("l_suppkey"), " ", "\t", "", "\u3000")).when(F.col("l_linenumber") % 4 == 0, shown).otherwise(F.date_format("l_shipdate", " yyyy-MM-dd"))
    item = F.struct(content.alias("content"), F.when(F.col("l_quantity") > 40, "in_progress").otherwise("pending").alias("status"))
    return validation.invalid_todo_lists(table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(item).alias("items")))


@query("""SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS customer, CASE WHEN o_custkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS other_status,
 CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS other_customer FROM orders WHERE o_orderkey % 2 = 0 AND (o_custkey % 4 = 0 OR o_custkey % 5 = 0)""")
def differing_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"))
    right = left.filter("id % 2 = 0").select("id", F.when(F.col("customer") % 4 == 0, "X").otherwise(F.col("status")).alias("status"), F.when(F.col("customer") % 5 != 0, F.col("customer")).alias("customer"))
    return validation.incompatible_headers(left, right, "status", "customer")


@query("""SELECT o_orderkey AS session_id, o_custkey AS state FROM orders WHERE o_orderkey % 7 NOT IN (0, 1, 2, 3)""")
def usable_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(key.alias("session_id"), F.col("o_custkey").alias("state"), F.lit(4).alias("format_version"), records.utc_millis(F.col("o_orderdate")).alias("created_at"),
                                                 F.when(key % 2 == 0, "/w").alias("cwd"), (key % 7 == 3).alias("is_seeded"), F.when(key % 7 == 3, 5).otherwise(0).alias("inherited_event_count"))
    kept = key % 7 == 6
    stored = rows.withColumnRenamed("session_id", "o_orderkey").withColumn("format_version", F.when(key % 7 != 0, F.col("format_version"))).withColumn("created_at", F.col("created_at") + (key % 7 == 1).cast("int"))
    stored = stored.withColumn("cwd", F.when(key % 7 == 2, "/elsewhere").otherwise(F.col("cwd"))).withColumn("is_seeded", F.when(~kept & (key % 7 != 3), F.lit(False)))
    stored = stored.withColumn("inherited_event_count", F.when(~kept & (key % 7 != 3), F.lit(0)))
    return stream_folds.usable_states(stored.withColumnRenamed("o_orderkey", "session_id"), rows).select("session_id", "state")


# Folds --------------------------------------------------------------------------


@query("""WITH {LOG}, s AS (SELECT session_id, seq, type, coalesce(call_id, 'x') AS p FROM elog WHERE type IN ('step/start', 'assistant/message')),
 c AS (SELECT session_id, max(seq) AS at, max_by(p, seq) AS p FROM s WHERE type = 'step/start' GROUP BY 1), h AS (SELECT session_id, max_by(p, seq) AS used FROM s WHERE type = 'assistant/message' GROUP BY 1),
 m AS (SELECT DISTINCT s.session_id FROM s JOIN c USING (session_id) WHERE s.type = 'assistant/message' AND s.seq > c.at AND s.p = c.p)
 SELECT a.session_id, used, CASE WHEN c.p IS NOT NULL AND m.session_id IS NULL THEN c.p ELSE used END AS next FROM (SELECT DISTINCT session_id FROM elog) a
 LEFT JOIN c USING (session_id) LEFT JOIN h USING (session_id) LEFT JOIN m USING (session_id)""")
def selected_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _renamed(event_log(spark, sf_dir), step_start="model/selection", assistant_message="request/header")
    picked = F.struct(F.coalesce("call_id", F.lit("x")).alias("provider"), F.lit("m").alias("model"), F.lit(None).cast("string").alias("effort"))
    return folds.model_selection(log.withColumn("selection", picked)).select("session_id", F.col("last_used.provider").alias("used"), F.col("next.provider").alias("next"))


@query("""WITH {LOG}, f AS (SELECT session_id, min_by(event_id, seq) AS e FROM elog WHERE type = 'tool/call' GROUP BY 1)
 SELECT a.session_id, f.e::VARCHAR AS provider, CASE WHEN f.e IS NOT NULL THEN f.e % 3 <> 0 END AS valid FROM (SELECT DISTINCT session_id FROM elog) a LEFT JOIN f USING (session_id)""")
def child_model_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    route = F.struct(F.col("event_id").cast("string").alias("provider"), F.lit("m").alias("model"))
    log = _renamed(event_log(spark, sf_dir), tool_call="subagent/model-selection-policy").withColumn("allowed_models", F.when(F.col("event_id") % 3 == 0, F.array(route, route)).otherwise(F.array(route)))
    return folds.model_policy(log).select("session_id", F.get("routes", F.lit(0))["provider"].alias("provider"), "valid")


@query("""WITH {LOG} SELECT session_id, sum(seq)::BIGINT AS input_tokens, coalesce(sum(output_tokens), 0)::BIGINT AS output_tokens, coalesce(sum(event_id % 9), 0)::BIGINT AS cache_read_tokens, 0::BIGINT AS cache_write_tokens FROM elog GROUP BY 1""")
def session_token_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).select("session_id", F.col("seq").alias("input_tokens"), "output_tokens", (F.col("event_id") % 9).alias("cache_read_tokens"), F.lit(None).cast("long").alias("cache_write_tokens"))
    return folds.token_usage(log)


@query("""WITH {LOG}, h AS (SELECT session_id, seq, type, call_id, last_value(CASE WHEN type = 'step/start' THEN coalesce(call_id, 'none') END IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY seq) AS declared FROM elog)
 SELECT session_id, seq, call_id AS tool, coalesce(declared = call_id OR (declared IS NOT NULL AND call_id = '0'), false) AS available FROM h WHERE type = 'tool/call'""")
def available_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _renamed(event_log(spark, sf_dir), step_start="request/header").withColumn("tool", F.col("call_id"))
    return folds.tool_history(log.withColumn("tools", F.when(F.col("type") == "request/header", F.array(F.coalesce("call_id", F.lit("none")), F.lit("0")))))


@query("""WITH {LOG} SELECT session_id, string_agg(event_id::VARCHAR, ',' ORDER BY seq) AS children FROM elog WHERE type = 'tool/result' AND seq >= 3 GROUP BY 1""")
def child_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _renamed(event_log(spark, sf_dir), tool_result="subagent/catalog").select("session_id", "seq", "type", F.col("event_id").cast("string").alias("child_id"), F.lit(3).alias("seed_length"))
    return folds.child_catalog(log).select("session_id", F.array_join("children", ",").alias("children"))


@query("""WITH {LOG} SELECT session_id, CASE WHEN max_by(type, seq) = 'tool/call' THEN max_by(event_id, seq)::VARCHAR END AS items FROM elog WHERE type IN ('tool/call', 'turn/end') GROUP BY 1""")
def current_todos(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _renamed(event_log(spark, sf_dir), tool_call="todo/write", turn_end="turn/start")
    return folds.current_todos(log.withColumn("items", F.col("event_id").cast("string")))


# Lineage, timeline, search ------------------------------------------------------


@query("""WITH c AS (SELECT turn AS seq FROM conversations WHERE conv_id = (SELECT min(conv_id) FROM conversations))
 SELECT 'source' AS relation, seq - 1 AS seq FROM c WHERE seq = 2 UNION ALL SELECT 'derived', seq FROM c WHERE seq = 3 UNION ALL SELECT 'replaced', seq FROM c WHERE seq = 0 UNION ALL SELECT 'replaced-by', seq + 2 FROM c WHERE seq = 2""")
def related_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = conversation_log(spark, sf_dir).withColumn("source_event_seqs", F.when(F.col("seq") >= 2, F.array(F.col("seq") - 1)).otherwise(F.array().cast("array<long>")))
    folded = log.select("session_id", "seq", F.when(F.col("seq") % 2 == 0, F.col("seq") + 2).alias("shadowed_by"))
    least = log.agg(F.min("session_id")).first()[0]
    return lineage.related_events(log, folded, least, 2)


@query("""WITH {LOG}, s AS (SELECT min(session_id) AS id FROM elog), p AS (SELECT seq, type, time, turn, step, call_id FROM elog, s WHERE session_id = id AND seq <= 16),
 q AS (SELECT seq, CASE WHEN type = 'step/start' AND seq % 5 < 3 THEN 'turn/start' ELSE type END AS type, time, turn, step, call_id FROM p),
 m AS (SELECT max(seq) AS last, max_by(time, seq) AS time, max(seq) FILTER (WHERE type IN ('turn/start', 'turn/end')) AS opened, max_by(type, seq) FILTER (WHERE type IN ('turn/start', 'turn/end')) = 'turn/start' AS open,
  max_by(turn, seq) FILTER (WHERE type IN ('turn/start', 'turn/end')) AS turn, max(seq) FILTER (WHERE type IN ('step/start', 'step/end')) AS sat, max_by(type, seq) FILTER (WHERE type IN ('step/start', 'step/end')) AS state, max_by(step, seq) FILTER (WHERE type IN ('step/start', 'step/end')) AS step FROM q),
 w AS (SELECT call_id, max(seq) AS called FROM q, m WHERE open AND q.type IN ('tool/call', 'tool/result') AND seq > m.opened GROUP BY 1 HAVING max_by(q.type, seq) = 'tool/call'),
 n AS (SELECT count(*) AS n FROM w), r AS (
 SELECT seq, type, time, turn, step, call_id, NULL AS reason FROM q UNION ALL SELECT last + 1, 'session/end-seed', time, NULL, NULL, NULL, NULL FROM m
 UNION ALL SELECT last + 1 + row_number() OVER (ORDER BY w.called), 'tool/result', time, turn, step, call_id, 'forked' FROM w, m
 UNION ALL SELECT last + 2 + n, 'step/end', time, turn, step, NULL, 'forked' FROM m, n WHERE open AND state = 'step/start' AND sat > opened
 UNION ALL SELECT last + 2 + n + CASE WHEN coalesce(state = 'step/start' AND sat > opened, FALSE) THEN 1 ELSE 0 END, 'turn/end', time, turn, NULL, NULL, 'forked' FROM m, n WHERE open)
 SELECT -1::BIGINT AS session_id, seq, type, time, turn, step, call_id, reason FROM r""")
def forked_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).select("session_id", "seq", "type", "time", "turn", "step", "call_id")
    log = log.withColumn("type", F.when((F.col("type") == "step/start") & (F.col("seq") % 5 < 3), "turn/start").otherwise(F.col("type")))
    least = log.agg(F.min("session_id")).first()[0]
    return lineage.fork(log, least, 16, -1)


@query("""SELECT conv_id AS session_id, turn AS seq, role, text, role = 'user' AND turn % 4 = 2 AS checkpoint FROM conversations WHERE role IN ('user', 'assistant') AND text <> '' AND NOT (role = 'user' AND turn % 6 = 4)""")
def spoken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    injected = F.when(F.col("seq") % 6 == 4, "plugin:note").when(F.col("seq") % 4 == 2, timeline.CHECKPOINT).otherwise("user")
    return timeline.conversation(conversation_log(spark, sf_dir).withColumn("source_kind", F.when(F.col("role") == "user", injected)))


@query("""WITH c AS (SELECT conv_id, turn, role, trim(text, chr(32) || chr(9) || chr(10) || chr(13)) AS t, (conv_id + turn) % 7 AS k FROM conversations), d AS (
 SELECT conv_id, turn, CASE k WHEN 0 THEN 'tool/call' WHEN 1 THEN 'tool/result' WHEN 2 THEN 'todo/write' WHEN 3 THEN 'turn/end' WHEN 4 THEN 'session/title' ELSE role || '/message' END AS type, CASE k
 WHEN 0 THEN [role, t] WHEN 1 THEN [t, 'grep', '{"a":1}', CASE WHEN turn % 2 = 0 THEN 'Timeout' END, CASE WHEN turn % 2 = 0 THEN 'E' || turn END] WHEN 2 THEN ['pending', t, 'completed', 'x']
 WHEN 3 THEN CASE turn % 5 WHEN 0 THEN ['error', t] WHEN 1 THEN ['aborted'] WHEN 2 THEN ['max-tokens'] WHEN 3 THEN ['interrupted'] END
 WHEN 4 THEN NULL ELSE CASE WHEN role IN ('user', 'assistant') THEN [t, 'grep', '{"a":1}'] END END AS parts FROM c)
 SELECT conv_id AS session_id, turn AS seq, type, turn * 10 AS time, 'current' AS surface, array_to_string(list_filter(parts, lambda p: p <> ''), chr(10)) AS text FROM d WHERE array_to_string(list_filter(parts, lambda p: p <> ''), chr(10)) <> ''""")
def searchable_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, kind = conversation_log(spark, sf_dir), (F.col("session_id") + F.col("seq")) % 7
    block = lambda kind, body, name, given: F.struct(F.lit(kind).alias("type"), body.alias("text"), F.lit(name).alias("name"), F.lit(given).alias("arguments"))
    blocks = F.array(block("text", F.col("text"), "", ""), block("reasoning", F.lit("hidden"), "", ""), block("tool-call", F.lit(""), " grep ", '{"a":1}'), block("image", F.lit("alt"), "", ""))
    failed, seq = F.col("seq") % 2 == 0, F.col("seq").cast("string")
    log = log.withColumn("type", F.when(kind == 0, "tool/call").when(kind == 1, "tool/result").when(kind == 2, "todo/write").when(kind == 3, "turn/end").when(kind == 4, "session/title").otherwise(F.col("type")))
    log = log.withColumn("blocks", blocks).withColumn("name", F.col("role")).withColumn("arguments", F.col("text")).withColumn("error", F.when(failed, F.struct(F.lit("Timeout").alias("name"), F.concat(F.lit("E"), seq).alias("code"))))
    todo = lambda status, content: F.struct(F.lit(status).alias("status"), content.alias("content"))
    log = log.withColumn("todos", F.array(todo("pending", F.col("text")), todo("completed", F.lit(" x "))))
    reason = F.struct(_one_of(F.col("seq"), "error", "aborted", "max-tokens", "interrupted", "completed").alias("kind"), F.col("text").alias("message"))
    return search.search_documents(log.withColumn("reason", reason).withColumn("time", F.col("seq") * 10).withColumn("surface", F.lit("current")))


@query("""WITH {LOG} SELECT CASE WHEN type = 'tool/call' THEN 'ERROR' ELSE 'INFO' END AS severity, session_id::VARCHAR AS session, type AS kind, seq::VARCHAR AS place, event_id::VARCHAR AS body FROM elog""")
def telemetry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).withColumn("severity", F.when(F.col("type") == "tool/call", "ERROR")).withColumn("body", F.col("event_id").cast("string"))
    found = stream_folds.telemetry_records(log)
    at = lambda name: F.element_at("attributes", name)
    return found.select("severity", at("session").alias("session"), at("type").alias("kind"), at("seq").alias("place"), "body")


# Stored tables ------------------------------------------------------------------


@query("""SELECT DISTINCT sha256(text) AS key, octet_length(encode(text))::BIGINT AS bytes, text FROM conversations WHERE text IS NOT NULL AND turn % 2 = 0""")
def stored_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, rows = _folder(spark, "blobs"), table(spark, sf_dir, "conversations").filter("text is not null")
    tables.put_blobs(rows.select(F.encode("text", "UTF-8").alias("content")), root)
    wanted = rows.filter("turn % 2 = 0").select(records.blob_key(F.encode("text", "UTF-8")).alias("key"))
    return tables.get_blobs(spark, root, wanted).select("key", F.octet_length("content").cast("long").alias("bytes"), F.decode("content", "UTF-8").alias("text"))


@query("""SELECT c_custkey::VARCHAR AS key, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_name END AS value, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS version FROM customer WHERE c_custkey % 5 <> 0""")
def keyed_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "keyed")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("value"), F.lit(1).cast("long").alias("version"), "c_custkey")
    tables.put(spark, folder, rows)
    tables.put(spark, folder, rows.filter("c_custkey % 3 = 0").withColumn("value", F.lit("new")).withColumn("version", F.lit(2).cast("long")))
    tables.delete(spark, folder, rows.filter("c_custkey % 5 = 0").withColumn("version", F.lit(3).cast("long")))
    return tables.load(spark, folder)


@query("""SELECT o_orderkey::VARCHAR AS task_id, o_orderstatus AS status, 1 AS attempts, o_orderkey % 2 = 0 AS git FROM orders""")
def task_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark, "index")
    entries = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("task_id"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("attempts"), F.struct((F.col("o_orderkey") % 2 == 0).alias("git")).alias("file_capture"))
    tables.append_index(entries.filter("o_orderkey % 3 = 0").drop("o_orderkey"), root)
    tables.append_index(entries.filter("o_orderkey % 3 <> 0").drop("o_orderkey"), root)
    return tables.read_index(spark, root).select("task_id", "status", "attempts", F.col("file_capture.git").alias("git"))


@query("""SELECT conv_id::VARCHAR AS session_id, turn AS seq, role || '/message' AS type, text AS data FROM conversations""")
def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "log")
    log = conversation_log(spark, sf_dir).select(F.col("session_id").cast("string").alias("session_id"), "seq", "type", F.col("text").alias("data"))
    logs.write_log(log.filter("seq < 3"), folder)
    logs.write_log(log.filter("seq >= 3"), folder)
    return logs.read_log(spark, folder).select("session_id", "seq", "type", "data")


@query("""WITH {LOG} SELECT session_id, seq, event_id FROM elog WHERE session_id = 8 AND seq >= 2 AND seq < 7""")
def partial_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.partial_read(event_log(spark, sf_dir), 8, 2, 5).select("session_id", "seq", "event_id")
