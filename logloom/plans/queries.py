"""Registered queries over the driver's tables, each beside its DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import records, redaction, retention, text
from logloom.operators import filters, folds, lineage, migration, search, surface, timeline, validation
from logloom.plans.inputs import conversation_log, event_log, spread, table
from logloom.sources import tables
from logloom.sources.scratch import work_folder, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The log of the events table, for DuckDB.
LOG = """log AS (
  SELECT user_id AS session_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS seq, (epoch_us(ts) // 1000) AS time, value, event_id,
         CAST(CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) % 4 AS VARCHAR) AS call_id, event_type
  FROM events
), elog AS (
  SELECT session_id, seq, time, value, event_id, call_id, seq // 20 AS turn, seq // 5 AS step,
         CASE WHEN seq % 20 = 19 THEN 'turn/end' ELSE CASE event_type WHEN 'view' THEN 'step/start' WHEN 'click' THEN 'assistant/message'
              WHEN 'error' THEN 'tool/call' WHEN 'purchase' THEN 'tool/result' ELSE 'step/end' END END AS type,
         CASE WHEN event_id % 3 <> 0 THEN time - 5 END AS first_token_time, CASE WHEN event_id % 5 <> 0 THEN CAST(floor(value) AS BIGINT) END AS output_tokens
  FROM log
)"""


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql.replace("{LOG}", LOG)
        return f

    return register


# Tokens and texts ---------------------------------------------------------------


@query("""SELECT conv_id, count(*) AS messages, sum(CAST(ceil(length(text) / 4.0) AS BIGINT) + 4)::BIGINT AS text_tokens,
 sum(CAST(ceil(length(text) / 4.0) AS BIGINT) + 8)::BIGINT AS message_tokens FROM conversations GROUP BY conv_id""")
def conversation_token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    tokens = text.text_tokens(F.col("text"))
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("messages"), F.sum(tokens).alias("text_tokens"), F.sum(tokens + text.ROLE_OVERHEAD).alias("message_tokens"))


@query("""SELECT event_id, CAST(ceil(length(event_type) / 4.0) + ceil(length(props) / 4.0) + 4 + ceil(length(event_type || props) / 4.0) + 4 + 4 AS BIGINT) AS tokens FROM events""")
def block_token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = lambda kind, t, n, a: F.struct(F.lit(kind).alias("type"), t.alias("text"), n.alias("name"), a.alias("arguments"), F.lit(None).cast("string").alias("json"))
    none = F.lit(None).cast("string")
    blocks = F.array(block("tool-call", none, F.col("event_type"), F.col("props")), block("text", F.concat("event_type", "props"), none, none))
    return table(spark, sf_dir, "events").select("event_id", text.message_tokens(blocks).alias("tokens"))


@query("""SELECT doc_id, CASE WHEN length(t) > 79 THEN rtrim(substr(t, 1, 79)) || '…' ELSE t END AS preview FROM
 (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)""")
def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.preview(F.array("text"), 80).alias("preview"))


#: The longest prefix of a text (column t) within some bytes; each has four at most.
_HEAD = "CASE WHEN strlen(t) <= {n} THEN t ELSE (SELECT max_by(p, strlen(p)) FROM (SELECT substr(t, 1, i::INT) AS p FROM range({low}, {n} + 1) r(i)) WHERE strlen(p) <= {n}) END"
#: Texts as one clean line (column c), as a title has them.
_LINE = r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(\x1B\]|\x{9D})(?s:.*?)(\x07|\x1B\\|\z)', '', 'g'), '(\x1B\[|\x{9B})[0-?]*[ -/]*[@-~]', '', 'g'), '\x1B[@-_]', '', 'g'),
 '[\x01-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]', '', 'g'), '[\x{200B}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}]', '', 'g'), '[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS c FROM documents"""


def _titles(words: int, size: int) -> str:
    line = f"SELECT doc_id, array_to_string(list_slice(list_filter(string_split(c, ' '), lambda w: w <> ''), 1, {words}), ' ') AS t FROM ({_LINE})"
    return f"SELECT doc_id, rtrim({_HEAD.format(n=size, low=size // 4)}) AS title FROM ({line})"


@query(_titles(5, 25))
def fallback_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.fallback_title(F.col("text"), 5, 25).alias("title"))


@query(f"SELECT doc_id, {_HEAD.format(n=17, low=4)} AS head FROM (SELECT doc_id, text AS t FROM documents)")
def utf8_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate_utf8(F.col("text"), 17).alias("head"))


@query(_titles(3, 60))
def fallback_titles_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.fallback_title(F.col("text"), 3, 60).alias("title"))


@query(f"SELECT doc_id, {_HEAD.format(n=40, low=10)} AS head FROM (SELECT doc_id, text AS t FROM documents)")
def utf8_heads_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate_utf8(F.col("text"), 40).alias("head"))


@query("""SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 100) || chr(10) || '[...]' || chr(10) || right(text, 50) ELSE text END AS pruned FROM documents""")
def pruned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.prune_middle(F.col("text"), 200, 100, 50).alias("pruned"))


@query("""SELECT conv_id, count(*) FILTER (WHERE length(text) > 200) AS prunes, coalesce(sum(length(text) - 157) FILTER (WHERE length(text) > 200), 0)::BIGINT AS chars_removed FROM conversations GROUP BY conv_id
 HAVING count(*) FILTER (WHERE length(text) > 200) > 0""")
def prune_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = conversation_log(spark, sf_dir).withColumn("chars_before", F.char_length("text").cast("long"))
    log = log.withColumn("chars_after", F.char_length(text.prune_middle(F.col("text"), 200, 100, 50)).cast("long")).filter("chars_after < chars_before")
    totals = folds.prune_totals(log.withColumn("type", F.lit("compaction/prune")))
    return totals.withColumnRenamed("session_id", "conv_id")


@query()
def retained_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split("text", F.lit("\n"))
    return table(spark, sf_dir, "documents").select("doc_id", retention.retain(parts, 200).alias("r")).select("doc_id", "r.*")


@query("""SELECT doc_id, regexp_replace(text, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b', '[redacted:email]', 'g') AS text FROM documents
 WHERE NOT regexp_matches(text, '(?i)(-----BEGIN|\\bbearer\\s|\\b(sk|pk|ghp|gho|AKIA|xoxb)[-_A-Za-z0-9]{12,}|\\b(password|passwd|secret|token|api[_-]?key)\\s*[:=])')""")
def redacted_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").filter(
        ~F.col("text").rlike(r"(?i)(-----BEGIN|\bbearer\s|\b(sk|pk|ghp|gho|AKIA|xoxb)[-_A-Za-z0-9]{12,}|\b(password|passwd|secret|token|api[_-]?key)\s*[:=])")
    )
    return rows.select("doc_id", redaction.redact(F.col("text")).alias("text"))


@query()
def redacted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", redaction.redact(F.col("text")).alias("text"))


# Filters ------------------------------------------------------------------------


@query("""SELECT conv_id AS session_id, turn AS seq FROM conversations WHERE regexp_matches(text, '(?i)of\\s+the') AND turn BETWEEN 1 AND 5 AND role IN ('assistant', 'system')""")
def filtered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    clauses = [{"kind": "text", "text": "OF  the"}, {"kind": "seq", "from": 1, "to": 5}, {"kind": "type", "values": ["assistant/message", "system/message"]}]
    return filters.filter_events(conversation_log(spark, sf_dir), clauses).select("session_id", "seq")


@query("""SELECT o_orderkey AS id FROM orders WHERE (o_orderpriority IN ('1-URGENT') OR (CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderpriority END) IS NULL)
 AND epoch_ms(o_orderdate) >= 852076800000 AND o_orderstatus IN ('F', 'O')""")
def filtered_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cwd = F.when(F.col("o_custkey") % 10 != 0, F.col("o_orderpriority"))
    sessions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), cwd.alias("cwd"), records.utc_millis(F.col("o_orderdate")).alias("created_at"), (F.col("o_orderstatus") == "F").alias("live"), (F.col("o_orderstatus") == "O").alias("persisted"))
    clauses = [{"kind": "cwd", "values": ["1-URGENT", None]}, {"kind": "created-at", "from": 852076800000}, {"kind": "availability", "values": ["live", "persisted"]}]
    return filters.filter_sessions(sessions, clauses).select("id")


@query("""SELECT p_partkey, p_type || '/' || replace(p_name, ' ', '/') AS path FROM part WHERE regexp_matches(p_type || '/' || replace(p_name, ' ', '/'), '^(?:.*/)?[^/]*ing$') AND p_type <> 'SMALL'""")
def kept_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_type", F.lit("/"), F.translate("p_name", " ", "/")).alias("path"))
    return paths.filter(text.is_kept(F.col("path"), include=["**/*ing"], exclude=["SMALL"]))


@query("""SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem WHERE l_quantity > 45 AND l_orderkey IN
 (SELECT o_orderkey FROM orders WHERE o_orderpriority = (SELECT o_orderpriority FROM orders WHERE o_orderkey = 0) OR o_orderkey = 0)""")
def authorized_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("cwd"))
    requested = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").cast("string").alias("id"))
    return filters.authorized_ids(requested, sessions, "0")


# Validation ---------------------------------------------------------------------


@query("""SELECT session_id, seq, expected FROM (SELECT conv_id AS session_id, turn AS seq, coalesce(lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) + 1, 0) AS expected
 FROM conversations WHERE (conv_id + turn) % 7 <> 0) WHERE seq <> expected""")
def log_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.gaps(conversation_log(spark, sf_dir).filter("(session_id + seq) % 7 <> 0"))


@query("""WITH {LOG} SELECT session_id, seq, CASE type WHEN 'assistant/message' THEN 'request/header' ELSE type END AS type FROM elog WHERE type IN ('step/end', 'turn/end') AND NOT (event_id % 2 = 0) OR type = 'assistant/message' AND event_id % 5 = 0""")
def unknown_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.range(4).select(F.get(F.array(*(F.lit(x) for x in ("step/start", "request/header", "tool/call", "tool/result"))), F.col("id").cast("int")).alias("type"))
    log = event_log(spark, sf_dir).withColumn("type", F.when(F.col("type") == "assistant/message", "request/header").otherwise(F.col("type")))
    reasons = F.when(F.col("event_id") % 5 == 0, validation.RETIRED_REASON).otherwise("changed")
    return validation.unknown_types(log.withColumn("ignorable", F.col("event_id") % 2 == 0).withColumn("reason", reasons), known)


@query("""WITH {LOG}, l AS (SELECT session_id, max_by(type, seq) FILTER (WHERE type IN ('step/start', 'turn/end')) AS state, max(seq) AS seq, max(time) AS time,
 max_by(turn, seq) FILTER (WHERE type IN ('step/start', 'turn/end')) AS turn FROM elog GROUP BY session_id)
 SELECT session_id, seq + 1 AS seq, 'turn/end' AS type, time, turn FROM l WHERE state = 'step/start'""")
def closed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).select("session_id", "seq", F.when(F.col("type") == "step/start", "turn/start").otherwise(F.col("type")).alias("type"), "time", "turn").withColumn("stored", F.lit(True))
    return validation.append_closers(log).filter("stored is null").drop("stored")


# Folds --------------------------------------------------------------------------


@query("""WITH {LOG}, a AS (
  SELECT *, last_value(CASE WHEN type = 'step/start' THEN seq END IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY seq) AS epoch,
    sum(CASE WHEN type = 'turn/end' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY seq) AS calls FROM elog
), b AS (
  SELECT a.*, s.turn AS oturn, s.step AS ostep, s.time AS otime, coalesce(sum(CASE WHEN a.type = 'step/end' THEN 1 ELSE 0 END) OVER (PARTITION BY a.session_id, epoch ORDER BY a.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ends
  FROM a LEFT JOIN (SELECT session_id AS sid, seq AS sseq, turn, step, time FROM elog) s ON s.sid = a.session_id AND s.sseq = a.epoch
), c AS (SELECT *, row_number() OVER (PARTITION BY session_id, epoch ORDER BY seq) AS nth FROM b WHERE type = 'assistant/message' AND ends = 0 AND oturn = turn AND ostep = step),
m AS (SELECT session_id, sum(greatest(0, time - otime)) AS llm_ms, sum(greatest(0, first_token_time - otime)) FILTER (WHERE first_token_time IS NOT NULL) AS ttft_ms, count(first_token_time) AS ttft_steps,
  sum(greatest(0, time - first_token_time)) FILTER (WHERE first_token_time IS NOT NULL AND output_tokens IS NOT NULL) AS decode_ms, sum(output_tokens) FILTER (WHERE first_token_time IS NOT NULL) AS decode_tokens FROM c WHERE nth = 1 GROUP BY session_id),
t AS (SELECT session_id, sum(greatest(0, time - ptime)) AS tool_ms FROM (SELECT *, lag(type) OVER w AS ptype, lag(time) OVER w AS ptime FROM a WHERE type IN ('tool/call', 'tool/result') WINDOW w AS (PARTITION BY session_id, call_id, calls ORDER BY seq)) WHERE type = 'tool/result' AND ptype = 'tool/call' GROUP BY session_id),
e AS (SELECT session_id, count(*) AS steps, count(*) FILTER (WHERE p IS NULL OR p <> turn) AS turns FROM (SELECT *, lag(turn) OVER (PARTITION BY session_id ORDER BY seq) AS p FROM elog WHERE type = 'step/end') GROUP BY session_id)
SELECT s.session_id, coalesce(turns, 0)::BIGINT AS turns, coalesce(steps, 0)::BIGINT AS steps, coalesce(llm_ms, 0)::BIGINT AS llm_ms, coalesce(tool_ms, 0)::BIGINT AS tool_ms, coalesce(ttft_ms, 0)::BIGINT AS ttft_ms,
  coalesce(ttft_steps, 0)::BIGINT AS ttft_steps, coalesce(decode_ms, 0)::BIGINT AS decode_ms, coalesce(decode_tokens, 0)::BIGINT AS decode_tokens
FROM (SELECT DISTINCT session_id FROM elog) s LEFT JOIN m USING (session_id) LEFT JOIN t USING (session_id) LEFT JOIN e USING (session_id)""")
def session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.session_stats(event_log(spark, sf_dir))


@query("""SELECT conv_id AS session_id, 0::BIGINT AS turn, 0::BIGINT AS seq,
  coalesce(CASE WHEN length(p) > 49 THEN rtrim(substr(p, 1, 49)) || '…' ELSE p END, '') AS prompt, coalesce(CASE WHEN length(a) > 119 THEN rtrim(substr(a, 1, 119)) || '…' ELSE a END, '') AS response
FROM (SELECT conv_id, min_by(t, turn) FILTER (WHERE role = 'user' AND t <> '') AS p, max_by(t, turn) FILTER (WHERE role = 'assistant' AND t <> '') AS a
  FROM (SELECT conv_id, turn, role, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM conversations) GROUP BY conv_id)""")
def turn_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = conversation_log(spark, sf_dir)
    plain = log.select("session_id", (F.col("seq") + 1).alias("seq"), "type", F.lit(0).cast("long").alias("turn"), F.when(F.col("role") == "user", "user").alias("source_kind"), F.array("text").alias("parts"))
    ends = log.groupBy("session_id").agg(F.max("seq").alias("last"))
    mark = lambda seq, kind: ends.select("session_id", seq.cast("long").alias("seq"), F.lit(kind).alias("type"), F.lit(0).cast("long").alias("turn"))
    whole = plain.unionByName(mark(F.lit(0), "turn/start"), allowMissingColumns=True).unionByName(mark(F.col("last") + 2, "turn/end"), allowMissingColumns=True)
    return folds.turn_outline(whole)


@query("""SELECT session_id, seq, running, running = 0 AS balanced FROM (SELECT conv_id AS session_id, turn AS seq, sum(CASE WHEN role = 'assistant' THEN turn % 3 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS running FROM conversations)""")
def tool_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.tool_balance(conversation_log(spark, sf_dir).withColumn("n_calls", F.col("seq") % 3))


@query("""SELECT conv_id AS session_id, turn AS seq, sum(CAST(ceil(length(text) / 4.0) AS BIGINT) + 8) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS total_tokens FROM conversations""")
def context_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = conversation_log(spark, sf_dir).withColumn("delta_tokens", text.text_tokens(F.col("text")) + text.ROLE_OVERHEAD)
    return folds.running_tokens(log)


@query("""WITH {LOG} SELECT session_id, max_by(value, seq) FILTER (WHERE type = 'tool/call') AS value FROM elog GROUP BY session_id""")
def last_request_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.last_value(event_log(spark, sf_dir), "tool/call", "value")


@query("""WITH {LOG} SELECT session_id, CASE WHEN max_by(type, seq) FILTER (WHERE type IN ('step/start', 'step/end')) = 'step/start' AND count(*) FILTER (WHERE type = 'tool/call') > 0
 THEN max_by(call_id, seq) FILTER (WHERE type = 'tool/call') END AS provider FROM elog GROUP BY session_id""")
def open_step_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).withColumn("provider", F.col("call_id"))
    return folds.open_step_provider(log.withColumn("type", F.when(F.col("type") == "tool/call", "request/header").otherwise(F.col("type"))))


@query("""WITH {LOG}, r AS (SELECT session_id, seq, time, CASE type WHEN 'turn/end' THEN 'D' WHEN 'step/start' THEN 'S' WHEN 'step/end' THEN 'E' END AS k, event_id % 4 <> 0 AS ok FROM elog),
 d AS (SELECT session_id, max(seq) FILTER (WHERE k = 'D') AS f, max_by(time, seq) AS latest FROM r GROUP BY session_id),
 t AS (SELECT *, lag(k) OVER w AS pk, lag(time) OVER w AS pt, lead(seq) OVER w AS ns FROM r JOIN d USING (session_id) WHERE k IN ('S', 'E') WINDOW w AS (PARTITION BY session_id ORDER BY seq)),
 u AS (SELECT * FROM t WHERE f IS NOT NULL AND (k = 'S' AND (seq > f OR ns IS NULL OR ns > f) OR k = 'E' AND seq > f AND pk = 'S'))
 SELECT d.session_id, coalesce(sum(greatest(0, time - pt)) FILTER (WHERE k = 'E'), 0)::BIGINT AS settled_ms, CASE WHEN max_by(k, seq) = 'S' THEN max_by(time, seq) END AS open_since,
 CASE WHEN max_by(k, seq) = 'S' THEN max(d.latest) END AS open_through, CASE WHEN max_by(k, seq) = 'E' THEN max_by(ok, seq) END AS completed FROM d LEFT JOIN u USING (session_id) GROUP BY d.session_id""")
def subagent_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"turn/end": "subagent/descriptor", "step/start": "turn/start", "step/end": "turn/end"}
    kind = F.col("type")
    renamed = F.coalesce(F.create_map(*(F.lit(x) for p in names.items() for x in p))[kind], kind)
    log = event_log(spark, sf_dir).withColumn("type", renamed).withColumn("reason", F.when(F.col("event_id") % 4 != 0, "completed").otherwise("aborted"))
    return folds.subagent_timing(log)


@query("""WITH {LOG}, w AS (SELECT session_id || '-' || seq // 40 AS message_id, seq, call_id AS i, event_id::VARCHAR AS e, type FROM elog WHERE type <> 'turn/end'),
 c AS (SELECT *, min(CASE WHEN type = 'step/end' THEN seq END) OVER (PARTITION BY message_id, i) AS stop FROM w WHERE type IN ('tool/call', 'assistant/message', 'step/end', 'step/start') AND i IS NOT NULL),
 b AS (SELECT message_id, i, min(seq) AS first, min_by(CASE type WHEN 'assistant/message' THEN 'text' WHEN 'step/start' THEN 'reasoning' ELSE 'tool-call' END, seq) AS kind, max(stop) AS stop, max(CASE WHEN seq = stop THEN e END) AS closed,
  coalesce(string_agg(e, '' ORDER BY seq) FILTER (WHERE type IN ('assistant/message', 'step/start') AND (stop IS NULL OR seq < stop)), '') AS text, coalesce(string_agg(e, '' ORDER BY seq) FILTER (WHERE type = 'tool/call' AND (stop IS NULL OR seq < stop)), '') AS given,
  max_by(e, seq) FILTER (WHERE type = 'tool/call' AND (stop IS NULL OR seq < stop)) AS id, max_by(e, seq) FILTER (WHERE type = 'tool/call' AND e::BIGINT % 2 = 0 AND (stop IS NULL OR seq < stop)) AS name FROM c GROUP BY ALL),
 f AS (SELECT message_id, max_by(e, seq) FILTER (WHERE type = 'tool/result') AS usage, max_by(CASE WHEN e::BIGINT % 3 = 0 THEN 'max-tokens' ELSE 'stop' END, seq) FILTER (WHERE type = 'tool/result') AS finish FROM w GROUP BY 1),
 t AS (SELECT message_id, first, CASE WHEN closed IS NOT NULL THEN 'tool-call' ELSE kind END AS kind, CASE WHEN closed IS NOT NULL THEN 'tool-call:closed' || closed || ':ls:[]' WHEN kind = 'tool-call' THEN 'tool-call:' || coalesce(id, 'call-' || i) || ':' || coalesce(name, '') || ':' || given ELSE kind || ':' || text END AS shown FROM b)
 SELECT f.message_id, usage, finish, string_agg(shown, '|' ORDER BY first) FILTER (WHERE NOT (kind = 'tool-call' AND coalesce(finish, '') = 'max-tokens')) AS blocks FROM f LEFT JOIN t USING (message_id) GROUP BY ALL""")
def assembled_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty events a message: deltas of text, reasoning and calls, ends, usages and finishes."""
    log, e = event_log(spark, sf_dir).filter("type <> 'turn/end'"), F.col("event_id").cast("string")
    message = F.concat(F.col("session_id").cast("string"), F.lit("-"), F.floor(F.col("seq") / 40).cast("string"))
    kinds = F.create_map(*(F.lit(x) for pair in {"assistant/message": "text-delta", "step/start": "reasoning-delta", "tool/call": "tool-call-delta", "step/end": "block-end", "tool/result": "usage"}.items() for x in pair))
    none = F.lit(None).cast("string")
    called = F.col("type") == "tool/call"
    block = F.struct(F.lit("tool-call").alias("type"), none.alias("text"), F.concat(F.lit("closed"), e).alias("id"), F.lit("ls").alias("name"), F.lit("[]").alias("arguments"))
    chunks = log.select(
        message.alias("message_id"), "seq", kinds[F.col("type")].alias("kind"), F.when(F.col("type") != "tool/result", F.col("call_id")).alias("index"), none.alias("block_type"), e.alias("text"), F.when(called, e).alias("id"),
        F.when(called & (F.col("event_id") % 2 == 0), e).otherwise("").alias("name"), F.when(called, e).alias("arguments"), F.when(F.col("type") == "step/end", block).alias("block"), e.alias("value"),
    )
    # each usage is followed by a finish, which shares its seq
    ends = chunks.filter("kind = 'usage'").withColumn("kind", F.lit("finish")).withColumn("value", F.when(F.col("value").cast("long") % 3 == 0, "max-tokens").otherwise("stop"))
    shown = lambda b: F.when(b["type"] == "tool-call", F.concat_ws(":", b["type"], b["id"], b["name"], b["arguments"])).otherwise(F.concat_ws(":", b["type"], b["text"]))
    found = folds.assemble_stream(chunks.unionByName(ends))
    told = F.array_join(F.transform("blocks", shown), "|")
    return found.select("message_id", "usage", "finish", told.alias("blocks"))


@query()
def surface_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = conversation_log(spark, sf_dir)
    replaces = (F.col("seq") % 4 == 3)
    ops = log.select("session_id", "seq", F.when(replaces, "replace").otherwise("append").alias("surface_op"), F.when(replaces, F.col("seq") - 2).alias("start_seq"), F.when(replaces, F.col("seq") - 1).alias("end_seq"), text.text_tokens(F.col("text")).alias("tokens"))
    return surface.fold_surface(ops)


@query("""WITH r AS (SELECT conv_id, turn, CASE WHEN turn % 8 = 4 THEN 'header' WHEN role = 'system' OR turn % 8 IN (5, 7) THEN 'system' ELSE 'message' END AS part,
  CASE WHEN turn % 8 = 7 AND conv_id % 3 = 0 THEN 0 ELSE CAST(ceil(length(text) / 4.0) AS BIGINT) + 4 END AS tok, length(text) % 50 AS tools, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations),
 n AS (SELECT conv_id, coalesce(max_by(tok, turn) FILTER (WHERE part = 'system' AND tok > 0), 0) AS system_tokens, sum(tok) AS all_tokens FROM r WHERE part <> 'header' AND NOT (turn % 4 IN (1, 2) AND turn - turn % 4 + 3 <= last) GROUP BY 1),
 t AS (SELECT conv_id, coalesce(max_by(tools, turn) FILTER (WHERE part = 'header'), 0)::BIGINT AS tools_tokens FROM r GROUP BY 1)
 SELECT CAST(conv_id AS VARCHAR) AS session_id, coalesce(system_tokens, 0)::BIGINT AS system_tokens, tools_tokens, (coalesce(all_tokens, 0) - coalesce(system_tokens, 0))::BIGINT AS message_tokens FROM t LEFT JOIN n USING (conv_id)""")
def context_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, seq = conversation_log(spark, sf_dir), F.col("seq")
    kind = F.when(seq % 8 == 4, "request/header").when((F.col("role") == "system") | (seq % 8).isin(5, 7), "system/message").otherwise("user/message")
    tokens = F.when((seq % 8 == 7) & (F.col("session_id") % 3 == 0), 0).otherwise(text.text_tokens(F.col("text")))
    log = log.select("session_id", "seq", kind.alias("type"), tokens.alias("tokens"), (F.char_length("text") % 50).alias("tools_tokens"))
    replaces, header = seq % 4 == 3, F.col("type") == "request/header"
    ops = log.select("session_id", "seq", F.when(replaces, "replace").when(~header, "append").alias("surface_op"), F.when(replaces, seq - 2).alias("start_seq"), F.when(replaces, seq - 1).alias("end_seq"), "tokens")
    return surface.context_breakdown(log, surface.fold_surface(ops))


@query("""SELECT o_custkey AS session_id, 'a' AS route, sum(10 + o_orderkey % 3 * 7 - 5)::BIGINT AS tokens FROM orders GROUP BY o_custkey UNION ALL SELECT o_custkey, 'b', sum(10)::BIGINT FROM orders GROUP BY o_custkey""")
def routed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("session_id"), F.lit(10).alias("tokens"), F.lit(5).alias("image_tokens"), F.lit(0).alias("file_tokens"), (F.col("o_orderkey") % 3).alias("n_images"), F.lit(0).alias("n_files"))
    return surface.route_price(nodes, [{"route": "a", "image_price": 7, "file_price": None}, {"route": "b", "image_price": None, "file_price": None}])


# Timelines and pages ------------------------------------------------------------


@query("""WITH {LOG} SELECT seq, type FROM elog WHERE session_id = 7 AND seq BETWEEN 5 AND 14""")
def event_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.neighbours(event_log(spark, sf_dir), 7, 10, 5, 4).select("seq", "type")


@query("""WITH {LOG}, s AS (SELECT session_id, event_id AS span_id, time AS s, time + CAST(floor(value) AS BIGINT) * 60000 AS e FROM elog),
 g AS (SELECT *, greatest(0, coalesce(s - max(e) OVER (PARTITION BY session_id ORDER BY s, e, span_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS gap FROM s),
 r AS (SELECT *, sum(gap) OVER (PARTITION BY session_id ORDER BY s, e, span_id)::BIGINT AS removed FROM g) SELECT session_id, span_id, s - removed AS "start", e - removed AS "end", removed FROM r""")
def compressed_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = event_log(spark, sf_dir).select("session_id", F.col("event_id").alias("span_id"), F.col("time").alias("start"), (F.col("time") + F.floor("value").cast("long") * 60000).alias("end"))
    return timeline.compress_idle(spans)


@query("""WITH {LOG} SELECT session_id, turn, min(time) AS time FROM elog GROUP BY session_id, turn""")
def turn_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.turn_boundaries(event_log(spark, sf_dir).withColumn("start", F.col("time")))


@query("""WITH {LOG} SELECT session_id, seq, type = 'assistant/message' AS visible, CASE WHEN type = 'assistant/message' THEN seq ELSE (SELECT min(n.seq) FROM elog n WHERE n.session_id = e.session_id AND n.seq > e.seq AND n.type = 'assistant/message') END AS host_seq FROM elog e""")
def attached_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.attach_to_next_visible(event_log(spark, sf_dir).withColumn("visible", F.col("type") == "assistant/message"))


@query("""SELECT o_custkey AS task_id, o_orderkey AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS nth FROM
 (SELECT *, last_value(epoch_ms(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS newest FROM orders) WHERE epoch_ms(o_orderdate) >= newest - 365 * 86400000::BIGINT) WHERE nth <= 3""")
def retained_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("task_id"), F.col("o_orderkey").alias("place"), records.utc_millis(F.col("o_orderdate")).alias("delivered_at"))
    return timeline.retain_deliveries(rows, 365, 3).select("task_id", "place")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey < 1000 ORDER BY o_orderkey DESC LIMIT 25""")
def order_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.newest_page(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 25, 1000)


# Search -------------------------------------------------------------------------

_HITS = """WITH d AS (SELECT conv_id AS session_id, turn AS seq, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM conversations),
 c AS (SELECT session_id, seq, len(w) AS length, len(list_filter(w, lambda x: x = 'that')) AS n0, len(list_filter(w, lambda x: x = 'the')) AS n1 FROM d),
 s AS (SELECT count(*) AS docs, avg(length) AS mean, count(*) FILTER (WHERE n0 > 0) AS df0, count(*) FILTER (WHERE n1 > 0) AS df1 FROM c),
 h AS (SELECT session_id, seq, round(ln(1 + (docs - df0 + 0.5) / (df0 + 0.5)) * n0 * 2.2 / (n0 + 1.2 * (0.25 + 0.75 * length / mean)) + ln(1 + (docs - df1 + 0.5) / (df1 + 0.5)) * n1 * 2.2 / (n1 + 1.2 * (0.25 + 0.75 * length / mean)), 6) AS score FROM c, s WHERE n0 > 0 AND n1 > 0)"""


@query(_HITS + " SELECT * FROM h")
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(conversation_log(spark, sf_dir), "the THAT")


@query(_HITS + " SELECT session_id, min_by(seq, (-score, seq)) AS seq, max(score) AS score FROM h GROUP BY session_id")
def best_match_per_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.best_per_session(ranked_search(spark, sf_dir))


@query(_HITS + " SELECT session_id, seq, score, (SELECT count(*) FROM h) > 20 AS capped FROM h ORDER BY score DESC, session_id, seq LIMIT 20")
def capped_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.capped(ranked_search(spark, sf_dir), 20)


@query("""SELECT conv_id AS session_id, turn AS seq, token, count(*) AS n, length FROM (SELECT conv_id, turn, len(w) AS length, unnest(w) AS token FROM
 (SELECT conv_id, turn, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM conversations)) GROUP BY ALL""")
def token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.token_table(conversation_log(spark, sf_dir)).withColumn("length", F.col("length").cast("long"))


# Lineage ------------------------------------------------------------------------


@query("""WITH RECURSIVE n AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 = 1 THEN -1 WHEN o_orderkey > 0 THEN o_orderkey // 3 END AS parent FROM orders),
 a AS (SELECT id, parent AS ancestor, 1 AS distance FROM n WHERE parent IN (SELECT id FROM n) UNION ALL SELECT a.id, n.parent, a.distance + 1 FROM a JOIN n ON n.id = a.ancestor WHERE n.parent IN (SELECT id FROM n)),
 o AS (SELECT DISTINCT id FROM (SELECT id, ancestor AS place FROM a UNION ALL SELECT id, id FROM n) WHERE place IN (SELECT id FROM n WHERE parent IS NOT NULL AND parent NOT IN (SELECT id FROM n)))
 SELECT n.id, a.ancestor, a.distance::BIGINT AS distance, CASE WHEN o.id IS NULL THEN 'complete' ELSE 'partial' END AS outcome FROM n LEFT JOIN a ON a.id = n.id LEFT JOIN o ON o.id = n.id""")
def session_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    parent = F.when(key % 50 == 1, F.lit(-1).cast("long")).when(key > 0, F.floor(key / 3).cast("long"))
    return lineage.ancestors(table(spark, sf_dir, "orders").select(key.alias("id"), parent.alias("parent")))


@query("""WITH RECURSIVE n AS (SELECT o_orderkey AS id, o_orderkey // 3 AS parent, row_number() OVER (PARTITION BY o_orderkey // 3 ORDER BY epoch_us(o_orderdate) // 1000, o_orderkey::VARCHAR) AS nth FROM orders WHERE o_orderkey > 0),
 t AS (SELECT 2::BIGINT AS id, 0 AS depth, [0::BIGINT] AS way UNION ALL SELECT n.id, depth + 1, list_append(way, nth) FROM t JOIN n ON n.parent = t.id) SELECT id, depth, row_number() OVER (ORDER BY way) - 1 AS place FROM t""")
def session_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    nodes = table(spark, sf_dir, "orders").select(key.alias("id"), F.when(key > 0, F.floor(key / 3).cast("long")).alias("parent"), records.utc_millis(F.col("o_orderdate")).alias("created_at"))
    return lineage.preorder(nodes, 2)


@query("""SELECT c.conv_id AS session_id, c.turn AS seq, c.turn - 1 AS source_seq, p.role || '/message' AS source_type FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1 WHERE c.turn % 2 = 1""")
def cited_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = conversation_log(spark, sf_dir)
    return lineage.cited_events(log.withColumn("source_event_seqs", F.when(F.col("seq") % 2 == 1, F.array(F.col("seq") - 1))))


@query("""SELECT conv_id AS session_id, turn AS seq, turn // 4 * 4 + 3 AS replaced_by, 1::BIGINT AS distance FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations) WHERE turn % 4 IN (1, 2) AND turn // 4 * 4 + 3 <= last""")
def replacement_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lineage.replacement_chains(written(surface_state(spark, sf_dir), "surface"))
    return found.select(F.col("session_id").cast("long").alias("session_id"), "seq", "replaced_by", "distance")


# Records ------------------------------------------------------------------------


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'success' WHEN o_orderkey % 6 IN (1, 2) THEN 'failed' WHEN o_orderkey % 6 = 3 THEN 'abandoned' WHEN o_orderkey % 6 = 4 THEN 'invalid/unknown'
 WHEN o_orderstatus = 'F' THEN 'invalid/infrastructure-error' ELSE 'failed' END AS bucket FROM orders""")
def task_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*(F.lit(x) for x in ("SUCCESS", "FAILED", "TIMEOUT", "ABANDONED", "UNKNOWN", "ERROR")))
    status = F.get(names, (F.col("o_orderkey") % 6).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", records.bucket_for(status, F.when(F.col("o_orderstatus") == "F", "infrastructure").otherwise("agent")).alias("bucket"))


@query("""SELECT event_id, CASE WHEN event_id % 8 = 1 THEN CAST(round(floor(value) * 1000) AS BIGINT) WHEN event_id % 8 = 2 THEN 9223372036854775807
 WHEN event_id % 8 = 6 THEN 1500 WHEN event_id % 8 = 7 THEN greatest(0, 1704067200000 + event_id % 28 * 86400000 - 1705276800000) END AS wait_ms FROM events""")
def rate_limit_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") % 28 * 86400), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    forms = {1: F.floor("value").cast("string"), 2: "1e300", 3: "Infinity", 4: "NaN", 5: "-5", 6: " 1.5\t", 7: day}
    stated = F.lit(None).cast("string")
    for rest, form in forms.items():
        stated = F.when(F.col("event_id") % 8 == rest, form).otherwise(stated)
    return table(spark, sf_dir, "events").select("event_id", records.retry_after_ms(stated, F.lit(1705276800000)).alias("wait_ms"))


@query("""SELECT event_id, event_id % 2 = 0 AS limited, CASE WHEN event_id % 2 = 0 THEN CAST(floor(value) AS BIGINT) * 1000 END AS wait_ms FROM events""")
def rate_limit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("HTTP 429: Retry-After: "), F.floor("value").cast("string"))).otherwise("other failure, retry-after: 3")
    return table(spark, sf_dir, "events").select("event_id", records.is_rate_limit(message).alias("limited"), records.message_retry_after_ms(message, F.lit(0)).alias("wait_ms"))


@query("""SELECT doc_id, sha256(text) AS key, substr(sha256(text), 1, 2) AS shard, strlen(text) AS bytes, substr(sha256(source), 1, 12) AS folder FROM documents""")
def blob_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = records.blob_key(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", key.alias("key"), records.blob_shard(key).alias("shard"), F.octet_length("text").cast("long").alias("bytes"), records.spill_folder(F.col("source")).alias("folder"))


@query("""SELECT p_partkey, CASE p_size WHEN 1 THEN '~' WHEN 2 THEN '~002E' WHEN 3 THEN '~002E~002E' ELSE
 array_to_string(list_transform(string_split(p_brand || '/~é' || chr(128500 + p_size) || p_name, ''), lambda c: CASE WHEN regexp_full_match(c, '[A-Za-z0-9._-]') THEN c
 WHEN ord(c) < 65536 THEN printf('~%04X', ord(c)) ELSE printf('~%04X~%04X', 55296 + (ord(c) - 65536) // 1024, 56320 + (ord(c) - 65536) % 1024) END), '') END AS name FROM part""")
def spill_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols = F.create_map(*(x for k in range(51) for x in (F.lit(k), F.lit(chr(128500 + k)))))
    name = F.concat("p_brand", F.lit("/~é"), symbols[F.col("p_size").cast("int")], "p_name")
    name = F.when(F.col("p_size") == 1, "").when(F.col("p_size") == 2, ".").when(F.col("p_size") == 3, "..").otherwise(name)
    return table(spark, sf_dir, "part").select("p_partkey", records.safe_name(name).alias("name"))


@query("""SELECT c_custkey, 'session:' || replace(replace(rtrim(to_base64(encode('"' || c_name || '"')), '='), '+', '-'), '/', '_') AS uri, c_name AS back FROM customer""")
def session_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = records.session_reference(F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", uri.alias("uri"), records.referenced_session(uri).alias("back"))


@query("""SELECT c_custkey, 'as @' || c_name || '](' || c_custkey || '\\ says,' || chr(10) || '@' || c_name || ' (@[x](y)) and @' || c_mktsegment AS text, 3::BIGINT AS n,
 c_name || '|' || c_name || '|' || c_mktsegment AS sessions FROM customer""")
def session_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    label = F.concat(name, F.lit("]("), F.col("c_custkey").cast("string"), F.lit("\\"))
    said = F.concat(F.lit("as "), records.session_mention(name, label), F.lit(" says,\n"), records.session_reference(name), F.lit(" (@[x](y)) and "), records.session_mention(segment))
    rows = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")).select("c_custkey", records.referenced_sessions(said).alias("found"))
    sessions = F.transform("found.sessions", lambda s: s["session_id"])
    return rows.select("c_custkey", "found.text", F.size("found.sessions").cast("long").alias("n"), F.array_join(sessions, "|").alias("sessions"))


@query("""SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN CAST(ceil(length(p_name) / 4.0) AS BIGINT) + 4 ELSE CAST(ceil((length(p_name) + length(p_type) + 4) / 4.0) AS BIGINT) + 4 END AS system_tokens,
 CASE p_size % 3 WHEN 0 THEN 0 ELSE CAST(ceil((length(p_brand) + 4) / 4.0) AS BIGINT) + 4 END AS tools_tokens FROM part""")
def prompt_token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    block = lambda kind, content, json: F.struct(F.lit(kind).alias("type"), content.alias("text"), none.alias("name"), none.alias("arguments"), json.alias("json"))
    blocks = F.array(block("text", F.col("p_name"), none), block("image", none, F.concat(F.lit('["'), F.col("p_type"), F.lit('"]'))))
    turn = F.col("p_size") % 3
    tools = F.when(turn == 0, "[]").otherwise(F.concat(F.lit('["'), F.col("p_brand"), F.lit('"]')))
    return table(spark, sf_dir, "part").select("p_partkey", text.system_tokens(F.slice(blocks, F.lit(1), turn)).alias("system_tokens"), text.tools_tokens(tools).alias("tools_tokens"))


@query("""SELECT conv_id, turn, count(*) AS headers, count(*) FILTER (WHERE role <> 'user' AND turn % 3 <> 0) AS with_defaults, count(*) FILTER (WHERE turn % 2 = 1) AS with_tools FROM conversations GROUP BY ALL""")
def canonical_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn, chosen = F.col("turn"), F.coalesce(F.col("role") != "user", F.lit(False))
    defaults = F.when(turn % 3 != 0, F.struct(chosen.alias("reasoning_effort"), F.lit(None).cast("boolean").alias("max_tokens")))
    tools = F.when(turn % 2 == 1, F.array(F.col("role"))).when(turn % 4 == 0, F.array().cast("array<string>"))
    header = records.canonical_header(F.struct(F.col("text").alias("config"), defaults.alias("adapter_defaults"), tools.alias("tools")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", header.alias("h"))
    return rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("headers"), F.count("h.adapter_defaults").alias("with_defaults"), F.count("h.tools").alias("with_tools"))


@query("""WITH r AS (SELECT conv_id AS session_id, turn AS seq, turn % 4 AS part, (turn // 4) % 3 AS way, CAST(ceil(length(coalesce(text, '')) / 4.0) AS BIGINT) + 4 AS tokens FROM conversations),
 d AS (SELECT session_id, seq, part = 2 AND way = 1 AS contradicts, CASE WHEN part IN (0, 3) THEN tokens WHEN part = 2 AND way = 0 THEN tokens - 7 WHEN part = 2 AND way = 1 THEN NULL ELSE 0 END AS delta FROM r)
 SELECT *, sum(delta) OVER (PARTITION BY session_id ORDER BY seq)::BIGINT AS total FROM d""")
def surface_token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq, way, part = F.col("seq"), F.floor(F.col("seq") / 4) % 3, F.col("seq") % 4
    # of every four events one is metered and replaced: by its range, by another, or without a claim
    kind = F.when(part == 2, "replace").when((part == 1) & (way < 2), "meter").when(part != 1, "append")
    start = F.when(part == 1, seq - 1).when(part == 2, seq - 2 + F.when(way == 1, 1).otherwise(0))
    tokens = F.when(part == 1, 7).otherwise(text.text_tokens(F.col("text")))
    log = conversation_log(spark, sf_dir).select("session_id", "seq", kind.alias("op"), tokens.alias("tokens"), start.alias("start_seq"), start.alias("end_seq"))
    return surface.surface_totals(log).select("session_id", "seq", "contradicts", "delta", "total")


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'python' WHEN 1 THEN 'typescript' WHEN 2 THEN NULL ELSE 'markdown' END AS language FROM part""")
def file_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.get(F.array(F.lit(".PY"), F.lit(".mts"), F.lit(""), F.lit(".x.md")), (F.col("p_size") % 4).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", records.file_language(F.concat(F.lit("src/"), F.translate("p_name", " .", "__"), suffix)).alias("language"))


@query("""SELECT event_id, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z' AS iso,
 strftime(make_timestamp((epoch_us(ts) // 1000) * 1000) + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') || '+09:00[Asia/Tokyo]' AS local FROM events""")
def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = records.utc_millis(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", records.iso_time(ms).alias("iso"), records.zoned_time(ms, "Asia/Tokyo").alias("local"))


@query("""WITH s AS (SELECT o_custkey, o_orderkey // 4 AS v FROM orders GROUP BY ALL), r AS (SELECT o_custkey, v, v - row_number() OVER (PARTITION BY o_custkey ORDER BY v) AS run FROM s),
 g AS (SELECT o_custkey, min(v) AS a, max(v) AS b, count(*) AS n FROM r GROUP BY o_custkey, run)
 SELECT o_custkey, sum(CASE WHEN n >= 3 THEN 1 ELSE n END)::BIGINT AS entries, sum(n)::BIGINT AS seqs FROM g GROUP BY o_custkey""")
def encoded_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_set(F.floor(F.col("o_orderkey") / 4).cast("long"))).alias("seqs"))
    packed = lists.withColumn("ranges", records.encode_ranges(F.col("seqs"))).withColumn("back", records.decode_ranges(F.col("ranges")))
    checked = F.when(F.col("back") == F.col("seqs"), F.size("back")).otherwise(-1)
    return packed.select("o_custkey", F.size("ranges").cast("long").alias("entries"), checked.cast("long").alias("seqs"))


# Stored tables ------------------------------------------------------------------


@query("""SELECT CAST(user_id AS VARCHAR) AS key, event_type AS value, event_id AS version FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth FROM events) WHERE nth = 1 AND event_type <> 'error'""")
def keyed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("value"), F.col("event_id").alias("version"), (F.col("event_type") == "error").alias("deleted"))
    return tables.latest(changes)


@query("""WITH o AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success' ELSE 'invalid_unknown' END AS bucket FROM orders),
 a AS (SELECT o_custkey, max(o_orderkey) AS k FROM o GROUP BY 1), b AS (SELECT o_custkey, max(o_orderkey) AS k FROM o WHERE o_orderkey % 3 <> 0 GROUP BY 1),
 l AS (SELECT a.o_custkey, b.k IS NOT NULL AS again, coalesce(b.k, a.k) AS k FROM a LEFT JOIN b USING (o_custkey))
 SELECT CASE WHEN NOT again AND k % 2 = 0 THEN 'abandoned' ELSE bucket END AS bucket, count(*) AS tasks, sum(k)::BIGINT AS price FROM l JOIN o ON o.o_orderkey = l.k GROUP BY 1""")
def dataset_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "FAILED").when(F.col("o_orderstatus") == "O", "SUCCESS").otherwise("UNKNOWN")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("task_id"), status.alias("status"), F.lit(None).cast("string").alias("error_class"), F.col("o_orderkey").alias("finished_at"), F.lit(1).alias("attempts"), F.col("o_orderkey").alias("price"))
    root = f"{work_folder(spark)}/dataset-{uuid.uuid4().hex}"
    # two calls: what the second doesn't bring stays, what it brings leaves its earlier bucket
    tables.write_tasks(rows.withColumn("status", F.when(F.col("price") % 2 == 0, "ABANDONED").otherwise(F.col("status"))), root)
    tables.write_tasks(rows.filter("price % 3 <> 0"), root)
    return tables.read_tasks(spark, root).groupBy("bucket").agg(F.count(F.lit(1)).alias("tasks"), F.sum("price").alias("price"))


@query("""WITH h AS (SELECT conv_id, turn, p, coalesce(lag(p) OVER (PARTITION BY conv_id ORDER BY turn), '') AS q FROM (SELECT conv_id, turn, 'say ' || (turn // 12) AS p FROM conversations WHERE turn % 6 = 3)),
 f AS (SELECT conv_id, min(turn) AS turn FROM conversations WHERE turn % 6 = 0 GROUP BY conv_id),
 b AS (SELECT conv_id AS session_id, turn, rank, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, rank) - 1 AS seq FROM
 (SELECT conv_id, turn, role, text, 1 AS rank FROM conversations UNION ALL SELECT conv_id, turn, 'system', p, 0 FROM h WHERE p <> q UNION ALL SELECT conv_id, turn, 'system', '', 2 FROM f))
 SELECT session_id, seq, CASE WHEN rank <> 1 THEN 'system/message' WHEN turn % 6 = 0 THEN 'step/start' WHEN turn % 6 = 3 THEN 'request/header' ELSE role || '/message' END AS type, text,
 CASE WHEN rank <> 1 THEN 'system-prompt' WHEN turn % 4 = 0 THEN 'user' WHEN turn % 4 = 1 THEN 'compact-checkpoint' WHEN turn % 4 = 2 THEN 'goal' ELSE 'plugin:mine' END AS source_kind, CASE WHEN turn % 2 = 0 THEN 'ptc' ELSE 'other' END AS preset,
 CASE WHEN rank <> 1 THEN (SELECT max(x.seq) FROM b x WHERE x.session_id = b.session_id AND x.rank <> 1 AND x.seq < b.seq) WHEN turn > 0 THEN (SELECT x.seq FROM b x WHERE x.session_id = b.session_id AND x.turn = b.turn - 1 AND x.rank = 1) END AS cited FROM b""")
def migrated_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, seq = conversation_log(spark, sf_dir), F.col("seq")
    kind = F.when(seq % 6 == 0, "step/start").when(seq % 6 == 3, "request/header").otherwise(F.col("type"))
    old = log.select(
        "session_id", "seq", kind.alias("type"), "text", F.when(seq % 6 == 3, F.concat(F.lit("say "), F.floor(seq / 12).cast("string"))).alias("system_text"),
        F.when(seq > 0, F.array(seq - 1)).otherwise(F.array()).cast("array<bigint>").alias("source_event_seqs"), F.when(seq % 2 == 0, "code").otherwise("other").alias("preset"),
        F.when(seq % 4 == 0, "user").otherwise("plugin").alias("source_kind"), F.when(seq % 4 == 1, "compact").when(seq % 4 == 2, "goal").when(seq % 4 == 3, "mine").alias("plugin"), F.lit(None).cast("boolean").alias("ignorable"),
    )
    return migration.migrate(old, 0).select("session_id", "seq", "type", "text", "source_kind", "preset", F.get("source_event_seqs", 0).alias("cited"))


@query("""WITH {LOG}, a AS (SELECT *, sum(CASE WHEN type = 'turn/end' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY seq) AS calls FROM elog),
 t AS (SELECT session_id, sum(greatest(0, time - ptime)) AS tool_ms FROM (SELECT *, lag(type) OVER w AS ptype, lag(time) OVER w AS ptime FROM a WHERE type IN ('tool/call', 'tool/result') WINDOW w AS (PARTITION BY session_id, call_id, calls ORDER BY seq)) WHERE type = 'tool/result' AND ptype = 'tool/call' GROUP BY session_id),
 e AS (SELECT session_id, count(*) AS steps, count(*) FILTER (WHERE p IS NULL OR p <> turn) AS turns FROM (SELECT *, lag(turn) OVER (PARTITION BY session_id ORDER BY seq) AS p FROM elog WHERE type = 'step/end') GROUP BY session_id)
 SELECT CAST(s.session_id AS VARCHAR) AS session_id, coalesce(turns, 0)::BIGINT AS turns, coalesce(steps, 0)::BIGINT AS steps, coalesce(tool_ms, 0)::BIGINT AS tool_ms FROM (SELECT DISTINCT session_id FROM elog) s LEFT JOIN t USING (session_id) LEFT JOIN e USING (session_id)""")
def streamed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.streaming.folds import stream_stats

    source = written(event_log(spark, sf_dir).select("session_id", "seq", "type", "time", "turn", "call_id"), "stream-source")
    path, = source.inputFiles()[0].rsplit("/", 1)[:1]
    out = f"{path}-out"
    stream = stream_stats(spark.readStream.schema(source.schema).parquet(path))
    running = stream.writeStream.outputMode("update").foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/{n}")).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.option("recursiveFileLookup", True).parquet(out).groupBy("session_id").agg(F.max_by("turns", "steps").alias("turns"), F.max("steps").alias("steps"), F.max("tool_ms").alias("tool_ms"))
