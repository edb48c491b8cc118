"""Registered queries of payloads, surfaces, stored indexes, resumed folds and pages, each beside its DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.functions import diff, retention, secrets
from logloom.operators import contracts, index, surface, timeline
from logloom.plans.inputs import conversation_log, event_log, small_batches, spread, table
from logloom.plans.queries import _HITS, SQL, query, ranked_search
from logloom.sources import framed, tables
from logloom.sources.scratch import work_folder, written
from logloom.streaming import resume


def _folder(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _json(**members: object) -> F.Column:
    """JSON text of an object with these members, given as columns of JSON text."""
    parts = [F.lit("{")]
    for i, (name, value) in enumerate(members.items()):
        parts += [F.lit(f'{"," if i else ""}"{name}":'), value if isinstance(value, F.Column) else F.lit(value)]
    return F.concat(*parts, F.lit("}"))


# Payloads -----------------------------------------------------------------------


@query("""WITH r AS (SELECT conv_id AS session_id, turn AS seq, (conv_id + turn) % 8 AS k FROM conversations)
 SELECT session_id, seq, CASE k WHEN 1 THEN 'user/message' WHEN 2 THEN 'tool/call' WHEN 4 THEN 'robot/dance' WHEN 5 THEN 'todo/write' WHEN 6 THEN 'turn/end' ELSE 'tool/result' END AS type,
  CASE k WHEN 7 THEN '$.message' ELSE '$' END AS path, CASE k WHEN 4 THEN 'unlisted' WHEN 5 THEN 'not an object' WHEN 6 THEN 'unreadable' ELSE 'members' END AS problem,
  CASE k WHEN 1 THEN 'content,source' WHEN 2 THEN '' WHEN 7 THEN 'content' END AS missing, CASE k WHEN 1 THEN 'extra' WHEN 2 THEN 'a,z' WHEN 7 THEN '' END AS unexpected
 FROM r WHERE k IN (1, 2, 5, 6, 7) OR k = 4 AND seq % 2 = 1""")
def payload_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = conversation_log(spark, sf_dir)
    k, text, turn = (F.col("session_id") + F.col("seq")) % 8, F.to_json(F.array("text")), F.col("seq").cast("string")
    result = {"turn": turn, "step": turn}
    data = (
        F.when(k == 0, _json(role='"user"', id='"m"', content=text, source='{"kind":"user"}')).when(k == 1, _json(extra=text, role='"user"', id="1"))
        .when(k == 2, _json(turn=turn, z="0", step=turn, callId='"c"', name='"n"', arguments=text, a="null")).when(k == 3, _json(**result, message='{"role":"tool","content":[]}', meta=_json(deep=text, turn="{}")))
        .when(k == 4, "{}").when(k == 5, text).when(k == 6, F.concat(F.lit('{"turn":'), turn)).otherwise(_json(**result, message='{"role":"tool"}', meta='{"role":{}}'))
    )
    kind = F.when(k < 2, "user/message").when(k == 2, "tool/call").when(k == 4, "robot/dance").when(k == 5, "todo/write").when(k == 6, "turn/end").otherwise("tool/result")
    known = contracts.read_contracts()
    # the message has a contract of its own; meta is opaque, so one for it would not be looked at
    inner = {"message": contracts.Contract(("role", "content")), "meta": contracts.Contract(("nothing",))}
    known["tool/result"] = contracts.Contract(known["tool/result"].required, known["tool/result"].optional, known["tool/result"].opaque, inner)
    found = contracts.payload_violations(log.select("session_id", "seq", kind.alias("type"), data.alias("data"), (F.col("seq") % 2 == 0).alias("ignorable")), known)
    return found.withColumn("missing", F.array_join("missing", ",")).withColumn("unexpected", F.array_join("unexpected", ","))


@query("""SELECT event_id AS session_id, event_id AS seq, CASE event_id % 9 WHEN 1 THEN '$["a"][1]' WHEN 2 THEN '$["a"][0]["b"]' WHEN 3 THEN '$["a"]' WHEN 4 THEN '$["t"]' WHEN 5 THEN '$["t"]' WHEN 6 THEN '$["x"]' ELSE '$' END AS path,
 CASE event_id % 9 WHEN 1 THEN 'negative zero' WHEN 2 THEN 'unsafe integer' WHEN 3 THEN 'repeated member' WHEN 4 THEN 'lone surrogate' WHEN 5 THEN 'negative zero' WHEN 6 THEN 'no finite number' ELSE 'no JSON' END AS reason FROM events WHERE event_id % 9 BETWEEN 1 AND 7""")
def lossy_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, value, props = F.col("event_id") % 9, F.col("value").cast("string"), F.to_json(F.array("props"))
    data = (
        F.when(k == 1, _json(a=F.concat(F.lit("["), value, F.lit(",-0]")), b="-0")).when(k == 2, _json(a=F.concat(F.lit('[{"b":9007199254740992,"c":'), props, F.lit("}]"))))
        .when(k == 4, _json(t='"\\ud83d"', u=props)).when(k == 5, _json(s='"\\ud83d\\ude00 -0"', t="-0.0e3")).when(k == 6, _json(x="1e999", y="-0")).when(k == 7, F.concat(value, F.lit(",")))
        .otherwise(_json(v=value, n="9007199254740991", p=props))
    )
    data = F.when(k == 3, F.concat(F.lit('{"a":'), value, F.lit(',"a":'), props, F.lit("}"))).otherwise(data)
    return contracts.lossy_payloads(table(spark, sf_dir, "events").select(F.col("event_id").alias("session_id"), F.col("event_id").alias("seq"), data.alias("data")))


_SETTINGS = {"type": "object", "members": {
    "key": {"type": "secret"}, "label": {"type": "any"}, "hosts": {"type": "dict", "inner": {"type": "object", "members": {"token": {"type": "secret"}}}},
    "routes": {"type": "array", "inner": {"type": "union", "list": [{"type": "object", "members": {"password": {"type": "secret"}}}, {"type": "object", "members": {"pin": {"type": "secret"}}}]}},
}}


@query("""SELECT c_custkey, '{"hosts":{"' || c_mktsegment || '":{' || CASE WHEN c_custkey % 2 = 0 THEN '"port":1' ELSE '' END || '},"none":7},' || CASE WHEN c_custkey % 3 = 0 THEN '"label":"' || c_name || '",' ELSE '' END || '"other":{"key":"kept"},"routes":[{"name":"' || c_name || '"},{},null]}' AS value,
 'key:' || (c_custkey % 5 <> 0) || ' hosts/' || CASE WHEN c_mktsegment < 'none' THEN c_mktsegment ELSE 'none' END || '/token:' || (c_mktsegment < 'none' AND c_custkey % 7 <> 0) || ' hosts/' || CASE WHEN c_mktsegment < 'none' THEN 'none' ELSE c_mktsegment END || '/token:' || (c_mktsegment >= 'none' AND c_custkey % 7 <> 0)
 || ' routes/0/password:true routes/0/pin:false routes/1/password:false routes/1/pin:true routes/2/password:false routes/2/pin:false' AS secrets FROM customer""")
def nested_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name = F.col("c_custkey"), F.to_json(F.array("c_name")).substr(F.lit(2), F.length(F.to_json(F.array("c_name"))) - 2)
    host = F.concat(F.lit("{"), F.when(key % 7 != 0, '"token":"t"').otherwise(""), F.when((key % 7 != 0) & (key % 2 == 0), ",").otherwise(""), F.when(key % 2 == 0, '"port":1').otherwise(""), F.lit("}"))
    hosts = F.concat(F.lit('{"none":7,"'), F.col("c_mktsegment"), F.lit('":'), host, F.lit("}"))
    routes = F.concat(F.lit('[{"password":null,"name":'), name, F.lit('},{"pin":[1]},null]'))
    text = F.concat(F.lit('{"routes":'), routes, F.when(key % 5 != 0, ',"key":{"a":1}').otherwise(""), F.when(key % 3 == 0, F.concat(F.lit(',"label":'), name)).otherwise(""), F.lit(',"hosts":'), hosts, F.lit(',"other":{"key":"kept"}}'))
    found = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")).select("c_custkey", secrets.strip_secrets(_SETTINGS, text).alias("s"))
    told = F.array_join(F.transform("s.secrets", lambda x: F.concat(F.array_join(x["path"], "/"), F.lit(":"), x["set"].cast("string"))), " ")
    return found.select("c_custkey", "s.value", told.alias("secrets"))


@query()
def document_hunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hunks between each document, a sentence a line, and an edited text; rebuilt must be that text."""
    small_batches(spark)
    old = F.regexp_replace("text", r"([.!?]) ", "$1\n")
    lines = F.split(old, "\n")
    edited = F.array_join(F.filter(F.transform(lines, lambda x, i: F.when((i + F.col("doc_id")) % 11 == 3, F.concat(x, F.lit(" edited\nand added"))).otherwise(x)), lambda x, i: (i + F.col("doc_id")) % 13 != 5), "\n")
    rows = table(spark, sf_dir, "documents").select("doc_id", old.alias("old"), edited.alias("new")).withColumn("d", diff.text_hunks(F.col("old"), F.col("new")))
    same = diff.rebuilt_text(F.col("old"), F.col("d.hunks")) == F.regexp_replace("new", r"\n\z", "")
    return rows.select("doc_id", F.size("d.hunks").alias("hunks"), "d.coarse", "d.added", "d.deleted", same.alias("rebuilt"))


@query("""SELECT doc_id, strlen(j) > 3000 AS spilled, CASE WHEN strlen(j) > 3000 THEN sha256(j) END AS key, CASE WHEN strlen(j) > 3000 THEN strlen(j) END AS bytes, CASE WHEN strlen(j) > 3000 THEN j END AS content FROM (SELECT doc_id, to_json(text)::VARCHAR AS j FROM documents)""")
def spilled_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as payloads whose text goes to a blob beyond 3,000 bytes, and the blobs as read back."""
    folder = _folder(spark, "spill")
    rows = table(spark, sf_dir, "documents").select("doc_id", retention.spilled(F.to_json(F.struct("doc_id", "text")), 3000).alias("s"))
    rows = written(rows.select("doc_id", "s.payload", "s.blobs"), "spilled")
    tables.put_blobs(rows.select(F.explode("blobs").alias("b")).select("b.content"), folder)
    reference = F.from_json("payload", "text struct<blob: struct<sha256: string, bytes: long>>", {"mode": "PERMISSIVE"})["text"]["blob"]
    found = rows.select("doc_id", (F.size("blobs") > 0).alias("spilled"), F.when(F.size("blobs") > 0, reference).alias("r")).select("doc_id", "spilled", F.col("r.sha256").alias("key"), F.col("r.bytes").alias("bytes"))
    read = tables.get_blobs(spark, folder, found.filter("key is not null")).select("key", F.decode("content", "UTF-8").alias("content"))
    return found.join(read, "key", "left").select("doc_id", "spilled", "key", "bytes", "content")


# Surfaces -----------------------------------------------------------------------

_NODES = """n AS (SELECT session_id, seq, event_id, seq % 10 AS r, max(seq) OVER (PARTITION BY session_id) AS last FROM elog)"""


def _surface_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tens of events: messages and results, a replacement of two, image offloads."""
    log, r = event_log(spark, sf_dir), F.col("seq") % 10
    names = F.array(*(F.lit(x) for x in ("user/message", "assistant/message", "tool/result", "user/message", "tool/result", "user/message", "image/offload", "image/offload", "assistant/message", "image/offload")))
    one = lambda back, *indexes: F.array(F.struct((F.col("seq") - back).alias("seq"), F.array(*map(F.lit, indexes)).alias("indexes")))
    again = F.when(F.col("event_id") % 3 == 0, one(9, 0)).otherwise(one(9, 1))
    targets = F.when(r == 6, one(6, 0)).when((r == 7) & (F.col("event_id") % 97 == 0), one(4, 0)).when(r == 7, one(5, 0, 1)).when(r == 9, F.when(F.col("event_id") % 89 == 0, again).otherwise(one(9, 1)))
    op = F.when(r == 5, "replace").when(~r.isin(6, 7, 9), "append")
    return log.select(
        F.col("session_id").cast("string").alias("session_id"), "seq", "event_id", F.get(names, r.cast("int")).alias("type"), op.alias("surface_op"), F.when(r == 5, F.col("seq") - 2).alias("start_seq"),
        F.when(r == 5, F.col("seq") - 1).alias("end_seq"), F.lit(1).alias("tokens"), targets.alias("targets"), F.when(r == 1, 1).otherwise(0).alias("n_calls"),
    )


def _images(log: DataFrame) -> DataFrame:
    return log.filter((F.col("seq") % 10).isin(0, 2, 3, 4, 5)).select("session_id", "seq", F.explode(F.array(F.lit(0), F.lit(1))).alias("index"))


@query("WITH {LOG}, " + _NODES + """, c AS (SELECT session_id, seq, CASE r WHEN 1 THEN 1 WHEN 2 THEN -1 WHEN 4 THEN -1 ELSE 0 END AS delta FROM n WHERE r NOT IN (6, 7, 9) AND NOT (r IN (3, 4) AND seq - r + 5 <= last)),
 b AS (SELECT *, row_number() OVER w - 1 AS position, sum(delta) OVER w AS behind FROM c WINDOW w AS (PARTITION BY session_id ORDER BY seq))
 SELECT session_id::VARCHAR AS session_id, seq, position::INT AS position, (behind - delta)::BIGINT AS open_before, behind::BIGINT AS open_behind, min(behind) OVER (PARTITION BY session_id ORDER BY seq) < 0 AS corrupt FROM b""")
def surface_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = written(_surface_log(spark, sf_dir), "surface-log")
    return surface.surface_balance(log, surface.fold_surface(log))


_REFUSED = _NODES + """, f AS (SELECT session_id, min(seq) AS seq FROM n WHERE r = 7 AND event_id % 97 = 0 OR r = 9 AND event_id % 89 = 0 AND event_id % 3 = 0 GROUP BY 1)"""


@query("WITH {LOG}, " + _REFUSED + " SELECT session_id::VARCHAR AS session_id, seq, CASE WHEN seq % 10 = 7 THEN 'not on the surface' ELSE 'offloaded before' END AS reason FROM f")
def refused_image_offloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = written(_surface_log(spark, sf_dir), "surface-log")
    return surface.refused_offloads(log, _images(log), surface.fold_surface(log))


@query("WITH {LOG}, " + _REFUSED + """, e AS (SELECT n.session_id, n.seq, n.r FROM n LEFT JOIN f USING (session_id) WHERE n.r IN (6, 7, 9) AND (f.seq IS NULL OR n.seq < f.seq)),
 m AS (SELECT session_id, seq - 6 AS seq, 0 AS i FROM e WHERE r = 6 UNION SELECT session_id, seq - 5, unnest([0, 1]) FROM e WHERE r = 7 UNION SELECT session_id, seq - 9, 1 FROM e WHERE r = 9)
 SELECT n.session_id::VARCHAR AS session_id, n.seq, x.index, m.i IS NOT NULL AS offloaded FROM n, (VALUES (0), (1)) x(index) LEFT JOIN m ON m.session_id = n.session_id AND m.seq = n.seq AND m.i = x.index WHERE n.r IN (0, 2, 3, 4, 5)""")
def offloaded_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = written(_surface_log(spark, sf_dir), "surface-log")
    return surface.offload_images(log, _images(log), surface.fold_surface(log))


# Stored indexes, resumed folds, pages -------------------------------------------


@query(_HITS + " SELECT * FROM h")
def indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ranked_search, through an index that was written in two generations, one of them twice."""
    folder, log = _folder(spark, "index"), conversation_log(spark, sf_dir)
    even = F.coalesce(F.col("session_id") % 2 == 0, F.lit(True))
    for generation, part in ((1, even), (2, ~even), (2, ~even)):
        index.append(log.filter(part), folder, generation)
    return index.search_index(spark, folder, "the THAT")


@query(SQL["session_stats"].replace("SELECT s.session_id, coalesce(turns", "SELECT s.session_id::VARCHAR AS session_id, coalesce(turns"))
def resumed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As session_stats: half the log as a stream, stored, then the whole log resumed from there.

    Of the stored rows some are of another version or another log; their sessions are
    folded anew.
    """
    log = event_log(spark, sf_dir).select(F.col("session_id").cast("string").alias("session_id"), *resume.READS)
    log = written(log, "resume-log")
    path, progress = _folder(spark, "resume-source"), _folder(spark, "resume-progress")
    stored, last = _folder(spark, "resume-stored"), _folder(spark, "resume-last")

    def add(low: int, high: int) -> None:
        # a session's events of one span lie in one file, and spans come one after another
        log.filter(F.col("seq").between(low, high)).repartition("session_id").write.mode("append").parquet(path)

    def stream(per_batch: int) -> DataFrame:
        return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", per_batch).parquet(path)

    add(0, 9)
    add(10, 24)
    # larger tables make larger batches, not more of them: each batch opens every partition's state
    few = max(3, -(-len(spark.read.schema(log.schema).parquet(path).inputFiles()) // 4))
    resume.write_checkpoints(resume.resumed_stats(stream(few)), stored, progress).awaitTermination()
    add(25, 2**40)
    rows = resume.latest_checkpoints(spark, stored).withColumn("ver", F.when(F.col("session_id").cast("long") % 5 == 0, 1).otherwise(F.col("ver")))
    header = log.select("session_id").distinct().select("session_id", F.lit(4).alias("format_version"), F.lit(7).alias("created_at"), F.lit("/w").alias("cwd"), F.lit(False).alias("is_seeded"), F.lit(0).alias("inherited_event_count"))
    older = header.withColumn("created_at", F.when(F.col("session_id").cast("long") % 7 == 1, 6).otherwise(7))
    usable = written(resume.usable_checkpoints(rows, older, header), "resume-usable")
    resume.write_checkpoints(resume.resumed_stats(stream(1000), usable), last, f"{progress}-again").awaitTermination()
    return resume.latest_checkpoints(spark, last).select("session_id", *resume.COUNTERS)


@query(_HITS + " SELECT *, (row_number() OVER (ORDER BY score DESC, session_id, seq) - 1) // 15 AS page FROM h ORDER BY score DESC, session_id, seq LIMIT 45")
def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pages of a ranked search, each read behind the last cursor of the one before."""
    found, order = written(ranked_search(spark, sf_dir), "found"), [("score", True), ("session_id", False), ("seq", False)]
    pages, cursor = [], None
    for n in range(3):
        page = written(timeline.keyset_page(found, order, 15, cursor), "page")
        pages.append(page.drop("cursor").withColumn("page", F.lit(n).cast("long")))
        last = page.orderBy("score", F.desc("session_id"), F.desc("seq")).select("cursor").first()
        cursor = last[0] if last else cursor
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


@query("""SELECT 's' || conv_id % 5 AS session_id, row_number() OVER (PARTITION BY conv_id % 5 ORDER BY conv_id, turn) - 1 AS seq, role || '/message' AS type, text AS data FROM conversations""")
def framed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as five long sessions, written in frames and read by several tasks a file."""
    nth = F.row_number().over(Window.partitionBy(F.col("session_id") % 5).orderBy("session_id", "seq")) - 1
    log = conversation_log(spark, sf_dir).select(F.concat(F.lit("s"), (F.col("session_id") % 5).cast("string")).alias("session_id"), nth.cast("long").alias("seq"), "type", F.col("text").alias("data"))
    folder = f"{work_folder(spark).removeprefix('file://')}/framed-{uuid.uuid4().hex}"
    framed.write_log(log, folder, frame_rows=20)
    return framed.read_events(spark, folder, partition_bytes=20_000).select("session_id", "seq", "type", "data")
