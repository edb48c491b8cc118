"""Text of events, token tables, and ranked search over them.

All words of a query must occur.  The score is BM25, our own choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.text import join_text

K1, B = 1.2, 0.75
DEFAULT_LIMIT = 100
#: Columns of a log that hold something to search for, by what they are.
TEXT_COLUMNS = {
    "blocks": "array<struct<type: string, text: string, name: string, arguments: string>>", "name": "string", "arguments": "string", "error": "struct<name: string, code: string>",
    "todos": "array<struct<status: string, content: string>>", "reason": "struct<kind: string, message: string>",
}


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), F.lit(r"[^\p{L}\p{N}]+")), lambda w: w != "")


def block_parts(blocks: Column) -> Column:
    """Searchable parts of content blocks: texts, names and arguments of tool calls; nothing of others."""
    part = lambda b: F.when(b["type"] == "text", F.array(b["text"])).when(b["type"] == "tool-call", F.array(b["name"], b["arguments"]))
    return F.flatten(F.filter(F.transform(blocks, part), lambda p: p.isNotNull()))


def event_text(kind: Column, blocks: Column, name: Column, arguments: Column, error: Column, todos: Column, reason: Column) -> Column:
    """Searchable text of an event, a trimmed part a line; empty for types that have none.

    Messages give their texts and tool calls, calls their name and arguments, results
    their content and error, todo lists status and content, ends of turns a reason other
    than completion.  Null parts count as empty.
    """
    none = F.array().cast("array<string>")
    listed = F.flatten(F.transform(todos, lambda t: F.array(t["status"], t["content"])))
    ended = F.when(reason["kind"] == "error", F.array(F.lit("error"), reason["message"])).when(reason["kind"].isin("aborted", "max-tokens", "interrupted"), F.array(reason["kind"]))
    parts = (
        F.when(kind.isin("user/message", "assistant/message"), block_parts(blocks)).when(kind == "tool/call", F.array(name, arguments))
        .when(kind == "tool/result", F.concat(F.coalesce(block_parts(blocks), none), F.array(error["name"], error["code"]))).when(kind == "todo/write", listed).when(kind == "turn/end", ended)
    )
    return join_text(F.coalesce(parts, none))


def search_documents(log: DataFrame) -> DataFrame:
    """session_id, seq, type, time, surface and text of events with text.

    Reads what ``TEXT_COLUMNS`` lists; a column that the log lacks counts as null.
    """
    given = [F.col(c) if c in log.columns else F.lit(None).cast(kind) for c, kind in TEXT_COLUMNS.items()]
    return log.select("session_id", "seq", "type", "time", "surface", event_text(F.col("type"), *given).alias("text")).filter("text <> ''")


def token_table(documents: DataFrame) -> DataFrame:
    """One row for each token of a document, with its count and the document's length."""
    words = documents.select("session_id", "seq", tokens(F.col("text")).alias("words")).withColumn("length", F.size("words"))
    return words.select("session_id", "seq", "length", F.explode("words").alias("token")).groupBy("session_id", "seq", "token").agg(F.count(F.lit(1)).alias("n"), F.first("length").alias("length"))


def _equals(token: str):
    return lambda word: word == token


def search(documents: DataFrame, query: str) -> DataFrame:
    """Documents that hold every word of ``query``, with their score.

    Words of the query are few, so documents shrink to their counts of these before
    anything is shuffled.
    """
    wanted = sorted({w for w in "".join(c.lower() if c.isalnum() else " " for c in query).split()})
    if not wanted:
        raise ValueError("a search needs a word")
    words = tokens(F.col("text"))
    counted = documents.withColumn("words", words).select("session_id", "seq", F.size("words").alias("length"), *(F.size(F.filter("words", _equals(t))).alias(f"n{i}") for i, t in enumerate(wanted)))
    stats = counted.agg(F.count(F.lit(1)).alias("docs"), F.avg("length").alias("mean"), *(F.sum((F.col(f"n{i}") > 0).cast("long")).alias(f"df{i}") for i in range(len(wanted))))
    # one row of statistics
    rows = counted.filter(" and ".join(f"n{i} > 0" for i in range(len(wanted)))).join(F.broadcast(stats))
    score = F.lit(0.0)
    for i in range(len(wanted)):
        n, df = F.col(f"n{i}"), F.col(f"df{i}")
        idf = F.log1p((F.col("docs") - df + 0.5) / (df + 0.5))
        score = score + idf * n * (K1 + 1) / (n + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    return rows.select("session_id", "seq", F.round(score, 6).alias("score"))


def capped(found: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The best ``limit`` rows and whether there were more."""
    top = found.orderBy(F.desc("score"), "session_id", "seq").limit(limit + 1)
    nth = F.row_number().over(Window.orderBy(F.desc("score"), "session_id", "seq"))
    rows = top.withColumn("nth", nth).withColumn("capped", F.max("nth").over(Window.partitionBy()) > limit)
    return rows.filter(F.col("nth") <= limit).drop("nth")


def best_per_session(found: DataFrame) -> DataFrame:
    """The best match of each session; of equal scores the least seq."""
    best = F.max(F.struct("score", (-F.col("seq")).alias("back"))).alias("best")
    return found.groupBy("session_id").agg(best).select("session_id", (-F.col("best.back")).alias("seq"), F.col("best.score").alias("score"))
