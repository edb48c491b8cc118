"""Ordered folds over session logs, as windows and aggregates.

A log has session_id, seq and type; each fold names what else it reads.  State
machines become epochs: a running count of the events that reset the state splits a
session, and inside an epoch the state is a first, last or running value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.text import preview

#: Most characters of an outline's previews.
PROMPT_CHARS, RESPONSE_CHARS = 50, 120


def _by_seq(*keys: str) -> Window:
    return Window.partitionBy("session_id", *keys).orderBy("seq")


def _up_to_now(*keys: str) -> Window:
    return _by_seq(*keys).rowsBetween(Window.unboundedPreceding, 0)


def _before(*keys: str) -> Window:
    return _by_seq(*keys).rowsBetween(Window.unboundedPreceding, -1)


def _is(*types: str) -> Column:
    return F.col("type").isin(*types)


def _floor0(x: Column) -> Column:
    """At least 0; null stays null, which greatest alone would make 0."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0).cast("long"), x))


def session_stats(log: DataFrame) -> DataFrame:
    """turns, steps and times of every session.

    Reads turn, step, time, call_id, first_token_time and output_tokens.  A message
    counts for the open step if turn and step agree; the first one closes it.  The
    first token of an earlier attempt wins.  A result counts against the latest call of
    its id in the same turn, once.  Negative spans count 0; negative token numbers are
    none.
    """
    log = log.withColumn("output_tokens", F.when(F.col("output_tokens") >= 0, F.col("output_tokens")))
    marks = log.withColumn("opened", F.last(F.when(_is("step/start"), F.struct("seq", "turn", "step", "time")), ignorenulls=True).over(_up_to_now()))
    marks = marks.withColumn("epoch", F.col("opened.seq")).withColumn("calls", F.sum(_is("turn/end").cast("int")).over(_up_to_now()))
    ends = F.coalesce(F.sum(_is("step/end").cast("int")).over(_before("epoch")), F.lit(0))
    matching = (F.col("opened.turn") == F.col("turn")) & (F.col("opened.step") == F.col("step")) & (ends == 0)
    marks = marks.withColumn("matches", F.coalesce(matching, F.lit(False)))
    answer = F.col("matches") & _is("assistant/message")
    earlier = F.coalesce(F.sum(answer.cast("int")).over(_before("epoch")), F.lit(0))
    counted = answer & (earlier == 0)
    attempt = F.first(F.when(F.col("matches") & _is("assistant/attempt"), F.col("first_token_time")), ignorenulls=True).over(_before("epoch"))
    first_token = F.when(counted, F.coalesce(attempt, F.col("first_token_time")))
    started = F.col("opened.time")
    call = _by_seq("call_id", "calls")
    last_kind = F.lag("type").over(call)
    tool_span = F.when(_is("tool/result") & (last_kind == "tool/call"), _floor0(F.col("time") - F.lag("time").over(call)))
    previous_turn = F.last(F.when(_is("step/end"), F.col("turn")), ignorenulls=True).over(_before())
    new_turn = _is("step/end") & ~F.col("turn").eqNullSafe(previous_turn)
    # calls and results alone take part in the call windows
    paired = log.filter(_is("tool/call", "tool/result", "turn/end")).withColumn("calls", F.sum(_is("turn/end").cast("int")).over(_up_to_now())).filter(~_is("turn/end"))
    tools = paired.withColumn("span", tool_span).groupBy("session_id").agg(F.sum("span").alias("tool_ms"))
    rows = marks.select(
        "session_id", new_turn.alias("new_turn"), _is("step/end").alias("ended"), F.when(counted, _floor0(F.col("time") - started)).alias("llm"),
        F.when(counted, _floor0(first_token - started)).alias("ttft"), F.when(counted & F.col("output_tokens").isNotNull(), _floor0(F.col("time") - first_token)).alias("decode"),
        F.when(counted & first_token.isNotNull(), F.col("output_tokens")).alias("tokens"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    stats = rows.groupBy("session_id").agg(
        total(F.col("new_turn").cast("int")).alias("turns"), total(F.col("ended").cast("int")).alias("steps"), total("llm").alias("llm_ms"),
        total("ttft").alias("ttft_ms"), F.count("ttft").alias("ttft_steps"), total("decode").alias("decode_ms"), total("tokens").alias("decode_tokens"),
    )
    joined = stats.join(tools, "session_id", "left")
    return joined.select("session_id", "turns", "steps", "llm_ms", F.coalesce("tool_ms", F.lit(0)).cast("long").alias("tool_ms"), "ttft_ms", "ttft_steps", "decode_ms", "decode_tokens")


def turn_outline(log: DataFrame) -> DataFrame:
    """Each turn's start seq, first human prompt and last answer, as previews.

    Reads turn, source_kind and parts (texts of a message).  Only a start that raises
    the turn number opens a turn.  An answer counts once its turn/end is there.
    """
    highest = F.max(F.when(_is("turn/start"), F.col("turn"))).over(_before())
    opens = _is("turn/start") & (highest.isNull() | (F.col("turn") > highest))
    rows = log.withColumn("opens", opens).withColumn("epoch", F.sum(F.col("opens").cast("int")).over(_up_to_now())).filter(F.col("epoch") > 0)
    rows = rows.withColumn("prompt", F.when(_is("user/message") & (F.col("source_kind") == "user"), preview(F.col("parts"), PROMPT_CHARS)))
    rows = rows.withColumn("answer", F.when(_is("assistant/message"), preview(F.col("parts"), RESPONSE_CHARS)))
    closed = F.max(F.when(_is("turn/end"), F.col("seq"))).over(Window.partitionBy("session_id", "epoch"))
    rows = rows.withColumn("closed", closed)
    said = lambda c: (F.col(c) != "") & F.col(c).isNotNull()
    grouped = rows.groupBy("session_id", "epoch").agg(
        F.min(F.when(F.col("opens"), F.col("turn"))).alias("turn"), F.min(F.when(F.col("opens"), F.col("seq"))).alias("seq"),
        F.min(F.when(said("prompt"), F.struct("seq", "prompt"))).alias("p"), F.max(F.when(said("answer") & (F.col("seq") < F.col("closed")), F.struct("seq", "answer"))).alias("a"),
    )
    return grouped.select("session_id", "turn", "seq", F.coalesce("p.prompt", F.lit("")).alias("prompt"), F.coalesce("a.answer", F.lit("")).alias("response"))


def tool_balance(log: DataFrame) -> DataFrame:
    """Running tool calls minus results; a cut behind an event is balanced at 0.

    Reads n_calls of messages.  A result without a call fails the query.
    """
    delta = F.when(_is("assistant/message"), F.col("n_calls")).when(_is("tool/result"), -1).otherwise(0)
    rows = log.withColumn("running", F.sum(delta).over(_up_to_now()))
    checked = F.when(F.col("running") < 0, F.raise_error(F.concat(F.lit("result without a call at seq "), F.col("seq").cast("string")))).otherwise(F.col("running"))
    return rows.select("session_id", "seq", checked.cast("long").alias("running")).withColumn("balanced", F.col("running") == 0)


def running_tokens(log: DataFrame) -> DataFrame:
    """Running total of the signed token deltas of surface events (reads delta_tokens)."""
    return log.select("session_id", "seq", F.sum(F.coalesce("delta_tokens", F.lit(0))).over(_up_to_now()).cast("long").alias("total_tokens"))


def token_usage(log: DataFrame) -> DataFrame:
    """The four disjoint counters summed over a session."""
    names = ("input_tokens", "output_tokens", "cache_read_tokens", "cache_write_tokens")
    return log.groupBy("session_id").agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in names))


def last_value(log: DataFrame, kind: str, column: str, default: str | None = None) -> DataFrame:
    """``column`` of a session's last ``kind`` event, else ``default`` (another column)."""
    found = F.max_by(column, F.when(_is(kind), F.col("seq")))
    other = F.max_by(default, "seq") if default else F.lit(None)
    return log.groupBy("session_id").agg(F.coalesce(F.when(F.max(_is(kind)), found), other).alias(column))


def current_todos(log: DataFrame, column: str = "items") -> DataFrame:
    """The list that a session wrote last; a later turn start clears it."""
    return log.filter(_is("todo/write", "turn/start")).groupBy("session_id").agg(F.max_by(F.when(_is("todo/write"), F.col(column)), "seq").alias(column))


def open_step_provider(log: DataFrame) -> DataFrame:
    """Provider of the last header while the last step is still open, else null."""
    state = F.max_by("type", F.when(_is("step/start", "step/end"), F.col("seq")))
    provider = F.max_by("provider", F.when(_is("request/header"), F.col("seq")))
    has_header = F.max(_is("request/header"))
    return log.groupBy("session_id").agg(F.when((state == "step/start") & has_header, provider).alias("provider"))


def subagent_timing(log: DataFrame) -> DataFrame:
    """Settled time since the last descriptor, the open turn, and how the last turn ended.

    Reads time and, of turn ends, reason.  A turn that was open at the descriptor
    counts from its own start.  Returns every session: settled_ms (0 without a
    descriptor), open_since and open_through (the session's last event; null without an open turn),
    completed (whether the last ended turn's reason was completion; null while a turn
    is open or before one ended).
    """
    rows = log.withColumn("from", F.max(F.when(_is("subagent/descriptor"), F.col("seq"))).over(Window.partitionBy("session_id")))
    turns = rows.filter(_is("turn/start", "turn/end") & F.col("from").isNotNull())
    before, after = F.lag(F.struct("type", "time")).over(_by_seq()), F.lead("seq").over(_by_seq())
    turns = turns.withColumn("before", before).withColumn("after", after)
    # a start counts behind the descriptor, or open at it; an end only of an open turn
    opens = _is("turn/start") & ((F.col("seq") > F.col("from")) | F.coalesce(F.col("after") > F.col("from"), F.lit(True)))
    closes = _is("turn/end") & (F.col("seq") > F.col("from")) & F.coalesce(F.col("before.type") == "turn/start", F.lit(False))
    done = F.coalesce(F.col("reason") == "completed", F.lit(False))
    marks = turns.filter(opens | closes).select("session_id", "seq", F.struct(_is("turn/start").alias("open"), "time", done.alias("done")).alias("mark"), F.when(_is("turn/end"), _floor0(F.col("time") - F.col("before.time"))).alias("span"))
    folded = marks.groupBy("session_id").agg(F.sum("span").alias("settled"), F.max_by("mark", "seq").alias("mark"))
    sessions = log.groupBy("session_id").agg(F.max_by("time", "seq").alias("through"))
    is_open = F.coalesce(F.col("mark.open"), F.lit(False))
    return sessions.join(folded, "session_id", "left").select(
        "session_id", F.coalesce("settled", F.lit(0)).cast("long").alias("settled_ms"), F.when(is_open, F.col("mark.time")).alias("open_since"),
        F.when(is_open, F.col("through")).alias("open_through"), F.when(~is_open, F.col("mark.done")).alias("completed"),
    )


def child_catalog(log: DataFrame) -> DataFrame:
    """Child facts behind the inherited part of a log, in order (reads child_id, seed_length)."""
    own = log.filter(_is("subagent/catalog") & (F.col("seq") >= F.coalesce("seed_length", F.lit(0))))
    return own.groupBy("session_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "child_id"))), lambda x: x["child_id"]).alias("children"))


def model_selection(log: DataFrame) -> DataFrame:
    """The selection last used by a request and the one that the next request will use.

    Reads selection (a struct) of selections and request headers.  A selection is
    pending until a later header has the same; a newer one replaces it.  Both columns
    are null in a session without either.
    """
    chosen, used = _is("model/selection"), _is("request/header")
    rows = log.filter(chosen | used).withColumn("epoch", F.sum(chosen.cast("int")).over(_up_to_now()))
    rows = rows.withColumn("current", F.last(F.when(chosen, F.col("selection")), ignorenulls=True).over(_up_to_now()))
    epochs = rows.groupBy("session_id", "epoch").agg(
        F.max(F.when(used, F.struct("seq", "selection"))).alias("header"), F.max_by("current", "seq").alias("pending"), F.max(used & F.col("current").eqNullSafe(F.col("selection"))).alias("met"),
    )
    epochs = epochs.withColumn("waits", F.when(~F.col("met"), F.col("pending")))
    last = epochs.groupBy("session_id").agg(F.max("header")["selection"].alias("last_used"), F.max(F.struct("epoch", "waits"))["waits"].alias("pending"))
    sessions = log.select("session_id").distinct().join(last, "session_id", "left")
    return sessions.select("session_id", "last_used", F.coalesce("pending", "last_used").alias("next"))


def model_policy(log: DataFrame) -> DataFrame:
    """Routes that a session's first policy lets children use, and whether they are valid.

    Reads allowed_models (provider and model).  Later policies don't count.  Valid
    routes aren't empty, blank or repeated; without a policy both columns are null.
    """
    kind = "subagent/model-selection-policy"
    first = log.groupBy("session_id").agg(F.min(F.when(_is(kind), F.struct("seq", "allowed_models")))["allowed_models"].alias("routes"), F.max(_is(kind)).alias("stated"))
    blank = F.exists("routes", lambda r: (F.coalesce(r["provider"], F.lit("")) == "") | (F.coalesce(r["model"], F.lit("")) == ""))
    valid = (F.size("routes") > 0) & ~blank & (F.size(F.array_distinct("routes")) == F.size("routes"))
    return first.select("session_id", "routes", F.when(F.col("stated"), F.coalesce(F.col("routes").isNotNull() & valid, F.lit(False))).alias("valid"))


def tool_history(log: DataFrame) -> DataFrame:
    """Tools that headers declared before each call, and whether the called one was there.

    Reads tools (names, on headers) and tool (name, on calls); the nearest earlier header counts.
    """
    header = F.last(F.when(_is("request/header"), F.col("tools")), ignorenulls=True).over(_up_to_now())
    rows = log.withColumn("declared", header).filter(_is("tool/call"))
    return rows.select("session_id", "seq", "tool", F.coalesce(F.array_contains("declared", F.col("tool")), F.lit(False)).alias("available"))


def assemble_stream(chunks: DataFrame) -> DataFrame:
    """message_id, usage, finish and blocks (type, text, id, name, arguments) of streamed messages.

    Reads message_id, seq, kind, index, block_type (of block-start), text (of text-delta
    and reasoning-delta), id, name and arguments (of tool-call-delta), block (of
    block-end, as in the result) and value (of usage and finish).  The first end of an
    index gives its block whole; what comes behind it is ignored.  An open one has the
    type of its first chunk, its deltas joined in order, the last id and the last name
    that isn't empty; without an id it is call-<index>.  Blocks stand by first sight;
    the last usage and finish count; tool calls go when the finish is max-tokens.
    """
    kind, call, told = F.col("kind"), F.col("kind") == "tool-call-delta", F.col("kind").isin("text-delta", "reasoning-delta")
    by_block = Window.partitionBy("message_id", "index")
    blocks = chunks.filter(F.col("index").isNotNull()).withColumn("end", F.min(F.when(kind == "block-end", F.col("seq"))).over(by_block))
    live = F.col("end").isNull() | (F.col("seq") < F.col("end"))
    opened = F.when(kind == "block-start", F.col("block_type")).when(kind == "text-delta", "text").when(kind == "reasoning-delta", "reasoning").when(call, "tool-call").otherwise(F.col("block.type"))
    joined = lambda taken, c: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(taken & live, F.struct("seq", F.coalesce(c, F.lit("")).alias("part"))))), lambda x: x["part"]), "")
    named = F.when(call & live & (F.coalesce("name", F.lit("")) != ""), F.col("seq"))
    built = blocks.groupBy("message_id", "index").agg(
        F.min("seq").alias("first"), F.min_by(opened, "seq").alias("type"), joined(told, F.col("text")).alias("text"), joined(call, F.col("arguments")).alias("arguments"),
        F.max_by("id", F.when(call & live, F.col("seq"))).alias("id"), F.max_by("name", named).alias("name"), F.max(F.when((kind == "block-end") & (F.col("seq") == F.col("end")), F.struct("block"))).alias("closed"),
    )
    is_call = F.col("type") == "tool-call"
    none = F.lit(None).cast("string")
    whole = F.struct(
        "type", F.when(~is_call, F.col("text")).alias("text"), F.when(is_call, F.coalesce("id", F.concat(F.lit("call-"), F.col("index").cast("string")))).otherwise(none).alias("id"),
        F.when(is_call, F.coalesce("name", F.lit(""))).alias("name"), F.when(is_call, F.col("arguments")).alias("arguments"),
    )
    built = built.select("message_id", "first", F.when(F.col("closed").isNotNull(), F.col("closed.block")).otherwise(whole).alias("block"))
    ends = chunks.groupBy("message_id").agg(
        F.max_by("value", F.when(F.col("kind") == "usage", F.col("seq"))).alias("usage"), F.max_by("value", F.when(F.col("kind") == "finish", F.col("seq"))).alias("finish")
    )
    kept = built.join(ends.select("message_id", "finish"), "message_id", "left").filter(~(F.coalesce(F.col("block.type") == "tool-call", F.lit(False)) & (F.coalesce("finish", F.lit("")) == "max-tokens")))
    content = kept.groupBy("message_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "block"))), lambda x: x["block"]).alias("blocks"))
    return ends.join(content, "message_id", "left")


def prune_totals(log: DataFrame) -> DataFrame:
    """Prunes and code points that they removed (reads chars_before, chars_after)."""
    pruned = log.filter(_is("compaction/prune"))
    return pruned.groupBy("session_id").agg(F.count(F.lit(1)).alias("prunes"), F.sum(F.col("chars_before") - F.col("chars_after")).alias("chars_removed"))
