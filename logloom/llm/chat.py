"""Reply trees to formatted conversations, with DataFrame operations alone.

Messages form trees by their parents.  Pointer doubling by self-joins finds every
message's depth and path score in log2(depth) rounds; the best leaves of a tree
are chosen, and the same pointer tables, walked from the longest jump down, list
each message of a chosen path exactly once.  A path becomes one text:

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|> ...

Control strings inside roles and texts get a backslash behind their first
character; one more backslash is added where some stand there already, so the
escape can be undone.  ``loss_spans`` holds the code point ranges of assistant texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, pick, text_or_empty

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of common chat templates, after their first character.
_TAIL = r"/?s>|/?INST\]|/?SYS>|\|"
_CONTROL = rf"([<\[])(\\*)({_TAIL})"
_ESCAPED = rf"([<\[])\\(\\*)({_TAIL})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def reply_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """The ``best`` highest-scoring root-to-leaf paths of every tree.

    Args:
        messages: tree_id, msg_id, parent_id, score; (tree_id, msg_id) is unique.

    A message whose parent is null or missing is a root.  Messages in or below a
    cycle reach no root and stand on no path.  A null score counts 0; of equal
    totals the smaller leaf id wins.  Returns tree_id, leaf_id, msg_id, position.
    """
    scratch = Scratch(messages.sparkSession, "replies")
    nodes = messages.select("tree_id", "msg_id", "parent_id", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    ids = nodes.select("tree_id", F.col("msg_id").alias("parent_id"), F.lit(True).alias("known"))
    linked = nodes.join(ids, ["tree_id", "parent_id"], "left").select(
        "tree_id", "msg_id", F.when(F.col("known"), F.col("parent_id")).alias("up"), "score", F.lit(1).cast("long").alias("depth")
    )
    first = scratch.save("jump0", linked)
    rooted = first.filter(F.col("up").isNull())
    jumps = [first.filter(F.col("up").isNotNull())]
    active = jumps[0].count()
    while active:
        low = jumps[-1]
        high = low.unionByName(rooted).select("tree_id", F.col("msg_id").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"), F.col("depth").alias("depth2"))
        further = scratch.save(f"jump{len(jumps)}", low.join(high, ["tree_id", "up"]).select(
            "tree_id", "msg_id", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"), (F.col("depth") + F.col("depth2")).alias("depth"),
        ))
        rooted = rooted.unionByName(further.filter(F.col("up").isNull()))
        still = further.filter(F.col("up").isNotNull())
        left = still.count()
        if left == active:  # only cycles go on
            break
        active = left
        jumps.append(still)
    parents = linked.filter(F.col("up").isNotNull()).select("tree_id", F.col("up").alias("msg_id")).distinct()
    leaves = rooted.join(parents, ["tree_id", "msg_id"], "left_anti")
    ranked = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree_id").orderBy(F.desc("score"), "msg_id")))
    chosen = ranked.filter(F.col("rank") <= best).select("tree_id", F.col("msg_id").alias("leaf_id"), "msg_id", F.col("depth").alias("position"))
    for k in range(len(jumps) - 1, -1, -1):
        step = jumps[k].select("tree_id", "msg_id", "up")
        above = chosen.join(step, ["tree_id", "msg_id"]).select("tree_id", "leaf_id", F.col("up").alias("msg_id"), (F.col("position") - 2**k).alias("position"))
        chosen = scratch.save(f"path{k}", chosen.unionByName(above))
    return chosen


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per path: ``formatted`` and ``loss_spans`` (start and length, code points)."""
    texts = messages.select("tree_id", "msg_id", escape(text_or_empty("role")).alias("role"), escape(text_or_empty("text")).alias("text"), (F.coalesce(F.col("role"), F.lit("")) == "assistant").alias("loss"))
    pieces = paths.join(texts, ["tree_id", "msg_id"]).withColumn("head", F.concat(F.lit(START), "role", F.lit(SEP)))
    before = Window.partitionBy("tree_id", "leaf_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.char_length("head") + F.char_length("text") + len(END)
    placed = pieces.withColumn("start", F.coalesce(F.sum(whole).over(before), F.lit(0)) + F.char_length("head"))
    turn = F.struct("position", F.concat("head", "text", F.lit(END)).alias("piece"), "loss", "start", F.char_length("text").cast("long").alias("length"))
    grouped = placed.groupBy("tree_id", "leaf_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.select(
        "tree_id", "leaf_id", F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss_spans"),
    )


def read_formatted(formatted: DataFrame) -> DataFrame:
    """The turns of formatted texts, unescaped: tree_id, leaf_id, turn, role, text, masked.

    ``masked`` says that the turn's text is a loss span.
    """
    keys = ["tree_id", "leaf_id"]
    blocks = formatted.select(*keys, F.posexplode(F.split("formatted", F.lit(r"<\|im_start\|>"))).alias("turn", "block")).filter("turn > 0")
    parts = F.split("block", F.lit(r"<\|im_sep\|>"), 2)
    turns = blocks.select(*keys, "turn", parts[0].alias("role"), F.expr(f"substring_index(element_at(split(block, '<\\\\|im_sep\\\\|>', 2), 2), '{END}', 1)").alias("text"), F.char_length("block").alias("n"))
    before = Window.partitionBy(*keys).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("n") + len(START)).over(before), F.lit(0)) + len(START) + F.char_length("role") + len(SEP)
    placed = turns.withColumn("start", start.cast("long")).withColumn("length", F.char_length("text").cast("long"))
    spans = formatted.select(*keys, F.inline("loss_spans")).withColumn("masked", F.lit(True))
    masked = placed.join(spans, [*keys, "start", "length"], "left")
    return masked.select(*keys, "turn", unescape(F.col("role")).alias("role"), unescape(F.col("text")).alias("text"), F.coalesce("masked", F.lit(False)).alias("masked"))


def probe_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1: a user and an assistant row that hold control strings."""
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as trees of one branch: each row answers the one before it.

    Rows stand by turn, null turns first; rows of one turn by role and text, and
    repeated rows all stay.  Rows with a null conv_id form one conversation.
    """
    order = [F.asc_nulls_first(c) for c in ("turn", "role", "text")]
    numbered = conversations.withColumn("msg_id", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    known = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    return numbered.select(known.alias("tree_id"), "msg_id", (F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Every conversation formatted, and what its formatted text reads back to."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    scratch = Scratch(conversations.sparkSession, "chat")
    messages = scratch.save("messages", conversation_messages(rows))
    formatted = scratch.save("formatted", format_paths(reply_paths(messages), messages))
    turn = F.struct("turn", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("all"), F.when(F.col("masked"), F.col("text")).otherwise("").alias("loss"))
    joined = lambda field: F.array_join(F.transform("turns", lambda x: x[field]), "")
    back = read_formatted(formatted).groupBy("tree_id", "leaf_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    back = back.select("tree_id", "leaf_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined("all"), 256).alias("turns_sha256"), joined("loss").alias("loss"))
    sizes = formatted.select("tree_id", "leaf_id", F.char_length("formatted").cast("long").alias("formatted_chars"))
    return back.join(sizes, ["tree_id", "leaf_id"]).select(
        F.expr("try_cast(tree_id as bigint)").alias("conv_id"), "n_turns", "turns_sha256",
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


def formatted_with_probe(conversations: DataFrame) -> DataFrame:
    """``format_conversations`` of all rows plus the probe conversation."""
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    return format_conversations(rows.unionByName(probe_conversation(conversations.sparkSession)))
