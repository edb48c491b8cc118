"""Walks along parents, replacements and citations, by joins that double their reach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.sources.scratch import WorkTables

#: Steps of a tour that are ranked by doubling; longer tours are contracted to as many first.
SHORT = 1 << 17


def ancestors(nodes: DataFrame) -> DataFrame:
    """Every ancestor of every node, with its distance: id, ancestor, distance, and outcome.

    nodes: id, parent; an id has one parent.  A parent that isn't a node ends the walk as
    "partial"; a walk that meets its own node again is a "cycle" and lists each node of it
    once; others are "complete".  A node's way up is one array; each round, ways that
    haven't ended take on the way of the node that they end at.  So reach doubles, the
    rounds grow with log2(depth), and joins move nodes, not pairs: the pairs are made from
    the ways at the end.
    """
    plain = nodes.select("id", "parent").distinct()
    known = plain.select(F.col("id").alias("parent"), F.lit(True).alias("found"))
    begun = F.when(F.col("id").isNull() | F.col("parent").isNull(), "complete").when(F.col("found").isNull(), "partial").when(F.col("id") == F.col("parent"), "cycle")
    links = plain.join(known, "parent", "left").withColumn("state", begun)
    tables = WorkTables(nodes.sparkSession, "lineage")
    fresh = tables.save("ways", links.select("id", F.when(F.col("state").isNull() | (F.col("state") == "cycle"), F.array("parent")).alias("way"), "state"))
    ended = fresh.filter("state is not null")
    reached, todo = fresh, fresh.filter("state is null")
    while not todo.isEmpty():
        todo = todo.withColumn("at", F.element_at("way", -1))
        wanted = tables.save("wanted", todo.select("at").distinct())
        # few nodes are ends of ways in late rounds, where many ways share them
        above = tables.save("above", reached.join(wanted, F.col("id") == F.col("at"), "left_semi").select(F.col("id").alias("at"), F.col("way").alias("more"), F.col("state").alias("end")))
        met = todo.drop("state").join(above, "at").withColumn("own", F.coalesce(F.array_position("more", F.col("id")), F.lit(0)))
        both = F.concat("way", "more")
        # a way into a circle runs round it, so a node comes again only behind all others
        way = F.when(F.col("more").isNull(), F.col("way")).when(F.col("own") > 0, F.concat("way", F.slice("more", F.lit(1), F.col("own").cast("int")))).when(F.col("end") == "cycle", F.array_distinct(both)).otherwise(both)
        fresh = tables.save("ways", met.select("id", way.alias("way"), F.when(F.col("own") > 0, "cycle").otherwise(F.col("end")).alias("state")))
        reached, todo = ended.unionByName(fresh), fresh.filter("state is null")
        ended = ended.unionByName(fresh.filter("state is not null"))
    tables.drop("wanted", "above")
    pairs = ended.select("id", F.posexplode_outer("way").alias("place", "ancestor"), F.col("state").alias("outcome"))
    return pairs.select("id", "ancestor", (F.col("place") + 1).cast("long").alias("distance"), "outcome")


def _toss(node: str, n: int) -> Column:
    """A fair coin of a step in round ``n``."""
    return F.xxhash64(f"{node}_id", f"{node}_in", F.lit(n)).bitwiseAND(1) == 1


def _contracted(tables: WorkTables, links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Links of fewer steps, and each round's table with the steps that went into the one before them.

    Where a step's coin shows heads and its successor's tails, it takes the successor's
    place too.  A quarter goes each round, so all rounds together read and write a few
    times the tour.  Steps whose successor isn't there can't come to the end and go.
    """
    size, rounds = links.count(), []
    none = [F.lit(None).cast(kind).alias(f"gone_{c}") for c, kind in (("id", links.schema["at_id"].dataType), ("in", "boolean"), ("entered", "long"), ("level", "long"))]
    while size > SHORT:
        n = len(rounds)
        tails = links.filter(~_toss("at", n)).select(*(F.col(c).alias(f"x_{c}") for c in links.columns))
        waits = F.col("to_id").isNotNull() & ~_toss("to", n)
        heads, rest = links.filter(_toss("at", n) & waits), links.filter(_toss("at", n) & ~waits)
        met = heads.join(tails, (F.col("to_id") == F.col("x_at_id")) & (F.col("to_in") == F.col("x_at_in")), "right")
        taken = F.col("at_id").isNotNull()
        joined = met.select(
            *(F.when(taken, F.col(c)).otherwise(F.col(f"x_{c}")).alias(c) for c in ("at_id", "at_in")), F.col("x_to_id").alias("to_id"), F.col("x_to_in").alias("to_in"),
            *((F.coalesce(c, F.lit(0)) + F.col(f"x_{c}")).alias(c) for c in ("entered", "level")),
            F.when(taken, F.col("x_at_id")).alias("gone_id"), F.when(taken, F.col("x_at_in")).alias("gone_in"), F.col("entered").alias("gone_entered"), F.col("level").alias("gone_level"),
        )
        rounds.append(tables.save("rounds", rest.select("*", *none).unionByName(joined)))
        links, before = rounds[-1].select(*links.columns), size
        size = links.count()
        if size > before * 0.95:  # steps without a successor to take, as in other trees
            break
    return links, rounds


def _ranked(tables: WorkTables, links: DataFrame) -> DataFrame:
    """entered and level of each step summed to the end; steps that don't come there drop out."""
    size, span = links.count(), 1
    while span < size:
        waiting = links.filter("to_id is not null")
        if waiting.isEmpty():
            break
        ahead = links.select(F.col("at_id").alias("to_id"), F.col("at_in").alias("to_in"), F.col("to_id").alias("beyond_id"), F.col("to_in").alias("beyond_in"), F.col("entered").alias("more"), F.col("level").alias("up"))
        jumped = waiting.join(ahead, ["to_id", "to_in"]).select("at_id", "at_in", F.col("beyond_id").alias("to_id"), F.col("beyond_in").alias("to_in"), (F.col("entered") + F.col("more")).alias("entered"), (F.col("level") + F.col("up")).alias("level"))
        links = tables.save("links", jumped.unionByName(links.filter("to_id is null")))
        tables.drop("links", keep_last=True)
        span *= 2
    return links.filter("to_id is null").select("at_id", "at_in", "entered", "level")


def preorder(nodes: DataFrame, root: object) -> DataFrame:
    """The tree below ``root`` in pre-order: id, depth and place (the root is 0 and 0).

    nodes: id, parent, created_at; an id stands once.  Children stand by created_at, then
    id in the order of ICU's root locale, as text.  A tour enters every node and leaves
    those with children; where each step of it stands is found by list ranking: random
    contraction to ``SHORT`` steps, successors that jump twice as far each round, and
    the contracted steps put back.  Rounds grow with log2 of the tour, not with the
    depth, and the work of all rounds with the tour.  Steps that never come to the
    root's end (other trees, cycles) drop out.  An unknown root has no tree.
    """
    tables = WorkTables(nodes.sparkSession, "preorder")
    plain = nodes.select("id", F.when(F.col("id") != root, F.col("parent")).alias("parent"), "created_at")
    siblings = Window.partitionBy("parent").orderBy("created_at", F.collate(F.col("id").cast("string"), "UNICODE"))
    kin = plain.withColumn("next", F.when(F.col("parent").isNotNull(), F.lead("id").over(siblings))).withColumn("nth", F.row_number().over(siblings))
    firsts = kin.filter("nth = 1 and parent is not null").select(F.col("parent").alias("id"), F.col("id").alias("child"))
    kin = tables.save("kin", kin.join(firsts, "id", "left").select("id", "parent", "next", "child"))
    # entered and level count the steps from `at` to before `to`; only the root's end has no successor
    inner = F.col("child").isNotNull()
    onward, enters = F.coalesce("next", "parent"), F.when(F.coalesce("next", "parent").isNotNull(), F.col("next").isNotNull())
    step = lambda enter, to, to_in, entered, level: (F.col("id").alias("at_id"), F.lit(enter).alias("at_in"), to.alias("to_id"), to_in.alias("to_in"), F.lit(entered).cast("long").alias("entered"), level.cast("long").alias("level"))
    enter = kin.select(*step(True, F.coalesce("child", onward), F.when(inner, True).otherwise(enters), 1, F.when(inner, 1).otherwise(0)))
    leave = kin.filter(inner).select(*step(False, onward, enters, 0, F.lit(-1)))
    links = tables.save("links", enter.unionByName(leave).filter(F.col("to_id").isNotNull() | (F.col("at_id") == root)))
    links, rounds = _contracted(tables, links)
    ranks = tables.save("ranks", _ranked(tables, links))
    for n in range(len(rounds) - 1, -1, -1):
        gone = rounds[n].filter("gone_id is not null").select("at_id", "at_in", "gone_id", "gone_in", "gone_entered", "gone_level")
        back = gone.join(ranks.filter(_toss("at", n)), ["at_id", "at_in"])
        back = back.select(F.col("gone_id").alias("at_id"), F.col("gone_in").alias("at_in"), (F.col("entered") - F.col("gone_entered")).alias("entered"), (F.col("level") - F.col("gone_level")).alias("level"))
        ranks = ranks.unionByName(tables.save("ranks", back))
    tables.drop("kin", "links", "rounds")
    ended = ranks.filter("at_in").select(F.col("at_id").alias("id"), "entered", "level")
    # levels counted to the end are those that lie above
    whole = ended.filter(F.col("id") == root).select(F.col("entered").alias("nodes"))
    return ended.join(F.broadcast(whole)).select("id", (F.lit(0) - F.col("level")).cast("int").alias("depth"), (F.col("nodes") - F.col("entered")).alias("place"))


def cited_events(log: DataFrame) -> DataFrame:
    """Events joined to what they cite: session_id, seq, source_seq, source_type."""
    cites = log.select("session_id", "seq", F.explode("source_event_seqs").alias("source_seq"))
    sources = log.select("session_id", F.col("seq").alias("source_seq"), F.col("type").alias("source_type"))
    return cites.join(sources, ["session_id", "source_seq"], "left")


def related_events(log: DataFrame, folded: DataFrame, session_id: str, seq: int) -> DataFrame:
    """relation and seq of events that one event derives from, gave rise to, replaced or was replaced by."""
    own = log.filter((F.col("session_id") == session_id)).select("seq", F.explode("source_event_seqs").alias("cited"))
    mine = folded.filter(F.col("session_id") == session_id)
    parts = [
        own.filter(F.col("seq") == seq).select(F.lit("source").alias("relation"), F.col("cited").alias("seq")),
        own.filter(F.col("cited") == seq).select(F.lit("derived").alias("relation"), "seq"),
        mine.filter(F.col("shadowed_by") == seq).select(F.lit("replaced").alias("relation"), "seq"),
        mine.filter((F.col("seq") == seq) & F.col("shadowed_by").isNotNull()).select(F.lit("replaced-by").alias("relation"), F.col("shadowed_by").alias("seq")),
    ]
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found.distinct()


def replacement_chains(folded: DataFrame) -> DataFrame:
    """Every later replacement of every shadowed event, with its distance."""
    key = lambda c: F.struct("session_id", F.col(c).alias("seq"))
    nodes = folded.select(key("seq").alias("id"), F.when(F.col("shadowed_by").isNotNull(), key("shadowed_by")).alias("parent"))
    found = ancestors(nodes).filter(F.col("ancestor").isNotNull())
    return found.select("id.session_id", "id.seq", F.col("ancestor.seq").alias("replaced_by"), "distance")


def fork(log: DataFrame, session_id: str, boundary: int, new_id: str) -> DataFrame:
    """A new session: the events up to ``boundary``, the end of the seed, and closers.

    Reads time, turn, step and call_id.  The marker takes the boundary event's time.  If
    the seed's last turn is open, results of its unanswered calls follow in the calls'
    order, then the end of its open step and of the turn, with reason "forked".
    """
    prefix = log.filter((F.col("session_id") == session_id) & (F.col("seq") <= boundary)).withColumn("session_id", F.lit(new_id).cast(log.schema["session_id"].dataType))
    marks = prefix.groupBy("session_id").agg(
        F.max("seq").alias("last"), F.max_by("time", "seq").alias("time"),
        F.max(F.when(F.col("type").isin("turn/start", "turn/end"), F.struct("seq", "type", "turn"))).alias("turned"), F.max(F.when(F.col("type").isin("step/start", "step/end"), F.struct("seq", "type", "step"))).alias("stepped"),
    )
    marks = marks.withColumn("open", F.coalesce(F.col("turned.type") == "turn/start", F.lit(False)))
    marker = marks.select("session_id", (F.col("last") + 1).alias("seq"), F.lit("session/end-seed").alias("type"), "time")
    # one session's open turn: the last event of each of its calls is the call itself
    turn = prefix.join(marks.filter("open").select("session_id", F.col("turned.seq").alias("from")), "session_id").filter(F.col("type").isin("tool/call", "tool/result") & (F.col("seq") > F.col("from")))
    unanswered = turn.groupBy("session_id", "call_id").agg(F.max_by("type", "seq").alias("state"), F.max("seq").alias("at")).filter("state = 'tool/call'")
    nth = F.row_number().over(Window.partitionBy("session_id").orderBy("at"))
    results = unanswered.join(marks, "session_id").select("session_id", (F.col("last") + 1 + nth).alias("seq"), F.lit("tool/result").alias("type"), "time", "turned.turn", "stepped.step", "call_id", F.lit("forked").alias("reason"))
    waiting = unanswered.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    ends = marks.filter("open").join(waiting, "session_id", "left").withColumn("at", F.col("last") + 2 + F.coalesce("n", F.lit(0)))
    in_step = F.coalesce((F.col("stepped.type") == "step/start") & (F.col("stepped.seq") > F.col("turned.seq")), F.lit(False))
    steps = ends.filter(in_step).select("session_id", F.col("at").alias("seq"), F.lit("step/end").alias("type"), "time", "turned.turn", "stepped.step", F.lit("forked").alias("reason"))
    turns = ends.select("session_id", (F.col("at") + in_step.cast("int")).alias("seq"), F.lit("turn/end").alias("type"), "time", "turned.turn", F.lit("forked").alias("reason"))
    for more in (marker, results, steps, turns):
        prefix = prefix.unionByName(more, allowMissingColumns=True)
    return prefix
