"""Exact repeats of ``LENGTH`` bytes anywhere in the corpus, by prefix-free parsing.

A rolling hash of ``GRAM`` bytes triggers a phrase wherever it is the least within the
grams of some ``LENGTH``-byte string; every such string therefore belongs to exactly
one trigger, found from its own bytes alone, and no text is without triggers.  The
phrase of a trigger is all bytes of the strings that belong to it, so phrases overlap
and none is a proper prefix of what another decides.

*Parse*: every occurrence of a phrase, as document and place.  *Dictionary*: phrases
by trigger and bytes.  An occurrence that isn't its phrase's first repeats it whole.
Suffixes of different phrases can agree for ``LENGTH`` bytes only under one trigger, so
there the dictionary's suffixes are sorted by their bytes; neighbours with a common
prefix of ``LENGTH`` are equal, and the place of their phrases' first occurrences in
the parse decides which is earliest.  That is the corpus' suffix order as deep as the
question needs it; the order beyond ``LENGTH`` bytes is never made.  A frequent
trigger isn't sorted by one task: its phrases meet by their hashes, and their strings
by digest and distance from the trigger, in as many tasks as there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, bloom_filter, change_with_few, filter_rows, maybe_in, pick, tasks_for, text_or_empty
from .words import copy_of, mix

LENGTH, GRAM = 100, 32
#: Grams of one string.
SPAN = LENGTH - GRAM + 1
#: Strings that are parsed at once, which bounds a worker's memory for long texts.
CHUNK = 1 << 20
#: A trigger that one task meets so often has its phrases, and their strings, dealt over all tasks.
HOT = 256
#: Phrases that a task hands on at once.
PARSED_ROWS = 1 << 17
#: Grams that a task counts at once.
MOST_COUNTED = 1 << 22
_INDEX_BITS = np.uint64(24)
_INDEX = np.uint64((1 << 24) - 1)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), shape=(len(data) - 7,), strides=(1,)).copy()


def triggers(data: np.ndarray, phrases: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash, place, first and last string, and phrase hash of each trigger."""
    found = []
    for base in range(0, len(data) - LENGTH + 1, CHUNK):
        part = np.ascontiguousarray(data[base : base + CHUNK + LENGTH - 1])
        eight = eight_bytes(part)
        n = len(part) - GRAM + 1
        gram = mix(sum(eight[8 * i : 8 * i + n] * _ODD[i] for i in range(GRAM // 8)))
        least = (gram & ~_INDEX) | np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = SPAN - width
        least = np.minimum(least[: len(least) - rest], least[rest:])
        place = (least & _INDEX).astype(np.int64)
        cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
        first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(place)]]) - 1
        place = place[first]
        phrase = (last - first).astype(np.uint64) * _ODD[0] + (place - first).astype(np.uint64)
        end = last + LENGTH - 8
        for k in range(-(-(LENGTH + SPAN) // 8) if phrases else 0):
            phrase = mix(phrase * _ODD[1] + eight[np.minimum(first + 8 * k, end)])
        found.append((gram[place], place + base, first + base, last + base, phrase))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.uint64))


def parse(texts: DataFrame, hot: np.ndarray | None = None) -> DataFrame:
    """gram, phrase, doc_id, copy, place, first, last, hot: every phrase of every text.

    ``hot`` is a Bloom filter of frequent triggers; one that it lets through by
    mistake is dealt like them, with the same result.
    """
    names = ["gram", "phrase", "doc_id", "copy", "place", "first", "last", "hot"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            held = 0

            def out() -> pa.RecordBatch:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                arrays = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(columns, types)]
                for c in columns:
                    c.clear()
                marked = np.zeros(len(arrays[0]), dtype=bool) if hot is None else maybe_in(hot, arrays[0])
                return pa.RecordBatch.from_arrays([*arrays, pa.array(marked)], names=names)

            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer()
                gram, place, first, last, phrase = triggers(np.frombuffer(data, dtype=np.uint8))
                for column, x in zip(columns, (gram.view(np.int64), phrase.view(np.int64), np.full(len(place), doc, np.int64), np.full(len(place), copy_of(data), np.int64), place.astype(np.int32), first.astype(np.int32), last.astype(np.int32))):
                    column.append(x)
                held += len(place)
                if held > PARSED_ROWS:
                    yield out()
                    held = 0
            yield out()

    long = texts.filter((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull())
    return long.mapInArrow(scan, "gram long, phrase long, doc_id long, copy long, place int, first int, last int, hot boolean")


def phrase_bytes(texts: DataFrame, unsure: DataFrame) -> DataFrame:
    """The listed phrases with their bytes, padded to one length."""
    size = LENGTH + SPAN + 7

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_py().encode("utf-8", "surrogatepass")
                own = copy_of(data)
                for m in marks.as_py():
                    if m["copy"] == own:
                        rows.append((m["gram"], doc, own, m["place"], m["first"], m["last"], data[m["first"] : m["last"] + LENGTH].ljust(size, b"\0")))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            names = ["gram", "doc_id", "copy", "place", "first", "last", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, types)], names=names)

    marks = unsure.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "copy", "place", "first", "last")).alias("marks"))
    held = filter_rows(texts, 0, bloom_filter(unsure.select("doc_id")))
    joined = held.join(marks, "doc_id").select("doc_id", "text", "marks")
    return joined.mapInArrow(cut, "gram long, doc_id long, copy long, place int, first int, last int, bytes binary")


def repeated_suffixes(gram: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Which strings repeat an earlier phrase's, by [row, distance from the trigger].

    Rows stand by gram, then document and place.  For each distance the dictionary's
    suffixes are sorted by gram and bytes; of equal neighbours the first row is kept.
    """
    repeated = np.zeros((len(gram), SPAN), dtype=bool)
    lead = (place - first).astype(np.int64)
    for back in range(SPAN):
        rows = np.flatnonzero((back <= lead) & (back >= place - last))
        if len(rows) < 2:
            continue
        suffix = np.zeros((len(rows), LENGTH + -LENGTH % 8), dtype=np.uint8)
        at = lead[rows] - back
        suffix[:, :LENGTH] = data[rows[:, None], at[:, None] + np.arange(LENGTH)]
        keys = suffix.view(">u8").astype(np.uint64)
        # the shared trigger's own bytes needn't be compared twice, but they are: equal hashes aren't proof
        order = np.lexsort((rows, *keys.T[::-1], gram[rows]))
        same = (gram[rows][order[1:]] == gram[rows][order[:-1]]) & (keys[order[1:]] == keys[order[:-1]]).all(axis=1)
        repeated[rows[order[1:][same]], back] = True
    return repeated


def resolve_phrases(phrases: DataFrame, tasks: int) -> DataFrame:
    """doc_id, copy, first, last of strings that an earlier phrase under the same trigger holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
            gram, doc, copy, place, first, last = (batch.column(i).to_numpy() for i in range(6))
            data = np.frombuffer(b"".join(batch.column(6).to_pylist()), dtype=np.uint8).reshape(len(gram), -1)
            # a repeated row isn't earlier than itself
            new = np.ones(len(gram), dtype=bool)
            new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1]) | (place[1:] != place[:-1]) | (data[1:] != data[:-1]).any(axis=1)
            gram, doc, copy, place, first, last, data = (x[new] for x in (gram, doc, copy, place, first, last, data))
            found = np.pad(repeated_suffixes(gram, place, first, last, data), ((0, 0), (1, 1))).astype(np.int8)
            step = np.diff(found, axis=1)
            row, low = np.nonzero(step == 1)
            _, high = np.nonzero(step == -1)
            columns = [pa.array(doc[row]), pa.array(copy[row]), pa.array((place[row] - high + 1).astype(np.int32)), pa.array((place[row] - low).astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "first", "last"])

        for batch in batches:  # a gram may go on in the next batch
            if not batch.num_rows:
                continue
            grams = batch.column(0).to_numpy()
            others = np.flatnonzero(grams != grams[-1])
            split = int(others[-1]) + 1 if len(others) else 0
            if held and (split or held[-1].column(0)[-1].as_py() != grams[-1]):
                yield emit(pa.concat_batches([*held, batch.slice(0, split)]))
                held = []
            elif split:
                yield emit(batch.slice(0, split))
            held.append(batch.slice(split))
        if held:
            yield emit(pa.concat_batches(held))

    ordered = phrases.repartition(tasks, "gram").sortWithinPartitions("gram", "doc_id", "copy", "place")
    return ordered.mapInArrow(run, "doc_id long, copy long, first int, last int")


def hot_strings(phrases: DataFrame) -> DataFrame:
    """gram, back, digest, doc_id, copy, place: every string of the phrases, by distance from its trigger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, doc, copy, place, first, last = (batch.column(i).to_pylist() for i in range(6))
            for base in range(0, batch.num_rows, 1000):  # bounds the rows that one batch gives
                rows = []
                for i in range(base, min(base + 1000, batch.num_rows)):
                    data = batch.column(6)[i].as_py()
                    for at in range(last[i] - first[i] + 1):
                        digest = hashlib.blake2b(data[at : at + LENGTH], digest_size=16).digest()
                        rows.append((gram[i], place[i] - first[i] - at, digest, doc[i], copy[i], place[i]))
                types = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 6, types)], names=["gram", "back", "digest", "doc_id", "copy", "place"])

    return phrases.mapInArrow(run, "gram long, back int, digest binary, doc_id long, copy long, place int")


def resolve_hot(phrases: DataFrame, scratch: Scratch) -> DataFrame:
    """As ``resolve_phrases``, with a gram's strings dealt over all tasks by 128-bit digest."""
    strings = scratch.save("strings", hot_strings(phrases))
    key = ["gram", "back", "digest"]
    heads = strings.groupBy(*key).agg(F.min(F.struct("doc_id", "copy", "place")).alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    found = strings.join(heads, key).filter((F.col("doc_id") != F.col("head.doc_id")) | (F.col("copy") != F.col("head.copy")) | (F.col("place") != F.col("head.place")))
    found = found.select("doc_id", "copy", "place", "back").distinct()
    nth = F.row_number().over(Window.partitionBy("doc_id", "copy", "place").orderBy("back"))
    runs = found.withColumn("run", F.col("back") - nth).groupBy("doc_id", "copy", "place", "run").agg(F.min("back").alias("low"), F.max("back").alias("high"))
    return runs.select("doc_id", "copy", (F.col("place") - F.col("high")).alias("first"), (F.col("place") - F.col("low")).alias("last"))


def frequent_grams(texts: DataFrame) -> DataFrame:
    """gram of each trigger that some task meets at least ``HOT`` times."""
    least = HOT

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, times = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            found = [triggers(np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), dtype=np.uint8), phrases=False)[0] for text in batch.column(0)]
            new, n = np.unique(np.concatenate([grams, *found]), return_inverse=True)
            weight = np.concatenate([times, np.ones(len(n) - len(times), np.int64)])
            grams, times = new, np.bincount(n, weight, len(new)).astype(np.int64)
            if len(grams) > MOST_COUNTED:  # single ones are let go first, as in lossy counting
                kept = times > 1
                grams, times = grams[kept], times[kept]
        yield pa.RecordBatch.from_arrays([pa.array(grams[times >= least].view(np.int64))], names=["gram"])

    long = texts.filter((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull())
    return long.select("text").mapInArrow(count, "gram long").distinct()


def repeated_strings(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, copy and first and last start of runs of repeated strings."""
    frequent = scratch.save("frequent", frequent_grams(texts))
    some = not frequent.isEmpty()
    parsed = parse(texts, bloom_filter(frequent) if some else None)
    # a hot phrase's occurrences are dealt by document too; the firsts of all deals meet below
    deal = F.xxhash64("phrase", F.pmod(F.xxhash64("doc_id"), F.lit(tasks_for(texts.sparkSession))))
    parsed = parsed.withColumn("deal", F.when(F.col("hot"), deal).otherwise(F.lit(0)))
    by_gram = Window.partitionBy("gram", "deal")
    order = Window.partitionBy("gram", "deal", "phrase").orderBy("doc_id", "copy", "place")
    parsed = parsed.withColumn("low", F.min("phrase").over(by_gram)).withColumn("high", F.max("phrase").over(by_gram)).withColumn("nth", F.dense_rank().over(order))
    known = parsed.filter("nth > 1 or low <> high or hot").select("gram", "phrase", "doc_id", "copy", "place", "first", "last", (F.col("nth") > 1).alias("repeats"), "hot")
    known = scratch.save("phrases", known)
    whole = known.filter("repeats").select("doc_id", "copy", "first", "last")
    few = phrase_bytes(texts, known.filter("not repeats and not hot"))
    found = whole.unionByName(scratch.save("resolved", resolve_phrases(few, tasks_for(texts.sparkSession))))
    if not some:
        return found
    # no more rows of a phrase than there are deals
    nth = F.dense_rank().over(Window.partitionBy("gram", "phrase").orderBy("doc_id", "copy", "place"))
    firsts = scratch.save("firsts", known.filter("not repeats and hot").withColumn("nth", nth))
    found = found.unionByName(firsts.filter("nth > 1").select("doc_id", "copy", "first", "last"))
    return found.unionByName(scratch.save("hot", resolve_hot(phrase_bytes(texts, firsts.filter("nth = 1")), scratch)))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every whole text without the bytes of strings that start earlier too.

    Args:
        docs: doc_id and text; other columns are ignored.

    Returns a row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 (of the remaining bytes).  Null texts are empty.  Equal rows
    count as one document; rows with one doc_id and different texts are documents of
    their own, of which that with the smaller hash of its text is the earlier.  A null
    doc_id takes no part.  An empty table gives no rows.
    """

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data, kept, at, removed, n = text.as_py().encode("utf-8", "surrogatepass"), hashlib.sha256(), 0, 0, 0
            end, spans = -1, spans.as_py() or []
            own = copy_of(data) if spans else 0
            for start, last in sorted((s["first"], s["last"]) for s in spans if s["copy"] == own):
                stop = last + LENGTH
                if start > end:
                    if end >= 0:
                        removed += end - begin
                    kept.update(data[at:start])
                    n, begin, end = n + 1, start, stop
                end = max(end, stop)
                at = end
            if end >= 0:
                removed += end - begin
            kept.update(data[at:])
            rows.append((doc, len(data), removed, n, kept.hexdigest()))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 5, types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    scratch = Scratch(docs.sparkSession, "suffix")
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_or_empty(F.col("text").cast("string")).alias("text"))
    spans = repeated_strings(texts, scratch).groupBy("doc_id").agg(F.collect_list(F.struct("copy", "first", "last")).alias("spans"))
    spans = scratch.save("spans", spans)
    scratch.keep("spans")
    return change_with_few(texts, "doc_id", spans, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
