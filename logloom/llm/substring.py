"""Repeated passages inside documents: paragraph MinHash banding and passage samples.

A paragraph is a line of at least ``MIN_WORDS`` words, or a run of shorter lines
without a blank one between them, as in hard-wrapped text, that has so many words
together.  Paragraphs get MinHash bands over their five-word shingles: twenty bands of
five rows let 99.96 % of the pairs at a similarity of 0.8 collide, and 5 % of those at
0.3.  Equal paragraphs form a class, and one stands for each; classes that share a
band are confirmed on their full shingle sets, and components of the links decide:
the first paragraph of a component stays, the others go.

A passage may also stand inside paragraphs that are otherwise different.  For that
runs of ``MIN_WORDS`` words are sampled wherever their hash is the least of
``CUT_WINDOW`` in a row.  Inside a repeated passage the samples agree, which is
banding with one band at a similarity of one; a sample seen before goes.  So a repeat
of 31 words or more never stays whole, at either end of it at most eleven words stay,
and repeats of fewer than 20 words (headings, stock sentences) stay.  Samples are told
apart by 96 bits of hash, paragraphs of one class by as many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bloom_filter, change_with_few, filter_rows, pick
from .near_dup import SHINGLE_WORDS, SIMILARITY, link_members
from .words import MinHasher, PassageHashes, Words, copy_of, shingles_in, slices, words_in

BANDS, ROWS = 20, 5
MIN_WORDS = 20
CUT_WINDOW = 12
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE, _PLACES = np.uint64(24), np.uint64((1 << 24) - 1)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word."""
    space = np.concatenate([[True], _SPACE[np.frombuffer(data, dtype=np.uint8)], [True]])
    change = np.flatnonzero(space[1:] != space[:-1])
    return change[::2], change[1::2]


def sampled_runs(text: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Places of the runs of ``MIN_WORDS`` words whose hash is the least of ``CUT_WINDOW`` in a row.

    ``text`` tells which text each word is of; a window lies within one text.
    """
    windows = len(runs) - CUT_WINDOW + 1
    if windows <= 0:
        return np.empty(0, dtype=np.int64)
    # the hash above, the place below: of equal hashes the first counts
    least, width = (runs & ~_PLACES) | (np.arange(len(runs), dtype=np.uint64) & _PLACES), 1
    while 2 * width <= CUT_WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:windows], least[CUT_WINDOW - width :][:windows])
    whole = np.flatnonzero(text[:windows] == text[CUT_WINDOW + MIN_WORDS - 2 :][:windows])
    # the place modulo the counter's range
    return np.unique(whole + (((least[whole] & _PLACES).astype(np.int64) - whole) & int(_PLACES)))


def paragraphs_in(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and size of each paragraph of at least ``MIN_WORDS`` words."""
    n = len(words.starts)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    line = np.searchsorted(np.flatnonzero(words.data == 10), words.starts)
    new_text, new_line = words.text[1:] != words.text[:-1], line[1:] != line[:-1]
    firsts = np.flatnonzero(np.concatenate([[True], new_text | new_line]))
    long = np.repeat(np.diff(np.append(firsts, n)) >= MIN_WORDS, np.diff(np.append(firsts, n)))
    apart = new_text | (new_line & (long[1:] | long[:-1] | (line[1:] - line[:-1] > 1)))
    firsts = np.flatnonzero(np.concatenate([[True], apart]))
    sizes = np.diff(np.append(firsts, n))
    return firsts[sizes >= MIN_WORDS], sizes[sizes >= MIN_WORDS]


def paragraph_signatures(words: Words, firsts: np.ndarray, sizes: np.ndarray, hasher: MinHasher) -> np.ndarray:
    """The low byte of each MinHash value of each paragraph."""
    if not len(firsts):
        return np.empty((0, len(hasher.scale)), dtype=np.uint8)
    shingles, bounds = shingles_in(words, SHINGLE_WORDS)
    # a paragraph's shingles start at its words but the last four
    counts = sizes - SHINGLE_WORDS + 1
    text = words.text[firsts]
    at = np.repeat(bounds[text] + firsts - words.bounds[text] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    return (hasher.minima(shingles[at], np.cumsum(counts) - counts) >> np.uint64(20)).astype(np.uint8)


def passage_keys(docs: DataFrame) -> DataFrame:
    """key and proof (hashes of the words), sig (null for a sample), start, size in words, again, doc_id, copy.

    ``again`` marks a sample that an earlier place of the same text has; ``copy`` tells
    apart the texts of rows with one doc_id.
    """
    names = ["key", "proof", "sig", "start", "size", "again", "doc_id", "copy"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(BANDS * ROWS, seed=7)

        def rows(words: Words, hashes: tuple[PassageHashes, PassageHashes], ids: np.ndarray, copies: np.ndarray, at: np.ndarray, sizes: np.ndarray, key: np.ndarray, again: np.ndarray, sig: pa.Array) -> pa.RecordBatch:
            proof = (hashes[1].of(at, sizes) >> np.uint64(33)).astype(np.int32)
            text = words.text[at]
            columns = [key.view(np.int64), proof, sig, (at - words.bounds[text]).astype(np.int32), sizes.astype(np.int32), again, ids[text], copies[text]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        for batch in batches:
            for offset, texts in slices(batch.column(1)):
                ids = batch.column(0).slice(offset, len(texts)).to_numpy()
                copies = np.array([copy_of(text.as_buffer()) for text in texts], dtype=np.int64)
                words = words_in(texts)
                hashes = PassageHashes(words.hashes), PassageHashes(words.hashes, 1)
                runs = np.arange(max(0, len(words.hashes) - MIN_WORDS + 1))
                runs = hashes[0].of(runs, MIN_WORDS)
                at = sampled_runs(words.text, runs)
                key, text = runs[at], words.text[at]
                order = np.lexsort((at, key, text))
                again = np.zeros(len(at), dtype=bool)
                again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
                yield rows(words, hashes, ids, copies, at, np.full(len(at), MIN_WORDS), key, again, pa.nulls(len(at), pa.binary()))
                firsts, sizes = paragraphs_in(words)
                sigs = paragraph_signatures(words, firsts, sizes, hasher)
                sig = pa.array([x.tobytes() for x in sigs], pa.binary())
                yield rows(words, hashes, ids, copies, firsts, sizes, hashes[0].of(firsts, sizes), np.zeros(len(firsts), dtype=bool), sig)

    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null and text is not null")
    return texts.mapInArrow(scan, "key long, proof int, sig binary, start int, size int, again boolean, doc_id long, copy long")


def _paragraph_items(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, size and packed words of the paragraphs (rep) listed by doc_id, start and size."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for offset, texts in slices(batch.column(0)):
                words, reps, sizes, items = words_in(texts), [], [], []
                hashes, data = PassageHashes(words.hashes), words.data.tobytes()
                for i, marks in enumerate(batch.column(1).slice(offset, len(texts))):
                    for mark in marks.as_py():
                        first, size = int(words.bounds[i]) + mark["start"], mark["size"]
                        # another text of the same doc_id may hold other words there
                        if first + size <= words.bounds[i + 1] and int(hashes.of(np.array([first]), size).view(np.int64)[0]) == mark["rep"]:
                            reps.append(mark["rep"])
                            sizes.append(size)
                            items.append(packer.compress(data[words.starts[first] : words.ends[first + size - 1]]))
                yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(sizes, pa.int32()), pa.array(items, pa.binary())], names=["rep", "size", "items"])

    marks = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("rep", "start", "size")).alias("marks"))
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null and text is not null")
    texts = filter_rows(texts, 0, bloom_filter(wanted.select("doc_id")))
    return texts.join(marks, "doc_id").select("text", "marks").mapInArrow(cut, "rep long, size int, items binary").dropDuplicates(["rep"])


def _members(keyed: DataFrame, scratch: Scratch) -> DataFrame:
    """key, leader (its least rep) and rep of keys with several reps.

    The count knows both reps of a key with two; only keys with more send their rows again.
    """
    counts = keyed.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = scratch.save("shared", counts.filter("n > 1"))
    pairs = shared.filter("n = 2").select("key", "leader", F.explode(F.array("leader", "last")).alias("rep"))
    more = shared.filter("n > 2").select("key", "leader")
    return pairs.unionByName(filter_rows(keyed, 0, bloom_filter(more.select("key"))).join(more, "key").select("key", "leader", "rep"))


def repeated_passages(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """doc_id, copy, start, size (words) and original (doc_id of the first copy), as a written table.

    Samples of a long passage overlap, and paragraphs may hold them: spans are to be
    joined.  A paragraph is listed if it isn't the first of its component.  Rows with
    one doc_id and different texts are documents of their own, told apart by ``copy``
    (``copy_of`` the text), whose order is theirs.  Null ids and texts take no part; an
    empty table has no passages.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    keys = scratch.save("keys", passage_keys(docs))
    told = keys.filter("sig is null").select("key", "proof", "doc_id", "copy", "start", "again")
    once = told.filter("not again").drop("again")
    # within a text the first place of a sample may still repeat another text's
    counts = once.groupBy("key", "proof").agg(
        F.min("doc_id").alias("original"), F.max("doc_id").alias("last"), F.max_by("start", "doc_id").alias("start"), F.max_by("copy", "doc_id").alias("copy"),
        F.min("copy").alias("least"), F.max("copy").alias("most"), F.count(F.lit(1)).alias("n"),
    )
    repeats = scratch.save("repeats", counts.filter("original <> last or least <> most"))
    span = ["doc_id", "copy", "start", F.lit(MIN_WORDS).alias("size"), "original"]
    # the later of two places is known from the count; only samples of more places, or of one id's texts, are looked up
    pairs = repeats.filter("n = 2 and original <> last").withColumn("doc_id", F.col("last")).select(*span)
    more = repeats.filter("n > 2 or original = last").select("key", "proof", "original")
    placed = filter_rows(once, 0, bloom_filter(more.select("key"))).join(more, ["key", "proof"])
    rest = placed.filter("doc_id <> original").select(*span)
    doubled = keys.groupBy("doc_id").agg(F.min("copy").alias("least"), F.max("copy").alias("most")).filter("least <> most")
    if not doubled.isEmpty():  # of several texts of the first doc_id the first keeps the sample
        own = placed.filter("doc_id = original").select("key", "proof", *span)
        heads = own.groupBy("key", "proof").agg(F.min("copy").alias("head"))
        rest = rest.unionByName(own.join(heads, ["key", "proof"]).filter("copy <> head").select("doc_id", "copy", "start", "size", "original"))
    samples = scratch.save("samples", pairs.unionByName(rest).unionByName(told.filter("again").withColumn("original", F.col("doc_id")).select(*span)))
    scratch.drop("repeats")
    place = F.struct("doc_id", "copy", "start", "size")
    paragraphs = keys.filter("sig is not null").withColumnRenamed("key", "rep")
    classes = paragraphs.groupBy("rep").agg(F.min(F.struct(place.alias("first"), "proof")).alias("head"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("n"))
    classes = scratch.save("classes", classes.select("rep", F.col("head.first").alias("first"), F.col("head.proof").alias("proof"), "sig", "n"))
    bands = F.explode(F.array(*(F.xxhash64(F.lit(b), F.substring("sig", b * ROWS + 1, ROWS)) for b in range(BANDS))))
    # the samples and signatures, most of the keys' table, aren't read any more
    paragraphs = scratch.save("paragraphs", paragraphs.select("rep", "proof", "doc_id", "copy", "start", "size"))
    scratch.drop("keys")
    members = scratch.save("members", _members(classes.select(bands.alias("key"), "rep"), scratch))
    scratch.drop("shared")
    places = classes.select("rep", "first.*")
    joined = link_members(members, classes.select("rep", "sig"), lambda ends: _paragraph_items(docs, places.join(ends, "rep", "left_semi")), percent, SHINGLE_WORDS, scratch, positions=BANDS * ROWS)
    grouped = classes.select("rep", "first", "proof", "n").join(joined.withColumnRenamed("node", "rep"), "rep", "left").filter("n > 1 or component is not null")
    grouped = scratch.save("grouped", grouped.select("rep", "first", "proof", F.coalesce("component", "rep").alias("component")))
    keeper = grouped.groupBy("component").agg(F.min("first").alias("keeper"))
    # a paragraph that shares its class' hash but not the proof stays
    repeated = paragraphs.join(grouped.join(keeper, "component").select("rep", "proof", "keeper"), ["rep", "proof"])
    repeated = repeated.filter((F.col("doc_id") != F.col("keeper.doc_id")) | (F.col("copy") != F.col("keeper.copy")) | (F.col("start") != F.col("keeper.start")))
    found = scratch.save("found", samples.unionByName(repeated.select("doc_id", "copy", "start", "size", F.col("keeper.doc_id").alias("original"))))
    scratch.keep("found")
    return found


def removed_ranges(spans: list[dict]) -> list[tuple[int, int]]:
    """The word ranges that the spans cover together."""
    merged: list[list[int]] = []
    for start, size in sorted((x["start"], x["size"]) for x in spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], start + size)
        else:
            merged.append([start, start + size])
    return [(a, b) for a, b in merged]


def cut_text(text: str | None, spans: list[dict]) -> tuple[str | None, int, int, int, list[int]]:
    """What is left of a text, its words, those removed, the gaps, and their originals."""
    if text is None:
        return None, 0, 0, 0, []
    data = text.encode("utf-8", "surrogatepass")
    own = copy_of(data) if spans else 0
    spans = [x for x in spans if x["copy"] == own]
    if not spans:
        return text, len(data.split()), 0, 0, []
    starts, ends = word_spans(data)
    ranges = removed_ranges(spans)
    kept, at = [], 0
    for a, b in ranges:
        kept.append(data[at : starts[a]])
        at = int(ends[b - 1])
    kept.append(data[at:])
    used = {x["original"] for x in spans}
    return b"".join(kept).decode("utf-8", "surrogatepass"), len(starts), sum(b - a for a, b in ranges), len(ranges), sorted(used)


def _spans_by_document(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id and its spans, which are no more than its own texts have places for."""
    spans = repeated_passages(docs, percent).groupBy("doc_id").agg(F.collect_list(F.struct("copy", "start", "size", "original")).alias("spans"))
    return Scratch(docs.sparkSession, "spans").save("spans", spans)


def remove_repeats(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """Every document without the passages that an earlier place already holds.

    Args:
        docs: doc_id and text; other columns are ignored.
        percent: least similarity of near-duplicate paragraphs, in per cent.

    Returns a row per input row: doc_id, text (what is left; the words around a gap
    keep the white space before it), n_words, n_removed (words), n_spans, originals
    (sorted doc_ids whose passages were repeated).  Earlier means a smaller doc_id,
    or the same document, earlier start.  Null texts stay null with no words; long
    ones are read whole.  Of equal passages in one document the first counts as the
    earlier.  Equal rows count as one document; rows with one doc_id and different
    texts are documents of their own, each cut by its own words, and of them that with
    the smaller hash of its text is the earlier.  A null doc_id takes no part.  An
    empty table gives no rows.
    """

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [cut_text(text.as_py(), spans.as_py() or []) for text, spans in zip(batch.column(1), batch.column(2))]
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        names = ["doc_id", "text", "n_words", "n_removed", "n_spans", "originals"]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 5, types))], names=names)

    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return change_with_few(texts, "doc_id", _spans_by_document(docs, percent), cut, "doc_id long, text string, n_words long, n_removed long, n_spans long, originals array<long>")


def without_repeats(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """``docs``, all columns, with repeats cut from text and n_chars brought up to date.

    Documents of which nothing is left go; those without words before stay, as do
    null texts and rows with a null doc_id.  n_chars may be absent; other columns
    may have any names, also ones that differ from these only in case.  An empty
    table stays empty.
    """
    columns = docs.columns
    at, size = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        arrays, texts, keep = list(batch.columns[:-1]), [], []
        sizes = arrays[size].to_pylist() if size is not None else [None] * batch.num_rows
        for i, (text, spans) in enumerate(zip(batch.column(at), batch.columns[-1])):
            left, n, removed, _, _ = cut_text(text.as_py(), spans.as_py() or [])
            if removed:
                sizes[i] = len(left)
            texts.append(left)
            keep.append(not removed or removed < n)
        arrays[at] = pa.array(texts, arrays[at].type)
        if size is not None:
            arrays[size] = pa.array(sizes, arrays[size].type)
        return pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep, pa.bool_()))

    return change_with_few(docs, "doc_id", _spans_by_document(docs, percent), cut, docs.schema)
