"""Collocations: phrases that stand together more often than their parts would by chance.

Words that occur often enough in their language are the dictionary; every other word
breaks its piece, as punctuation does, since no phrase that counts can hold it.  A
dictionary word is a number, a phrase of k words a binary key of k numbers in big-endian
order, so that keys sort like numbers.  Each task radix-sorts the keys of its texts and
counts runs of equal ones; what is left is partitioned by ranges of keys, sorted, and
its runs are counted again across tasks.

Longer phrases are counted only where both shorter ones inside them may have counted: a
Bloom filter of bounded size tells, and one that lets more through only costs time.

The dictionary is sent to the tasks as sorted hashes while it has ``MOST_WORDS`` words at
most (32 MB).  Beyond that nothing is looked up: words go by their 64-bit hashes, keys
are twice as wide, and a Bloom filter breaks the pieces.  Either way no two words of a
corpus may share a hash; that is checked over all words, and another seed is taken if
two do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, bloom_filter, maybe_in, pick, tasks_for, text_or_empty
from .words import mix, slices, word_hashes

LEAST, LONGEST, MOST = 100, 5, 2000
#: Words of a dictionary that is sent to the tasks.
MOST_WORDS = 1 << 22
#: Numbers in a row of encoded text, and keys or words that a task counts at once.
ROW_WORDS, HELD = 1 << 20, 1 << 18
UNKNOWN = "und"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def words_of_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, start and end of each word, its text, and whether it begins a piece."""
    texts = texts.cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, n = int(offsets[0]), int(offsets[-1] - offsets[0])
    data = _LOWER[np.frombuffer(values, dtype=np.uint8)[low : low + n]] if n else np.empty(0, np.uint8)
    offsets = offsets - low
    inside = ~_GAP[data]
    first, last = inside.copy(), np.concatenate([[False], inside])
    first[1:] &= ~inside[:-1]
    last[1:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = inside[cuts]
    last[cuts] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
    piece = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)
    begins = np.ones(len(starts), dtype=bool)
    begins[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    return data, starts, ends, text, begins


def _lang_seeds(langs: pa.Array, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(lang.as_py().encode(), seed=seed) for lang in langs], dtype=np.uint64)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A hash of each word and its language; 0 is kept for breaks."""
    codes = mix(word_hashes(data, starts, ends) ^ seeds)
    codes[codes == 0] = 1
    return codes


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """code, lang, word and n from each task; a null word counts all of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["code", "lang", "word", "n"]
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by(["code", "lang", "word"]).aggregate([("n", "sum")]).rename_columns(names)

        for batch in batches:
            for offset, part in slices(batch.column(1)):
                data, starts, ends, text, _ = words_of_pieces(part)
                langs = batch.column(0).slice(offset, len(part)).dictionary_encode()
                kind, seeds = langs.indices.to_numpy(), _lang_seeds(langs.dictionary, seed)
                codes = word_codes(data, starts, ends, seeds[kind[text]])
                _, first, n = np.unique(codes, return_index=True, return_counts=True)
                sizes = (ends - starts)[first]
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                at = np.arange(bounds[-1]) + np.repeat(starts[first] - bounds[:-1], sizes)
                word = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[at].tobytes())])
                lang = langs.dictionary.take(pa.array(kind[text[first]]))
                held.append(pa.table([pa.array(codes[first].view(np.int64)), lang, word.cast(pa.binary()), pa.array(n)], names=names))
                all_n = np.bincount(kind[text], minlength=len(seeds))
                held.append(pa.table([pa.array(seeds.view(np.int64)), langs.dictionary, pa.nulls(len(seeds), pa.binary()), pa.array(all_n)], names=names))
            if sum(t.num_rows for t in held) > HELD:
                held = [merged()]
                if held[0].num_rows > HELD // 2:
                    yield from held.pop().combine_chunks().to_batches(max_chunksize=1 << 17)
        if held:
            yield from merged().combine_chunks().to_batches(max_chunksize=1 << 17)

    return texts.mapInArrow(count, "code long, lang string, word binary, n long")


def frequent_words(texts: DataFrame, least: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """code, lang, word (null: the whole language) and f of what occurs at least so often, and the hashes' seed."""
    for seed in range(100):
        by_code = Window.partitionBy("code")
        counted = word_counts(texts, seed).repartition("code").groupBy("code", "lang", "word").agg(F.sum("n").alias("f"))
        counted = counted.withColumn("sharing", F.count("word").over(by_code)).withColumn("whole", F.sum("f").over(by_code)).filter(F.col("whole") >= least)
        words = scratch.save(f"words{seed}", counted.select("code", "lang", "word", "f", "sharing"))
        if words.filter("sharing > 1").isEmpty():
            return words.drop("sharing"), seed
        scratch.drop(f"words{seed}")
    raise RuntimeError("no seed tells all words apart")


class Coder:
    """Numbers of dictionary words, by their hashes; 0 is no word of it."""

    def __init__(self, words: DataFrame, most: int):
        codes = words.filter("word is not null").select("code")
        self.sorted: np.ndarray | None = None
        if codes.count() <= most:
            self.sorted = np.sort(codes.toArrow().column("code").to_numpy().view(np.uint64))
            self.type = np.dtype(">u4")
        else:
            self.bits, self.type = bloom_filter(codes), np.dtype(">u8")

    @property
    def width(self) -> int:
        return self.type.itemsize

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        if self.sorted is None:
            return np.where(maybe_in(self.bits, pa.array(codes.view(np.int64))), codes, np.uint64(0))
        if not len(self.sorted):
            return np.zeros(len(codes), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.sorted, codes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == codes, at + 1, 0).astype(np.uint32)


def encoded_texts(texts: DataFrame, coder: Coder, seed: int, longest: int) -> DataFrame:
    """own and ids: numbers of words with 0 between pieces; phrases begin at the first ``own``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offset, part in slices(batch.column(1)):
                data, starts, ends, text, begins = words_of_pieces(part)
                langs = batch.column(0).slice(offset, len(part)).dictionary_encode()
                seeds = _lang_seeds(langs.dictionary, seed)[langs.indices.to_numpy()[text]]
                ids = coder.numbers(word_codes(data, starts, ends, seeds))
                row = np.insert(ids, np.flatnonzero(begins), 0)
                keep = row != 0
                keep[1:] |= row[:-1] != 0  # one break is as good as many
                row = row[keep].astype(coder.type)
                own, held = [], []
                for a in range(0, len(row), ROW_WORDS):
                    own.append(min(ROW_WORDS, len(row) - a))
                    held.append(row[a : a + ROW_WORDS + longest - 1].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(held, pa.binary())], names=["own", "ids"])

    return texts.mapInArrow(encode, "own int, ids binary")


def radix_order(rows: np.ndarray) -> np.ndarray:
    """The order of rows of numbers, by stable counting of 16 bits at a time from the last."""
    order = np.arange(len(rows))
    for column in range(rows.shape[1] - 1, -1, -1):
        values = rows[:, column].astype(np.uint64)
        most = int(values.max()) if len(values) else 0
        for shift in range(0, max(1, most.bit_length()), 16):
            digit = ((values >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            order = order[np.argsort(digit[order], kind="stable")]  # of 16 bits numpy's stable sort is a radix sort
    return order


def run_lengths(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted rows and the sums of their counts."""
    if not len(rows):
        return rows, counts
    order = radix_order(rows)
    rows, counts = rows[order], counts[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    return rows[new], np.add.reduceat(counts, np.flatnonzero(new))


def gram_hashes(places: np.ndarray | list[np.ndarray]) -> np.ndarray:
    """A hash of each phrase, given its first numbers, its second ones, and so on."""
    total = np.full(len(places[0]), len(places), dtype=np.uint64)
    for ids in places:
        total = mix(total * _ODD[0] + ids.astype(np.uint64) * _ODD[1])
    return total


def task_counts(encoded: DataFrame, k: int, coder: Coder, shorter: np.ndarray | None) -> DataFrame:
    """key and n of the phrases of k words that each task meets, sorted within a batch."""
    kind = coder.type

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        native = kind.newbyteorder("=")
        none = np.empty((0, k), native)
        rows, counts = [none], [np.empty(0, np.int64)]

        def out(rows: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(rows), 1 << 17):
                part = rows[a : a + (1 << 17)].astype(kind)  # numbers are native until here
                keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(k * kind.itemsize), len(part), [None, pa.py_buffer(part.tobytes())])
                yield pa.RecordBatch.from_arrays([keys.cast(pa.binary()), pa.array(counts[a : a + (1 << 17)])], names=["key", "n"])

        for batch in batches:
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(ids.as_buffer(), dtype=kind).astype(native)
                n = min(own, len(ids) - k + 1)
                if n <= 0:
                    continue
                whole = ids[:n] != 0
                for i in range(1, k):
                    whole &= ids[i : n + i] != 0
                if shorter is not None:
                    known = maybe_in(shorter, pa.array(gram_hashes([ids[i : n + 1 + i] for i in range(k - 1)]).view(np.int64)))
                    whole &= known[:n] & known[1 : n + 1]
                at = np.flatnonzero(whole)
                rows.append(np.stack([ids[at + i] for i in range(k)], axis=1) if len(at) else none)
                counts.append(np.ones(len(at), np.int64))
                if sum(map(len, rows)) > HELD:
                    merged, sums = run_lengths(np.concatenate(rows), np.concatenate(counts))
                    rows, counts = [merged], [sums]
                    if len(merged) > HELD // 2:
                        yield from out(merged, sums)
                        rows, counts = [none], [np.empty(0, np.int64)]
        yield from out(*run_lengths(np.concatenate(rows), np.concatenate(counts)))

    return encoded.mapInArrow(count, "key binary, n long")


def counted_runs(partial: DataFrame, least: int, k: int, coder: Coder, tasks: int) -> DataFrame:
    """key, f and hash of all phrases that occur ``least`` times, from range-partitioned, sorted keys."""
    kind, width = coder.type, k * coder.width

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = b"", 0

        def out(keys: list[bytes], sums: list[int]) -> pa.RecordBatch:
            kept = [(key, n) for key, n in zip(keys, sums) if n >= least]
            ids = np.frombuffer(b"".join(key for key, _ in kept), dtype=kind).reshape(-1, k)
            columns = [pa.array([key for key, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64()), pa.array(gram_hashes(ids.T).view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["key", "f", "hash"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, n = batch.column(0), batch.column(1).to_numpy()
            start = int(np.frombuffer(keys.buffers()[1], dtype=np.int32)[keys.offset])
            rows = np.frombuffer(keys.buffers()[2], dtype=np.uint8)[start : start + width * len(keys)].reshape(-1, width)
            heads = np.concatenate([[0], np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1])
            sums = np.add.reduceat(n, heads)
            if key == rows[0].tobytes():
                sums[0] += total
            elif total >= least:
                yield out([key], [total])
            key, total = rows[heads[-1]].tobytes(), int(sums[-1])
            often = np.flatnonzero(sums[:-1] >= least)
            yield out([rows[heads[i]].tobytes() for i in often], sums[often].tolist())
        if total:
            yield out([key], [total])

    ordered = partial.repartitionByRange(tasks, "key").sortWithinPartitions("key")
    return ordered.mapInArrow(count, "key binary, f long, hash long")


def _keyed(words: DataFrame, coder: Coder) -> DataFrame:
    """The dictionary by key: key, lang, word, f."""
    kind, numbers = coder.type, coder.numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = numbers(batch.column(0).to_numpy().view(np.uint64)).astype(kind).tobytes()
            keys = [ids[a : a + kind.itemsize] for a in range(0, len(ids), kind.itemsize)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *batch.columns[1:]], names=["key", "lang", "word", "f"])

    return words.filter("word is not null").mapInArrow(run, "key binary, lang string, word binary, f long")


def _first(rows: DataFrame, most: int, rank: Callable, *order) -> DataFrame:
    """The first ``most`` of each language, found among those of each deal."""
    deals = F.pmod(F.xxhash64("key"), F.lit(tasks_for(rows.sparkSession)))
    return rows.withColumn("deal", deals).withColumn("nth", rank().over(Window.partitionBy("lang", "deal").orderBy(*order))).filter(F.col("nth") <= most).drop("deal", "nth")


def find_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST, percent: int = 100, most_words: int = MOST_WORDS) -> DataFrame:
    """The strongest collocations of every language.

    Args:
        docs: text and lang; other columns are ignored.
        least: occurrences that a phrase needs.
        longest: words of the longest phrases.
        most: phrases of a language in the result.
        percent: a phrase goes if one longer by some words occurs so often, in per cent of it.
        most_words: words of a dictionary that is sent to the tasks.

    Returns lang, rank, phrase, a (its occurrences), l and r (those of the two parts of
    its weakest cut), n (words of the language) and score, floor(1000 * a * n / (l * r)).
    Null texts are empty, a null lang is ``und``; repeated rows count each time; equal
    scores stand by a, then by the phrase's bytes; an empty table gives no rows.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "phrases")
    texts = pick(docs, "lang", "text").select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text_or_empty(F.col("text").cast("string")).alias("text"))
    words, seed = frequent_words(texts, least, scratch)
    coder, tasks = Coder(words, most_words), tasks_for(spark)
    width = coder.width
    encoded = scratch.save("encoded", encoded_texts(texts, coder, seed, longest))
    dictionary = scratch.save("dictionary", _keyed(words, coder))
    grams, shorter = [], None
    for k in range(2, longest + 1):
        partial = scratch.save("partial", task_counts(encoded, k, coder, shorter))
        grams.append(scratch.save(f"grams{k}", counted_runs(partial, least, k, coder, tasks)))
        scratch.drop("partial")
        shorter = bloom_filter(grams[-1].select("hash")) if k < longest else None
    scratch.drop("encoded")
    candidates = grams[0]
    for more in grams[1:]:
        candidates = candidates.unionByName(more)
    counts = dictionary.select("key", "f", "lang").unionByName(candidates.select("key", "f", F.lit(None).cast("string").alias("lang")))
    size = F.octet_length("key") / width
    cuts = candidates.select("key", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size.cast("int") - 1)).alias("cut"))
    cuts = cuts.withColumn("left", F.expr(f"substring(key, 1, cut * {width})")).withColumn("right", F.expr(f"substring(key, cut * {width} + 1)"))
    cuts = cuts.join(counts.select(F.col("key").alias("left"), F.col("f").alias("l"), "lang"), "left").join(counts.select(F.col("key").alias("right"), F.col("f").alias("r")), "right")
    rows = cuts.groupBy("key", "a").agg(F.max("lang").alias("lang"), F.collect_list(F.struct("cut", "l", "r")).alias("cuts"))
    longer = candidates.filter(F.octet_length("key") > 2 * width)
    inside = F.array(F.expr(f"substring(key, 1, octet_length(key) - {width})"), F.expr(f"substring(key, {width + 1})"))
    # what holds a phrase so often holds the one in between as often
    held = longer.select(F.explode(inside).alias("key"), "f").groupBy("key").agg(F.max("f").alias("most"))
    rows = rows.join(held, "key", "left").filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * percent)).drop("most")
    totals = words.filter("word is null").select("lang", F.col("f").alias("n"))
    rows = rows.join(totals, "lang")
    whole = lambda name: f"cast({name} as decimal(16, 0))"
    # exact: the product has 37 digits at most, the quotient no more than 10 n
    score = f"(cast(1000 as decimal(4, 0)) * {whole('a')} * {whole('n')}) div ({whole('c.l')} * {whole('c.r')})"
    rows = rows.withColumn("cut", F.expr(f"array_min(transform(cuts, c -> struct({score} as score, c.cut as cut, c.l as l, c.r as r)))"))
    rows = rows.select("key", "lang", "a", "cut.l", "cut.r", "n", "cut.score")
    strongest = scratch.save("strongest", _first(rows, most, F.rank, F.desc("score"), F.desc("a")))
    ids = strongest.select("key", F.explode(F.sequence(F.lit(1), size.cast("int"))).alias("place")).withColumn("id", F.expr(f"substring(key, (place - 1) * {width} + 1, {width})"))
    spelled = ids.join(dictionary.select(F.col("key").alias("id"), "word"), "id").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
    phrase = F.array_join(F.transform("words", lambda w: w["word"].cast("string")), " ")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    named = _first(strongest.join(spelled.select("key", phrase.alias("phrase")), "key"), most, F.row_number, *order)
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= most)
    scratch.keep("strongest", "dictionary")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
