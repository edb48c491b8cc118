"""Toxic passages by maximum-scoring segments over token log-odds.

Forms of a token are the word and its beginnings of ``PREFIXES`` letters, for words
that inflect.  A form's weight is its log-odds of standing in a toxic against a clean
labelled text, smoothed by a Dirichlet prior in proportion to the form's count in the
whole corpus; only weights at least ``LEAST_Z`` standard errors from zero count, and a
token has that of its surest form.  Every other token costs a drift, set from the
corpus so that a random token's expected score is as far below zero as the toxic
weights alone lift it.  A word that a text holds again weighs its k-th part the k-th
time, since weights tell whether a text holds a form, not how often.  One linear scan
finds all maximal segments of a text.  By extreme-value theory n random tokens have
``often * n * exp(-rate * S)`` segments of score S or more, so a segment exceeds chance
by ``rate * S - log(often * (n + LEAST_TOKENS))``; the rate solves
E[exp(rate * score)] = 1 over the corpus' tokens, and ``often`` comes from clean
labelled texts.  Segments above chance are passages; their sum and number, the best
one, and how all segments' sum compares with that of a clean text of the length go into
a logistic calibration.  It and the clean texts' figures are fitted on labelled texts
that the weights haven't seen.

Counts of words over the corpus stay a distributed table, which is joined with the
labelled forms; only weights that count come to the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pick, text_or_empty

#: Labelled documents that the classifier is fitted on, about so many at most, those with the least id hashes.
MAX_LABELLED = 200_000
FOLDS, HELD_OUT_FOLD, WEIGHT_FOLD = 3, 1, 0
LEAST_COUNT, LEAST_Z = 3, 2.5
#: Prior texts of every form, and further ones that are dealt by corpus frequency.
PRIOR_EACH, PRIOR = 0.5, 50.0
PREFIXES = (5, 7)
#: Words whose forms a task remembers; longer words aren't remembered, and counted by a digest.
CACHE_WORDS, LONG_WORD = 100_000, 64
#: What a token without a weight costs at least.
LEAST_DRIFT = 0.05
THRESHOLD = 0.7
#: Added to a text's tokens, so that a short text's segments aren't significant by its shortness.
LEAST_TOKENS = 100
#: Segments with at most this chance of standing in random text are passages.
SIGNIFICANCE = 0.05
#: Segments that clean texts are taken to have beyond those met, so that few texts don't make any segment rare.
PRIOR_SEGMENTS = 10
#: The best segment's score above chance counts up to here.
MOST_EXCESS = 15.0
_TOKEN = re.compile(r"\w+")
#: A task hands on its counts beyond so many words.
_FLUSH = 150_000


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def name_of(word: str) -> str:
    """The word; of a long one its beginning and a digest, from which the same beginnings come."""
    return word if len(word) <= LONG_WORD else f"{word[:8]}#{xxhash.xxh3_128_hexdigest(word.encode('utf-8', 'surrogatepass'))}"


def forms_of(word: str) -> tuple[str, ...]:
    """A word and its beginnings."""
    word = name_of(word)
    return (word, *(f"{word[:k]}~" for k in PREFIXES if len(word) > k))


def form_columns(word: Column) -> Column:
    """``forms_of`` a column of names."""
    forms = [word, *(F.when(F.length(word) > k, F.concat(F.substring(word, 1, k), F.lit("~"))) for k in PREFIXES)]
    return F.array_compact(F.array(*forms))


class FormCache(dict):
    """What ``make`` gives for a word's forms, remembered for a bounded number of words."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self.make(forms_of(word))
        if len(word) <= LONG_WORD:
            self[word] = value
        return value


def maximal_segments(scores: list[tuple[int, float]], drift: float, n: int) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of a sparse score sequence.

    ``scores`` holds the places that differ from ``drift`` (negative).  Each candidate
    keeps the running total before and after it, and joins earlier candidates while
    they start lower and end lower.  It also keeps which candidate before it starts
    lower, so that those in between are never looked at again: the scan is linear.
    """
    found: list[tuple[int, int, float, float, int]] = []  # start, end, total before, total after, the last that starts lower
    total, at = 0.0, 0
    for place, score in scores:
        total += (place - at) * drift
        before, total, at = total, total + score, place + 1
        if score <= 0:
            continue
        start, low, high = place, before, total
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= low:
                k = found[k][4]
            if k < 0 or found[k][3] >= high:
                found.append((start, at, low, high, k))
                break
            start, low = found[k][0], found[k][2]
            del found[k:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


@dataclass(frozen=True)
class ToxicityModel:
    """Weights and standard scores of forms, the extreme-value rate, the calibration."""

    weights: dict[str, tuple[float, float]]
    rate: float = 1.0
    drift: float = -LEAST_DRIFT
    often: float = 1.0
    usual: float = 0.0  # what a clean text's segments score together for each token
    centre: tuple[float, ...] = ()
    spread: tuple[float, ...] = ()
    slope: tuple[float, ...] = ()
    base: float = -20.0

    def weight_of(self, forms: tuple[str, ...]) -> float:
        """The weight of the surest form; 0 without one."""
        return max((self.weights[f] for f in forms if f in self.weights), key=lambda x: abs(x[1]), default=(0.0, 0.0))[0]

    def segments(self, text: str, cache: FormCache | None = None) -> tuple[int, list[tuple[int, int, float]]]:
        """Token count, and each maximal segment as first token, end, score."""
        tokens, scores, times = tokens_of(text), [], Counter()
        cache = FormCache(self.weight_of) if cache is None else cache
        for i, token in enumerate(tokens):
            weight = cache[token]
            if weight:
                times[token] += 1
                scores.append((i, weight / times[token]))
        return len(tokens), maximal_segments(scores, self.drift, len(tokens))

    def chance(self, n: int) -> float:
        return math.log(self.often * (n + LEAST_TOKENS))

    def passages(self, text: str, cache: FormCache | None = None) -> list[tuple[int, int, float]]:
        """First token, end and score above chance of the significant segments."""
        n, found = self.segments(text, cache)
        scored = [(a, b, self.rate * x - self.chance(n)) for a, b, x in found]
        return [x for x in scored if x[2] >= -math.log(SIGNIFICANCE)]

    def features(self, text: str, cache: FormCache | None = None) -> list[float]:
        return self.features_of(*self.segments(text, cache))

    def features_of(self, n: int, found: list[tuple[int, int, float]]) -> list[float]:
        total, chance = sum(x for _, _, x in found), self.chance(n)
        excess = [self.rate * x - chance for _, _, x in found]
        above = [x for x in excess if x >= -math.log(SIGNIFICANCE)]
        best = min(MOST_EXCESS, max(excess, default=-chance))
        return [best, math.log1p(sum(above)), math.log1p(len(above)), math.log((total + 1) / (self.usual * (n + LEAST_TOKENS) + 1))]

    def scores(self, rows: list[list[float]]) -> np.ndarray:
        x = np.asarray(rows, dtype=float).reshape(len(rows), -1)
        z = np.full(len(rows), self.base)
        if self.slope and len(rows):
            z = self.base + ((x - np.asarray(self.centre)) / np.asarray(self.spread)) @ np.asarray(self.slope)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def drift_of(counts: dict[float, int]) -> float:
    """What a token without a weight adds, from the corpus' counts of token weights.

    The expected score is then minus the toxic weights' share of it, so never positive.
    """
    total, plain = sum(counts.values()), counts.get(0.0, 0)
    gain = sum(n * x for x, n in counts.items() if x > 0)
    loss = -sum(n * x for x, n in counts.items() if x < 0)
    return -max(LEAST_DRIFT, (2 * gain - loss) / plain) if total and plain else -LEAST_DRIFT


def extreme_rate(counts: dict[float, int], drift: float) -> float:
    """The positive root of E[exp(rate * score)] = 1 over the corpus tokens.

    Without a positive score, or where the mean isn't negative (a corpus with hardly
    a token without a weight), there is none and the rate is 1.
    """
    score = np.array([x or drift for x in counts], dtype=float)
    p = np.array(list(counts.values()), dtype=float)
    if not p.sum() or score.max() <= 0 or (p * score).sum() >= 0:
        return 1.0
    p /= p.sum()
    low, high = 0.0, 50.0 / score.max()
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * score)).sum() < 1 else (low, mid)
    return low


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Centre, spread, slope and base of a ridge logistic regression."""
    centre, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - centre) / spread])
    beta = np.zeros(z.shape[1])
    penalty = np.full(len(beta), ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve(z.T @ (z * w[:, None]) + np.diag(penalty), z.T @ (y - p) - penalty * beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return centre, spread, beta[1:], float(beta[0])


# Spark -----------------------------------------------------------------------


def fold_of(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS, F.lit(-1))


def _counts(rows: DataFrame, by_text: bool) -> DataFrame:
    """token, n0 and n1: by label (0 or 1) the texts that hold a form, or the occurrences of a word.

    By text the empty form counts all texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {}

        def out() -> pa.RecordBatch:
            flat = [(label, token, n) for label, c in held.items() for token, n in c.items()]
            held.clear()
            types = (pa.int32(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*flat)) or [[]] * 3, types)], names=["label", "token", "n"])

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                tokens = tokens_of(text.as_py())
                counter = held.setdefault(label, Counter())
                if by_text:
                    counter[""] += 1
                    counter.update({f for t in set(tokens) for f in forms_of(t)})
                else:
                    counter.update(tokens if max(map(len, tokens), default=0) <= LONG_WORD else map(name_of, tokens))
                if len(counter) > _FLUSH:
                    yield out()
        yield out()

    counted = rows.select("text", "label").mapInArrow(count, "label int, token string, n long")
    return counted.groupBy("token").agg(*(F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, label and fold of labelled documents outside the held-out fold.

    A document with several labels has the highest; null ones don't count.  Of more
    than ``MAX_LABELLED`` that share of the id hashes stays.
    """
    known = pick(labels, "doc_id", "toxic").filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    known = known.withColumn("fold", fold_of()).filter(F.col("fold") != HELD_OUT_FOLD)
    n = known.count()
    if n > MAX_LABELLED:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(MAX_LABELLED / n * 2**30))
    # about MAX_LABELLED rows of three numbers
    known = known.withColumn("label", (F.col("label") > 0).cast("int"))
    return pick(docs, "doc_id", "text").select("doc_id", text_or_empty().alias("text")).join(F.broadcast(known), "doc_id")


def form_weights(seen: DataFrame, words: DataFrame, n_clean: int, n_toxic: int) -> DataFrame:
    """token, odds and z of the labelled forms (token, n0, n1) that are sure enough.

    words: token and n0, every word of the corpus and how often it stands there.
    """
    total = words.agg(F.sum("n0")).first()[0] or 0
    corpus = words.select(F.explode(form_columns(F.col("token"))).alias("token"), "n0").groupBy("token").agg(F.sum("n0").alias("n"))
    rows = seen.filter(f"token <> '' and n0 + n1 >= {LEAST_COUNT}").join(corpus, "token", "left")
    prior = PRIOR_EACH + PRIOR * F.coalesce("n", F.lit(0)) / max(total, 1)
    rows = rows.withColumn("prior", prior).withColumn("a", F.col("n1") + F.col("prior")).withColumn("b", F.col("n0") + F.col("prior"))
    share = lambda x, n: F.log(F.col(x) / (n + 2 * F.col("prior") - F.col(x)))
    rows = rows.withColumn("odds", share("a", n_toxic) - share("b", n_clean)).withColumn("z", F.col("odds") / F.sqrt(1 / F.col("a") + 1 / F.col("b")))
    return rows.filter(F.abs("z") >= LEAST_Z).select("token", "odds", "z")


def token_weights(words: DataFrame, model: ToxicityModel) -> dict[float, int]:
    """How many tokens of the corpus have each weight; 0 is that of tokens without one."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[model.weight_of(forms_of(word))] += n
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.float64()), pa.array(held.values(), pa.int64())], names=["weight", "n"])

    return {r["weight"]: r["n"] for r in words.select("token", "n0").mapInArrow(weigh, "weight double, n long").groupBy("weight").agg(F.sum("n").alias("n")).collect()}


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """The model of the labelled documents; without labels of both kinds it calls nothing toxic.

    Null texts count as empty; labels of no document, null labels and null ids are left out.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = labelled_sample(docs, labels)
    seen = scratch.save("seen", _counts(sample.filter(F.col("fold") == WEIGHT_FOLD), True))
    n = seen.filter("token = ''").agg(F.sum("n0"), F.sum("n1")).first()
    if not n[0] or not n[1]:
        scratch.keep()
        return ToxicityModel({})
    every = pick(docs, "text").select(text_or_empty().alias("text"), F.lit(0).alias("label"))
    words = scratch.save("words", _counts(every, False))
    model = ToxicityModel({r["token"]: (r["odds"], r["z"]) for r in form_weights(seen, words, *n).collect()})
    counts = token_weights(words, model)
    drift = drift_of(counts)
    model = replace(model, drift=drift, rate=extreme_rate(counts, drift))
    scratch.keep()

    rest = sample.filter(F.col("fold") != WEIGHT_FOLD).select("text", "label")
    n, total, over = _segment_sums(rest.filter("label = 0"), model)
    model = replace(model, often=math.e * (over + PRIOR_SEGMENTS) / max(n, 1), usual=total / max(n, 1))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = FormCache(model.weight_of)
        for batch in batches:
            rows = [model.features(x.as_py(), cache) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])

    rest = rest.mapInArrow(measure, "label int, x array<double>").toArrow()
    y = rest.column(0).to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return model
    x = rest.column(1).combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    centre, spread, slope, base = calibrate(x, y)
    return replace(model, centre=tuple(centre), spread=tuple(spread), slope=tuple(slope), base=base)


def _segment_sums(rows: DataFrame, model: ToxicityModel) -> tuple[int, float, int]:
    """Tokens, summed segment scores, and segments of score 1 / rate or more, of all texts."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, n, total, over = FormCache(model.weight_of), 0, 0.0, 0
        for batch in batches:
            for text in batch.column(0):
                size, found = model.segments(text.as_py(), cache)
                n, total, over = n + size, total + sum(x for _, _, x in found), over + sum(model.rate * x >= 1 for _, _, x in found)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (n, total, over)], names=["n", "total", "over"])

    found = rows.mapInArrow(sums, "n long, total double, over long").agg(F.sum("n"), F.sum("total"), F.sum("over")).first()
    return tuple(x or 0 for x in found)


def score_documents(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and n_passages for every row.

    Null texts score as empty ones; a null doc_id is not held out; repeated rows each
    get their score; an empty table gives no rows.
    """
    least = -math.log(SIGNIFICANCE)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = FormCache(model.weight_of)
        for batch in batches:
            found = [model.segments(x.as_py(), cache) for x in batch.column(2)]
            scores = model.scores([model.features_of(*x) for x in found])
            passages = [sum(model.rate * x - model.chance(n) >= least for _, _, x in segments) for n, segments in found]
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32)), pa.array(passages, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", "n_passages"])

    rows = pick(docs, "doc_id", "text").select("doc_id", (fold_of() == HELD_OUT_FOLD).alias("held_out"), text_or_empty().alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, n_passages long")


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, all columns under any names, without the rows that the model rejects.

    Null and empty texts score alike, and as any text without a toxic word; repeated
    rows share their fate; an empty table stays empty.
    """
    at = docs.columns.index("text")

    def verdict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = FormCache(model.weight_of)
        for batch in batches:
            scores = model.scores([model.features(x.as_py() or "", cache) for x in batch.column(at)])
            yield batch.filter(pa.array(scores < threshold, pa.bool_()))

    return docs.mapInArrow(verdict, docs.schema)
