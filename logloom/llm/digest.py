"""Similarity digests of documents from improbable byte windows.

Every window of ``WINDOW`` bytes has an entropy, scaled to 0..``SCALE``.  Its rank is
how common that entropy is among all windows of the corpus, rarest first; nearly
constant windows are no features.  In each run of ``RUN`` windows the least rank wins
(the leftmost of equals); windows that win ``LEAST_WINS`` runs are features.  A
feature sets ``BITS_EACH`` bits of a Bloom filter; after ``PER_FILTER`` features the
next filter of the chain is filled.  Digests compare by the bits that two filters
share beyond chance, each filter of the shorter chain with its best match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pick, tasks_for, text_or_empty
from .words import mix

WINDOW, RUN, LEAST_WINS = 32, 32, 8
SCALE, LEAST_ENTROPY = 1000, 100
FILTER_BITS, BITS_EACH, PER_FILTER = 2048, 5, 160
#: Rows of one range partition on average, and partitions at most unless the session asks for more.
PART_ROWS, MAX_PARTS = 4096, 10_000
BUFFER_BYTES = 1 << 18
_NO_RANK = np.uint32(SCALE + 1)
#: c * log2(c) in fixed point, so that sliding sums are exact.
_UNIT = 1 << 20
_TERM = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 2)], dtype=np.int32)


def window_entropies(data: np.ndarray) -> np.ndarray:
    """Scaled entropy of each window of ``WINDOW`` bytes, by sliding counts."""
    n = len(data) - WINDOW + 1
    if n < 1:
        return np.empty(0, dtype=np.int64)
    before, after = np.zeros(len(data), dtype=np.uint8), np.zeros(len(data), dtype=np.uint8)
    for j in range(1, WINDOW):  # equal bytes among the WINDOW - 1 before and after each byte
        same = (data[j:] == data[:-j]).view(np.uint8)
        before[j:] += same
        after[:-j] += same
    # the byte that leaves stood among `after` others, the one that comes finds `before`
    leaves = after[: n - 1].astype(np.intp)
    comes = before[WINDOW:].astype(np.intp)
    change = (_TERM[comes + 1] - _TERM[comes]) - (_TERM[leaves + 1] - _TERM[leaves])
    first = _TERM[np.bincount(data[:WINDOW], minlength=256)].sum()
    sums = np.concatenate([[first], first + np.cumsum(change, dtype=np.int64)])
    most = np.log2(WINDOW) * WINDOW * _UNIT
    return np.rint((most - sums) / most * SCALE).astype(np.int64)


def _buffers(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Texts joined to buffers: bytes, each text's bounds, the first text's number."""
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= BUFFER_BYTES):
            size += len(texts[end])
            end += 1
        part = texts[start:end]
        yield np.frombuffer(b"".join(part), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in part])]), start
        start = end


def _inside(bounds: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` windows lie in one text."""
    ok = np.ones(max(n, 0), dtype=bool)
    for end in bounds[1:-1]:
        ok[max(0, end - WINDOW + 1) : end] = False
    return ok


def entropy_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all whole texts have each scaled entropy."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SCALE + 1, dtype=np.int64)
        for batch in batches:
            for data, bounds, _ in _buffers([x.as_py().encode("utf-8", "surrogatepass") for x in batch.column(0)]):
                found = window_entropies(data)
                counts += np.bincount(found[_inside(bounds, len(found))], minlength=SCALE + 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], names=["entropy", "n"])

    rows = docs.select("text").mapInArrow(scan, "entropy int, n long").groupBy("entropy").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(SCALE + 1, dtype=np.int64)
    for row in rows:
        counts[row["entropy"]] = row["n"]
    return counts


def rank_table(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy, rarest first; entropies under the least have none."""
    ranks = np.empty(SCALE + 1, dtype=np.uint32)
    ranks[np.lexsort((np.arange(SCALE + 1), counts))] = np.arange(SCALE + 1, dtype=np.uint32)
    ranks[:LEAST_ENTROPY] = _NO_RANK
    return ranks


def features(data: np.ndarray, bounds: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each feature in a buffer of texts."""
    entropy = window_entropies(data)
    n = len(entropy)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    rank = np.where(_inside(bounds, n), ranks[entropy], _NO_RANK + np.uint32(1))
    marked = rank.astype(np.uint64) << np.uint64(40) | np.arange(n, dtype=np.uint64)
    least, span = marked, 1
    while span < RUN and len(least) > span:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    # runs lie in one text each; a text of fewer windows is one run
    runs, needed = np.zeros(len(least), dtype=bool), np.full(n, LEAST_WINS)
    short = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = b - a - WINDOW + 1
        runs[a : max(a, a + own - RUN + 1)] = True
        if 0 < own < 2 * RUN:
            needed[a:b] = 1
            if own < RUN:
                short.append(marked[a : a + own].min())
    winners = np.concatenate([least[runs], np.array(short, dtype=np.uint64)]) & np.uint64((1 << 40) - 1)
    wins = np.bincount(winners.astype(np.int64), minlength=n)
    at = np.flatnonzero((wins >= needed) & (rank < _NO_RANK))
    parts = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at].view(np.uint64)
    value = np.zeros(len(at), dtype=np.uint64)
    for i in range(parts.shape[1]):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + parts[:, i] + np.uint64(i + 1))
    return at, value


def bloom_chain(values: np.ndarray) -> np.ndarray:
    """Packed filters of the features, in order."""
    if not len(values):
        return np.empty((0, FILTER_BITS // 8), dtype=np.uint8)
    which = np.arange(len(values)) // PER_FILTER
    bits = np.zeros((which[-1] + 1, FILTER_BITS), dtype=bool)
    for i in range(BITS_EACH):
        bits[which, (values >> np.uint64(11 * i)).astype(np.int64) & (FILTER_BITS - 1)] = True
    return np.packbits(bits, axis=1)


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The filter chain of each text; a text without features has its own hash for one."""
    found: list[np.ndarray] = []
    for data, bounds, first in _buffers(texts):
        at, values = features(data, bounds, ranks)
        cuts = np.searchsorted(at, bounds)
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            own = values[a:b]
            if a == b and texts[first + i]:
                own = np.frombuffer(hashlib.sha256(texts[first + i]).digest()[:8], dtype=np.uint64)
            found.append(bloom_chain(own))
    return found


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """0 to 1; equal digests have 1, an empty and another one 0."""
    if x.shape == y.shape and np.array_equal(x, y):
        return 1.0
    if not len(x) or not len(y):
        return 0.0
    if len(x) > len(y):
        x, y = y, x
    a, b = np.unpackbits(x, axis=1).astype(np.float32), np.unpackbits(y, axis=1).astype(np.float32)
    na, nb = a.sum(axis=1)[:, None], b.sum(axis=1)[None, :]
    chance = na * nb / FILTER_BITS
    share = (a @ b.T - chance) / (np.minimum(na, nb) - chance)
    return float(np.clip(share, 0, 1).max(axis=1).mean())


def digest_text(chain: np.ndarray) -> str:
    return f"{len(chain)}:{chain.tobytes().hex()}"


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in RESULT.split(", ")]
_TYPES = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[x.split()[1]] for x in RESULT.split(", ")]


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the following text's beginning."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _compare(ids: list, texts: list[str], following: list[str], ranks: np.ndarray, chains: list[np.ndarray], next_chains: list[np.ndarray]) -> list[tuple]:
    changed = [edited(a, b).encode("utf-8", "surrogatepass") for a, b in zip(texts, following)]
    rows = []
    for i, text, change, chain, new, after in zip(ids, texts, changed, chains, digests(changed, ranks), next_chains):
        rows.append((i, len(text), hashlib.sha256(change).hexdigest(), digest_text(chain), digest_text(new), likeness(chain, new), likeness(chain, after)))
    return rows


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Digest of every whole text and of its edited text, and how alike they are.

    Documents follow each other by doc_id (null first), then by the text's hash; the
    last is followed by the first.  Null texts count as empty, with an empty digest.
    A single document follows itself; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "digest")
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    ranks = rank_table(entropy_counts(texts))
    n = texts.count()
    parts = min(max(MAX_PARTS, tasks_for(spark)), max(1, -(-n // PART_ROWS)))
    order = ["doc_id", F.xxhash64("text")]
    ranged = texts.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def encode(values: list[str]) -> list[bytes]:
        return [x.encode("utf-8", "surrogatepass") for x in values]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compared documents; of each partition also its first and last text."""
        part = TaskContext.get().partitionId()

        def batch_of(rows: list[tuple], edge: int, kept: list[str | None]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(_TYPES), _TYPES)]
            more = [pa.array([part] * len(rows), pa.int32()), pa.array([edge] * len(rows), pa.int8()), pa.array(kept, pa.string())]
            return pa.RecordBatch.from_arrays([*columns, *more], names=[*_NAMES, "part", "edge", "text"])

        ids, held, chains = [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                new = rows.column(1).to_pylist()
                if not new:
                    continue
                fresh = digests(encode(new), ranks)
                if not held:
                    yield batch_of([(rows.column(0)[0].as_py(), None, None, digest_text(fresh[0]), None, None, None)], 1, [new[0]])
                ids, held, chains = ids + rows.column(0).to_pylist(), held + new, chains + fresh
                yield batch_of(_compare(ids[:-1], held[:-1], held[1:], ranks, chains[:-1], chains[1:]), 0, [None] * (len(held) - 1))
                ids, held, chains = ids[-1:], held[-1:], chains[-1:]
        if held:
            yield batch_of([(ids[0], None, None, digest_text(chains[0]), None, None, None)], 2, held)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, following = (batch.column(i).to_pylist() for i in range(3))
            rows = _compare(ids, texts, following, ranks, digests(encode(texts), ranks), digests(encode(following), ranks))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(_TYPES), _TYPES)], names=_NAMES)

    scanned = scratch.save("scanned", ranged.mapInArrow(scan, f"{RESULT}, part int, edge byte, text string"))
    filled = sorted(row["part"] for row in scanned.filter("edge = 1").select("part").collect())
    after = spark.createDataFrame(list(zip(filled, filled[1:] + filled[:1])), "part int, next int")
    last = scanned.filter("edge = 2").select("part", "doc_id", "text").join(after, "part")
    first = scanned.filter("edge = 1").select(F.col("part").alias("next"), F.col("text").alias("following"))
    ends = last.join(first, "next").select("doc_id", "text", "following").mapInArrow(finish, RESULT)
    return scanned.filter("edge = 0").select(*_NAMES).unionByName(ends)
