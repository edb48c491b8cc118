"""Best-fit packing of token sequences with certified bin counts.

Pieces of at most ``capacity`` tokens are dealt into groups of a bounded number of
rows.  A group packs by best-fit decreasing and computes a lower bound from dual
feasible functions (DFF): a function u with sum(u(x)) <= 1 whenever sum(x) <= 1
turns any set of sizes into a bound on its bins.  A group whose bin count equals
its bound is certified: no packing of its pieces is better.  What stands in bins
with gaps is exchanged between the groups: such pieces are dealt anew and packed
again, in rounds, until all bins together meet the bound or a round saves none.  DFF values are additive, so the bound of the
whole input is one aggregation.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pick, text_or_empty
from .tokens import worker_tokenizer

CAPACITY = 4096
END_OF_DOCUMENT = 1
#: Pieces that one task packs at once.
GROUP_ROWS = 2048
#: Rounds of exchange at most; each that is left out could only have saved sequences.
MAX_ROUNDS = 8
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokens of each whole text plus the end id, cut after every ``capacity``.

    Null texts count as empty: they give one piece that holds the end id alone.
    Repeated rows and null ids are documents of their own.
    """
    end = END_OF_DOCUMENT.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(tokenizer_path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokenizer.encode(text.as_py()) + end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, piece, start, len(part) // 4, zlib.crc32(part)))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))
        tokenizer.forget()

    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_or_empty(F.col("text").cast("string")).alias("text"))
    return texts.mapInArrow(cut, PIECES)


# Dual feasible functions -----------------------------------------------------

STAIRS = tuple(range(1, 13))
CUTS = tuple(1 / k for k in range(2, 13))


def bound_terms(length: Column, capacity: int) -> dict[str, Column]:
    """Each DFF as a Spark expression whose sum over pieces bounds the bins."""
    x = length.cast("double") / F.lit(float(capacity))
    terms = {"size": x}
    for k in STAIRS:
        whole = (length * (k + 1)) % capacity == 0
        terms[f"stair_{k}"] = F.when(whole, x).otherwise(F.floor(length * (k + 1) / capacity) / k)
    for k, eps in enumerate(CUTS, 2):
        terms[f"cut_{k}"] = F.when(x > 1 - eps, 1.0).when(x < eps, 0.0).otherwise(x)
    return terms


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The same bound for the pieces of one group."""
    x = lengths / capacity
    best = x.sum()
    for k in STAIRS:
        whole = lengths * (k + 1) % capacity == 0
        best = max(best, np.where(whole, x, (lengths * (k + 1) // capacity) / k).sum())
    for eps in CUTS:
        best = max(best, np.where(x > 1 - eps, 1.0, np.where(x < eps, 0.0, x)).sum())
    return math.ceil(best - 1e-6)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each piece, and the gap left in each bin.

    Bins stand in stacks by gap; bit g of ``filled`` says that a bin with gap g is
    there, so the tightest bin that fits is the lowest set bit from the length on.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled, gaps = 0, []
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        rest = filled >> size
        if rest:
            gap = size + (rest & -rest).bit_length() - 1
            b = stacks[gap].pop()
            if not stacks[gap]:
                filled ^= 1 << gap
        else:
            gap, b = capacity, len(gaps)
            gaps.append(capacity)
        bins[i], offsets[i] = b, capacity - gap
        gaps[b] = gap = gap - size
        if gap:
            stacks[gap].append(b)
            filled |= 1 << gap
    return bins, offsets, gaps


def _pack_group(capacity: int, round_no: int, slack: int):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].to_numpy()
        bins, offsets, gaps = best_fit_decreasing(lengths, capacity)
        gaps = np.asarray(gaps)
        certified = len(gaps) == lower_bound(lengths, capacity)
        group = int(frame["packing_group"].iloc[0])
        return frame.drop(columns="packing_group").assign(
            sequence_id=(round_no << 58) + (group << 20) + bins, offset=offsets, certified=certified, reopened=(gaps > slack)[bins]
        )

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Columns ``sequence_id``, ``offset`` and ``certified`` added to ``pieces``.

    Args:
        pieces: doc_id, piece, start, length (1 to ``capacity``), ids_crc32.
        capacity: tokens of a sequence.
        group_rows: pieces that one task packs at once; also the most bins of one.

    An empty input gives no rows.  Equal lengths are placed in any order.
    """
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    open_pieces = scratch.save("pieces", pieces)
    placed, before, last = [], math.inf, None
    for round_no in range(MAX_ROUNDS):
        terms = bound_terms(F.col("length"), capacity)
        stats = open_pieces.agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("least"), *(F.sum(v).alias(k) for k, v in terms.items())).first()
        if not stats["n"] and placed:
            break
        bound = math.ceil(max(stats[k] or 0 for k in terms) - 1e-6)
        groups = max(1, math.ceil(stats["n"] / group_rows))
        # a bin opens again if the shortest open piece fits its gap
        slack = (stats["least"] or 1) - 1
        dealt = open_pieces.withColumn("packing_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        out = f"{PIECES}, sequence_id long, offset long, certified boolean, reopened boolean"
        packed = scratch.save(f"round{round_no}", dealt.groupBy("packing_group").applyInPandas(_pack_group(capacity, round_no, slack), out))
        first = F.col("offset") == 0
        bins, gaps = packed.agg(F.count(F.when(first, 1)), F.count(F.when(first & F.col("reopened"), 1))).first()
        if bins > before:  # the earlier places were better
            placed.append(last.filter("reopened"))
            break
        # one group, a certified whole, or a round that saved no bin ends the exchange
        if groups == 1 or bins == bound or bins >= before or round_no == MAX_ROUNDS - 1:
            placed.append(packed)
            break
        before, last = gaps, packed
        placed.append(packed.filter(~F.col("reopened")))
        open_pieces = packed.filter("reopened").select(*(c.split()[0] for c in PIECES.split(", ")))
    result = placed[0]
    for more in placed[1:]:
        result = result.unionByName(more)
    return result.drop("reopened")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of all ``docs``, each with its sequence and its place there."""
    return pack(token_pieces(docs, tokenizer_path, capacity), capacity)
