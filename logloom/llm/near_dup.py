"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A document's set is its distinct word shingles.  Documents with equal sets form a
class; one signature stands for each.  A signature of ``POSITIONS`` values of ``BITS``
bits is split into chunks of ``CHUNK``.  If two signatures differ in fewer than twice
as many positions as there are chunks, some chunk differs in at most one.  A value that
differs may be any other, so a chunk's allowed errors are enumerated by their place:
each position left out gives a key, and all pairs under that distance (half of
the positions) share one.  A link's expected distance is far below; at a
similarity of 0.85 one pair in a million exceeds it, at 0.8 some three.

Pairs of a key are never listed outright.  First every member joins the cell of the
nearest among the least members of its keys; then keys that still span several
components meet in the cell of their least component, where those without a near
signature in another component drop out.  In a cell full sets are compared
in blocks, and only links that join components come out, so their number is linear.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bloom_filter, maybe_in, pick, tasks_for
from .components import components
from .words import MinHasher, sets_of, shingle_sets, signatures, slices, words_in, words_of

POSITIONS, CHUNK, BITS = 40, 4, 16
#: Values of the longer signature, a byte each, that pairs are filtered by.
FILTER = 128
#: Words and texts that one block of a cell holds on average; both bound a task's memory.
BLOCK_WORDS, BLOCK_TEXTS = 1 << 18, 1000
#: Signatures that one block of a cell holds on average.
BLOCK_SIGNATURES = 1024
SHINGLE_WORDS, SIMILARITY = 5, 80


def max_distance(percent: int, positions: int = FILTER) -> int:
    """Signature bytes in which a linked pair may differ: five deviations above its mean."""
    apart = 1 - percent / 100
    return min(positions, int(positions * apart + 5 * (positions * apart * (1 - apart)) ** 0.5) + 1)


def shingle_table(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit set id, and the signatures, for every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(FILTER)
        for batch in batches:
            for offset, texts in slices(batch.column(1)):
                values, bounds = shingle_sets(words_in(texts), words)
                whole = np.array([np.frombuffer(xxhash.xxh3_128_digest(values[a:b]), dtype=np.int64) for a, b in zip(bounds[:-1], bounds[1:])]).reshape(-1, 2)
                minima = signatures(hasher, values, bounds)
                index = [x.tobytes() for x in (minima[:, :POSITIONS] >> np.uint64(24)).astype(np.uint16)]
                sig = [x.tobytes() for x in (minima >> np.uint64(20)).astype(np.uint8)]
                columns = [batch.column(0).slice(offset, len(texts)), pa.array(np.diff(bounds)), pa.array(whole[:, 0]), pa.array(whole[:, 1]), pa.array(index, pa.binary()), pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_low", "set_high", "index", "sig"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scan, "doc_id long, n_shingles long, set_low long, set_high long, index binary, sig binary")


def index_keys(index: Column) -> Column:
    """The keys of a signature: each chunk with each of its positions left out."""
    size, keys = BITS // 8, []
    for chunk in range(POSITIONS // CHUNK):
        for out in range(CHUNK):
            kept = [F.substring(index, (chunk * CHUNK + i) * size + 1, size) for i in range(CHUNK) if i != out]
            keys.append(F.xxhash64(F.lit(chunk * CHUNK + out), *kept))
    return F.array(*keys)


# Cells -----------------------------------------------------------------------


def similar_pairs(items: list[np.ndarray], percent: int) -> np.ndarray:
    """Upper triangle of which sets are similar enough, from exact intersection sizes.

    Only values that two sets hold count; they go through in columns of a 0-1 matrix.
    """
    sizes = np.array([len(x) for x in items])
    values, column = np.unique(np.concatenate(items), return_inverse=True)
    row = np.repeat(np.arange(len(items)), sizes)
    often = np.bincount(column, minlength=len(values)) > 1
    number = np.cumsum(often) - 1
    row, column = row[often[column]], number[column[often[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(items), len(items)), dtype=np.float32)
    for low in range(0, int(often.sum()), 2048):
        a, b = np.searchsorted(column, [low, low + 2048])
        holds = np.zeros((len(items), 2048), dtype=np.float32)
        holds[row[a:b], column[a:b] - low] = 1
        common += holds @ holds.T
    both = sizes[:, None] + sizes[None, :] - common
    return np.triu(100 * common.astype(np.float64) >= percent * both.astype(np.float64), 1)


def spanning_links(node: np.ndarray, comp: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Links that join what ``linked`` joins, one for each join of two components."""
    names, which = np.unique(comp, return_inverse=True)
    x, y = np.nonzero(linked & (which[:, None] != which[None, :]))
    pair, at = np.unique(np.sort(np.stack([which[x], which[y]], axis=1), axis=1), axis=0, return_index=True)
    root = list(range(len(names)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    found = []
    for (a, b), i in zip(pair.tolist(), at):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            found.append((node[x[i]], node[y[i]]))
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each value of the first column, by which the rows are sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:  # a group may go on in the next batch
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        for a, b in zip(edges[:-1], edges[1:]):
            if held and held[0].column(0)[0].as_py() != key[a]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.concat_batches(held)


def _cell_links(percent: int, words: int):
    """Links across components of each cell; the rows of a cell stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for group in _groups(batches):
            node, comp = (group.column(i).to_numpy() for i in (1, 2))
            if comp.min() != comp.max():
                items = sets_of([unpack(x.as_py()) for x in group.column(3)], words)
                links = spanning_links(node, comp, similar_pairs(items, percent))
                yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    return run


def _near_signatures(limit: int):
    """cell, rep and component of those with a signature within ``limit`` in another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            comp = group.column(3).to_numpy()
            if comp.min() == comp.max():
                continue
            sigs = np.frombuffer(b"".join(group.column(4).to_pylist()), dtype=np.uint8).reshape(len(comp), -1)
            near = np.zeros(len(comp), dtype=bool)
            for i in range(0, len(comp), 32):
                far = (sigs[i : i + 32, None, :] != sigs[None, :, :]).sum(axis=2, dtype=np.int16)
                near[i : i + 32] = ((far <= limit) & (comp[i : i + 32, None] != comp[None, :])).any(axis=1)
            yield group.select([1, 2, 3]).filter(pa.array(near))

    return run


def near_members(placed: DataFrame, sigs: DataFrame, limit: int) -> DataFrame:
    """Rows of ``placed`` (cell, rep, component) that some member of their cell may be linked with.

    Two signatures further apart than ``limit`` can't belong to a link, so a row that is far
    from all other components' goes without its text being read.
    """
    blocks = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SIGNATURES).cast("int").alias("blocks"))
    dealt = placed.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"))
    rows = dealt.select(task.alias("task"), "cell", "rep", "component").join(sigs, "rep").select("task", "cell", "rep", "component", "sig")
    ordered = rows.repartition(tasks_for(placed.sparkSession), "task").sortWithinPartitions("task")
    return ordered.mapInArrow(_near_signatures(limit), "cell long, rep long, component long").distinct()


def cell_links(placed: DataFrame, items_of: Callable[[DataFrame], DataFrame], percent: int, words: int, scratch: Scratch, label: str) -> DataFrame:
    """Links between different components of each cell, confirmed on full sets.

    placed: cell, rep, component.  A larger cell than ``BLOCK_WORDS`` or
    ``BLOCK_TEXTS`` is cut into blocks; each pair of blocks is compared by one task.  Texts travel packed, since
    their sets of hashes take four times the room.
    """
    items = scratch.save(f"{label}-items", items_of(placed.select("rep").distinct()))
    sizes = placed.join(items.select("rep", "size"), "rep")
    blocks = sizes.groupBy("cell").agg(F.greatest(F.lit(1), F.ceil(F.sum("size") / BLOCK_WORDS), F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS)).cast("int").alias("blocks"))
    dealt = placed.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"))
    cells = dealt.select(task.alias("task"), "rep", "component").join(items, "rep").select("task", "rep", "component", "items")
    n = tasks_for(placed.sparkSession)
    links = scratch.save(f"{label}-links", cells.repartition(n, "task").sortWithinPartitions("task").mapInArrow(_cell_links(percent, words), "a long, b long"))
    scratch.drop(f"{label}-items")
    return links


# Candidates -------------------------------------------------------------------


def nearest_leader(pairs: DataFrame, sigs: DataFrame, limit: int) -> DataFrame:
    """Of each b the a whose signature differs least, within ``limit`` positions."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
            far = (x != y).sum(axis=1).astype(np.int32)
            rows = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(far)], names=["a", "b", "far"])
            yield rows.filter(pa.array(far <= limit))

    left, right = (sigs.select(F.col("rep").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab")
    near = pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(measure, "a long, b long, far int")
    return near.groupBy("b").agg(F.min(F.struct("far", "a"))["a"].alias("a")).select("a", "b")


def packed_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, size in words, and items, the compressed words, of rows (rep, text) with a wanted rep.

    Only texts that a Bloom filter of the wanted ones lets through are shuffled.
    """
    bits = bloom_filter(wanted)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            batch = batch.filter(pa.array(maybe_in(bits, batch.column(0))))
            words = [words_of(x.as_py()) for x in batch.column(1)]
            columns = [batch.column(0), pa.array(map(len, words), pa.int32()), pa.array((packer.compress(b" ".join(x)) for x in words), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "size", "items"])

    return texts.select("rep", "text").mapInArrow(pack, "rep long, size int, items binary").join(wanted, "rep", "left_semi")


def link_members(members: DataFrame, sigs: DataFrame, items_of: Callable[[DataFrame], DataFrame], percent: int, words: int, scratch: Scratch, more: DataFrame | None = None, positions: int = FILTER) -> DataFrame:
    """node and component of the confirmed links among the pairs of each key.

    Args:
        members: key, leader (the key's least rep) and rep of keys with several reps.
        sigs: rep and sig, a byte for each of ``positions`` MinHash values.
        items_of: gives (rep, size, items) as ``packed_texts`` for a table of reps; it is written once a round.
        more: further links (a, b) that need no confirmation.
    """
    stars = members.filter("leader <> rep").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    limit = max_distance(percent, positions)
    nearest = scratch.save("nearest", nearest_leader(stars, sigs, limit))
    ends = nearest.select(F.col("a").alias("cell"), F.col("b").alias("rep")).unionByName(nearest.select(F.col("a").alias("cell"), F.col("a").alias("rep"))).distinct()
    links = cell_links(ends.withColumn("component", F.col("rep")), items_of, percent, words, scratch, "star")
    joined = scratch.save("star-joined", components(links if more is None else links.unionByName(more), scratch, "star"))
    # keys that still span components meet in the cell of their least component
    rows = members.select("key", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    split = rows.groupBy("key").agg(F.min("component").alias("cell"), F.max("component").alias("high")).filter("cell <> high").drop("high")
    placed = scratch.save("cells", rows.join(split, "key").select("cell", "rep", "component").distinct())
    placed = scratch.save("near-cells", near_members(placed, sigs, limit))
    across = cell_links(placed, items_of, percent, words, scratch, "cell")
    if across.isEmpty():
        return joined
    return scratch.save("joined", components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(across), scratch, "all"))


# Operator --------------------------------------------------------------------


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = SIMILARITY) -> DataFrame:
    """Component of every document under links of at least ``percent`` similarity.

    Args:
        docs: doc_id and text; other columns are ignored.
        words: words of a shingle.  A text of fewer words has one shingle, all of it;
            one without words, or null, has none and is linked with nothing.
        percent: least Jaccard similarity of two linked sets, in per cent (at least
            50, so that the index keeps its guarantee).

    Returns a row per input row: doc_id, n_shingles, component_id (smallest doc_id
    reachable), kept (doc_id = component_id).  Repeated rows share a component; a
    null doc_id takes no part and is kept.  An empty table gives no rows.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    scratch = Scratch(docs.sparkSession, "neardup")
    rows = scratch.save("rows", shingle_table(docs, words))
    filled = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = scratch.save(
        "classes",
        filled.groupBy("set_low", "set_high").agg(F.min("doc_id").alias("rep"), F.first("index").alias("index"), F.first("sig").alias("sig")),
    )
    # an id with several texts stands for several classes, each with its signature
    sigs = classes.select("rep", "sig")
    keyed = classes.select("rep", F.explode(index_keys(F.col("index"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    members = scratch.save("members", keyed.join(shared, "key"))
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("rep"), "text")
    # an id with several texts joins their classes
    placed = filled.join(classes.select("set_low", "set_high", "rep"), ["set_low", "set_high"]).select("doc_id", "rep")
    own = placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    own = scratch.save("own", own)
    links = own.filter("a <> b").select("a", "b").unionByName(own.filter("a <> b").join(placed, "doc_id").select("a", F.col("rep").alias("b")))
    joined = link_members(members, sigs, lambda ends: packed_texts(texts, ends), percent, words, scratch, links)
    scratch.keep("rows", "own", "joined", "star-joined")
    final = own.join(joined.withColumnRenamed("node", "a"), "a", "left").select("doc_id", F.coalesce("component", "a").alias("component"))
    found = rows.select("doc_id", "n_shingles").join(final, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = SIMILARITY) -> DataFrame:
    """``docs``, all columns, without the near duplicates of a smaller doc_id.

    Of rows that repeat a kept doc_id all stay, as do null ids and texts without
    words.  Other columns may have any names; an empty table stays empty.
    """
    dropped = near_duplicates(docs, words, percent).filter("not kept").select(F.col("doc_id").alias("dropped")).distinct()
    # columns go by number, so that a name that differs only in case is no ambiguity
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at = docs.columns.index("doc_id")
    return rows.join(dropped, F.col(f"c{at}") == F.col("dropped"), "left_anti").toDF(*docs.columns)
