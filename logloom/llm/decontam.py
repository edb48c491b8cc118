"""Benchmark passages in documents, found within an edit budget.

An item of n characters may be met with ``n // 10`` edits.  It is split into one
piece more than that, so some piece stands unchanged in every match.  One automaton
of all pieces runs over each whole text.  A piece's hit climbs a binary tree of its
item: a node of p pieces must match within p - 1 edits, for else both halves of some
node would exceed theirs.  Chance hits end at the first node; the root is the item.
Distances come from Myers' bit-parallel algorithm on whole-number bit vectors.

Texts and items are compared lower-cased with white space runs as one space.  Items of
fewer than ``MIN_WORDS`` words or ``MIN_CHARS`` characters are not searched for: a short
answer ("yes") stands in most texts by chance, and says nothing about a leak.  In
scripts without spaces ``LONE_CHARS`` characters are enough.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick

#: One edit is allowed for so many characters of an item.
CHARS_PER_EDIT = 10
#: Items of one automaton hold so many characters at most, which bounds a task's memory.
BLOCK_CHARS = 1_000_000
#: Items of one pass over the documents hold so many at most, which bounds what a task is sent.
PASS_CHARS = 32_000_000
#: The least item that is searched for; few words may also be many characters.
MIN_WORDS, MIN_CHARS, LONE_CHARS = 5, 20, 40
_WORD = re.compile(r"\S+")


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def is_searched(item: str) -> bool:
    """Whether a normalised item is long enough for a match to mean a leak."""
    return len(item) >= LONE_CHARS or len(item) >= MIN_CHARS and item.count(" ") + 1 >= MIN_WORDS


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers_search(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of ``text``, and its first end."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        d0 = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        hp = (minus | ~(d0 | plus)) & full
        hn = d0 & plus
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 & full
        hn = hn << 1 & full
        plus = (hn | ~(d0 | hp)) & full
        minus = hp & d0
        if score < best:
            best, end = score, j
    return best, end


class Item:
    """A normalised item, its pieces, and each piece's way up the tree."""

    def __init__(self, item_id: int, text: str):
        self.item_id, self.text = item_id, text
        self.budget = len(text) // CHARS_PER_EDIT
        n = self.budget + 1
        self.cuts = [len(text) * i // n for i in range(n + 1)]
        self.ways: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        nodes = [(0, n)]
        while nodes:
            a, b = nodes.pop()
            if b - a > 1:
                for piece in range(a, b):
                    self.ways[piece].append((self.cuts[a], self.cuts[b], b - a - 1))
                half = (a + b) // 2
                nodes += [(a, half), (half, b)]
        for way in self.ways:
            way.sort(key=lambda x: x[2])
        self.masks: dict[tuple[int, int], dict[str, int]] = {}

    def pieces(self) -> list[str]:
        return [self.text[a:b] for a, b in zip(self.cuts, self.cuts[1:])]

    def _distance(self, start: int, end: int, window: str) -> tuple[int, int]:
        masks = self.masks.get((start, end))
        if masks is None:
            masks = self.masks[start, end] = pattern_masks(self.text[start:end])
        return myers_search(masks, end - start, window)

    def match(self, text: str, piece: int, at: int) -> tuple[int, int, int] | None:
        """Distance, start and end in ``text`` of a match around a piece's hit at ``at``."""
        own = self.cuts[piece]
        distance, low, end = 0, at, len(self.text)
        for start, stop, budget in self.ways[piece]:
            low = max(0, at - (own - start) - budget)
            distance, end = self._distance(start, stop, text[low : at + stop - own + budget])
            if distance > budget:
                return None
        end = low + end if self.ways[piece] else at + len(self.text)
        back = text[max(0, end - len(self.text) - self.budget) : end][::-1]
        distance, length = myers_search(pattern_masks(self.text[::-1]), len(self.text), back)
        return distance, end - length, end


class Matcher:
    """All items of a block behind one automaton."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.items = [Item(item_id, text) for item_id, text in rows]
        owners: dict[str, list[tuple[int, int]]] = {}
        for i, item in enumerate(self.items):
            for p, piece in enumerate(item.pieces()):
                owners.setdefault(piece, []).append((i, p))
        self.automaton = ahocorasick.Automaton()
        for piece, found in owners.items():
            self.automaton.add_word(piece, (len(piece), found))
        if owners:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of every match; of overlapping ones the nearest."""
        if not self.items or not text:
            return []
        found: dict[int, list[tuple[int, int, int]]] = {}
        for last, (size, owners) in self.automaton.iter(text):
            at = last - size + 1
            for i, piece in owners:
                item, known = self.items[i], found.get(i)
                begin = at - item.cuts[piece]
                if known and any(abs(begin - s) <= d for d, s, _ in known):
                    continue
                match = item.match(text, piece, at)
                if match:
                    found.setdefault(i, []).append(match)
        out = []
        for i, places in found.items():
            taken: list[tuple[int, int, int]] = []
            for d, s, e in sorted(places):
                if all(e <= a or s >= b for _, a, b in taken):
                    taken.append((d, s, e))
            out += [(self.items[i].item_id, d, s, e) for d, s, e in taken]
        return sorted(out)


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where normalised characters from ``start`` to ``end`` stand in ``text``, by whole words."""
    at, first, last = 0, None, None
    for word in _WORD.finditer(text):
        size = len(word[0].lower())
        if at + size > start and at < end:
            first = word.start() if first is None else first
            last = word.end()
        at += size + 1
        if at >= end:
            break
    return (first, last) if first is not None else (0, 0)


def item_passes(benchmark: DataFrame) -> Iterator[list[list[tuple[int, str]]]]:
    """The items, normalised, in blocks, and these in passes, both of bounded size.

    The benchmark is a query set that is small beside the documents; it comes to the
    driver item by item.  Null items and those too short to be searched for are left out.
    """
    blocks: list[list[tuple[int, str]]] = [[]]
    size = whole = 0
    for row in pick(benchmark, "item_id", "text").filter("text is not null").distinct().toLocalIterator():
        text = normalised(row["text"])
        if not is_searched(text):
            continue
        if blocks[-1] and whole + len(text) > PASS_CHARS:
            yield blocks
            blocks, size, whole = [[]], 0, 0
        if blocks[-1] and size + len(text) > BLOCK_CHARS:
            blocks.append([])
            size = 0
        blocks[-1].append((row["item_id"], text))
        size, whole = size + len(text), whole + len(text)
    yield blocks


MATCHES = "doc_id long, item_id long, distance int, start_char long, end_char long"


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each place where a document holds a benchmark item within its edit budget.

    Returns doc_id, item_id, distance (edits of the normalised texts), start_char and
    end_char (code points of the whole words that hold the match).  Of overlapping
    matches of one item the nearest counts, of equally near ones the first.  Null texts
    and items of fewer than five words or twenty characters (without spaces: forty
    characters) match nothing, long texts are read whole; a null doc_id or item_id
    is reported as such; repeated rows give repeated results; an empty table on either
    side gives no rows.
    """
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("text is not null")

    def found(batch: pa.RecordBatch, matcher: Matcher) -> pa.RecordBatch:
        out = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            for item, distance, start, end in matcher.matches(normalised(text)):
                out.append((doc, item, distance, *original_span(text, start, end)))
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = ["doc_id", "item_id", "distance", "start_char", "end_char"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, types)], names=names)

    result = None
    for blocks in item_passes(benchmark):

        def scan(batches: Iterator[pa.RecordBatch], blocks=blocks) -> Iterator[pa.RecordBatch]:
            sole = Matcher(blocks[0]) if len(blocks) == 1 else None  # the only one kept between batches
            for batch in batches:
                for block in blocks:
                    yield found(batch, sole or Matcher(block))

        part = texts.mapInArrow(scan, MATCHES)
        result = part if result is None else result.unionByName(part)
    return result


def cut_matches(text: str, matcher: Matcher) -> tuple[str, int]:
    """A text without the words of any match, and how many matches there were."""
    spans = sorted(original_span(text, s, e) for _, _, s, e in matcher.matches(normalised(text)))
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : max(at, start)])
        at = max(at, end)
    return "".join([*kept, text[at:]]), len(spans)


def without_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs``, all columns, with matches cut from text and n_chars brought up to date.

    Documents of which no word is left go; null and empty texts stay.  n_chars may be
    absent, and other columns may have any names; repeated rows are cut alike; an
    empty table on either side changes nothing.
    """
    columns = docs.columns
    at, size = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def without(batch: pa.RecordBatch, matcher: Matcher) -> pa.RecordBatch:
        arrays, texts, keep = list(batch.columns), batch.column(at).to_pylist(), [True] * batch.num_rows
        sizes = arrays[size].to_pylist() if size is not None else [None] * batch.num_rows
        for i, text in enumerate(texts):
            left, n = cut_matches(text, matcher) if text else (text, 0)
            if n:
                texts[i], sizes[i], keep[i] = left, len(left), bool(left.strip())
        arrays[at] = pa.array(texts, arrays[at].type)
        if size is not None:
            arrays[size] = pa.array(sizes, arrays[size].type)
        return pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep, pa.bool_()))

    result = docs
    for blocks in item_passes(benchmark):

        def cut(batches: Iterator[pa.RecordBatch], blocks=blocks) -> Iterator[pa.RecordBatch]:
            sole = Matcher(blocks[0]) if len(blocks) == 1 else None
            for batch in batches:
                for block in blocks:
                    batch = without(batch, sole or Matcher(block))
                yield batch

        result = result.mapInArrow(cut, docs.schema)
    return result
