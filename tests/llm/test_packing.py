import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logloom.llm import packing, registry
from logloom.llm.tokens import WordTokenizer

from .conftest import prose


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aZ'sß é.,\n\t<|>endoftext12", max_size=60))
def test_cached_ids_equal_the_tokenizers(text):
    own = WordTokenizer(registry.TOKENIZER)
    whole = Tokenizer.from_file(registry.TOKENIZER)
    assert list(np.frombuffer(own.encode(text), "<u4")) == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40))
def test_best_fit_respects_capacity_and_bound(sizes):
    lengths = np.array(sizes, dtype=np.int64)
    bins, offsets, gaps = packing.best_fit_decreasing(lengths, 50)
    used = np.zeros(len(gaps), dtype=int)
    for b, o, n in sorted(zip(bins, offsets, lengths)):
        assert used[b] == o
        used[b] += n
    assert all(u + g == 50 for u, g in zip(used, gaps)) and len(gaps) >= packing.lower_bound(lengths, 50)


def test_bound_beats_the_plain_sum():
    assert packing.lower_bound(np.array([34, 34, 34, 34]), 66) == 4  # no two fit


def test_packs_every_piece_once(docs):
    rows = [(1, prose(1, 3000)), (2, None), (3, ""), (4, "amber"), (4, "amber"), (None, "birch"), *((i, prose(i, i)) for i in range(10, 60))]
    got = packing.pack_documents(docs(rows), registry.TOKENIZER, capacity=512).collect()
    whole, sequences = Tokenizer.from_file(registry.TOKENIZER), {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    expected = []
    for doc, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 512)):
            part = ids[start : start + 512]
            expected.append((doc, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(expected, key=key)
    assert len(sequences) <= sum(x[3] for x in expected) // 512 + 2


def test_exchange_rounds_close_gaps(spark):
    rows = [(i, 0, 0, 1 + i * 37 % 700, 0) for i in range(4000)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECES), capacity=1000, group_rows=100)
    n = got.select("sequence_id").distinct().count()
    assert got.count() == 4000 and n <= 1.002 * sum(r[3] for r in rows) / 1000 + 2


@pytest.mark.parametrize("rows", [[]])
def test_empty_table(docs, rows):
    assert packing.pack_documents(docs(rows), registry.TOKENIZER).count() == 0
