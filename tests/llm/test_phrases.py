import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from logloom.llm import phrases, registry


def brute(rows, least, longest=5, most=2000, percent=100):
    found, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                found[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            inside = [q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * candidates[q] >= percent * a for q in inside):
                continue
            score, _, l, r = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((score, a, " ".join(p), l, r))
        kept.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, totals[lang], score) for i, (score, a, p, l, r) in enumerate(kept[:most])]
    return sorted(out)


def drawn(seed, n):
    draw = random.Random(seed)
    words = ["The", "the", "of", "cat", "Sat", "on", "é", "É", "x" * 70, "mat", "rare%d", "naïve word", "a-b"]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(draw.randrange(40)):
            word = draw.choice(words)
            text += (word % draw.randrange(1000) if "%" in word else word) + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "?!"])
            if draw.random() < 0.3:
                text += draw.choice(["the cat sat on mat ", "on the mat. ", "of the "])
        rows.append((draw.choice(["en", "en", "fr", "und", None]), text))
    return rows + [("en", None), ("en", ""), ("de", "the the the the the the the"), ("en", rows[0][1]), ("en", rows[0][1])]


def found(spark, rows, **more):
    frame = spark.createDataFrame([(i, t, lang, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, LANG_ string")
    return sorted(tuple(r) for r in phrases.find_phrases(frame, **more).collect())


@pytest.mark.parametrize("more", [{}, {"most": 7, "percent": 60, "most_words": 3}])
def test_phrases_equal_brute_force(spark, more):
    rows = drawn(21, 150)
    limits = {k: v for k, v in more.items() if k != "most_words"}
    expected = brute(rows, 12, **limits)
    assert found(spark, rows, least=12, **more) == expected and len({r[0] for r in expected}) == 3


def test_phrases_of_nothing(spark):
    assert found(spark, []) == [] and found(spark, [("en", "a b c"), (None, None)]) == []
    assert found(spark, [("de", "a a a")], least=2, longest=3) == brute([("de", "a a a")], 2, 3) == [("de", 1, "a a", 2, 3, 3, 3, 666)]


def test_products_pass_64_bits(spark):
    big, scale = 10**13, "cast({} as decimal(16, 0))"
    value = f"(cast(1000 as decimal(4, 0)) * {scale.format(big)} * {scale.format(big * 9)}) div ({scale.format(big * 2 + 1)} * {scale.format(big * 3)})"
    assert spark.range(1).selectExpr(f"{value} AS v").first()["v"] == 1000 * big * big * 9 // ((2 * big + 1) * 3 * big)


def test_radix_order_and_runs():
    draw = np.random.default_rng(5)
    for kind, top in ((">u4", 50), (">u4", 2**32 - 1), (">u8", 2**64 - 1)):
        rows = draw.integers(0, top, (500, 3), dtype=np.uint64).astype(kind)
        rows[100:200] = rows[:100]
        assert [tuple(x) for x in rows[phrases.radix_order(rows)]] == sorted(tuple(x) for x in rows)
        distinct, sums = phrases.run_lengths(rows, np.ones(500, np.int64))
        assert dict(zip(map(tuple, distinct.tolist()), sums)) == Counter(map(tuple, rows.tolist()))


def test_long_texts_are_cut_into_rows_without_loss(spark, monkeypatch):
    rows = [("en", "a b c d e " * 300), ("fr", "x. y z")]
    whole = found(spark, rows, least=20)
    assert whole == brute(rows, 20)
    data, starts, ends, text, begins = phrases.words_of_pieces(pa.array(["A b", "", "c, d\te", "\x0b"]))
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == [b"a", b"b", b"c", b"d", b"e"]
    assert text.tolist() == [0, 0, 2, 2, 2] and begins.tolist() == [True, False, True, True, False]
    frame = spark.createDataFrame([("en", "a b c d e " * 300)], "lang string, text string")
    words = spark.createDataFrame([], "code long, lang string, word string, f long")
    coder = phrases.Coder(words, 0 if words.count() else 1)
    coder.sorted = None
    coder.bits, coder.type = np.full(4, 2**64 - 1, dtype=np.uint64), np.dtype(">u8")
    monkeypatch.setattr(phrases, "ROW_WORDS", 7)
    cut = phrases.task_counts(phrases.encoded_texts(frame, coder, 0, 5), 5, coder, None)
    assert sum(r["n"] for r in cut.collect()) == 1496


def test_sql_equals_the_query(spark, tmp_path):
    rows = drawn(22, 120)
    spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM read_parquet('{tmp_path}/d/*.parquet')")
    got = con.execute(registry.OP13_SQL.replace(">= 100", ">= 12")).fetchall()
    assert sorted(got) == brute(rows, 12)
