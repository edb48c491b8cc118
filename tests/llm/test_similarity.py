import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from logloom.llm import near_dup, substring, suffix, words
from logloom.llm.common import Scratch
from logloom.llm.components import components
from logloom.llm.words import copy_of, shingle_set, words_of

from .conftest import prose


def brute_components(rows, size, percent):
    sets = {}
    for doc, text in rows:
        w = words_of(text)
        k = min(size, len(w))
        sets.setdefault(doc, []).append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    ids = sorted(d for d in sets if d is not None)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: find(d) for d in ids}


def edited(text, seed, share):
    draw = random.Random(seed)
    return " ".join(w if draw.random() > share else f"new{draw.randrange(10**6)}" for w in text.split())


def test_near_duplicates_equal_brute_force(docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Amber birch"), (5, "amber\tBIRCH"), (6, "amber"), (None, "amber birch"), (7, prose(5, 30)), (7, prose(5, 30)), (8, prose(5, 30).upper()), (90, prose(6, 25)), (90, prose(7, 25)), (91, prose(6, 25)), (92, prose(7, 25))]
    base = prose(3, 120)
    rows += [(100 + i, edited(base, i, 0.012 * (i % 6))) for i in range(60)]
    rows += [(300 + i, prose(1000 + i, 40)) for i in range(20)]
    got = near_dup.near_duplicates(docs(rows), words=3, percent=85).collect()
    assert len(got) == len(rows)
    expected = brute_components(rows, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == expected
    assert all(r["kept"] == (r["doc_id"] is None or expected[r["doc_id"]] == r["doc_id"]) for r in got)
    assert {r["doc_id"]: r["n_shingles"] for r in got}[6] == 1 and {r["doc_id"]: r["n_shingles"] for r in got}[3] == 0


def test_near_duplicates_of_nothing(docs):
    assert near_dup.near_duplicates(docs([])).count() == 0
    assert near_dup.keep_one(docs([(1, None), (1, None)])).count() == 2


def test_index_finds_every_pair_under_its_distance():
    draw = np.random.default_rng(1)
    for _ in range(300):
        a = draw.integers(0, 2**31, near_dup.POSITIONS)
        b = a.copy()
        at = draw.choice(near_dup.POSITIONS, near_dup.POSITIONS // 2 - 1, replace=False)
        b[at] += 1
        chunks = (a != b).reshape(-1, near_dup.CHUNK).sum(axis=1)
        assert (chunks <= 1).any()


def test_components_of_random_links(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)]
    root = {x: x for edge in edges for x in edge}
    for _ in edges:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    loops = {x for x in root if all(a == b for a, b in edges if x in (a, b))}
    assert got == {x: r for x, r in root.items() if x not in loops}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (None, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


def test_repeated_passages_go_and_clean_texts_stay(docs):
    passage, near = prose(50, 60), prose(51, 80)
    changed = near.split()
    changed[40] = "other"
    rows = [
        (1, f"{prose(1, 30)} {passage} {prose(2, 20)}"), (2, f"{prose(3, 15)}\n{prose(4, 25)} {passage}"), (3, prose(5, 100)), (4, near), (5, prose(6, 30) + "\n" + " ".join(changed) + "\nend"),
        (6, None), (7, ""), (8, "amber birch"), (9, "amber birch"), (10, passage), (10, passage), (None, passage),
    ]
    got = {}
    for r in substring.remove_repeats(docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert all(got[i][0]["n_removed"] == 0 for i in (1, 3, 4, 6, 7, 8, 9)) and got[6][0]["text"] is None
    assert all(got[i][0]["text"] == dict(rows)[i] for i in (1, 3, 4, 8))
    for i in (2, 10):
        # at either end fewer words than one cut window may stay
        assert got[i][0]["n_removed"] > 60 - 2 * substring.CUT_WINDOW and 1 in got[i][0]["originals"]
    assert got[5][0]["n_removed"] == 80 and got[5][0]["originals"] == [4] and got[5][0]["text"].endswith("end")
    assert len(got[10]) == 2 and got[10][0]["text"] == got[10][1]["text"] and got[None][0]["n_removed"] == 0
    assert substring.remove_repeats(docs([])).count() == 0


def test_rows_of_one_id_lose_only_their_own_words(docs):
    a, b, c = prose(90, 90), prose(91, 90), prose(92, 60)
    rows = [(1, a), (2, a), (2, b), (2, a), (3, f"{prose(93, 30)} {c}"), (3, f"{prose(94, 25)} {c} {prose(95, 25)}"), (4, c)]
    got = [tuple(r) for r in substring.remove_repeats(docs(rows)).select("doc_id", "n_words", "n_removed", "n_spans", "originals").collect()]
    assert sorted(x for x in got if x[0] < 3) == [(1, 90, 0, 0, []), (2, 90, 0, 0, []), (2, 90, 90, 1, [1]), (2, 90, 90, 1, [1])]
    twins = sorted(x for x in got if x[0] == 3)
    assert sorted(x[2] > 0 for x in twins) == [False, True] and all(x[2] <= 60 for x in twins)
    last = next(x for x in got if x[0] == 4)
    assert last[2] > 60 - 2 * substring.CUT_WINDOW and last[3:] == (1, [3])
    left = sorted((r["doc_id"], r["text"]) for r in substring.without_repeats(docs(rows[:3])).collect())
    assert left == [(1, a), (2, b)]
    strings = suffix.remove_repeats(docs([(1, "p" * 50 + a), (2, "q" * 60 + a), (2, "short text"), (2, b)])).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["n_spans"]) for r in strings) == [(1, 0, 0), (2, 0, 0), (2, 0, 0), (2, len(a), 1)]


def test_paragraph_bands_reach_their_recall():
    hasher = words.MinHasher(substring.BANDS * substring.ROWS, seed=7)
    draw, near, far = random.Random(4), [], []
    for seed in range(300):
        text = prose(seed, 120).split()
        other, third = list(text), [w if draw.random() < 0.85 else f"new{draw.random()}" for w in text]
        other[draw.randrange(120)] = "zz"
        found = words.words_in(pa.array([" ".join(x) for x in (text, other, third)]))
        sigs = substring.paragraph_signatures(found, *substring.paragraphs_in(found), hasher)
        bands = [[s[b * substring.ROWS : (b + 1) * substring.ROWS].tobytes() for b in range(substring.BANDS)] for s in sigs]
        sets = [shingle_set(" ".join(x), 5) for x in (text, other, third)]
        for other in (1, 2):
            j = len(np.intersect1d(sets[0], sets[other])) / len(np.union1d(sets[0], sets[other]))
            met = any(x == y for x, y in zip(bands[0], bands[other]))
            if j >= 0.8:
                near.append(met)
            elif j < 0.35:
                far.append(met)
    assert len(near) > 200 and np.mean(near) >= 0.99
    assert len(far) > 100 and np.mean(far) < 0.15


def test_word_batches_equal_plain_words():
    texts = ["", None, "a", "A b", "\x0b", "x" * 200 + " " + "x" * 201, "abcdefgh abcdefghi", " lead", "trail ", "é É", prose(1, 50)]
    for lot in (pa.array(texts), pa.array(["pad", *texts])[1:]):
        found = words.words_in(lot)
        data = found.data.tobytes()
        got = [[data[a:b] for a, b in zip(found.starts[x:y], found.ends[x:y])] for x, y in zip(found.bounds[:-1], found.bounds[1:])]
        assert got == [words_of(t) for t in texts]
        known = {}
        for word, h in zip([w for x in got for w in x], found.hashes.tolist()):
            assert known.setdefault(word, h) == h
        assert len(set(known.values())) == len(known)
        for k in (1, 3, 5):
            values, bounds = words.shingle_sets(found, k)
            plain = [{tuple(w[i : i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)} if w else set() for w in got]
            assert [len(x) for x in plain] == np.diff(bounds).tolist()
            assert all(values[a:b].tolist() == shingle_set(t, k).tolist() for t, a, b in zip(texts, bounds[:-1], bounds[1:]))


def test_passage_hashes_depend_on_words_alone():
    draw = np.random.default_rng(3)
    run = draw.integers(0, 2**63, 30, dtype=np.uint64)
    line = np.concatenate([draw.integers(0, 2**63, 17, dtype=np.uint64), run, draw.integers(0, 2**63, 9, dtype=np.uint64), run, run[:29]])
    at = words.PassageHashes(line).of(np.array([17, 56, 86]), np.array([30, 30, 29]))
    assert at[0] == at[1] != at[2] and at[0] != words.PassageHashes(run[::-1].copy()).of(np.array([0]), 30)[0]


def test_passages_of_any_place_and_width_are_caught(docs):
    """Every 50-word passage inside other words, and wrapped near copies, against brute force."""
    draw, rows, planted = random.Random(8), [], {}
    for i in range(40):
        passage = prose(2000 + i, 50)
        rows.append((i, f"{prose(3000 + i, draw.randrange(40))} {passage} {prose(4000 + i, draw.randrange(40))}"))
        rows.append((100 + i, f"{prose(5000 + i, draw.randrange(40))}\n{prose(6000 + i, draw.randrange(15))} {passage} {prose(7000 + i, 5)}"))
        planted[100 + i] = passage
    wrapped = prose(8000, 144).split()
    edited_lines = list(wrapped)
    edited_lines[70] = "other"
    lines = lambda w: "\n".join(" ".join(w[i : i + 12]) for i in range(0, len(w), 12))
    rows += [(200, f"title\n\n{lines(wrapped)}\n\nend"), (201, f"name\n\n{lines(edited_lines)}\n\nlast")]
    got = {r["doc_id"]: r for r in substring.remove_repeats(docs(rows)).collect()}
    for i, text in rows:
        if i in planted:
            edge = substring.CUT_WINDOW - 1
            assert planted[i] in text and " ".join(planted[i].split()[edge : 50 - edge]) not in got[i]["text"]
            assert 50 - 2 * edge <= got[i]["n_removed"] <= 50
        elif i != 201:
            assert got[i]["n_removed"] == 0
    assert got[201]["n_removed"] == 144 and got[201]["originals"] == [200]


def brute_strings(rows):
    rows = [(d, (t or "").encode()) for d, t in rows]
    earliest = {}
    for doc, data in rows:
        for i in range(len(data) - 99):
            if doc is not None:
                key = data[i : i + 100]
                place = (doc, copy_of(data), i)
                earliest[key] = min(earliest.get(key, place), place)
    out = []
    for doc, data in rows:
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if doc is not None and earliest[data[i : i + 100]] < (doc, copy_of(data), i):
                gone[i : i + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_repeats_equal_brute_force(docs, seed):
    draw = random.Random(seed)
    parts = [prose(i, 25) for i in range(6)] + ["a" * 260, "ab" * 150, "é" * 99, "\0" * 130, "x"]
    rows = [(i, "".join(draw.choice(parts)[draw.randrange(40) :] for _ in range(draw.randrange(1, 6)))) for i in range(50)]
    rows += [(3, parts[0] + parts[1]), (3, parts[1]), (60, parts[2]), (60, parts[2][:150] + "!"), (60, None), (61, ""), (62, "y" * 99), (62, "y" * 99), (63, parts[0]), (63, parts[0]), (None, parts[0])]
    got = sorted((tuple(r) for r in suffix.remove_repeats(docs(rows)).collect()), key=repr)
    assert got == sorted(brute_strings(rows), key=repr)


def test_exact_repeats_of_nothing_and_long_texts(docs, monkeypatch):
    assert suffix.remove_repeats(docs([])).count() == 0
    long = prose(9, 3000)
    data = np.frombuffer(long.encode(), dtype=np.uint8)
    whole = suffix.triggers(data)
    monkeypatch.setattr(suffix, "CHUNK", 1000)
    pieces = suffix.triggers(data)
    strings = lambda t: [(p, s) for p, a, b in zip(t[1], t[2], t[3]) for s in range(a, b + 1)]
    assert strings(whole) == strings(pieces)


def test_no_task_holds_all_phrases_of_a_frequent_trigger(docs, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", 8, raising=False)
    sizes, resolve = [], suffix.resolve_phrases

    def measured(phrases, tasks):
        sizes.extend(r["count"] for r in phrases.groupBy("gram").count().collect())
        return resolve(phrases, tasks)

    monkeypatch.setattr(suffix, "resolve_phrases", measured)
    banner = "=" * 40 + " the same banner in every text " + "=" * 40
    rows = [(i, prose(i % 130, 12) + banner + prose(200 + i % 119, 12)) for i in range(240)] + [(7, prose(7, 12) + banner + prose(207, 12)), (590, prose(1, 40) + banner), (591, banner)]
    got = sorted((tuple(r) for r in suffix.remove_repeats(docs(rows)).collect()), key=repr)
    assert got == sorted(brute_strings(rows), key=repr)
    assert sizes and max(sizes) < 8 * docs([(0, "x")] * 240).rdd.getNumPartitions()
