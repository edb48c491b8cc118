import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logloom.llm import decontam, digest, licenses, toxicity

from .conftest import WORDS, prose


def edit_search(pattern, text):
    row = list(range(len(pattern) + 1))
    best, end = len(pattern), 0
    for j, c in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (p != c)))
        row = new
        if row[-1] < best:
            best, end = row[-1], j
    return best, end


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc", min_size=1, max_size=70), st.text(alphabet="abc", max_size=90))
def test_bit_parallel_distance(pattern, text):
    assert decontam.myers_search(decontam.pattern_masks(pattern), len(pattern), text) == edit_search(pattern, text)


def test_every_match_in_budget_is_found():
    draw = random.Random(3)
    items = [(i, decontam.normalised(prose(i, 25))) for i in range(12)]
    matcher = decontam.Matcher(items)
    for trial in range(150):
        number, item = items[trial % 12]
        chars = list(item)
        for _ in range(draw.randrange(0, len(item) // 10 + 1)):
            at = draw.randrange(len(chars))
            kind = draw.randrange(3)
            chars[at : at + (kind != 1)] = [] if kind == 0 else [draw.choice("qzj")]
        text = decontam.normalised(prose(500 + trial, 40) + " " + "".join(chars) + " " + prose(900 + trial, 40))
        expected = edit_search(item, text)[0]
        found = {(i, d) for i, d, _, _ in matcher.matches(text)}
        assert found == ({(number, expected)} if expected <= len(item) // 10 else set())


def test_contamination_of_documents(spark, docs):
    item = prose(1, 20)
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (1, item), (4, prose(2, 20))], "item_id long, text string")
    text = f"Start here.\n{item.upper().replace(' ', '  ', 3)} and   more"
    rows = [(10, text), (11, None), (12, ""), (13, prose(3, 50)), (10, text), (None, item)]
    got = decontam.find_contamination(docs(rows), benchmark).collect()
    assert sorted((r["doc_id"] or -1, r["item_id"], r["distance"]) for r in got) == [(-1, 1, 0), (10, 1, 0), (10, 1, 0)]
    place = next(r for r in got if r["doc_id"] == 10)
    assert decontam.normalised(text[place["start_char"] : place["end_char"]]) == item
    full = docs(rows).withColumn("n_chars", F.char_length("text").cast("long"))
    left = {r["doc_id"]: r for r in decontam.without_contamination(full, benchmark).collect()}
    assert set(left) == {10, 11, 12, 13} and left[10]["text"] == "Start here.\n and   more" and left[10]["n_chars"] == 23
    assert decontam.find_contamination(docs([]), benchmark).count() == 0
    assert decontam.find_contamination(docs(rows), benchmark.limit(0)).count() == 0


def test_short_items_are_not_searched_for(spark, docs):
    items = ["yes", "a", "is fine", "", "one two three four", "one two three four five", "四十二" * 13, "四十二" * 14, "it is a b c"]
    assert [decontam.is_searched(decontam.normalised(x)) for x in items] == [False, False, False, False, False, True, False, True, False]
    benchmark = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "item_id long, text string")
    rows = [(1, "Yes, a banana eyes data is fine"), (2, "one two three four five six"), (3, "四十二" * 20)]
    left = {r["doc_id"]: r["text"] for r in decontam.without_contamination(docs(rows), benchmark).collect()}
    assert left == {1: rows[0][1], 2: " six"}
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_contamination(docs(rows), benchmark).collect()} == {(2, 5), (3, 7)}


def test_sliding_entropy_equals_direct():
    data = np.frombuffer((prose(1, 40) + "a" * 80 + "é").encode(), dtype=np.uint8)
    got = digest.window_entropies(data)
    for i in (0, 1, 7, 100, len(got) - 1):
        counts = np.bincount(data[i : i + digest.WINDOW])
        p = counts[counts > 0] / digest.WINDOW
        assert abs(got[i] - round(-(p * np.log2(p)).sum() / math.log2(digest.WINDOW) * digest.SCALE)) <= 1


def test_digests(docs):
    rows = [(1, prose(1, 300)), (2, prose(1, 300)), (3, None), (4, ""), (5, "tiny"), (6, prose(2, 8)), (7, prose(3, 4000)), (None, prose(4, 100)), (7, prose(3, 4000)), (8, "a" * 500)]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = digest.fingerprint_documents(docs(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    expected = []
    for i, (doc, text) in enumerate(ordered):
        change = digest.edited(text or "", ordered[(i + 1) % len(rows)][1] or "")
        expected.append((doc or -1, len(text or ""), hashlib.sha256(change.encode()).hexdigest()))
    assert sorted((r["doc_id"] or -1, r["n_chars"], r["edited_sha256"]) for r in got) == sorted(expected)
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] and by_id[1]["near_next"] == 1.0
    assert by_id[1]["near_edited"] > 0.5 and by_id[7]["near_edited"] > 0.5 and by_id[2]["near_next"] < 0.3
    assert by_id[3]["fingerprint"] == "0:" and all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    one = digest.fingerprint_documents(docs([(1, "abcdefgh")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one["near_next"] == 1.0
    assert digest.fingerprint_documents(docs([])).count() == 0


def test_digest_of_a_text_ignores_its_neighbours():
    ranks = digest.rank_table(np.arange(digest.SCALE + 1)[::-1])
    texts = [prose(i, 5 + 40 * i).encode() for i in range(6)]
    together = digest.digests(texts, ranks)
    assert all(np.array_equal(x, digest.digests([t], ranks)[0]) for t, x in zip(texts, together))


def maximal_by_recursion(scores, low=0, high=None):
    """Maximal segments by their definition: the best one, then the same on either side.

    Of segments with equal scores the shortest counts, since no part of a maximal
    segment scores as much as all of it.
    """
    high = len(scores) if high is None else high
    best, place = 0.0, None
    for a in range(low, high):
        total = 0.0
        for b in range(a, high):
            total += scores[b]
            shorter = place and abs(total - best) <= 1e-9 and b + 1 - a < place[1] - place[0]
            if total > best + 1e-9 or shorter:
                best, place = total, (a, b + 1)
    if place is None:
        return []
    return maximal_by_recursion(scores, low, place[0]) + [place] + maximal_by_recursion(scores, place[1], high)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([None, None, 3.0, 1.5, -1.0, -2.25]), max_size=18))
def test_maximal_segments(values):
    sparse = [(i, v) for i, v in enumerate(values) if v is not None]
    dense = [-0.25 if v is None else v for v in values]
    got = toxicity.maximal_segments(sparse, -0.25, len(values))
    assert abs(sum(s for _, _, s in got) - sum(sum(dense[a:b]) for a, b in maximal_by_recursion(dense))) < 1e-9
    assert all(abs(s - sum(dense[a:b])) < 1e-9 for a, b, s in got)


def test_toxicity_learns_and_generalises(spark, docs):
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 60).split()
        toxic = i % 5 == 0
        if toxic:
            for k in (5, 9, 14, 20):
                words[k] = ("grumbly", "snarfing", "bletchous")[(i + k) % 3] + ("", "ly", "ness")[(i + k) % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), "x"))
    labels += [(5, None, "x"), (9999, 1, "x"), (None, 1, "x"), (7, 0, "x")]
    table = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    all_rows = [*rows, (5000, None), (5001, ""), (None, "amber"), (3, rows[3][1])]
    model = toxicity.fit(docs(all_rows), table)
    got = toxicity.score_documents(docs(all_rows), model).collect()
    assert len(got) == len(all_rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    assert sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held) >= 0.95 * len(held)
    full = docs(rows)
    kept = {r["doc_id"] for r in toxicity.keep_clean(full, model).collect()}
    assert len([i for i in kept if i % 5]) >= 315 and len([i for i in kept if i % 5 == 0]) <= 8


def test_toxicity_without_labels(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs([(1, "amber")]), empty)
    assert [r["predicted"] for r in toxicity.score_documents(docs([(1, "amber")]), model).collect()] == [0]
    assert toxicity.score_documents(docs([]), model).count() == 0


@pytest.fixture()
def files(spark):
    def make(rows):
        return spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, license string")

    return make


def cosine(text, template, weights):
    counts = {}
    for w in "".join(c if c.isalnum() else " " for c in text.lower()).split():
        counts[w] = counts.get(w, 0) + 1
    other = licenses.template_counts()[template]
    x, y = ({w: n * weights[w] for w, n in c.items()} for c in (counts, other))
    dot = sum(v * y[w] for w, v in x.items() if w in y)
    return dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())) if x else 0.0


def plain_weights(texts):
    """Inverse document frequency of every word of the texts and templates."""
    words = lambda text: {w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()}
    held = [words(t) for t in texts]
    every = set().union(*held, *licenses.template_counts())
    return {w: math.log((1 + len(texts)) / (1 + sum(w in h for h in held))) + 1 for w in every}


def plain_best(text, weights):
    """The best cosine of the whole text, its lines and all runs of its pieces within reach of a template."""
    pieces = re.split(licenses.PIECE_CUT, text)
    best = 0.0
    for t, template in enumerate(licenses.template_counts()):
        units = [text, *text.split("\n")]
        for i in range(len(pieces)):
            for j in range(i + 1, len(pieces) + 1):
                run = " ".join(pieces[i:j])
                if len(re.findall(r"[^\W_]+", run)) > licenses.REACH * sum(template.values()):
                    break
                units.append(run)
        best = max([best, *(cosine(u, t, weights) for u in units)])
    return best


def test_licenses(files, spark):
    mit, gpl = licenses.TEMPLATES[4][1], licenses.TEMPLATES[5][1]
    rows = [
        ("a/LICENSE", mit), ("a/b/c/code.py", prose(1, 30)), ("a/b/COPYING", gpl), ("a/b/c/d/x.py", None), ("z/y.py", prose(2, 20)), ("a/h.py", prose(3, 40) + "\nReleased under the MIT License.\n" + prose(4, 10)),
        (None, prose(5, 10)), ("top.py", ""), ("a/e.py", "amber"), ("a/e.py", "amber"), ("q/n.py", "Licensed under nothing at all, as the birch and cedar say."),
    ]
    got = licenses.scan_licenses(files(rows)).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: (r["license"], r["origin"], r["from_path"]) for r in got}
    assert found[0] == ("MIT", "file", None) and found[2] == ("GPL-3.0-only", "file", None) and found[5] == ("MIT", "header", None)
    assert found[1] == found[3] == ("GPL-3.0-only", "inherited", "a/b/COPYING") and found[8] == found[9] == ("MIT", "inherited", "a/LICENSE")
    assert all(found[i] == (None, None, None) for i in (4, 6, 7, 10))
    # equal rows count once
    weights = plain_weights([t for _, t in dict.fromkeys((i - (i == 9), t) for i, (_, t) in enumerate(rows))] + ["amber"])
    for doc, path in enumerate(rows):
        best = plain_best(path[1] or "", weights)
        own = next(r for r in got if r["doc_id"] == doc)
        assert (best >= 0.8) == (own["origin"] in ("file", "header")) and (best < 0.8 or abs(own["score"] - best) < 1e-6 or own["origin"] == "file")
    assert licenses.scan_licenses(files([])).count() == 0


def test_prose_with_a_notice_is_no_licence_file(files):
    notice = "Released under the MIT License."
    long = prose(90, 400).split()
    rows = [("p/book.txt", f"{' '.join(long[:200])}. {notice} {' '.join(long[200:])}"), ("p/near.txt", f"{prose(91, 8)}. {notice}"), ("p/plain.txt", prose(92, 30)), ("n/LICENSE.md", f"{prose(93, 30)}. {notice}"), ("n/code.py", prose(94, 30)),
            ("n/deep/er/x.py", prose(95, 10)), ("m/license_notes/x.py", prose(96, 10)), ("m/license_notes/y.txt", notice + " " + prose(97, 20))]
    found = {r["doc_id"]: (r["license"], r["origin"], r["from_path"]) for r in licenses.scan_licenses(files(rows)).collect()}
    assert found[0] == found[1] == ("MIT", "header", None) and found[2] == (None, None, None) and found[7][1] == "header" and found[6] == (None, None, None)
    assert found[3] == ("MIT", "file", None) and found[4] == found[5] == ("MIT", "inherited", "n/LICENSE.md")
    weights = plain_weights([t for _, t in rows])
    assert cosine(rows[0][1], 2, weights) < 0.3 and plain_best(rows[0][1], weights) > 0.99


def test_nothing_that_grows_goes_through_the_driver(files, spark, monkeypatch):
    """Joins send only the templates' table, though Spark takes all others for small too."""
    plans, save = [], licenses.Scratch.save
    seen = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(licenses.Scratch, "save", lambda self, name, df: (seen(df), save(self, name, df))[1])
    rows = [("a/LICENSE", licenses.TEMPLATES[4][1]), *((f"a/{i % 7}/{i}.py", prose(i, 30) + ("\nReleased under the MIT License.\n" if i % 5 == 0 else "")) for i in range(300))]
    seen(found := licenses.scan_licenses(files(rows)))
    assert found.filter("origin = 'inherited' and from_path = 'a/LICENSE'").count() == 240
    sent = [x for plan in plans for x in re.findall(r"BroadcastExchange.*?(Scan [^\[]*\[\w+)", plan, re.DOTALL)]
    assert len(plans) == 9 and sent and set(sent) == {"Scan ExistingRDD[word"}


def test_licences_are_inherited_by_directory(spark):
    draw = random.Random(9)
    paths = ["top.py", "/x.py", "/a/x.py", "a//x.py", "a/b/", "", None, "a//b/LICENSE", "a/LICENSE", "/a/LICENSE"]
    paths += ["/".join([*(draw.choice("abc") for _ in range(draw.randrange(5))), f"{i}.py"]) for i in range(300)]

    def expected(origin, licensed):
        out = []
        for i, path in enumerate(paths):
            found = None
            if path is not None and origin[i] is None:
                names = path.split("/")[:-1]
                for k in range(len(names), -1, -1):
                    found = min((p for p in licensed if p.rpartition("/")[0] == "/".join(names[:k])), default=None)
                    if found is not None:
                        break
            if origin[i] is None:
                out.append((i, path, "L-" + found if found else None, 1.0 if found else None, "inherited" if found else None, found))
        return out

    for share in (0.0, 0.05, 0.5):
        origin = [("file" if i in (7, 8, 9) and share or i > 9 and draw.random() < share else None) for i in range(len(paths))]
        rows = [(i, p, (True, 1.0, f"L-{p}") if o else None, o) for i, (p, o) in enumerate(zip(paths, origin, strict=True))]
        table = spark.createDataFrame(rows, "doc_id long, path string, own struct<granted: boolean, score: double, license: string>, origin string")
        got = sorted(map(tuple, licenses.inherited(table, licenses.Scratch(spark, "test")).collect()))
        assert got == expected(origin, [p for p, o in zip(paths, origin, strict=True) if o])


def test_anchors_lose_nothing():
    weights = {w: 1.0 + len(w) for w in set().union(*licenses.template_counts())}
    chosen = set(licenses.anchors(weights, 0.8))
    for counts in licenses.template_counts():
        squares = {w: (c * weights[w]) ** 2 for w, c in counts.items()}
        assert sum(s for w, s in squares.items() if w not in chosen) < 0.64 * sum(squares.values())


def test_words_are_words():
    assert WORDS and toxicity.forms_of("grumblyness") == ("grumblyness", "grumb~", "grumbly~")


WRAPPED_MPL = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\n"


def wrapped(text, width=70, mark="// "):
    lines, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            lines.append(line)
            line = ""
        line += w + " "
    return "".join(mark + x.rstrip() + "\n" for x in [*lines, line])


def test_licenses_across_and_inside_lines(files, spark):
    texts = dict(enumerate(x for _, x in licenses.TEMPLATES))
    of = lambda name, least=60: next(x for n, x in licenses.TEMPLATES if n == name and len(x.split()) >= least)
    code = "".join(f"x{i} = call({prose(i, 4)})\n" for i in range(60))
    rows = [
        ("b/mpl.c", WRAPPED_MPL + code), ("b/mit.c", wrapped("Copyright (c) 2020 Someone " + texts[4]) + code), ("b/gpl.c", wrapped(of("GPL-3.0-or-later")) + code),
        ("b/in.py", "Copyright 2020 Someone and others, see the list. Released under the MIT License. " + prose(70, 30)),
        ("isc/LICENSE", wrapped("ISC License Copyright (c) 2020 Someone " + [x for n, x in licenses.TEMPLATES if n == "ISC"][-1], mark="")), ("isc/a/code.py", prose(71, 30)),
        ("bsd/LICENSE", wrapped("Copyright (c) 2020, Someone. All rights reserved. " + of("BSD-3-Clause"), mark="")), ("two/LICENSE", wrapped("Copyright (c) 2020, Someone. All rights reserved. " + of("BSD-2-Clause"), mark="")),
        ("agpl/COPYING", wrapped(of("AGPL-3.0-only"), mark="") + "\n".join(prose(i, 12) for i in range(80, 180))), ("agpl/code.py", prose(72, 30)),
        ("r/notice.txt", prose(73, 20) + "\nAll rights reserved.\n" + prose(74, 20)), ("r/code.py", prose(75, 20)), ("b/both.c", "Copyright Someone. All rights reserved.\nReleased under the MIT License.\n" + code),
    ]
    rows.append(rows[1])
    found = {r["doc_id"]: (r["license"], r["origin"]) for r in licenses.scan_licenses(files(rows)).collect()}
    assert [found[i] for i in range(4)] == [(x, "header") for x in ("MPL-2.0", "MIT", "GPL-3.0-or-later", "MIT")] and found[13] == found[1]
    assert found[4] == ("ISC", "file") and found[5] == ("ISC", "inherited") and found[6] == ("BSD-3-Clause", "file") and found[7] == ("BSD-2-Clause", "file")
    assert found[8] == ("AGPL-3.0-only", "file") and found[9] == ("AGPL-3.0-only", "inherited")
    assert found[10] == (licenses.RESERVED, "header") and found[11] == (None, None) and found[12] == ("MIT", "header")


def test_segment_scan_is_linear():
    """Every candidate of a falling total starts lower than all before it; a scan of them all wouldn't end."""
    many = [(10 * i, 1.0) for i in range(300_000)]
    assert len(toxicity.maximal_segments(many, -0.5, 3_000_000)) == 300_000
