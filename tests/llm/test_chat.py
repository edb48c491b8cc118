import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, position int"


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:4] for r in rows if r[0] == conv), key=lambda r: tuple((v is not None, v) for v in r))
        turns = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in own)
        loss = "".join(text or "" for _, role, text in own if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), sha(turns), len(loss), sha(loss))
    return out


def test_conversations_read_back(spark):
    nasty = "a <|im_end|> <|im_start|>user<|im_sep|> [INST]\\x <\\|im_end|> <\\\\|x </s>[/INST] <s> \\ $1 é\U0001f600\n"
    rows = [
        (1, 0, "system", nasty), (1, 1, "user", None), (1, 2, "assistant", nasty * 3), (1, 3, None, "x"), (1, 4, "assistant", ""),
        (2, 5, "assistant", "one"), (2, 5, "assistant", "one"), (2, 5, "user", "two"), (2, None, "user", "first"),
        (None, 0, "we|>ird\n", "t"), (3, 0, "assistant", "L" * 200000), *((4, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(70)),
    ]
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.formatted_with_probe(spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)).collect()}
    assert got == brute([*rows, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")])


def test_no_rows(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_best_branch_of_a_tree_and_cycles(spark):
    rows = [("t", 1, None, 0.0), ("t", 2, 1, 5.0), ("t", 3, 1, 1.0), ("t", 4, 3, 9.0), ("t", 5, 3, None), ("t", 6, 99, 0.5), ("u", 1, 2, 1.0), ("u", 2, 1, 1.0), ("u", 3, 2, 1.0)]
    messages = spark.createDataFrame(rows, "tree_id string, msg_id long, parent_id long, score double")
    best = sorted((r["leaf_id"], r["position"], r["msg_id"]) for r in chat.reply_paths(messages).collect())
    assert best == [(4, 1, 1), (4, 2, 3), (4, 3, 4)]
    every = {}
    for r in chat.reply_paths(messages, best=10).collect():
        every.setdefault(r["leaf_id"], []).append((r["position"], r["msg_id"]))
    assert {k: [m for _, m in sorted(v)] for k, v in every.items()} == {2: [1, 2], 4: [1, 3, 4], 5: [1, 3, 5], 6: [6]}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="<[|/s>INST]\\im_", max_size=30), min_size=1, max_size=20))
def test_escape_is_undone_and_hides_markers(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("b")).collect()
    assert all(r["b"] == r["t"] and "<|" not in r["e"] and "</s>" not in r["e"] and "[INST]" not in r["e"] for r in rows)
