"""Heads and tails of contents under a token budget, and bounded previews."""

from __future__ import annotations

import difflib
import hashlib
import json
import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.text import BLOCK_OVERHEAD, CHARS_PER_TOKEN


def _cost(text: str) -> int:
    return math.ceil(len(text) / CHARS_PER_TOKEN) + BLOCK_OVERHEAD


def _room(budget: int) -> int:
    """Code points that a text block of this budget can hold."""
    return max(0, budget - BLOCK_OVERHEAD) * CHARS_PER_TOKEN if budget > BLOCK_OVERHEAD else 0


def _fitting(texts: list[str], budget: int, part: Callable[[str, int], str]) -> tuple[list[str], int]:
    """The first texts whose running cost stays within the budget, and ``part`` of the next; and how many are whole."""
    totals = list(accumulate(map(_cost, texts)))
    whole = bisect_right(totals, budget)
    room = _room(budget - (totals[whole - 1] if whole else 0))
    more = part(texts[whole], room) if whole < len(texts) and room else ""
    return [*texts[:whole], *([more] if more else [])], whole


def head_and_tail(texts: list[str], budget: int) -> tuple[list[str], list[str], int]:
    """Texts kept from either end, each within half the budget, and omitted bytes.

    The tail is chosen as the head is, from what the head leaves, read backwards.
    """
    head, whole = _fitting(texts, budget - budget // 2, lambda text, room: text[:room])
    rest = texts[whole:]
    if len(head) > whole:
        rest = [rest[0][len(head[whole]) :], *rest[1:]]
    tail, _ = _fitting(rest[::-1], budget // 2, lambda text, room: text[-room:])
    size = lambda parts: sum(len(x.encode("utf-8", "surrogatepass")) for x in parts)
    return head, tail[::-1], size(texts) - size(head) - size(tail)


def retain(texts: Column, budget: int) -> Column:
    """(head, tail, omitted_bytes) of an array of texts; null is an empty array."""
    if budget < 0:
        raise ValueError("budget must not be negative")

    @F.pandas_udf("head array<string>, tail array<string>, omitted_bytes long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [head_and_tail([] if x is None else [t or "" for t in x], budget) for x in batch]
            yield pd.DataFrame(rows, columns=["head", "tail", "omitted_bytes"])

    return run(texts)


#: What stands between a preview's ends, and the notice behind it.
GAP = "\n\n[...]\n\n"
SPILL_NOTICE = "(Omitted {} bytes. Full formatted result stored at: {}. {})"
SPILL_HINT = "Use read with offset/limit, or grep this path to search within it."
CUT_NOTICE = "\n[… omitted {} UTF-8 bytes …]"


def bounded_result(texts: list[str], locator: str, budget: int, hint: str = SPILL_HINT) -> tuple[str, bool, int]:
    """A result's text within a token budget, whether it was cut, and omitted bytes.

    What goes is replaced by a gap, and a notice behind tells where the whole is.  A
    result stays whole if it fits, or if not even the notice does.
    """
    total = sum(len(x.encode("utf-8", "surrogatepass")) for x in texts)
    longest = SPILL_NOTICE.format(total, locator, hint)
    if sum(map(_cost, texts)) <= budget or _cost(longest) > budget:
        return "".join(texts), False, 0
    head, tail, omitted = head_and_tail(texts, max(0, budget - _cost(GAP) - _cost("\n\n" + longest)))
    notice = SPILL_NOTICE.format(omitted, locator, hint)
    return ("".join([*head, GAP, *tail, "\n\n", notice]) if head or tail else notice), True, omitted


def bound_inline(texts: Column, locator: Column, budget: int, hint: str = SPILL_HINT) -> Column:
    """(text, spilled, omitted_bytes) of a tool result's text blocks; null blocks are empty.

    ``locator`` names where the whole text is kept; without one nothing is cut.
    """

    @F.pandas_udf("text string, spilled boolean, omitted_bytes long")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for blocks, places in batches:
            held = [[] if x is None else [t or "" for t in x] for x in blocks]
            rows = [bounded_result(x, at, budget, hint) if at is not None else ("".join(x), False, 0) for x, at in zip(held, places)]
            yield pd.DataFrame(rows, columns=["text", "spilled", "omitted_bytes"])

    return run(texts, locator)


def _size(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass"))


def _tag_safe(value: object) -> str:
    """JSON that holds no literal opening tag."""
    return json.dumps(value, ensure_ascii=False, separators=(",", ":")).replace("<", "\\u003c")


def ends_with_notice(text: str, limit: int) -> tuple[str, int]:
    """The longest two ends of a text that fit ``limit`` bytes with a notice of the omitted ones."""
    data = text.encode("utf-8", "surrogatepass")
    if len(data) <= limit:
        return text, 0

    def shown(kept: int) -> tuple[str, int]:
        head, tail = data[: kept - kept // 2], data[len(data) - kept // 2 :]
        ends = [head.decode("utf-8", "ignore"), tail.decode("utf-8", "ignore")]
        omitted = len(data) - sum(map(_size, ends))
        return "".join(ends) + CUT_NOTICE.format(omitted), omitted

    # what is shown never shrinks when more is kept
    fits = bisect_right(range(max(0, limit) + 1), limit, key=lambda kept: _size(shown(kept)[0]))
    return shown(fits - 1) if fits else ("", len(data))


def fit_transcript(facts: dict, messages: list[dict], budget: int) -> tuple | None:
    """JSON of a conversation within ``budget`` bytes, with counts; None if the facts alone don't fit.

    First the oldest messages go, other than checkpoints and the newest; then the
    longest left is cut, again and again, to what the excess leaves of it.
    """
    frame = _size(_tag_safe({**facts, "conversation": []}))
    weigh = lambda role, text: _size(_tag_safe({"role": role, "text": text})) + 1
    weights = [weigh(m["role"], m["text"]) for m in messages]
    # a list of n items has n - 1 commas
    excess = frame + sum(weights) - bool(messages) - budget
    loose = [i for i, m in enumerate(messages[:-1]) if not m["checkpoint"]]
    freed = list(accumulate(weights[i] for i in loose))
    gone = set(loose[: min(len(loose), bisect_left(freed, excess) + 1)] if excess > 0 else [])
    excess -= sum(weights[i] for i in gone)
    kept = [i for i in range(len(messages)) if i not in gone]
    texts, lost = {i: messages[i]["text"] for i in kept}, dict.fromkeys(kept, 0)
    while excess > 0:
        longest = max(kept, key=lambda i: _size(texts[i]), default=None)
        if longest is None or not texts[longest]:
            return None
        role, before = messages[longest]["role"], texts[longest]
        texts[longest], lost[longest] = ends_with_notice(messages[longest]["text"], max(0, _size(before) - excess))
        if texts[longest] == before:
            return None
        excess += weigh(role, texts[longest]) - weigh(role, before)
    omitted = sum(lost.values()) + sum(_size(messages[i]["text"]) for i in gone)
    data = _tag_safe({**facts, "conversation": [{"role": messages[i]["role"], "text": texts[i]} for i in kept]})
    return data, any(m["checkpoint"] for m in messages), len(messages), len(kept), len(gone), omitted, bool(gone) or omitted > 0


def capped_transcript(session: Column, messages: Column, budget: int) -> Column:
    """A session's conversation as JSON of at most ``budget`` bytes, and what it lost.

    Args:
        session: a struct of session_id, label, cwd and captured_through_seq; it is
            kept whole, and the result is null where it alone exceeds the budget.
        messages: role, text and checkpoint, in order; null texts and empty ones take
            no part.
    """
    facts = F.to_json(F.struct(session["session_id"].alias("sessionId"), session["label"].alias("label"), session["cwd"].alias("cwd"), session["captured_through_seq"].alias("capturedThroughSeq")), {"ignoreNullFields": "false"})
    said = F.filter(messages, lambda m: m["text"] != "")

    @F.pandas_udf("data string, compacted boolean, original long, retained long, omitted long, omitted_bytes long, truncated boolean")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for frames, lists in batches:
            rows = [fit_transcript(json.loads(x), [] if y is None else list(y), budget) or (None,) * 7 for x, y in zip(frames, lists)]
            yield pd.DataFrame(rows, columns=["data", "compacted", "original", "retained", "omitted", "omitted_bytes", "truncated"]).astype({c: "Int64" for c in ("original", "retained", "omitted", "omitted_bytes")})

    found = run(facts, said)
    return F.when(found["data"].isNotNull(), found)


def small_json(value: object, budget: int) -> str:
    """Valid JSON within ``budget`` bytes: strings cut, then items left out."""
    whole = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    if len(whole.encode()) <= budget:
        return whole
    if isinstance(value, str):
        low, high = 0, len(value)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if len(json.dumps(value[:mid] + "…", ensure_ascii=False).encode()) <= budget else (low, mid - 1)
        return json.dumps(value[:low] + "…", ensure_ascii=False) if budget >= 5 else "null"
    if isinstance(value, (list, dict)):
        kept: list | dict = [] if isinstance(value, list) else {}
        share = max(16, budget // max(1, len(value)))
        for item in value if isinstance(value, list) else value.items():
            key, inner = (None, item) if isinstance(value, list) else item
            short = json.loads(small_json(inner, share))
            trial = [*kept, short] if isinstance(value, list) else {**kept, key: short}
            if len(json.dumps(trial, ensure_ascii=False, separators=(",", ":")).encode()) > budget:
                break
            kept = trial
        return json.dumps(kept, ensure_ascii=False, separators=(",", ":"))
    return "null"


def json_preview(value: Column, budget: int) -> Column:
    """JSON texts within a byte budget; what isn't JSON becomes a cut JSON string."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text: str) -> str:
            try:
                return small_json(json.loads(text), budget)
            except ValueError:
                return small_json(text, budget)

        for batch in batches:
            yield batch.map(one, na_action="ignore")

    return run(value)


#: Fixed value: bytes of a field's JSON that stay in its event.
MAX_INLINE = 65536
PREVIEW_BYTES = 2048


def spill_members(text: str, most: int, preview: int) -> tuple[str, list[dict]]:
    """A JSON object with members beyond ``most`` bytes replaced by references, and their contents."""
    compact = lambda v: json.dumps(v, ensure_ascii=False, separators=(",", ":"))
    members, blobs = json.loads(text), []
    for name, value in members.items() if isinstance(members, dict) else ():
        content = compact(value).encode("utf-8", "surrogatepass")
        if len(content) > most:
            key = hashlib.sha256(content).hexdigest()
            members[name] = {"blob": {"sha256": key, "bytes": len(content), "path": f"blobs/{key[:2]}/{key}"}, "original_bytes": len(content), "preview": small_json(value, preview), "truncated": True}
            blobs.append({"key": key, "content": content})
    return compact(members), blobs


def spilled(payload: Column, most: int = MAX_INLINE, preview: int = PREVIEW_BYTES) -> Column:
    """A struct of payload (JSON text) and blobs (key, content) of a payload's large members.

    A member whose JSON takes more than ``most`` bytes becomes a reference to its blob
    with its size and a preview.  Payloads that are no objects stay; broken and null ones
    are null without blobs.
    """

    @F.pandas_udf("payload string, blobs array<struct<key: string, content: binary>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def one(text: str | None) -> tuple[str | None, list[dict]]:
            try:
                return spill_members(text, most, preview) if text is not None else (None, [])
            except ValueError:
                return None, []

        for batch in batches:
            found = [one(text) for text in batch]
            yield pd.DataFrame({"payload": [p for p, _ in found], "blobs": [b for _, b in found]})

    return run(payload)


def text_diff(before: Column, after: Column, context: int = 3) -> Column:
    """(hunks, added, deleted) between two texts, by lines; null counts as empty."""

    @F.pandas_udf("hunks long, added long, deleted long")
    def run(old: pd.Series, new: pd.Series) -> pd.DataFrame:
        rows = []
        for a, b in zip(old, new):
            lines = list(difflib.unified_diff((a or "").splitlines(), (b or "").splitlines(), n=context, lineterm=""))[2:]
            rows.append((sum(x.startswith("@@") for x in lines), sum(x.startswith("+") for x in lines), sum(x.startswith("-") for x in lines)))
        return pd.DataFrame(rows, columns=["hunks", "added", "deleted"])

    return run(before, after)


def numstat(listing: Column) -> Column:
    """NUL-separated change counts as an array of (path, renamed_from, added, deleted).

    A record is "added TAB deleted TAB path"; with an empty path the old and the new
    one follow as fields of their own.  Binary files have "-", which counts 0.
    """

    @F.pandas_udf("array<struct<path string, renamed_from string, added long, deleted long>>")
    def run(batch: pd.Series) -> pd.Series:
        def parse(text: str) -> list[dict]:
            fields, found = iter(text.split("\0")), []
            for field in fields:
                if not field:
                    continue
                added, deleted, path = field.split("\t", 2)
                old = None if path else next(fields)
                count = lambda x: 0 if x == "-" else int(x)
                found.append({"path": path or next(fields), "renamed_from": old, "added": count(added), "deleted": count(deleted)})
            return found

        return batch.map(parse, na_action="ignore")

    return run(listing)
