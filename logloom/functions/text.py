"""Scalar functions over texts and content blocks, as Column expressions.

Lengths are in code points throughout; a UTF-16 length would count characters
beyond the basic plane twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the density estimate.
CHARS_PER_TOKEN, BLOCK_OVERHEAD, ROLE_OVERHEAD = 4, 4, 4
PRUNE_MARKER = "\n[...]\n"
#: White space of Unicode, also the non-breaking and ideographic spaces.
SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

# Terminal escapes and characters that a one-line title can't hold.
_TITLE_NOISE = (
    r"(?s)(?:\x1B\]|\x{9D})(?:(?!\x07|\x1B\\).)*(?:\x07|\x1B\\|\z)",
    r"(?:\x1B\[|\x{9B})[0-?]*[ -/]*[@-~]",
    r"\x1B[@-_]",
    r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]",
    r"[\x{200B}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}]",
)
#: What any of these begins with.
_NOISE = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}\x{200B}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}]"


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def collapse_space(text: Column) -> Column:
    # a plain space that stands alone stays as it is
    return F.regexp_replace(text, f"(?! (?!{SPACE})){SPACE}+", " ")


def strip_end(text: Column) -> Column:
    return F.regexp_replace(text, rf"{SPACE}+\z", "")


def join_text(parts: Column) -> Column:
    """Trimmed parts that aren't empty, one per line."""
    trimmed = F.transform(F.filter(parts, lambda x: x.isNotNull()), strip_space)
    return F.array_join(F.filter(trimmed, lambda x: x != ""), "\n")


def text_tokens(text: Column) -> Column:
    """Estimated tokens of one text block; null counts as empty."""
    return (F.ceil(F.char_length(F.coalesce(text, F.lit(""))) / CHARS_PER_TOKEN) + BLOCK_OVERHEAD).cast("long")


def block_tokens(block: Column) -> Column:
    """Estimated tokens of a content block (type, text, name, arguments, json).

    Text and reasoning are priced by their text, tool calls by name and arguments
    separately, any other block by the length of its JSON.
    """
    size = lambda c: F.ceil(F.char_length(F.coalesce(c, F.lit(""))) / CHARS_PER_TOKEN)
    typed = F.when(block["type"].isin("text", "reasoning"), size(block["text"])).when(
        block["type"] == "tool-call", size(block["name"]) + size(block["arguments"])
    )
    return (typed.otherwise(size(block["json"])) + BLOCK_OVERHEAD).cast("long")


def content_tokens(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda total, b: total + block_tokens(b))


def message_tokens(blocks: Column) -> Column:
    return content_tokens(blocks) + ROLE_OVERHEAD


def system_tokens(blocks: Column) -> Column:
    """Estimated tokens of a system prompt: its text as one string; none for no blocks."""
    size = lambda b: F.char_length(F.coalesce(F.when(b["type"] == "text", b["text"]).otherwise(b["json"]), F.lit("")))
    total = F.aggregate(blocks, F.lit(0), lambda n, b: n + size(b))
    return F.when(F.size(blocks) > 0, F.ceil(total / CHARS_PER_TOKEN) + ROLE_OVERHEAD).otherwise(0).cast("long")


def tools_tokens(tools: Column) -> Column:
    """Estimated tokens of a request's tool schemas, given as one JSON array; none for null or an empty one."""
    return F.when(F.coalesce(tools, F.lit("[]")) != "[]", F.ceil(F.char_length(tools) / CHARS_PER_TOKEN) + BLOCK_OVERHEAD).otherwise(0).cast("long")


def preview(parts: Column, limit: int) -> Column:
    """Space-joined, white space collapsed, cut to ``limit`` with an ellipsis."""
    whole = strip_space(collapse_space(F.array_join(parts, " ")))
    cut = F.concat(strip_end(F.substring(whole, 1, limit - 1)), F.lit("…"))
    return F.when(F.char_length(whole) > limit - 1, cut).otherwise(whole)


def clean_title(text: Column) -> Column:
    """One trimmed line without terminal escapes, control and direction characters."""
    clean = text
    for noise in _TITLE_NOISE:
        clean = F.regexp_replace(clean, noise, "")
    # one look at a text without any of them; what is collapsed has plain spaces alone
    return F.trim(collapse_space(F.when(text.rlike(_NOISE), clean).otherwise(text)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it.

    The engine shares no common parts inside functions of lambdas; an array of one binds them to a name.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def truncate_utf8(text: Column, max_bytes: int) -> Column:
    """The longest code-point prefix within ``max_bytes`` of UTF-8.

    A prefix in bytes ends inside a character where the next byte continues one; up
    to three bytes are then given up.
    """
    if max_bytes <= 0:
        raise ValueError("max_bytes must be positive")

    def shortened(raw: Column) -> Column:
        def back(at: Column) -> Column:
            following = F.conv(F.hex(F.substring(raw, at + 1, F.lit(1))), 16, 10).cast("int")
            return F.when((following >= 128) & (following < 192), at - 1).otherwise(at)

        cut = F.lit(max_bytes)
        for _ in range(3):
            cut = bound(cut, back)
        return F.decode(F.substring(raw, F.lit(1), cut), "UTF-8")

    return bound(text, lambda text: F.when(F.octet_length(text) <= max_bytes, text).otherwise(bound(F.encode(text, "UTF-8"), shortened)))


def normal_title(text: Column, max_bytes: int) -> Column:
    return strip_end(truncate_utf8(clean_title(text), max_bytes))


def fallback_title(text: Column, max_words: int, max_bytes: int) -> Column:
    """The leading words of a first prompt within both limits."""
    if max_words <= 0:
        raise ValueError("max_words must be positive")
    return strip_end(truncate_utf8(F.substring_index(clean_title(text), " ", max_words), max_bytes))


def prune_middle(text: Column, threshold: int, head: int, tail: int, marker: str = PRUNE_MARKER) -> Column:
    """Head, marker and tail of a text over the threshold; others unchanged."""
    if head + len(marker) + tail > threshold:
        raise ValueError("head, marker and tail must fit the threshold")
    cut = F.concat(F.substring(text, 1, head), F.lit(marker), F.right(text, F.lit(tail)) if tail else F.lit(""))
    return F.when(F.char_length(text) > threshold, cut).otherwise(text)


def prune_blocks(blocks: Column, threshold: int, head: int, tail: int, marker: str = PRUNE_MARKER) -> Column:
    """The middle of all text blocks together replaced by one marker; other blocks stay.

    ``blocks`` is an array of (type, text).  Blocks whose text is gone are left out.
    """
    if head + len(marker) + tail > threshold:
        raise ValueError("head, marker and tail must fit the threshold")
    size = lambda b: F.when(b["type"] == "text", F.char_length(b["text"])).otherwise(0)
    sizes = F.transform(blocks, size)
    total = F.aggregate(sizes, F.lit(0), lambda a, b: a + b)
    low, high = F.lit(head), total - tail

    def cut(b: Column, i: Column) -> Column:
        start = F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda a, x: a + x)
        length = size(b)
        keep_head = F.least(length, F.greatest(F.lit(0), low - start))
        keep_tail = F.greatest(F.lit(0), length - F.least(length, F.greatest(F.lit(0), high - start)))
        # the first block that reaches past the head holds the marker
        marked = (start < high) & (start + length > low) & (start <= low)
        text = F.concat(F.substring(b["text"], F.lit(1), keep_head), F.when(marked, marker).otherwise(""), F.right(b["text"], keep_tail))
        return F.when(b["type"] == "text", b.withField("text", text)).otherwise(b)

    pruned = F.filter(F.transform(blocks, cut), lambda b: (b["type"] != "text") | (b["text"] != ""))
    return F.when(total > threshold, pruned).otherwise(blocks)


def literal_pattern(text: str) -> str:
    """A pattern for literal text, any case, any white space between its words."""
    words = text.split()
    if not words:
        raise ValueError("a text filter must hold more than white space")
    escaped = ["".join(rf"\{c}" if c in r".*+?^${}()|[]\\-" else c for c in w) for w in words]
    return "(?iu)" + f"{SPACE}+".join(escaped)


def glob_pattern(pattern: str) -> str:
    """A path glob as a pattern: ``*`` and ``?`` stop at "/", ``**`` doesn't.

    A plain name without a dot in its last part is a directory and holds all below.
    """
    out, i = "", 0
    while i < len(pattern):
        rest = pattern[i:]
        if rest.startswith("**/"):
            out, i = out + "(?:.*/)?", i + 3
        elif rest.startswith("/**"):
            out, i = out + "(?:/.*)?", i + 3
        elif rest.startswith("**"):
            out, i = out + ".*", i + 2
        elif rest[0] in "*?":
            out, i = out + ("[^/]*" if rest[0] == "*" else "[^/]"), i + 1
        else:
            out, i = out + (rf"\{rest[0]}" if rest[0] in r".+^${}()|[]\\" else rest[0]), i + 1
    directory = not any(c in pattern for c in "*?") and "." not in pattern.rsplit("/", 1)[-1]
    return rf"\A{out}{'(?:/.*)?' if directory else ''}\z"


def matches_glob(path: Column, pattern: str) -> Column:
    return path.rlike(glob_pattern(pattern))


def is_kept(path: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Whether a path passes the include list (if given) and none of the exclude list."""
    any_of = lambda patterns: F.greatest(F.lit(False), F.lit(False), *(matches_glob(path, p) for p in patterns))
    kept = F.lit(True) if include is None else any_of(include)
    return kept if exclude is None else kept & ~any_of(exclude)
