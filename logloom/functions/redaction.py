"""Secrets out of texts: known literals first, then pattern rules.

Hits are taken by start, then by rank (literals, longest first, before rules); hits
that overlap one taken before are left.  Marks are never hits, so a second run
changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rules by rank.
RULES = (
    ("private-key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----"),
    ("bearer", r"(?i)\bbearer\s+[A-Za-z0-9._~+/-]{8,}=*"),
    ("api-key", r"\b(?:sk|pk|ghp|gho|AKIA|xoxb)[-_A-Za-z0-9]{12,}\b"),
    ("assignment", r"(?i)\b(?:password|passwd|secret|token|api[_-]?key)\s*[:=]\s*[^\s,;\[]+"),
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
)
_COMPILED = tuple((name, re.compile(pattern, re.S)) for name, pattern in RULES)
#: What a text must hold for any rule to meet it; Python's case folding is the Unicode one.
_SUSPECT = r"(?iu)-----BEGIN|bearer|(?:sk|pk|ghp|gho|AKIA|xoxb)[-_A-Za-z0-9]{12}|password|passwd|secret|token|api[_-]?key|@"
_MARK = re.compile(r"\[redacted:[a-z-]+\]")


def redact_text(text: str, literals: Sequence[str] = ()) -> str:
    hits = [(m.start(), -1, m.end(), m[0]) for m in _MARK.finditer(text)]
    for literal in sorted({x for x in literals if x}, key=lambda x: (-len(x), x)):
        hits += [(m.start(), 0, m.end(), "[redacted:literal]") for m in re.finditer(re.escape(literal), text)]
    for rank, (name, rule) in enumerate(_COMPILED, 1):
        hits += [(m.start(), rank, m.end(), f"[redacted:{name}]") for m in rule.finditer(text)]
    out, at = [], 0
    for start, _, end, mark in sorted(hits, key=lambda h: (h[0], h[1], -h[2])):
        if start >= at:
            out += [text[at:start], mark]
            at = end
    return "".join([*out, text[at:]])


def redact(text: Column, literals: Sequence[str] = ()) -> Column:
    """``redact_text`` over a column; null stays null.

    Texts that no rule or literal can meet are told by the engine and never leave it.
    """
    known = tuple(x for x in literals if x)
    suspect = text.rlike(_SUSPECT)
    for literal in known:
        suspect = suspect | text.contains(literal)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: redact_text(t, known), na_action="ignore")

    return F.coalesce(run(F.when(suspect, text)), text)


def strip_fields(record: Column, secret: Sequence[str]) -> Column:
    """A struct without its secret fields, and which of them were set: (record, secrets)."""
    was_set = F.array(*(F.struct(F.lit(path).alias("path"), record[path].isNotNull().alias("set")) for path in secret))
    return F.struct(record.dropFields(*secret).alias("record"), was_set.alias("secrets"))
