"""Personal data in whole texts: anchors by Aho-Corasick, boundaries by local parsers.

One automaton runs over each text and stops at at-signs, plus signs, digits, schemes
(``://``), country codes with a check digit and words that announce an identifier.
Each stop has a parser that expands from there to both sides and validates what it
meets, so a text is read once whatever the number of kinds.

Kinds of the base, each leftmost and without overlap in itself:

* ``email``: local part, at-sign, labels joined by dots (ASCII);
* ``ip``: four numbers of at most 255;
* ``card``: 13 to 19 digits, spaced or hyphenated, that pass Luhn's check;
* ``phone``: a plus sign and 9 to 15 digits.

A match that fails its check is dropped and nothing inside it is tried again.  Kinds
that anchors add, beside the base and possibly over it:

* ``mailbox``: an email with letters or digits beyond ASCII, from its own boundaries;
* ``login``: a URL with user and password before its host;
* ``iban``: an account number of its country's length whose checksum is right;
* ``account``: 6 to 30 digits, after up to four capitals, behind an announcing word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, text_or_empty

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "mailbox", "login", "iban", "account")
#: Words that announce an identifier, in the languages of the corpus.
CUES = ("account", "acct", "iban", "konto", "kontonummer", "compte", "cuenta", "passport", "passeport", "pasaporte", "reisepass", "ssn", "dni")
#: Length of an IBAN by country.
IBAN_LENGTHS = {
    "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21,
    "HU": 28, "IE": 22, "IT": 27, "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26,
}
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WIDE_DOMAIN = re.compile(r"(?:[^\W_]|-)+(?:\.(?:[^\W_]|-)+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SCHEME = re.compile(r"[A-Za-z0-9+.-]")
_USER = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_NUMBER = re.compile(r"(?:\x20?(?:no|nr|num|number|nummer|numéro|número)\b\.?)?\x20{0,2}[:#]?\x20{0,2}([A-Z]{0,4}[0-9](?:[\x20-]?[0-9]){5,29})(?![\x20-]?[0-9])", re.IGNORECASE)


def anchors() -> ahocorasick.Automaton:
    """All anchors; a value holds the parser's name and the anchor's length."""
    found: dict[str, str] = {"@": "at", "+": "plus", "://": "scheme"} | {d: "digit" for d in "0123456789"}
    found |= {code + d: "country" for code in IBAN_LENGTHS for d in "0123456789"}
    found |= {form: "cue" for cue in CUES for form in (cue, cue.upper(), cue.capitalize())}
    automaton = ahocorasick.Automaton()
    for anchor, parser in found.items():
        automaton.add_word(anchor, (parser, len(anchor)))
    automaton.make_automaton()
    return automaton


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        twice = int(d) * (1 + i % 2)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def passes_mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


class Reader:
    """The parsers over one text; ``spans`` are in order for each kind."""

    def __init__(self, text: str):
        self.text = text
        self.spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        #: Where the next match of a kind may begin.
        self.free = dict.fromkeys(KINDS, 0)

    def _take(self, kind: str, start: int, end: int, valid: bool = True) -> None:
        self.free[kind] = end
        if valid:
            self.spans[kind].append((start, end))

    def at(self, at: int, size: int) -> None:
        text, low, floor = self.text, at, self.free["email"]
        while low > floor and _LOCAL.match(text[low - 1]):
            low -= 1
        domain = _DOMAIN.match(text, at + 1)
        if low < at and domain:
            self._take("email", low, domain.end())
        wide, floor = at, self.free["mailbox"]
        while wide > floor and (text[wide - 1].isalnum() or text[wide - 1] in "._%+-"):
            wide -= 1
        domain = _WIDE_DOMAIN.match(text, at + 1)
        if wide < at and domain and not text[wide : domain.end()].isascii():
            self._take("mailbox", wide, domain.end())

    def plus(self, at: int, size: int) -> None:
        found = _PHONE.match(self.text, at)
        if found:
            self._take("phone", at, found.end(), 9 <= sum(c.isdigit() for c in found[0]) <= 15)

    def digit(self, at: int, size: int) -> None:
        text = self.text
        if at >= self.free["card"]:
            found = _CHAIN.match(text, at)
            if found:
                digits = found[0].replace(" ", "").replace("-", "")
                self._take("card", at, found.end(), 13 <= len(digits) <= 19 and passes_luhn(digits))
        if at >= self.free["ip"]:
            end = _DIGITS.match(text, at).end()
            found = _IP.match(text, at) if text[end : end + 1] == "." else None
            # no later start in a run of digits can match where the first doesn't
            self._take("ip", at, found.end() if found else end, bool(found) and all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in found[0].split(".")))

    def scheme(self, at: int, size: int) -> None:
        text, low = self.text, at
        while low > self.free["login"] and text[low - 1].isascii() and _SCHEME.match(text[low - 1]):
            low -= 1
        while low < at and not text[low].isalpha():
            low += 1
        found = _USER.match(text, at + size)
        if low < at and found:
            self._take("login", low, found.end())

    def country(self, at: int, size: int) -> None:
        text, left = self.text, IBAN_LENGTHS[self.text[at : at + 2]]
        if at < self.free["iban"] or text[max(0, at - 1) : at].isalnum():
            return
        chars, end = [], at
        while left and end < len(text):
            c = text[end]
            if c.isascii() and (c.isdigit() or c.isupper()):
                chars.append(c)
                left -= 1
            elif c != " " or text[end - 1] == " ":
                return
            end += 1
        if not left and not text[end : end + 1].isalnum() and chars[3].isdigit() and passes_mod97("".join(chars)):
            self._take("iban", at, end)

    def cue(self, at: int, size: int) -> None:
        text = self.text
        if text[max(0, at - 1) : at].isalnum() or text[at + size : at + size + 1].isalpha():
            return
        found = _NUMBER.match(text, at + size)
        if found and found.start(1) >= self.free["account"]:
            self._take("account", *found.span(1))


def spans_in(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points, end exclusive), by kind and start."""
    reader = Reader(text)
    parsers = {name: getattr(reader, name) for name in ("at", "plus", "digit", "scheme", "country", "cue")}
    for last, (parser, size) in automaton.iter(text):
        parsers[parser](last - size + 1, size)
    return [(kind, start, end) for kind in KINDS for start, end in reader.spans[kind]]


FOUND = "doc_id long, found array<struct<kind: string, start: long, end: long, value: string>>"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and found: kind, start, end (code points, end exclusive) and value of each span.

    A row per input row, also for null ids, repeated rows and texts with nothing in
    them; null texts count as empty, long ones are read whole, other columns are
    ignored, and an empty table gives no rows.  Spans stand by kind (as ``KINDS`` lists
    them) and start.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py()
                rows.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in spans_in(text, automaton)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(span))], names=["doc_id", "found"])

    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_or_empty(F.col("text").cast("string")).alias("text"))
    return texts.mapInArrow(scan, FOUND)


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [number(kind) for kind in BASE]
    return find_personal_data(docs).select("doc_id", *counts, F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("found")).alias("spans"))
