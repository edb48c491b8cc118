import hashlib
import random
import re
import time

from logloom.llm import pii

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", m.start(), m.end()) for m in re.finditer(EMAIL, text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(CARD, text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", m.start(), m.end()) for m in re.finditer(PHONE, text) if 9 <= len(digits(m)) <= 15]


def base_of(text):
    return [s for s in pii.spans_in(text, AUTOMATON) if s[0] in pii.BASE]


AUTOMATON = pii.anchors()
PARTS = ["@", ".", "..", "a", "ab-c", "%x", "é", "z@y.de", "1.2.3.4", "300.1.1.1", "0255.1.1.001", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+", "+49", "(", ") ",
         "-", " ", "\n", "5500000000000004", "12", "007", "7", "://", "iban", "DE8", "1.2.3", "mail@x", "_", "+(5", "0" * 20, "٣", "😀"]


def test_base_spans_equal_the_patterns():
    draw = random.Random(11)
    for _ in range(6000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randrange(12)))
        assert base_of(text) == brute(text), text
        digits = "".join(draw.choice("0123456789 -.+()@a") for _ in range(draw.randrange(40)))
        assert base_of(digits) == brute(digits), digits


def test_anchors_add_what_the_patterns_miss():
    cases = {
        "mail jörg.müller@straße.example.de now": ("mailbox", "jörg.müller@straße.example.de"),
        "see https://ann:s3cret@host.example.org/x": ("login", "https://ann:s3cret@host.example.org"),
        "pay DE89 3704 0044 0532 0130 00 today": ("iban", "DE89 3704 0044 0532 0130 00"),
        "GB82WEST12345698765432.": ("iban", "GB82WEST12345698765432"),
        "Account no. 12345678, please": ("account", "12345678"),
        "SSN: 123-45-6789": ("account", "123-45-6789"),
        "Kontonummer 0012 3456 78!": ("account", "0012 3456 78"),
    }
    for text, (kind, value) in cases.items():
        added = [(k, text[a:b]) for k, a, b in pii.spans_in(text, AUTOMATON) if k not in pii.BASE]
        assert added == [(kind, value)], text
    for clean in ("DE89 3704 0044 0532 0130 01", "XDE89370400440532013000", "accounting 12345678", "account of 1999", "http://host:80/a@b", "no account 12345", "plain words, 12 of them."):
        assert [s for s in pii.spans_in(clean, AUTOMATON) if s[0] not in pii.BASE] == [], clean


def test_long_texts_take_linear_time():
    long = ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a://" * 80_000, "x@" * 150_000, "DE8" * 100_000, "account " * 40_000, "1 " * 150_000)
    began = time.perf_counter()
    assert [len(base_of(text)) for text in long] == [0, 0, 37_500, 0, 0, 0, 0, 0, 0]
    assert time.perf_counter() - began < 20


def test_report_of_documents(spark, docs):
    texts = ["write to a.b@c.example.com or +1 (017) 555-7713, 10.0.0.1", None, "", "clean words", "müller@straße.de"]
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[0])]
    got = pii.personal_data_report(docs(rows)).collect()
    assert len(got) == 7
    for r in got:
        text = texts[0] if r["doc_id"] is None else texts[r["doc_id"]] or ""
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text))
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest() and r["spans"].startswith(told)
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in brute(text)) for k in pii.BASE]
    assert {r["doc_id"]: r["spans"] for r in got}[4] == "mailbox:0:16"
    values = {x["value"] for r in pii.find_personal_data(docs(rows)).collect() for x in r["found"]}
    assert values == {"a.b@c.example.com", "+1 (017) 555-7713", "10.0.0.1", "müller@straße.de"}
    assert pii.personal_data_report(docs([])).count() == 0
