"""Personal data: parsers against plain patterns, kinds beyond the base, defined cases."""

from __future__ import annotations

import hashlib
import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from ledgerstar.llm import personal
from ledgerstar.llm.common import table
from tests.conftest import SF
from tests.llm.conftest import values

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def sums_to_ten(digits: str) -> bool:
    doubled = "0246813579"
    return sum(int(doubled[int(c)]) if i % 2 else int(c) for i, c in enumerate(digits[::-1])) % 10 == 0


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if kind == "ip":
                good = all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
            elif kind == "card":
                good = 13 <= len(digits) <= 19 and sums_to_ten(digits)
            else:
                good = kind == "email" or 9 <= len(digits) <= 15
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def base(text: str) -> list[tuple[str, int, int]]:
    return [s for s in personal.spans_of(text) if s[0] in personal.BASE_KINDS]


PIECES = [
    "@", "@@", ".", "..", "-", " ", "  ", "+", "++", "+1", "a", "b.c", "x_y", "%", "é", "ß@", "0", "00", "255", "256", "1.2.3.4",
    "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "(555) 010-9999", "+44 20 7946 0958", "a@b.c", "a@b", "\n", "\t",
    "۳", "²", "1.2", "12345678901234567890", "iban ", "http://", "u:p@h.de",
]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans_are_those_of_plain_patterns(text):
    assert base(text) == plain_spans(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="@.+-_ 0123456789abZé()\n", max_size=60))
def test_base_spans_of_any_characters(text):
    assert base(text) == plain_spans(text)


def test_given_documents(spark):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = personal.digests(docs).collect()
    assert len(out) == len(texts)
    for r in out:
        plain = plain_spans(texts[r.doc_id] or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in plain)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in plain) for k in PLAIN]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


@pytest.mark.parametrize("text, kind, found", [
    ("see https://ann:s3cret@host.example/x", "login", "ann:s3cret"),
    ("https://host.example/ann:x@y", "login", None),
    ("IBAN: DE89 3704 0044 0532 0130 00 please", "account", "DE89 3704 0044 0532 0130 00"),
    ("IBAN: DE88 3704 0044 0532 0130 00", "account", None),
    ("SSN 123-45-6789.", "account", "123-45-6789"),
    ("SSN 666-45-6789.", "account", None),
    ("Account no. 0012 3456 78", "account", "0012 3456 78"),
    ("discount 12345678", "account", None),
    ("jörg.müller@bücher.example", "mailbox", "jörg.müller@bücher.example"),
    ("plain@host.example", "mailbox", None),
])
def test_kinds_beyond_the_base(text, kind, found):
    assert [text[a:b] for k, a, b in personal.spans_of(text) if k == kind] == ([found] if found else [])


def test_long_runs_take_linear_time():
    began = time.time()
    for unit in ("1", "1.", "1 ", "a@", "@", "+1", "a", "é", "http://a:", "http://" + "a:" * 50, "iban DE12", "+1("):
        personal.spans_of(unit * (400_000 // len(unit)))
    assert time.time() - began < 40


def test_defined_cases(spark, make_docs, odd_rows):
    rows = [*odd_rows, (9, "a@b.example and +44 20 7946 0958"), (9, "a@b.example and +44 20 7946 0958")]
    docs = make_docs(rows)
    out = personal.digests(docs).collect()
    assert len(out) == len(rows)
    assert [(r.n_email, r.n_phone, r.spans) for r in out if r.doc_id == 9] == [(1, 1, "email:0:11,phone:16:32")] * 2
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.spans == "" for r in out if r.doc_id in (1, 2, 3, 4))
    assert personal.digests(make_docs([])).count() == 0
    clear = personal.redacted(docs)
    assert clear.schema == docs.schema and values(clear, "doc_id")[0] == values(docs, "doc_id")[0]
    assert {r.text for r in clear.filter("doc_id = 9").collect()} == {"<email> and <phone>"}
    assert clear.filter("doc_id = 1").first().text is None
    found = personal.found_in(docs.withColumn("personal", docs["lang"]))
    assert sorted(found.columns) == sorted([*docs.columns, "personal"])


def test_overlapping_spans_are_redacted_once():
    assert personal.redact("card 4111.1111 +4111 1111 1111 1111") == "card 4111.1111 +<card>"
    assert personal.redact("x 10.0.0.1@b.example y") == "x <email> y"
