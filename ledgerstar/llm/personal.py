"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus signs before
a digit, digits beside a dot, a blank or a hyphen, schemes, and identifier cues such as
`iban`. At each anchor a small deterministic parser expands to both sides and validates:

- `email`, `ip`, `card`, `phone`: the base kinds, fixed by `BASE_RULES`;
- `mailbox`: an at-sign between letters of any alphabet, where the base email is absent or
  covers a part of the address only;
- `login`: user and password of a URL, between its scheme and the at-sign before its host;
- `account`: a value after a cue: an IBAN whose check digits fit, a social security number
  with a valid area, group and serial, or an account or passport number of 6 to 17 digits.

Every parser moves on from where its last match or its last failed run ended, so a text is
read in time that grows with its length. One pass over the table, no shuffle.

Defined cases: a null text is empty; an empty one has no spans; very long texts are read
whole; equal matches of different kinds stand each under its kind, base kinds first; rows
that repeat, or share or lack a doc_id, are searched and returned each; other columns,
whatever their names, stay as they are in `found_in` and `redacted`; an empty table gives none.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# The kinds in the order in which spans are listed, the first four being base.
KINDS = ("email", "ip", "card", "phone", "mailbox", "login", "account")
BASE_KINDS = KINDS[:4]
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "postgres://", "mysql://", "mongodb://", "redis://")
CUES = {
    "iban": ("iban",),
    "social": ("ssn", "social security"),
    "number": ("account", "acct", "konto", "cuenta", "compte", "passport"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_SPACED = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_DIALLED = re.compile(r"[\x20().0-9-]+")
_WIDE_HOST = re.compile(r"[^\W_][\w-]*(?:\.[\w-]+)*\.[^\W\d_]{2,}")
_USER = re.compile(r"[^\s/?#@:\"'<>]+:[^\s/?#@\"'<>]+(?=@[^\s@/])")
_BRIDGE = re.compile(r"(?:[\x20]{0,2}(?:no|nr|number|num|id)\b)?[\x20.:#=-]{1,4}", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SOCIAL = re.compile(r"([0-9]{3})[\x20-]([0-9]{2})[\x20-]([0-9]{4})(?![0-9])")
_NUMBER = re.compile(r"[A-Z]{0,2}[0-9](?:[\x20-]?[0-9]){5,16}(?![0-9A-Za-z])")

Span = tuple[str, int, int]


@cache
def anchors() -> ahocorasick.Automaton:
    """The automaton: every anchor gives the names of the parsers it starts, and its length."""
    starts: dict[str, set[str]] = {"@": {"at"}}
    for a in _DIGITS:
        starts["+" + a] = {"plus"}
        for b in _DIGITS:
            starts[f"{a}.{b}"] = {"dotted"}
            for gap in ("", " ", "-"):
                starts[a + gap + b] = {"spaced"}
    for scheme in SCHEMES:
        for spelt in (scheme, scheme.upper()):
            starts.setdefault(spelt, set()).add("scheme")
    for kind, cues in CUES.items():
        for cue in cues:
            for spelt in (cue, cue.upper(), cue.capitalize(), cue.title()):
                starts.setdefault(spelt, set()).add(kind)
    held = ahocorasick.Automaton()
    for anchor, names in starts.items():
        held.add_word(anchor, (len(anchor), sorted(names)))
    held.make_automaton()
    return held


def luhn(digits: Iterable[str]) -> bool:
    total = 0
    for place, digit in enumerate(reversed(list(digits))):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban_fits(value: str) -> bool:
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _part_fits(part: str) -> bool:
    significant = part.lstrip("0")
    return len(significant) < 3 or len(significant) == 3 and int(significant) <= 255


class Reader:
    """Parsers over one text; each remembers up to where it has read."""

    def __init__(self, text: str):
        self.text = text
        self.spans: list[Span] = []
        self.read = dict.fromkeys(("email", "dotted", "spaced", "scheme", "account", "wide"), 0)

    def at(self, begin: int, end: int) -> None:
        """Local part to the left of an at-sign, host to its right."""
        text, first = self.text, begin
        floor = self.read["email"]
        while first > floor and text[first - 1] in _LOCAL:
            first -= 1
        host = _HOST.match(text, end)
        base = host is not None and first < begin
        if base:
            self.spans.append(("email", first, host.end()))
            self.read["email"] = host.end()
        self.wide(begin, end, (first, host.end()) if base else None)

    def wide(self, begin: int, end: int, base: tuple[int, int] | None) -> None:
        text, first = self.text, begin
        while first > self.read["wide"] and (text[first - 1] in _LOCAL or _letter(text[first - 1])):
            first -= 1
        self.read["wide"] = end
        while first < begin and text[first] in ".-+%":
            first += 1
        host = _WIDE_HOST.match(text, end)
        if host is None or first == begin or text[begin - 1] == ".":
            return
        beyond = text[first:host.end()]
        whole = base is not None and base[0] <= first and host.end() <= base[1]
        if not whole and not beyond.isascii():
            self.spans.append(("mailbox", first, host.end()))

    def dotted(self, begin: int, end: int) -> None:
        """Runs of digits joined by dots; from the left, every four of them are one match."""
        if begin < self.read["dotted"]:
            return
        while begin > self.read["dotted"] and self.text[begin - 1] in _DIGITS:
            begin -= 1
        chain = _DOTTED.match(self.text, begin)
        self.read["dotted"] = chain.end()
        parts, at = chain[0].split("."), begin
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            width = sum(map(len, four)) + 3
            if all(map(_part_fits, four)):
                self.spans.append(("ip", at, at + width))
            at += width + 1

    def spaced(self, begin: int, end: int) -> None:
        """Digits with at most one blank or hyphen between two of them."""
        if begin < self.read["spaced"]:
            return
        run = _SPACED.match(self.text, begin)
        self.read["spaced"] = run.end()
        digits = [c for c in run[0] if c in _DIGITS]
        if 13 <= len(digits) <= 19 and luhn(digits):
            self.spans.append(("card", begin, run.end()))

    def plus(self, begin: int, end: int) -> None:
        """A plus, a digit, and what dialled numbers are written with, up to its last digit."""
        run = _DIALLED.match(self.text, end)
        if run is None:
            return
        last = run.end()
        while last > end and self.text[last - 1] not in _DIGITS:
            last -= 1
        if last - end >= 2 and 9 <= 1 + sum(c in _DIGITS for c in self.text[end:last]) <= 15:
            self.spans.append(("phone", begin, last))

    def scheme(self, begin: int, end: int) -> None:
        if end <= self.read["scheme"]:
            return
        user = _USER.match(self.text, end)
        self.read["scheme"] = user.end() if user else end
        if user:
            self.spans.append(("login", end, user.end()))

    def _value(self, begin: int, end: int) -> int | None:
        """Where a value may begin behind a cue that stands as a word of its own."""
        if begin < self.read["account"] or begin and self.text[begin - 1].isalnum():
            return None
        bridge = _BRIDGE.match(self.text, end)
        return bridge.end() if bridge else None

    def _account(self, begin: int, end: int) -> None:
        self.spans.append(("account", begin, end))
        self.read["account"] = end

    def iban(self, begin: int, end: int) -> None:
        at = self._value(begin, end)
        found = at is not None and _IBAN.match(self.text, at)
        if not found:
            return
        for stop in range(found.end(), at + 14, -1):  # blanks may lead into the next word
            value = self.text[at:stop].replace(" ", "")
            if len(value) >= 15 and self.text[stop - 1] != " " and iban_fits(value):
                if stop == len(self.text) or not self.text[stop].isalnum():
                    self._account(at, stop)
                    return

    def social(self, begin: int, end: int) -> None:
        at = self._value(begin, end)
        found = at is not None and _SOCIAL.match(self.text, at)
        if found and found[1] not in ("000", "666") and found[1] < "900" and found[2] != "00" and found[3] != "0000":
            self._account(at, found.end())

    def number(self, begin: int, end: int) -> None:
        at = self._value(begin, end)
        found = at is not None and _NUMBER.match(self.text, at)
        if found:
            self._account(at, found.end())


def _letter(char: str) -> bool:
    return char > "\x7f" and unicodedata.category(char)[0] in "LMN"


def spans_of(text: str) -> list[Span]:
    """All spans, by kind as listed in KINDS, then by start."""
    reader = Reader(text)
    parsers: dict[str, Callable[[int, int], None]] = {
        n: getattr(reader, n) for n in ("at", "plus", "dotted", "spaced", "scheme", *CUES)
    }
    for last, (width, names) in anchors().iter(text):
        for name in names:
            parsers[name](last + 1 - width, last + 1)
    return sorted(reader.spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


_FOUND = "array<struct<kind:string,start:long,end:long>>"


def found_in(docs: DataFrame, text: str = "text", into: str = "personal") -> DataFrame:
    """The rows of `docs` with `into` as an array of (kind, start, end), ends exclusive.

    A column that is called `into` already is replaced.
    """

    @F.pandas_udf(_FOUND)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([
            [{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t or "")] for t in texts
        ])

    return docs.withColumn(into, spans(docs[text].cast("string")))


def redact(text: str) -> str:
    """The text with `<kind>` in place of each span; of spans that overlap the first kind stands."""
    out, at = [], 0
    for begin, stop, kinds in merged(spans_of(text)):
        out += [text[at:begin], f"<{kinds}>"]
        at = stop
    return "".join([*out, text[at:]])


def merged(spans: list[Span]) -> Iterator[tuple[int, int, str]]:
    """Disjoint stretches covered by spans, each with the first kind among its spans."""
    held: tuple[int, int, str] | None = None
    for kind, begin, end in sorted(spans, key=lambda s: s[1]):
        if held and begin < held[1]:
            first = min(kind, held[2], key=KINDS.index)
            held = (held[0], max(held[1], end), first)
            continue
        if held:
            yield held
        held = (begin, end, kind)
    if held:
        yield held


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs`, personal data in their texts replaced by the name of its kind."""

    @F.pandas_udf("string")
    def without(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redact(t) for t in texts])

    return docs.withColumn(text, without(docs[text].cast("string")))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, and n_ of the other kinds."""
    found = found_in(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "personal")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds: str) -> Column:
        return F.filter("personal", lambda s: s["kind"].isin(*kinds))

    counts = {f"n_{k}": F.size(of(k)).cast("long") for k in KINDS}
    return found.select(
        "doc_id", *[counts[f"n_{k}"].alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed(of(*BASE_KINDS)), 256).alias("base_sha256"), listed(F.col("personal")).alias("spans"),
        *[counts[f"n_{k}"].alias(f"n_{k}") for k in KINDS[len(BASE_KINDS):]],
    )
