"""Find secrets in texts and tell widely copied examples from owner-specific credentials.

One pass over the texts finds the spans of three base kinds, and candidates of a fourth
kind, `live`: long random-looking tokens that no base span covers. The value of every span
is hashed. Over the whole corpus each hash is counted by distinct owners and distinct
repositories. A value seen with more than `most_owners` owners, or in more than
`most_repositories` repositories, is a copied example; any other value that looks random
enough is taken as the live credential of its owner.

Base spans stay whatever their value's class is; a candidate becomes a `live` span only if
it is owner-specific. No text leaves the task that reads it: only spans and hashes are
shuffled, and owners are counted from distinct (value, owner, repository) rows, combined
before the shuffle, so that a value that a third of all documents hold stays small.

Defined cases: a null text is empty; a null owner or repository counts as one of its own;
rows repeated or sharing a doc_id are scanned and returned each; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.llm.common import in_batches, rows_of, stored

# The base patterns, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "live")
_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("passw", "secret", "token", "api_key", "apikey")
LEAST_VALUE = 6

_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_ENTROPY = 3.5


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    """Long, of letters and digits mixed, and with many different characters."""
    letters = sum(c.isalpha() for c in value)
    digits = sum(c.isdigit() for c in value)
    return letters >= 4 and digits >= 4 and entropy(value) >= LEAST_ENTROPY


Span = tuple[int, int, str, str]  # start, end, kind, value


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds; each kind is matched leftmost and without overlaps."""
    found: list[Span] = []
    folded = text.lower()
    if any(w in folded for w in _WORDS):
        for m in _ASSIGN.finditer(text):
            if len(m[1]) >= LEAST_VALUE:
                found.append((m.start(), m.end(), "assign", m[1]))
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex", m[0]) for m in _HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def candidate_spans(text: str, base: list[Span]) -> list[Span]:
    """Random-looking tokens that touch no base span."""
    out, at = [], 0
    for m in _TOKEN.finditer(text):
        while at < len(base) and base[at][1] <= m.start():
            at += 1
        if any(b[0] < m.end() and m.start() < b[1] for b in base[at : at + len(KINDS)]):
            continue
        if looks_random(m[0]):
            out.append((m.start(), m.end(), "live", m[0]))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)


def value_hash(value: str) -> bytes:
    return xxhash.xxh3_128_digest(value.encode())


_SCAN_TYPE = pa.schema([
    ("doc_id", pa.int64()), ("owner", pa.string()), ("repository", pa.string()),
    ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
    ("base_sha256", pa.string()),
    ("found", pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("value", pa.binary()),
    ]))),
])
_SCAN = (
    "doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, "
    "base_sha256 string, found array<struct<start:long,end:long,kind:string,value:binary>>"
)


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One row per document: counts and digest of its base spans, and all spans with hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text, own, repo in rows_of(batches, "doc_id", "text", "owner", "repository"):
                text = text or ""
                base = base_spans(text)
                counts = Counter(s[2] for s in base)
                spans = in_order(base + candidate_spans(text, base))
                yield (
                    doc_id, own, repo, *(counts[k] for k in KINDS[:3]),
                    hashlib.sha256(joined(base).encode()).hexdigest(),
                    [{"start": s[0], "end": s[1], "kind": s[2], "value": value_hash(s[3])} for s in spans],
                )

        yield from in_batches(rows(), _SCAN_TYPE)

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        owner.cast("string").alias("owner"), repository.cast("string").alias("repository"),
    )
    return source.mapInArrow(work, _SCAN)


def ownership(spans: DataFrame, most_owners: int, most_repositories: int) -> DataFrame:
    """value, owners, repositories, copied: how widely each value is held."""
    held = spans.select(
        "value", F.coalesce("owner", F.lit("")).alias("owner"),
        F.coalesce("repository", F.lit("")).alias("repository"),
    ).distinct()
    # two plain counts: by (value, owner) and by (value, repository), then both by value
    owners = held.select("value", "owner").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("owners"))
    repositories = (
        held.select("value", "repository").distinct()
        .groupBy("value").agg(F.count(F.lit(1)).alias("repositories"))
    )
    return owners.join(repositories, "value").withColumn(
        "copied", (F.col("owners") > most_owners) | (F.col("repositories") > most_repositories)
    )


def find_secrets(
    docs: DataFrame, owner: Column, repository: Column, most_owners: int = 1, most_repositories: int = 3,
) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.

    `spans` lists base spans and the owner-specific candidates; n_live and n_copied count
    the spans whose value is owner-specific or widely copied.
    """
    # the number is drawn once and kept with the written rows
    scanned = stored(
        scan(docs, owner, repository).withColumn("row", F.monotonically_increasing_id()), "secret-spans"
    )
    spans = scanned.select("row", "owner", "repository", F.explode("found").alias("s")).select(
        "row", "owner", "repository", "s.*"
    )
    classes = stored(ownership(spans, most_owners, most_repositories), "secret-owners").select("value", "copied")
    marked = spans.select("row", "start", "end", "kind", "value").join(classes, "value")
    listed = F.filter("s", lambda x: (x["kind"] != "live") | ~x["copied"])
    by_row = marked.groupBy("row").agg(
        F.array_sort(
            F.collect_list(F.struct("start", _rank().alias("rank"), "end", "kind", "copied"))
        ).alias("s")
    ).select(
        F.col("row"),
        F.array_join(
            F.transform(listed, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
        ).alias("spans"),
        F.size(F.filter(listed, lambda x: ~x["copied"])).cast("long").alias("n_live"),
        F.size(F.filter("s", lambda x: x["copied"])).cast("long").alias("n_copied"),
    )
    return scanned.drop("found", "owner", "repository").join(by_row, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
    )


def _rank() -> Column:
    out = F.lit(len(KINDS))
    for number, kind in enumerate(KINDS):
        out = F.when(F.col("kind") == kind, F.lit(number)).otherwise(out)
    return out
