"""Collocations: the trie and the query against plain counting, defined cases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerstar.llm import collocations
from ledgerstar.llm.common import table
from tests.conftest import SF


def plain_counts(rows) -> dict[str, Counter]:
    out: dict[str, Counter] = {}
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                for at in range(len(words) - n + 1):
                    out.setdefault(lang or "und", Counter())[" ".join(words[at : at + n])] += 1
    return out


def plain_collocations(rows, least: int, top: int):
    out = set()
    for lang, f in plain_counts(rows).items():
        total = sum(c for p, c in f.items() if " " not in p)
        held = {p: c for p, c in f.items() if " " in p and c >= least}
        scores = []
        for phrase, a in held.items():
            words = phrase.split(" ")
            cuts = []
            for k in range(1, len(words)):
                left, right = f[" ".join(words[:k])], f[" ".join(words[k:])]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            longer = [q for q in held if len(q) > len(phrase) and f" {phrase} " in f" {q} "]
            if not any(100 * held[q] >= 80 * a for q in longer):
                scores.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scores)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return out


def found(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def made_rows(seed: int, n: int):
    draw = random.Random(seed)
    words = ["the", "of", "Red", "fox", "ox", "ß", "É", "a\x0bb", "x\x00y", "w-w"] + [f"w{i}" for i in range(40)]
    ends = [" ", " ", " ", "  ", "\t", ".", ", ", "\n", "\r\n", " ? "]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randint(0, 60)):
            parts += ["big red fox jumps"] if draw.random() < 0.05 else [draw.choice(words[: draw.choice([5, 50])])]
            parts.append(draw.choice(ends))
        rows.append((draw.choice(["en", "de", None, "und"]), "".join(parts)))
    return rows


@pytest.mark.parametrize("burst, most, size", [(8, 64, 50), (64, 500, 7), (1 << 16, 1 << 20, 1 << 22)])
def test_trie_counts_every_phrase(burst, most, size):
    texts = [t for _, t in made_rows(1, 60)]
    words, held = collocations.Words(), Counter()

    def spill(paths):
        assert (np.diff(paths[0].astype(object)) >= 0).all()
        for numbers, counts in collocations.phrases_of(paths):
            for *path, count in zip(*numbers.tolist(), counts.tolist()):
                held[b" ".join(words.names[w] for w in path).decode()] += count

    trie = collocations.HatTrie(spill, burst, most)
    rest = np.empty(0, np.uint64)
    for ids in collocations.numbered([t.encode() for t in texts], words, size):
        ids = np.concatenate([rest, ids])
        trie.add(ids)
        rest = ids[max(0, len(ids) - 3) :]
    trie.add(np.concatenate([rest, np.zeros(3, np.uint64)]))
    assert burst > 100 or len(trie.containers) > 3
    trie.close()
    assert held == plain_counts([("en", t) for t in texts])["en"]


def test_slices_end_between_words():
    text = b" ".join(b"w" * (i % 9 + 1) for i in range(500)) + b"x" * 400
    for size in (1, 5, 64, 1000):
        parts = list(collocations.slices(text, size))
        assert b"".join(parts) == text
        assert [w for p in parts for w in p.split()] == text.split()


@pytest.mark.parametrize("burst, most", [(16, 200), (1 << 16, 1 << 20)])
def test_query_against_plain_counting(spark, burst, most):
    rows = made_rows(2, 400)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    out = collocations.collocations(df, least=6, top=15, burst=burst, most=most)
    want = plain_collocations(rows, 6, 15)
    assert found(out) == want and len(want) > 30


def test_given_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert found(collocations.collocations(docs, least=5)) == plain_collocations(rows, 5, 2000)


def test_defined_cases(spark, make_docs, odd_rows):
    text = "one two three four. One two\tthree  four\n"
    docs = make_docs([*odd_rows, *[(i, text) for i in range(15)]])
    out = found(collocations.collocations(docs))
    assert out == plain_collocations([("en", t) for _, t in odd_rows] + [("en", text)] * 15, 30, 2000)
    assert {(p, a) for _, _, p, a, *_ in out} == {("one two three four", 30)}
    assert collocations.collocations(make_docs([])).count() == 0
    none = spark.createDataFrame([(None, None), ("en", ""), (None, "a b " * 40)], "lang string, text string")
    assert {r[0] for r in found(collocations.collocations(none))} == {"und"}
