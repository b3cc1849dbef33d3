"""Line dedup against a plain rule, the perfect hash, and packing round trips."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerstar.llm import line_dedup, packing
from ledgerstar.llm.queries import vocabulary_path
from tests.llm.conftest import values


def plain_lines(rows, least=20, min_docs=3):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    order = lambda i: (i is not None, i or 0)
    held = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least:
                held[k].append(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(held[key(x)]) < min_docs or max(held[key(x)], key=order) == doc_id
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=repr)


LINE = "This very line is held by MANY documents"
REPEATED = [
    (10, f"one\n{LINE}\ntwo"), (11, f"\t{LINE.upper()} \r\nthree"), (12, f"{LINE}\n{LINE}\n"), (13, LINE),
    (14, "ÜBER die Länge zwanzig hinaus\nx"), (15, "ÜBER die länge zwanzig hinaus"), (16, "Über die Länge zwanzig hinaus"),
    (17, "ÜBER die Länge zwanzig hinaus"), (None, LINE), (13, LINE), (18, "under twenty\n" * 4), (19, "under twenty"), (20, "under twenty"),
]


def test_lines_follow_the_plain_rule(make_docs, odd_rows):
    rows = REPEATED + odd_rows
    got = values(line_dedup.digests(make_docs(rows)), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == plain_lines(rows)


def test_line_stage_keeps_all_rows_and_columns(make_docs):
    docs = make_docs(REPEATED)
    out = line_dedup.dedup_lines(docs)
    assert out.schema == docs.schema and out.count() == len(REPEATED)
    assert {r.text for r in out.filter("doc_id = 13").collect()} == {LINE}
    assert out.filter("doc_id = 10").first().text == "one\ntwo"
    assert line_dedup.dedup_lines(make_docs([])).count() == 0


def test_a_hot_line_is_dealt_over_copies_of_its_shard(make_docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "PROBES_PER_COPY", 10)
    monkeypatch.setattr(line_dedup, "SHARD_ROWS", 40)
    rows = [(i, f"{LINE}\nown line of document number {i:05d}\n{'tail of every second one' * (i % 2)}") for i in range(120)]
    got = values(line_dedup.digests(make_docs(rows)), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == plain_lines(rows)


def test_empty_table_gives_no_lines(make_docs):
    assert line_dedup.digests(make_docs([])).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash_is_minimal_and_survives_packing(keys):
    array = np.array(sorted(keys), np.uint64)
    table = line_dedup.PerfectHash.build(array)
    again = line_dedup.PerfectHash.unpack(*table.pack())
    assert sorted(again.index(array).tolist()) == list(range(len(keys)))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab Zé'9.\n\t 　\u0085\x1f<|>endoftext"), max_size=40), max_size=6))
def test_word_by_word_ids_are_those_of_the_whole_text(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary_path())
    own = packing._tokenizer(vocabulary_path())
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)] if texts else []
    assert [np.frombuffer(b, own.kind).tolist() for b in own.encode(texts)] == want


def test_special_strings_and_forgetting(tokenizer):
    small = packing.WordTokenizer(vocabulary_path(), memory=3)
    for text in ("a <|endoftext|> b", "many different words here", "many  blanks   end ", "it's don't 'll"):
        assert np.frombuffer(small.encode([text])[0], small.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings_among_many_words(tokenizer):
    texts = ["one <|endoftext|> two one", "", "<|endoftext|>", "two <|endoftext|>x one", "  a  <|endoftext|> one\n"]
    own = packing.WordTokenizer(vocabulary_path())
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, own.kind).tolist() for b in own.encode(texts)] == want


def test_a_vocabulary_without_ranks_gives_the_same_ids(tokenizer):
    own = packing.WordTokenizer(vocabulary_path())
    own.ranked = None
    texts = ["some words and some more words", "", "a  b \n c", "words"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, own.kind).tolist() for b in own.encode(texts)] == want


def test_occurrences_of_words_are_no_python_objects():
    import tracemalloc

    own = packing._tokenizer(vocabulary_path())
    texts = [" ".join(f"w{i}" for i in range(500))] * 1000
    own.encode(texts[:2])
    tracemalloc.start()
    found = own.encode(texts)
    peak = tracemalloc.get_traced_memory()[1] - sum(map(len, found))
    tracemalloc.stop()
    assert peak < 15e6  # 500,000 words; a string for each is 27 MB


def check_packing(rows, pieces, tokenizer, length=2048):
    ids_of = defaultdict(list)
    for doc_id, text in rows:
        ids_of[doc_id].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids_of)
    for doc_id, held in by_doc.items():
        assert sum(p.length for p in held) == sum(map(len, ids_of[doc_id]))
        if len(ids_of[doc_id]) > 1:
            continue
        ids, at = ids_of[doc_id][0], 0
        for p in sorted(held, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : at], "<u4").tobytes())
    padding = 0
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


def test_every_id_lies_in_one_piece(make_docs, odd_rows, tokenizer):
    rows = odd_rows + [(100 + i, "some words of a text " * (i * 37 % 200)) for i in range(80)]
    pieces = packing.pack(make_docs(rows), vocabulary_path()).collect()
    padding = check_packing(rows, pieces, tokenizer)
    assert padding <= 0.01 * sum(p.length for p in pieces)


def test_packing_in_many_groups_and_of_nothing(make_docs, tokenizer):
    rows = [(i, "word " * (i % 90)) for i in range(150)]
    pieces = packing.pack(make_docs(rows), vocabulary_path(), length=64, group_bytes=2000).collect()
    check_packing(rows, pieces, tokenizer, 64)
    assert len({p.sequence_id >> packing._GROUP_BITS for p in pieces}) > 5
    assert packing.pack(make_docs([]), vocabulary_path()).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit_decreasing_equals_the_plain_search(lengths):
    room, bins = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = next((b for b, r in enumerate(room) if r >= lengths[i]), None)
        if at is None:
            room.append(50)
            bins.append([])
            at = len(room) - 1
        room[at] -= lengths[i]
        bins[at].append(i)
    assert packing.first_fit_decreasing(lengths, 50) == bins


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=40))
def test_filling_gaps_loses_nothing(lengths):
    bins = [[(i, 0, lengths[i]) for i in b] for b in packing.first_fit_decreasing(lengths, 64)]
    done = packing.fill_gaps(bins, 64, 4)
    parts = sorted(p for b in done for p in b)
    at = defaultdict(int)
    for item, start, length in parts:
        assert start == at[item] and length > 0
        at[item] += length
    assert dict(at) == dict(enumerate(lengths))
    for b in done:
        used = sum(p[2] for p in b)
        assert used <= 64 and (64 - used < 4 or used & (used - 1) == 0)


def test_line_hashes_that_fold_into_one_are_told_apart(spark, monkeypatch):
    """Two keys of 128 bits whose first fold to 64 bits is the same number."""
    high = np.array([3, 5], np.int64)
    low = (line_dedup._spread(high, 0) ^ np.uint64(12345)).view(np.int64)
    rows = [(int(low[i]), int(high[i]), d, d) for i in range(2) for d in range(4 + i)]
    hashes = spark.createDataFrame(rows, "low long, high long, doc_id long, text_hash long")
    index = line_dedup.build_index(hashes, 1)
    assert index.first().fold == 1
    lost = line_dedup.dropped_lines(hashes, index, 1, 3).collect()
    assert {(r.doc_id, len(r.lost)) for r in lost} == {(0, 2), (1, 2), (2, 2), (3, 1)}


def test_documents_without_ids_get_their_lines_apart(make_docs):
    line = "a line that all of these documents hold"
    rows = [(None, f"{line}\nanother line, of document number {i}") for i in range(40)] + [(9, line)]
    docs = make_docs(rows)
    source = docs.select("doc_id", "text")
    assert line_dedup.lost_by_document(source, 20, 3).count() == 40
    got = {r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {f"another line, of document number {i}" for i in range(40)} | {line}
