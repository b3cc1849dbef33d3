"""N-gram join, passages and decontamination against brute force."""

from __future__ import annotations

import itertools
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerstar.llm import components, decontaminate, ngram_join, substring_dedup
from ledgerstar.llm.common import table
from tests.conftest import SF
from tests.llm.conftest import values


def brute_join(rows):
    sets = [set(ngram_join.shingles(t).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return sorted(((d, least[find(i)] if sets[i] else d, links[i]) for i, (d, _) in enumerate(rows)), key=repr)


def edited(words, changes, draw):
    words = list(words)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    draw = random.Random(5)
    rows = []
    for base in range(6):
        words = [f"b{base}w{draw.randrange(5000)}" for _ in range(120)]
        rows += [(100 * base + k, edited(words, k % 7, draw)) for k in range(25)]
    return rows


def test_join_equals_brute_force(make_docs, odd_rows, copies):
    rows = copies + odd_rows + copies[:5]
    got = values(ngram_join.join(make_docs(rows)), "doc_id", "class_id", "n_links")
    assert got == brute_join(rows)


def test_join_in_blocks_counts_each_pair_once(make_docs, copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    got = values(ngram_join.join(make_docs(copies)), "doc_id", "class_id", "n_links")
    assert got == brute_join(copies)


def test_join_over_the_given_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert values(ngram_join.join(docs), "doc_id", "class_id", "n_links") == brute_join(rows)


def test_one_document_of_each_group_stays(make_docs, odd_rows, copies):
    rows = [(1000 + i, t) for i, t in copies] + odd_rows
    docs = make_docs(rows)
    out = ngram_join.keep_one(docs)
    assert out.schema == docs.schema
    held = brute_join(rows)
    kept = sorted((r.doc_id for r in out.collect()), key=repr)
    wordless = [d for d, t in rows if not re.search(r"\w", t or "")]
    heads = {c for d, c, n in held if (d, c) and d == c and d is not None and d not in wordless}
    want = sorted([*heads, *wordless, None], key=repr)  # None: the row without an id
    assert kept == want
    assert ngram_join.keep_one(make_docs([])).count() == 0


def test_one_row_stays_of_near_copies_that_share_an_id_or_have_none(make_docs):
    draw = random.Random(31)
    groups = [[f"g{g}w{draw.randrange(5000)}" for _ in range(120)] for g in range(3)]
    ids = [lambda k: 7, lambda k: None, lambda k: None if k else 9]
    rows = [(ids[g](k), edited(words, 1, draw)) for g, words in enumerate(groups) for k in range(6)]
    kept = ngram_join.keep_one(make_docs(rows)).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == [7, 9, None]


def test_rows_without_ids_take_no_longer(make_docs):
    """Each such row meets its own class only, so the time does not grow with their pairs."""
    draw = random.Random(4)
    texts = []
    for i in range(500):
        words = [f"t{draw.randrange(5000)}" for _ in range(40)]
        texts += [" ".join(words), " ".join(words[:-1] + ["end"])]
    texts += texts[:50]
    took = {}
    for name, ids in (("first", range(len(texts))), ("ids", range(len(texts))), ("none", [None] * len(texts)), ("one", [7] * len(texts))):
        begin = time.perf_counter()
        out = ngram_join.join(make_docs(list(zip(ids, texts)))).collect()
        took[name] = time.perf_counter() - begin
        links = sorted(r.n_links for r in out)
        if name == "first":
            want = links
        assert links == want
    assert max(took["none"], took["one"]) < 2 * took["ids"]


def test_both_ways_to_count_common_shingles_agree():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 300, 80).astype(np.uint64)) for _ in range(20)]
    left, right = np.triu_indices(20, 1)
    want = [len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in zip(left, right)]
    assert ngram_join.common_sizes(sets, left, right).tolist() == want
    assert ngram_join.common_sizes(sets, left[:9], right[:9]).tolist() == want[:9]


def test_the_last_depth_reaches_the_target():
    assert ngram_join.found_chance(ngram_join.THRESHOLD, ngram_join.DEPTHS[-1]) >= ngram_join.TARGET


def test_a_large_group_ends_no_round_of_other_pairs(make_docs, monkeypatch):
    draw = random.Random(21)
    words = [f"h{i}" for i in range(400)]
    rows = [(i, edited(words, 1, draw)) for i in range(150)]  # links far above the threshold
    rows += [(1000 + i, " ".join(f"p{i}q{k}" for k in range(100))) for i in range(40)]
    depths, verified = [], ngram_join.verified

    def noted(members, depth, longer):
        depths.append(depth)
        return verified(members, depth, longer)

    monkeypatch.setattr(ngram_join, "verified", noted)
    assert values(ngram_join.join(make_docs(rows)), "doc_id", "class_id", "n_links") == brute_join(rows)
    assert ngram_join.found_chance(ngram_join.THRESHOLD, depths[-1]) >= ngram_join.TARGET


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    found = dict(values(components.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 160)} == {100}
    assert found[200] == found[300] == 200
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- passages

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=40), st.integers(1, 6))
def test_compact_windows_cover_each_passage_once(hashed, least):
    array = np.array(hashed, np.uint64) << np.uint64(20)
    left, centre, right = substring_dedup.compact_windows(array, np.array([0]), np.array([len(array)]), least)
    for i in range(len(array)):
        for j in range(i + least, len(array) + 1):
            held = [c for a, c, b in zip(left, centre, right) if a <= i <= c < j <= b]
            assert len(held) == 1 and array[held[0]] == array[i:j].min()


def covered(found):
    out = {}
    for r in found:
        out.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    return out


def classes_at(found):
    """doc_id -> [(start, end, class_id)]."""
    out = {}
    for r in found:
        out.setdefault(r.doc_id, []).append((r.start_word, r.end_word, r.class_id))
    return out


def apart(rows, found):
    """Pairs of texts that hold 50 words in common and share no class there."""
    words = {i: re.findall(r"\w+", (t or "").lower()) for i, t in rows}
    held, named, bad = {}, classes_at(found), []
    for i, w in words.items():
        for s in range(len(w) - 49):
            held.setdefault(tuple(w[s : s + 50]), {}).setdefault(i, s)
    for places in held.values():
        if len(places) > 1:
            classes = [{c for a, b, c in named.get(i, []) if a <= s and s + 50 <= b} for i, s in places.items()]
            if not set.intersection(*classes):
                bad.append(places)
    return bad


def missed_repeats(rows, found):
    """Windows of 50 words that two different texts share and that no passage covers."""
    words = {i: re.findall(r"\w+", (t or "").lower()) for i, t in rows}
    held = {}
    for i, w in words.items():
        for s in range(len(w) - 49):
            held.setdefault(tuple(w[s : s + 50]), set()).add((i, s))
    spans = covered(found)
    return [
        (i, s) for places in held.values() if len({i for i, _ in places}) > 1 for i, s in places
        if not any(a <= s and s + 50 <= b for a, b in spans.get(i, []))
    ]


@pytest.fixture(scope="module")
def repeated():
    draw = random.Random(3)
    own = lambda n: [f"u{draw.randrange(10**7)}" for _ in range(n)]
    shared, common = own(55), ["licensed", "under", "the", "usual", "terms", "of", "this", "place"]
    rows = [(i, " ".join(own(40 + i) + shared + own(30))) for i in range(30)]
    rows += [(100 + i, " ".join(own(60) + common + own(60))) for i in range(30)]
    near = own(90)
    rows += [(200, " ".join(own(50) + near)), (201, edited(near, 2, draw) + " " + " ".join(own(50)))]
    rows += [(300, " ".join(own(70))), (301, rows[0][1]), (302, rows[0][1])]
    return [(1000 + i, t) for i, t in rows]


def test_passages_are_found_and_clean_texts_left_alone(make_docs, repeated, odd_rows):
    found = substring_dedup.repeats(make_docs(repeated + odd_rows)).collect()
    assert missed_repeats(repeated, found) == []
    spans = covered(found)
    assert set(range(1000, 1030)) | {1200, 1201, 1301, 1302, 5, 6} <= set(spans)
    assert not set(spans) & ({1300} | set(range(1100, 1130)) | {4, 8, 2**62, -7})
    assert apart(repeated, found) == []
    near = {r.class_id for r in found if r.doc_id == 1200} & {r.class_id for r in found if r.doc_id == 1201}
    assert near == {1200}
    assert all(r.end_word - r.start_word >= 50 for r in found)
    # a row for each document and passage, not for each pair
    assert sum(1000 <= r.doc_id < 1030 for r in found if r.doc_id is not None) <= 32
    whole = {(r.doc_id, r.class_id, r.start_word, r.n_rows) for r in found if r.doc_id in (1000, 1301, 1302)}
    assert {(i, 1000, 0, 3) for i in (1000, 1301, 1302)} <= whole


def test_passages_of_the_given_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = substring_dedup.repeats(docs).collect()
    assert missed_repeats(rows, found) == [] and apart(rows, found) == []


@pytest.mark.parametrize("block", [512, 16])
@pytest.mark.parametrize("small", [8, 2])
def test_a_large_group_is_one_class(make_docs, monkeypatch, block, small):
    monkeypatch.setattr(substring_dedup, "TILE_BLOCK", block)
    monkeypatch.setattr(substring_dedup, "SMALL_GROUP", small)
    draw = random.Random(8)
    own = lambda n: [f"v{draw.randrange(10**7)}" for _ in range(n)]
    shared = own(70)
    rows = [(i, " ".join(own(30) + edited(shared, i % 2, draw).split() + own(30))) for i in range(60)]
    found = substring_dedup.repeats(make_docs(rows)).collect()
    assert apart(rows, found) == []
    assert {r.class_id for r in found} == {0} and {r.doc_id for r in found} == set(range(60))


@pytest.mark.parametrize("copies", [40, 160])
def test_rows_grow_with_the_texts_that_hold_a_passage(make_docs, copies):
    draw = random.Random(9)
    own = lambda n: [f"g{draw.randrange(10**7)}" for _ in range(n)]
    shared = own(60)
    rows = [(i, " ".join(own(20) + shared + own(20))) for i in range(copies)]
    found = substring_dedup.repeats(make_docs(rows)).collect()
    assert len(found) == copies and {r.n_rows for r in found} == {copies}


@pytest.mark.parametrize("kind", ["line", "repeated"])
def test_texts_that_share_little_are_not_compared_in_pairs(monkeypatch, kind):
    """A tile of texts that share a line, or repeat a few words, compares about those that are linked."""
    draw = np.random.default_rng(11)
    own = lambda n: draw.integers(0, 1 << 24, n, dtype=np.uint32)
    common, grams = own(15), []
    for i in range(300):
        if kind == "line":  # one line of 15 shingles in the middle
            base = np.concatenate([own(20), common, own(20)])
        else:  # eight shingles over and over
            base = np.concatenate([own(20), np.tile(common[:8], 40), own(20)])
        grams.append(base)
        if i % 30 == 0:  # a near one, two shingles changed
            grams.append(base.copy())
            grams[-1][[3, 4]] = own(2)
    rows = np.zeros(len(grams), substring_dedup.STRETCH)
    rows["doc"] = np.arange(len(grams))
    rows["first"], rows["last"] = 20, [len(g) - 21 for g in grams] if kind == "repeated" else [20] * len(grams)
    compared, may_hold = [], substring_dedup.Places.may_hold

    def counted(self, one, others):
        compared.append(len(others))
        return may_hold(self, one, others)

    monkeypatch.setattr(substring_dedup.Places, "may_hold", counted)
    linked = {
        frozenset(f[:2]) for f in substring_dedup.forest(rows, grams, np.zeros(len(grams), bool), True)
    }
    wanted = {
        frozenset((i, j)) for i, j in itertools.combinations(range(len(grams)), 2)
        if any(substring_dedup.passages(grams[i], grams[j], s)
               for s in substring_dedup.shifts_of(rows[i], rows[j], grams[i], grams[j]))
    }
    assert linked == wanted and len(wanted) == 10
    assert sum(compared) <= 10 * len(grams)


def test_partial_holders_do_not_part_a_class(make_docs):
    """Texts with less than a passage of it stand first, and are no link between the others."""
    draw = random.Random(10)
    own = lambda n: [f"p{draw.randrange(10**7)}" for _ in range(n)]
    shared = own(60)
    rows = [(i, " ".join(own(30) + shared[i % 3 * 15 :][:30] + own(30))) for i in range(40)]
    rows += [(100 + i, " ".join(own(30) + shared + own(30))) for i in range(20)]
    found = substring_dedup.repeats(make_docs(rows)).collect()
    assert {r.doc_id for r in found} == set(range(100, 120)) and {r.class_id for r in found} == {100}


@pytest.mark.parametrize("size, places", [(100, [49]), (140, [46, 93]), (146, [36, 73, 110])])
@pytest.mark.parametrize("texts", [2, 12])
def test_recall_of_near_passages(make_docs, size, places, texts):
    """Passages at 0.8 to 0.91 of another one, without 50 words in common."""
    draw = random.Random(size + texts)
    own = lambda n: [f"r{draw.randrange(10**7)}" for _ in range(n)]
    rows, pairs = [], []
    for _ in range(30):
        base, first = own(size), len(rows)
        for k in range(texts):
            other = [f"new{draw.randrange(10**7)}" if k and at in places else w for at, w in enumerate(base)]
            a, b = (set(zip(*[x[i:] for i in range(5)])) for x in (base, other))
            if k:
                assert 0.8 <= len(a & b) / len(a | b) <= 0.91
                pairs.append((first, len(rows)))
            rows.append((len(rows), " ".join(own(25) + other + own(25))))
    named = classes_at(substring_dedup.repeats(make_docs(rows)).collect())
    hit = sum(bool({c for *_, c in named.get(i, [])} & {c for *_, c in named.get(j, [])}) for i, j in pairs)
    assert hit >= 0.95 * len(pairs)
    classes = {c for held in named.values() for *_, c in held}
    assert len(classes) >= 28  # passages of different groups are not put together


def test_one_word_repeated_takes_linear_time(make_docs):
    grams = substring_dedup.grams_of("same " * 300_000)
    began = time.time()
    windows = substring_dedup.windows_of([(1, grams)])
    assert time.time() - began < 5 and len(windows) < 6 * 300_000
    rows = [(1, "same " * 40_000), (2, "other words " * 20 + "same " * 20_000), (3, "alone " * 10)]
    found = substring_dedup.repeats(make_docs(rows)).collect()
    assert {r.doc_id for r in found} == {1, 2} and {r.class_id for r in found} == {1}


def test_missing_and_repeated_ids_change_nothing_but_the_ids(make_docs, repeated):
    named = substring_dedup.repeats(make_docs(repeated)).collect()
    none = substring_dedup.repeats(make_docs([(None, t) for _, t in repeated])).collect()
    same = substring_dedup.repeats(make_docs([(7, t) for _, t in repeated])).collect()
    shape = lambda found: sorted((r.start_word, r.end_word, r.n_rows) for r in found)
    assert shape(named) == shape(none) == shape(same)
    assert {r.class_id for r in none} == {None} and {r.class_id for r in same} == {7}


def test_passages_of_all_shifts_are_found(make_docs):
    draw = random.Random(11)
    own = lambda n: [f"s{draw.randrange(10**7)}" for _ in range(n)]
    parts = [own(60) for _ in range(20)]
    one = [w for part in parts for w in part]
    two = [w for part in parts for w in part + own(60)]  # the shift grows by 60 with every part
    rows = [(1, " ".join(one)), (2, " ".join(two))]
    assert missed_repeats(rows, substring_dedup.repeats(make_docs(rows)).collect()) == []


@pytest.mark.parametrize("changed", [[49], [0], [47], [2], [0, 49]])
@pytest.mark.parametrize("around", [0, 30])
def test_words_changed_near_the_ends_of_a_passage(changed, around):
    draw = random.Random(12)
    own = lambda n: [f"e{draw.randrange(10**7)}" for _ in range(n)]
    passage = own(50)
    other = [f"other{i}" if i in changed else w for i, w in enumerate(passage)]
    a, b = (substring_dedup.grams_of(" ".join(own(around) + w + own(around))) for w in (passage, other))
    (begin, end, other_begin, other_end, alike), = substring_dedup.passages(a, b, 0)
    assert end - begin >= 46 and other_end - other_begin >= 46 and alike >= 0.8
    assert around - 4 <= begin <= around + 4 and (begin, end) == (other_begin, other_end)


def test_no_texts_no_passages(make_docs):
    assert substring_dedup.repeats(make_docs([])).count() == 0


# ---- decontamination

ITEMS = [
    (1, "A farmer keeps seventeen brown sheep in the northern meadow. How many remain if nine wander off? Eight sheep remain."),
    (2, "The copper kettle whistles loudly whenever boiling water reaches its narrow spout near the window."),
    (3, "The of and."), (4, None), (5, ""),
]


def brute_leaks(rows):
    items = decontaminate.Items([(i, t) for i, t in ITEMS if decontaminate.words_of(t)])
    out = set()
    for doc_id, text in rows:
        words = decontaminate.words_of(text)
        for k, (item, answer, span) in enumerate(zip(items.words, items.answers, items.spans)):
            for start in range(0, max(1, len(words)), span):
                window = words[max(0, start - span) : start + 2 * span]
                share = decontaminate.common_subsequence(item, window) / len(item)
                good = decontaminate.common_subsequence(answer, window) / len(answer)
                if share >= decontaminate.LEAST_MOST or share >= decontaminate.LEAST_PART and good >= decontaminate.LEAST_ANSWER:
                    out.add((doc_id, items.ids[k]))
    return out


def test_leaks_are_found_and_clean_documents_stay(spark, make_docs, odd_rows):
    filler = " ".join(f"filler{i}" for i in range(200))
    reworded = ITEMS[0][1].replace("brown ", "").replace("northern", "southern").replace("wander off", "leave")
    rows = [
        (20, f"{filler} {ITEMS[0][1]} {filler}"), (21, ITEMS[1][1].upper()), (22, f"{filler} {reworded}"),
        (23, filler), (24, "sheep meadow kettle water window"), (20, ITEMS[1][1]),
    ] + odd_rows
    docs = make_docs(rows)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    want = brute_leaks(rows)
    assert got == want and {(20, 1), (21, 2), (22, 1)} <= got
    kept = decontaminate.clean(docs, benchmark)
    assert kept.schema == docs.schema
    assert kept.count() == len(rows) - 4
    assert decontaminate.leaks(make_docs([]), benchmark).count() == 0
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == len(rows)


def test_items_that_leaked_often_are_found_beside_others_and_reworded(spark, make_docs):
    items = [(k, " ".join(f"i{k}w{n}" for n in range(14))) for k in range(2)]
    hot, rare = (text.split() for _, text in items)
    rows = [(i, " ".join(hot)) for i in range(200)]
    # the words that the fewest documents hold are those that the paraphrase replaces
    rows += [(300 + i, " ".join(hot[4:])) for i in range(100)]
    rows += [(500, " ".join(hot[:4] + ["x"] * 2 + rare)), (501, " ".join(["y"] * 4 + hot[4:])), (502, " ".join(rare))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(make_docs(rows), benchmark).collect()}
    words = {i: t.split() for i, t in rows}
    want = set()
    for i, own in words.items():
        for k, item in enumerate((hot, rare)):
            share = decontaminate.common_subsequence(item, own) / len(item)
            answer = decontaminate.common_subsequence(item[-3:], own) / 3
            if share >= 0.8 or share >= 0.6 and answer >= 0.6:
                want.add((i, k))
    assert want <= found and {(501, 0), (500, 1)} <= found


def plain_leaks(rows, items):
    """All windows of all texts against all items, with no candidates."""
    out = set()
    for doc_id, text in rows:
        words = decontaminate.words_of(text)
        for item_id, item in items:
            own, answer = decontaminate.words_of(item), decontaminate.answer_of(item)
            step = 16
            while step < len(own):
                step *= 2
            for start in range(0, len(words), step):
                window = words[max(0, start - step) : start + 2 * step]
                share = decontaminate.common_subsequence(own, window) / len(own)
                good = decontaminate.common_subsequence(answer, window) / len(answer)
                if share >= 0.8 or share >= 0.6 and good >= 0.6:
                    out.add((doc_id, item_id))
    return out


def paraphrased(draw, item, kept):
    """An item with some words dropped and others replaced, its answer left as it is."""
    words = item.split()
    lost = set(draw.sample(range(len(words)), int((1 - kept) * len(words))))
    return " ".join(draw.choice(["", f"other{draw.randrange(500)}"]) if i in lost else w for i, w in enumerate(words))


def planted_rows(spark):
    draw = random.Random(6)
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    texts = [r.text for r in table(spark, SF, "documents").orderBy("doc_id").collect() if 200 < len(r.text or "") < 4000]
    rows = []
    for i in range(160):
        words = draw.choice(texts).split()
        at = draw.randrange(len(words))
        _, item = items[i % len(items)]
        rows.append((i, " ".join(words[:at] + [paraphrased(draw, item, draw.uniform(0.62, 1.0))] + words[at:])))
    return rows, items


def test_recall_of_paraphrases_against_a_plain_search(spark, make_docs):
    rows, items = planted_rows(spark)
    want = plain_leaks(rows, items)
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(
        make_docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) >= 100 and found <= want
    assert len(found) >= 0.98 * len(want)


def test_the_latent_space_decides(spark, make_docs, monkeypatch):
    """With noise for the singular vectors, and bounds as they were, matches are lost."""
    rows, items = planted_rows(spark)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(rows)
    exact_targets, exact_space, bounds = decontaminate.targets_of, decontaminate.latent_space, []

    def noise(*arguments):
        space, noisy = exact_space(*arguments)
        bounds.append(exact_targets(arguments[2], arguments[1], space, noisy)[1])
        return np.linalg.qr(np.random.default_rng(1).standard_normal(space.shape))[0].astype(np.float32), noisy

    found = decontaminate.leaks(docs, benchmark).count()
    monkeypatch.setattr(decontaminate, "latent_space", noise)
    monkeypatch.setattr(decontaminate, "targets_of", lambda *a: (exact_targets(*a)[0], bounds[-1]))
    assert decontaminate.leaks(docs, benchmark).count() < 0.5 * found


def test_items_of_one_template_are_found_without_their_own_words(spark, make_docs):
    frame = "which of these towns lies north of the river and has a market".split()
    items = [(i, " ".join(frame[:6] + [f"name{i}"] + frame[6:] + [f"place{i}"])) for i in range(50)]
    text = " ".join(frame[:6] + ["someone"] + frame[6:] + ["somewhere"])
    rows = [(1, f"{'before ' * 40}{text}{' after' * 40}"), (2, "north of the river"), (3, items[7][1])]
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(
        make_docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == plain_leaks(rows, items) and len(found) == 100


def test_sums_of_runs_equal_reduceat():
    draw = np.random.default_rng(2)
    rows = draw.standard_normal((50, 7))
    for size in (1, 40, 5000):
        held = draw.integers(0, 50, size)
        heads = np.unique(np.r_[0, draw.integers(0, size, size // 30)])
        assert np.allclose(decontaminate._sums(rows, heads, held, at_once=8), np.add.reduceat(rows[held], heads, axis=0))


def test_leaks_of_a_very_long_text(spark, make_docs):
    words = [f"w{i * 7919 % 9973}" for i in range(200_000)]
    rows = [(1, " ".join(words[:150_000] + ITEMS[0][1].split() + words[150_000:])), (2, " ".join(ITEMS[0][1].split() * 5000))]
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(make_docs(rows), benchmark).collect()} == {(1, 1), (2, 1)}


def test_leaks_of_the_given_documents(spark):
    docs, benchmark = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    items = [(r.item_id, " " + " ".join(decontaminate.words_of(r.text)) + " ") for r in benchmark.collect()]
    for r in docs.collect():
        text = " " + " ".join(decontaminate.words_of(r.text)) + " "
        for item_id, item in items:
            assert (item in text) <= ((r.doc_id, item_id) in found)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abc"), max_size=12))
def test_common_subsequence_equals_the_table(one, two):
    best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
    for i, x in enumerate(one):
        for j, y in enumerate(two):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert decontaminate.common_subsequence(one, two) == best[-1][-1]
