"""Conversation repair: the search against all edits, cutting into segments, defined cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from ledgerstar.llm import repair
from ledgerstar.llm.common import table
from ledgerstar.llm.queries import op12_repair
from tests.conftest import SF

ROLES = ["user", "assistant", "system", "tool", ""]


def random_items(draw: random.Random, n: int) -> list[repair.Item]:
    out = []
    for _ in range(n):
        gone = draw.random() < 0.3
        out.append(repair.Item(draw.choice(ROLES), "x", gone, not gone and draw.random() < 0.4, draw.choice([1, 3]) if gone else 1))
    return out


def least_edits(items, entry, leave):
    """Every state's least (cost, edits), row after row; two inserts at most in one place."""
    def inserted(best):
        out, now = dict(best), best
        for _ in range(2):
            now = {repair._NEXT[s]: (c + 3, e + "I") for s, (c, e) in sorted(now.items(), key=lambda x: x[1], reverse=True)}
            for s, way in now.items():
                out[s] = min(out.get(s, way), way)
        return out

    best = {entry: (0, "")}
    for item in items:
        after = {}
        for s, (cost, edits) in inserted(best).items():
            for letters, price, rows, then in item.moves(s):
                if rows:
                    way = (cost + price, edits + letters)
                    after[then] = min(after.get(then, way), way)
        best = after
    if leave is not None:
        return best.get(leave)
    return min(way for s, way in inserted(best).items() if s in (repair.NOTHING, repair.ASSISTANT))


def test_search_finds_the_least_edits():
    draw = random.Random(1)
    for _ in range(800):
        items = random_items(draw, draw.randint(1, 7))
        for entry in repair.STATES:
            for leave in (None, *repair.STATES):
                assert repair.cheapest(items, entry, leave) == least_edits(items, entry, leave)
    assert repair.cheapest([], repair.NOTHING, None) == (0, "")


def test_segments_give_the_edits_of_the_whole():
    draw = random.Random(2)
    for _ in range(300):
        items = random_items(draw, draw.randint(1, 24))
        parts, at = [], 0
        while at < len(items):
            size = draw.randint(1, 5)
            parts.append(items[at : at + size])
            at += size
        ways = [repair.all_ways(p) for p in parts]
        narrow = [[(w["entry"], w["leave"], w["cost"], w["rank"]) for w in repair.ranked(x, False)] for x in ways]
        steps = repair.route(narrow, repair.NOTHING, None)
        edits = "".join(x[s][1] for x, s in zip(ways, steps)) + "I" * (repair._CLOSE[steps[-1][1]] // 3)
        cost = sum(x[s][0] for x, s in zip(ways, steps)) + repair._CLOSE[steps[-1][1]]
        assert (cost, edits) == repair.cheapest(items, repair.NOTHING, None)


def plain_report(rows):
    """The contract, a conversation at a time, with `least_edits` for the edits."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, items, counts = set(), [], [0, 0, 0]
        for _, role, text in mine:
            ink = text.strip(" \t\n\v\f\r")
            fault = 0 if not ink else 1 if (role, text) in seen else 2 if ink[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            items.append(repair.Item(role, text, fault in (0, 1), fault == 2, 1))
        pairs = zip(mine, mine[1:])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, edits = least_edits(items, repair.NOTHING, None)
        kept, state = repair.edited(items, repair.NOTHING, edits)
        assert state in (repair.NOTHING, repair.ASSISTANT)
        lines = "\n".join(f"{t['role']}:{t['text']}" for t in kept)
        out[conv] = (gaps, *counts, illegal, cost, edits, hashlib.sha256(lines.encode()).hexdigest())
    return out


def reported(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("segment, block", [(repair.SEGMENT, repair.BLOCK), (3, 2), (2, 1000)])
def test_reports_follow_the_contract(spark, segment, block):
    draw = random.Random(3)
    texts = ["Yes.", "No!", "cut", "", " \t", "Why?", "a. ", "ß.", None]
    rows = [
        (draw.choice([1, 2, 3, 4, 5, None]), draw.choice([*range(30), None]), draw.choice([*ROLES, None]),
         draw.choice(texts) if draw.random() < 0.5 else f"text {draw.randint(0, 99)}.")
        for _ in range(300)
    ]
    rows += [(6, 2, "user", "same.")] * 40 + [(7, t, "user", "same.") for t in range(40)] + [(8, 0, "system", "s.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    fixed = repair.repair(df, segment=segment, block=block)
    assert reported(repair.report(fixed)) == plain_report(rows)
    listed = repair.repaired_rows(fixed).orderBy("conv_id", "place", "at").collect()
    for conv in {r[0] for r in rows}:
        roles = "".join(r.role[0] for r in listed if r.conv_id == conv)
        assert roles == "" or roles.lstrip("s").replace("ua", "") == ""


def test_a_conversation_of_all_rows_is_dealt_over_tasks(spark):
    rows = [(1, t, "ua"[t % 2].replace("u", "user").replace("a", "assistant"), f"line {t}" + "." * (t % 5 > 0)) for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    ordered = repair.ordered_rows(df, None)
    sizes = [len(p) for p in ordered.select("turn").rdd.glom().collect()]
    assert max(sizes) < 0.6 * 3000
    assert reported(repair.report(repair.repair(df, segment=64, block=4))) == plain_report(rows)


def test_damage_is_by_checksum(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (*range(40), None) for r, x in [("user", "A. b!"), (None, None)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(key.encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else x.replace(".", "").replace("!", "").replace("?", "") if kind == 2 else x
        want += [(c, t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(repr, map(tuple, repair.damaged(df).collect()))) == sorted(map(repr, want))


def test_every_conversation_comes_back(spark):
    rows = table(spark, SF, "conversations")
    out = op12_repair(spark, SF)
    assert sorted(r.conv_id for r in out.collect()) == sorted(r.conv_id for r in rows.select("conv_id").distinct().collect())
    gone = spark.createDataFrame([(5,), (None,)], "conv_id long")
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string, n string, place string")
    empty = hashlib.sha256(b"").hexdigest()
    assert reported(repair.report(repair.repair(none, known=gone))) == {k: (0, 0, 0, 0, 0, 0, "", empty) for k in (5, None)}
    assert repair.report(repair.repair(none)).count() == 0


def test_very_long_texts_and_clashing_columns(spark):
    long = "word " * 400_000
    rows = [(1, 0, "user", long, "x", 1), (1, 1, "assistant", long + "end.", "x", 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, digest string, n int")
    assert reported(repair.report(repair.repair(df)))[1][:7] == (0, 0, 0, 1, 0, 3, "KK")
