"""Conversation structure repair by iterative-deepening A*.

A conversation's rows stand by turn (nulls first), then role, then a digest of the text. A row
may be blank, a duplicate (same role and text earlier in the conversation) or truncated (its
last character that is no blank ends no sentence). The cheapest edits are sought that make the
initials of its roles read `(s?(ua)+)?`: Delete, Insert, Keep or Rerole, in this order, which
is ASCII order. A depth-first search under a bound tries them in that order; the bound grows
to the least cost met beyond it, so the first accepting path is the cheapest, and the
ASCII-least of these. A transposition table holds, for every state a search has failed in, the
least cost that its rest is known to need.

In Spark: equal rows of a turn are counted first; first turns of repeated texts come from a
hash aggregate; a range partitioning by (conversation, turn, role, digest) brings rows into
order, so that a conversation of any length is dealt over many tasks. A conversation that lies
whole in one task, and has at most SEGMENT rows, is searched at once. Others are cut into
segments, each searched for every state it may begin and end in; as inserts stand before the
row that follows them, cheapest and ASCII-least edits of the whole are put together from
those of the segments. Blocks of BLOCK segments, then blocks of a conversation, are chained by
costs and ranks alone. Texts are moved by the range partitioning and never gathered.

Defined cases: a null role or text is one blank; an empty role fits no place, so its row is
rewritten or deleted; rows repeated within a turn are duplicates of the first; a null conv_id
is a conversation of its own; other columns are not read; an empty table gives none. Texts of
any length are only looked at at their ends and digested.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.llm.common import in_batches, rows_of, stored

SEGMENT, BLOCK = 128, 1024

# What edits cost, and the text rules.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
_INK = re.compile(r"[^\x20\x09-\x0D]")
_BLANKS = " \t\n\v\f\r"
_ENDS = ".!?"
_LEGAL = frozenset(["su", "ua", "au"])

# States: nothing yet, system last, user last, assistant last.
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # the state that an inserted or rewritten row leads to
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_CLOSE = (0, 2 * INSERT, INSERT, 0)  # inserts after the last row

Way = tuple[int, str]  # cost, edits


class Item:
    """A row, or `times` rows alike that all have to go."""

    __slots__ = ("role", "text", "gone", "cut", "times")

    def __init__(self, role: str, text: str, gone: bool, cut: bool, times: int):
        self.role, self.text, self.gone, self.cut, self.times = role, text, gone, cut, times

    def least(self) -> int:
        """What any edit of it costs at least."""
        return DELETE * self.times if self.gone else TRUNCATED * self.cut

    def moves(self, state: int) -> list[tuple[str, int, int, int]]:
        """(letters, cost, rows taken, next state) of its edits, in ASCII order."""
        out = [("D" * self.times, DELETE * self.times, 1, state), ("I", INSERT, 0, _NEXT[state])]
        if not self.gone:
            extra = TRUNCATED * self.cut
            kept = _KEPT[state].get(self.role[:1])
            if kept is not None:
                out.append(("K", extra, 1, kept))
            out.append(("R", REROLE + extra, 1, _NEXT[state]))
        return out


def cheapest(items: list[Item], entry: int, leave: int | None) -> Way | None:
    """Least cost and ASCII-least edits from `entry` to `leave`, or to a whole conversation.

    To reach `leave` no insert follows the last row; None is any state, and inserts after
    the last row close it.
    """
    n = len(items)
    if leave is not None and not _reachable(items, entry, leave):
        return None
    end = [*_CLOSE] if leave is None else [0 if s == leave else math.inf for s in STATES]
    need = [end]
    for item in reversed(items):
        need.append([item.least() + min(need[-1])] * 4)
    need.reverse()

    def moves(at: int, state: int):
        if at < n:
            return iter(items[at].moves(state))
        return iter([("I", INSERT, 0, _NEXT[state])] if leave is None and _CLOSE[state] else [])

    while True:
        bound = need[0][entry]
        if bound == math.inf:
            return None
        # a frame: place, state, cost so far, edits left, least cost its rest needs
        stack = [[0, entry, 0, moves(0, entry), math.inf]]
        path: list[str] = []
        while stack:
            frame = stack[-1]
            at, state, spent, left, low = frame
            if at == n and need[n][state] == 0:
                return spent, "".join(path)
            for letters, cost, step, then in left:
                rest = cost + need[at + step][then]
                if spent + rest <= bound:
                    path.append(letters)
                    stack.append([at + step, then, spent + cost, moves(at + step, then), math.inf])
                    break
                frame[4] = min(frame[4], rest)
            else:
                need[at][state] = max(need[at][state], frame[4])
                stack.pop()
                if stack:
                    path.pop()
                    above = stack[-1]
                    above[4] = min(above[4], spent - above[2] + need[at][state])


def _reachable(items: list[Item], entry: int, leave: int) -> bool:
    if leave == NOTHING:
        return entry == NOTHING
    if leave == SYSTEM:
        return entry == SYSTEM or entry == NOTHING and any(i.role[:1] == "s" and not i.gone for i in items)
    return True


def all_ways(items: list[Item]) -> dict[tuple[int, int], Way]:
    found = {(p, q): cheapest(items, p, q) for p in STATES for q in STATES}
    return {k: w for k, w in found.items() if w is not None}


def joined(left: dict[tuple[int, int], Way], right: dict[tuple[int, int], Way]) -> dict[tuple[int, int], Way]:
    """The ways through two stretches, one after the other."""
    out: dict[tuple[int, int], Way] = {}
    for (p, m), (cost, edits) in left.items():
        for (again, q), (more, others) in right.items():
            if m == again:
                way = (cost + more, edits + others)
                out[p, q] = min(out.get((p, q), way), way)
    return out


def ranked(ways: dict[tuple[int, int], Way], keep_edits: bool) -> list[dict]:
    """Rows of entry, leave, cost, rank, edits; of one entry, a lower rank has ASCII-lesser edits."""
    out = []
    for p in STATES:
        mine = sorted((w[1], q) for (entry, q), w in ways.items() if entry == p)
        for rank, (edits, q) in enumerate(mine):
            row = {"entry": p, "leave": q, "cost": ways[p, q][0], "rank": rank}
            out.append({**row, "edits": edits if keep_edits else None})
    return out


def route(stretches: list[list[tuple]], entry: int, leave: int | None) -> list[tuple[int, int]]:
    """(entry, leave) of each stretch on the cheapest way, of several the ASCII-least one."""
    togo = [list(_CLOSE) if leave is None else [0 if s == leave else math.inf for s in STATES]]
    for ways in reversed(stretches):
        rest = [math.inf] * 4
        for p, q, cost, _ in ways:
            rest[p] = min(rest[p], cost + togo[-1][q])
        togo.append(rest)
    out = []
    for ways, before, after in zip(stretches, togo[:0:-1], togo[-2::-1]):
        _, q = min((rank, q) for p, q, cost, rank in ways if p == entry and cost + after[q] == before[entry])
        out.append((entry, q))
        entry = q
    return out


def edited(items: list[Item], entry: int, edits: str) -> tuple[list[dict], int]:
    """The rows after the edits, and the state they end in."""
    out, at, row, state = [], 0, 0, entry
    while at < len(edits):
        letter = edits[at]
        if letter == "I":
            state = _NEXT[state]
            out.append({"role": _ROLE[state], "text": ""})
            at += 1
            continue
        item = items[row]
        if letter == "R":
            state = _NEXT[state]
            out.append({"role": _ROLE[state], "text": item.text})
        elif letter == "K":
            state = _KEPT[state][item.role[:1]]
            out.append({"role": item.role, "text": item.text})
        at += item.times
        row += 1
    return out, state


# ---- rows in order

def ordered_rows(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """conv_id, turn, role, text, n, late: distinct rows; n is 0 for a conversation's own row."""
    same = ["conv_id", "turn", "role", "text"]
    counted = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    ).groupBy(*same).agg(F.count(F.lit(1)).alias("n")).withColumn("digest", F.sha2("text", 256))
    # texts that stand at several turns of a conversation: all after the first are late
    again = counted.groupBy("conv_id", "role", "digest").agg(
        F.min(_turn_order()).alias("first"), F.count(F.lit(1)).alias("turns")
    ).filter("turns > 1").select(
        F.col("conv_id").alias("a_conv"), F.col("role").alias("a_role"), F.col("digest").alias("a_digest"), "first"
    )
    met = (
        F.col("conv_id").eqNullSafe(F.col("a_conv")) & (F.col("role") == F.col("a_role"))
        & (F.col("digest") == F.col("a_digest"))
    )
    marked = counted.join(again, met, "left").select(
        *same, "n", "digest", F.coalesce(_turn_order() > F.col("first"), F.lit(False)).alias("late")
    )
    if known is not None:
        marked = marked.unionByName(known.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
            "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
            F.lit(0).cast("long").alias("n"), F.lit("").alias("digest"), F.lit(False).alias("late"),
        ))
    order = ["conv_id", "turn", "role", "digest", "n"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def _turn_order() -> Column:
    return F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))


def items_of(role: str, text: str, n: int, late: bool) -> list[Item]:
    ink = _INK.search(text) is not None
    if late or not ink:
        return [Item(role, text, True, False, n)]
    first = Item(role, text, False, text.rstrip(_BLANKS)[-1] not in _ENDS, 1)
    return [first] if n == 1 else [first, Item(role, text, True, False, n - 1)]


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_FACTS = [
    ("rows", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("first_turn", pa.int64()),
    ("last_turn", pa.int64()), ("turns_met", pa.int64()),
]
_WAYS = pa.list_(pa.struct([
    ("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("edits", pa.string()),
]))
_PIECES = pa.schema([
    ("kind", pa.string()), ("conv_id", pa.int64()), ("place", pa.int64()), ("block", pa.int64()), *_FACTS,
    ("cost", pa.int64()), ("audit", pa.string()), ("turns", _TURNS), ("ways", _WAYS),
    ("items", pa.list_(pa.struct([
        ("role", pa.string()), ("text", pa.string()), ("gone", pa.bool_()), ("cut", pa.bool_()), ("times", pa.int64()),
    ]))),
])
_FACT_TYPES = (
    "rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "first_turn long, last_turn long, turns_met long"
)
_PIECE_TYPES = (
    f"kind string, conv_id long, place long, block long, {_FACT_TYPES}, cost long, audit string, "
    "turns array<struct<role:string,text:string>>, "
    "ways array<struct<entry:int,leave:int,cost:long,rank:int,edits:string>>, "
    "items array<struct<role:string,text:string,gone:boolean,cut:boolean,times:long>>"
)


class Stretch:
    """Counts over rows that follow each other."""

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns_met = 0
        self.first = self.last = self.first_turn = self.last_turn = None

    def facts(self) -> tuple:
        return tuple(getattr(self, name) for name, _ in _FACTS)

    def row(self, turn: int | None, role: str, n: int, items: list[Item], text: str) -> None:
        self.add(n, 0, 0, sum(i.cut for i in items), n - 1, role[:1], role[:1], turn, turn, int(turn is not None))
        gone = sum(i.times for i in items if i.gone)
        if _INK.search(text):
            self.duplicate += gone
        else:
            self.blank += gone

    def add(self, rows, blank, duplicate, truncated, illegal, first, last, first_turn, last_turn, turns_met) -> None:
        """The counts of what follows."""
        if self.rows and rows:
            self.illegal += self.last + first not in _LEGAL
        if rows:
            self.first = first if self.first is None else self.first
            self.last = last
        if turns_met:
            turns_met -= self.last_turn == first_turn
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn
        self.rows += rows
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.illegal += illegal
        self.turns_met += turns_met

    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns_met if self.turns_met else 0


class Cutter:
    """Rows of one task, in order, to finished conversations, segments and blocks.

    The first and the last conversation of a task may go on in other tasks.
    """

    def __init__(self, place: int, segment: int, block: int):
        self.place, self.segment, self.block = place, segment, block
        self.conversations = 0

    def begin(self, conv_id: int | None) -> None:
        self.conv_id, self.cut, self.chained = conv_id, 0, 0
        self.items, self.facts = [], Stretch()
        self.conversations += 1

    def take(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, turn, role, text, n, late in rows:
            if not self.conversations:
                self.begin(conv_id)
            elif conv_id != self.conv_id:
                yield from self.finish(last=False)
                self.begin(conv_id)
            if n:
                more = items_of(role, text, n, late)
                if len(self.items) + len(more) > self.segment:
                    yield from self.cut_off()
                self.items += more
                self.facts.row(turn, role, n, more, text)
        if self.conversations:
            yield from self.finish(last=True)

    def finish(self, last: bool) -> Iterator[tuple]:
        if self.cut or last or self.conversations == 1:
            yield from self.cut_off()
            if self.chained:
                yield self.blocked()
            return
        cost, edits = cheapest(self.items, NOTHING, None)
        self.place += 1
        turns, _ = edited(self.items, NOTHING, edits)
        yield ("whole", self.conv_id, self.place, None, *self.facts.facts(), cost, edits, turns, None, None)

    def cut_off(self) -> Iterator[tuple]:
        self.place += 1
        ways = all_ways(self.items)
        self.chain = joined(self.chain, ways) if self.chained else ways
        self.begun = self.begun if self.chained else self.place
        items = [{k: getattr(i, k) for k in Item.__slots__} for i in self.items]
        yield ("segment", self.conv_id, self.place, self.begun, *self.facts.facts(), None, None, None, ranked(ways, True), items)
        self.items, self.facts = [], Stretch()
        self.cut, self.chained = self.cut + 1, self.chained + 1
        if self.chained == self.block:
            yield self.blocked()

    def blocked(self) -> tuple:
        self.chained = 0
        none = [None] * (len(_FACTS) + 3)
        return ("block", self.conv_id, self.begun, self.begun, *none, ranked(self.chain, False), None)


def pieces_of(ordered: DataFrame, segment: int, block: int) -> DataFrame:
    """Finished conversations (`whole`), and segments and blocks of the others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(TaskContext.get().partitionId() << 40, segment, block)
        rows = rows_of(batches, "conv_id", "turn", "role", "text", "n", "late")
        yield from in_batches(cutter.take(rows), _PIECES, size=1024)

    return ordered.mapInArrow(work, _PIECE_TYPES)


# ---- the way through conversations of several segments

_CHOICES = pa.schema([("stretch", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32()), ("closing", pa.bool_())])


def chosen(stretches: DataFrame, group: str) -> DataFrame:
    """stretch, entry, leave, closing: the route through the stretches of each group, in order of place.

    `given_entry` and `given_leave` are a group's ends; without an end its last stretch closes
    the conversation. Only costs and ranks are held.
    """
    named = stretches.select(
        F.col(group).alias("grp"), "place", "given_entry", "given_leave", "closes",
        F.transform("ways", lambda w: F.struct(w["entry"].alias("p"), w["leave"].alias("q"), w["cost"].alias("c"), w["rank"].alias("r"))).alias("ways"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            read = rows_of(batches, "grp", "place", "given_entry", "given_leave", "closes", "ways")
            for _, group_rows in groupby(read, key=lambda r: r[0]):
                held = list(group_rows)
                _, _, entry, leave, closes, _ = held[0]
                ways = [[tuple(w[k] for k in "pqcr") for w in r[5]] for r in held]
                for at, (row, (p, q)) in enumerate(zip(held, route(ways, entry, leave))):
                    yield row[1], p, q, closes and at == len(held) - 1

        yield from in_batches(rows(), _CHOICES)

    dealt = named.repartition("grp").sortWithinPartitions("grp", "place")
    return dealt.mapInArrow(work, "stretch long, entry int, leave int, closing boolean")


def settled(pieces: DataFrame) -> DataFrame:
    """The segments with their cost, audit and turns."""
    blocks = pieces.filter("kind = 'block'").select(
        "conv_id", "place", "ways", F.lit(NOTHING).alias("given_entry"), F.lit(None).cast("int").alias("given_leave"),
        F.lit(True).alias("closes"),
    )
    ends = stored(chosen(blocks, "conv_id"), "repair-blocks")
    segments = pieces.filter("kind = 'segment'")
    inner = segments.select("place", "block", "ways").join(ends, F.col("block") == F.col("stretch")).select(
        "block", "place", "ways", F.col("entry").alias("given_entry"), F.col("leave").alias("given_leave"),
        F.col("closing").alias("closes"),
    )
    choices = stored(chosen(inner, "block"), "repair-segments")
    rows = segments.join(choices, F.col("place") == F.col("stretch"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _PIECES.names

        def done():
            for row in rows_of(batches, *names, "entry", "leave", "closing"):
                piece, (entry, leave, closing) = list(row[: len(names)]), row[len(names):]
                way = next(w for w in row[names.index("ways")] if (w["entry"], w["leave"]) == (entry, leave))
                edits = way["edits"] + "I" * (_CLOSE[leave] // INSERT if closing else 0)
                turns, _ = edited([Item(**i) for i in row[names.index("items")]], entry, edits)
                cost = way["cost"] + (_CLOSE[leave] if closing else 0)
                for name, value in (("cost", cost), ("audit", edits), ("turns", turns), ("ways", None), ("items", None)):
                    piece[names.index(name)] = value
                yield tuple(piece)

        yield from in_batches(done(), _PIECES, size=1024)

    return rows.mapInArrow(work, _PIECE_TYPES)


def repair(
    rows: DataFrame, known: DataFrame | None = None, segment: int = SEGMENT, block: int = BLOCK
) -> DataFrame:
    """Repaired pieces of conversations: conv_id, place, counts, cost, audit, turns (role, text).

    A conversation is one piece, or several in order of place. Conversations of `known` that
    have no rows come back without turns.
    """
    pieces = stored(pieces_of(ordered_rows(rows, known), segment, block), "repair-pieces")
    out = pieces.filter("kind = 'whole'").unionByName(settled(pieces))
    return out.drop("block", "ways", "items")


def repaired_rows(repaired: DataFrame) -> DataFrame:
    """conv_id, place, at, role, text: the rows of the repaired conversations, in order of (place, at)."""
    return repaired.select("conv_id", "place", F.posexplode("turns").alias("at", "turn")).select(
        "conv_id", "place", "at", "turn.role", "turn.text"
    )


# ---- reports

_REPORT = pa.schema([
    ("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
])
_REPORT_TYPES = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def report(repaired: DataFrame) -> DataFrame:
    """One row per conversation: gaps, counts of faults, cost, audit, digest of the repaired rows.

    A conversation of one piece is reported where it lies; those of several are read in order,
    a piece at a time.
    """
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    spread = F.when(F.col("turns_met") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns_met"))
    whole = repaired.filter("kind = 'whole'").select(
        "conv_id", F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        "cost", "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *[n for n, _ in _FACTS], "cost", "audit", "turns"]

        def done():
            for conv_id, group in groupby(rows_of(batches, *names), key=lambda r: r[0]):
                facts, cost, audit, digest, some = Stretch(), 0, [], hashlib.sha256(), False
                for row in group:
                    facts.add(*row[1 : 1 + len(_FACTS)])
                    cost += row[-3]
                    audit.append(row[-2])
                    for turn in row[-1]:
                        digest.update((("\n" if some else "") + f"{turn['role']}:{turn['text']}").encode())
                        some = True
                yield (conv_id, facts.gaps(), facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost,
                       "".join(audit), digest.hexdigest())

        yield from in_batches(done(), _REPORT)

    parted = repaired.filter("kind = 'segment'").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return whole.unionByName(parted.mapInArrow(work, _REPORT_TYPES))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: every twentieth row dropped, emptied, cut, repeated or renamed, by a checksum."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    text = F.coalesce(F.col("text"), blank)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.array_repeat(F.lit(0), times).alias("copies"),
    ).select("conv_id", "turn", "role", "text", F.explode("copies")).drop("col")
