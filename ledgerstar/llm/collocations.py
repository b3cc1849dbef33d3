"""Phrase collocation mining over a HAT-trie of word paths.

1. A task turns its texts into word numbers and counts, for every word, the path of this word
   and the next three of its piece. Paths lie in a trie over word numbers of at most two
   levels whose leaves are containers: arrays of paths, made distinct when they have doubled.
   A container that outgrows BURST is split between two words; one that holds a single word
   goes down a level. Beyond MOST_HELD paths whole subtrees, the largest first, leave the
   trie as sorted runs, in which the phrases of one to four words are counted as path prefixes.
2. Runs are dealt by the leading part of a hash of the whole phrase, packed, so a word that a
   third of all rows hold is spread over all tasks. A task merges one part after the other and
   keeps the phrases that are frequent enough; every part of such a phrase is frequent too.
3. Cuts, containment and ranks are joins and aggregates over the frequent phrases. A language's
   phrases compete in HEATS groups before the first ones of each are ranked together.

Counts cover all texts and are exact, as are scores (decimals).

Defined cases: a null text is empty; a null language is `und`; texts without words give
nothing; very long texts are read in slices; ties of score and count go by the phrase's
bytes; rows that repeat count each; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstar.llm.common import rows_of, stored
from ledgerstar.llm.words import mixed

LONGEST, LEAST_COUNT, TOP = 4, 30, 2000
# a longer phrase hides its parts if it makes up this much of their occurrences
HIDING_PERCENT, SCORE_SCALE = 80, 2_000_000
BURST, MOST_HELD = 1 << 16, 1 << 20
SLICE = 4 << 20  # bytes of text looked at together
PARTS_PER_TASK = 4
HEATS = 256

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BREAK = b"\xff"  # never a byte of UTF-8
_FOLD = bytearray(range(256))
for _upper in range(ord("A"), ord("Z") + 1):
    _FOLD[_upper] = _upper + 32
for _end in b".,;:!?\n\v\f\r":
    _FOLD[_end] = _BREAK[0]
_FOLD[ord("\t")] = ord(" ")
_FOLD = bytes(_FOLD)


# ---- words

class Words(dict):
    """Numbers of words from 1 on, given at first sight; the break is 0."""

    def __init__(self):
        super().__init__({_BREAK: 0})
        self.names: list[bytes] = [b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        return number


def slices(text: bytes, size: int) -> Iterator[bytes]:
    """A folded text in pieces of about `size`, cut at blanks and breaks only."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(b" ", at, at + size), text.rfind(_BREAK, at, at + size))
        if cut <= at:
            ends = [e for e in (text.find(b" ", at + size), text.find(_BREAK, at + size)) if e >= 0]
            cut = min(ends, default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def numbered(texts: Iterable[bytes], words: Words, size: int = SLICE) -> Iterator[np.ndarray]:
    """Word numbers of the texts, a break after each, in arrays of about `size` bytes of text."""
    def read(folded: bytes) -> np.ndarray:
        found = folded.replace(_BREAK, b" \xff ").split()
        return np.fromiter(map(words.__getitem__, found), np.uint64, len(found))

    held, weight = [], 0
    for text in texts:
        folded = text.translate(_FOLD)
        for piece in slices(folded, size) if len(folded) > size else [folded]:
            held.append(piece)
            weight += len(piece)
            if weight >= size:
                # what is cut off a text goes on without a break
                yield read(b"".join(held))
                held, weight = [], 0
        held.append(_BREAK)
    if held:
        yield read(b"".join(held))


# ---- the trie

Paths = tuple[np.ndarray, np.ndarray, np.ndarray]  # first two words, last two, counts


def distinct(parts: list[Paths]) -> Paths:
    """Sorted distinct paths with the sums of their counts."""
    high, low, count = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((low, high))
    high, low, count = high[order], low[order], count[order]
    change = np.ones(len(high), bool)
    change[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    heads = np.flatnonzero(change)
    return high[heads], low[heads], np.add.reduceat(count, heads) if len(heads) else count


class Container:
    """Paths of one stretch of the trie; new ones wait until they are as many as the old."""

    def __init__(self, paths: Paths):
        self.paths, self.waiting, self.size = paths, [], len(paths[0])

    def add(self, paths: Paths) -> None:
        self.waiting.append(paths)
        self.size += len(paths[0])

    def compact(self) -> None:
        if self.waiting:
            self.paths, self.waiting = distinct([self.paths, *self.waiting]), []
            self.size = len(self.paths[0])


class HatTrie:
    """Containers in the order of the paths, each from its least first two words on."""

    def __init__(self, spill: Callable[[Paths], None], burst: int = BURST, most: int = MOST_HELD):
        self.spill, self.burst, self.most = spill, burst, most
        none = np.empty(0, np.uint64)
        self.begins = np.zeros(1, np.uint64)
        self.containers = [Container((none, none, np.empty(0, np.int64)))]

    def add(self, ids: np.ndarray) -> None:
        """Count the paths that begin at all but the last LONGEST - 1 words."""
        n = len(ids) - LONGEST + 1
        if n <= 0:
            return
        words = [ids[:n]]
        for at in range(1, LONGEST):  # nothing follows a break
            words.append(ids[at : at + n] * (words[-1] > 0))
        real = words[0] > 0
        high = (words[0] << np.uint64(32) | words[1])[real]
        low = (words[2] << np.uint64(32) | words[3])[real]
        if not len(high):
            return
        paths = distinct([(high, low, np.ones(len(high), np.int64))])
        edges = np.searchsorted(paths[0], self.begins[1:])
        bounds = [0, *edges.tolist(), len(paths[0])]
        grown = []
        for at, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b:
                held = self.containers[at]
                held.add(tuple(p[a:b] for p in paths))
                if held.size > max(self.burst, 2 * len(held.paths[0])):
                    held.compact()
                    if held.size > self.burst:
                        grown.append(at)
        for at in reversed(grown):
            self._split(at)
        if self.size() > self.most:
            self._spill_largest()

    def size(self) -> int:
        return sum(c.size for c in self.containers)

    def _split(self, at: int) -> None:
        """Split a container near its middle: between two first words, or within one between two second ones."""
        high = self.containers[at].paths[0]
        middle = len(high) // 2
        cut = None
        for shift in (np.uint64(32), np.uint64(0)):
            word = high >> shift
            left, right = np.searchsorted(word, word[middle]), np.searchsorted(word, word[middle], "right")
            cut = left if 0 < left and (middle - left <= right - middle or right == len(high)) else right
            if 0 < cut < len(high):
                begin = high[cut] >> shift << shift
                break
        else:
            return  # one pair of words
        left, right = (tuple(p[s] for p in self.containers[at].paths) for s in (slice(cut), slice(cut, None)))
        self.containers[at : at + 1] = [Container(left), Container(right)]
        self.begins = np.insert(self.begins, at + 1, begin)
        for part in (at + 1, at):
            if self.containers[part].size > self.burst:
                self._split(part)

    def _spill_largest(self) -> None:
        """Subtrees leave as sorted runs, the largest first, until half the room is free."""
        left = self.size()
        for held in sorted(self.containers, key=lambda c: -c.size):
            if left <= self.most // 2:
                break
            left -= held.size
            self._emptied(held)

    def _emptied(self, held: Container) -> None:
        held.compact()
        if held.size:
            self.spill(held.paths)
        held.paths, held.size = tuple(p[:0] for p in held.paths), 0

    def close(self) -> None:
        """The whole trie as one run."""
        for held in self.containers:
            held.compact()
        paths = tuple(np.concatenate(c) for c in zip(*(c.paths for c in self.containers)))
        if len(paths[0]):
            self.spill(paths)
        self.containers = self.containers[:1]
        self.begins = self.begins[:1]
        self.containers[0].paths, self.containers[0].size = tuple(p[:0] for p in paths), 0


def phrases_of(paths: Paths) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, one row per word; counts) of the phrases of each length in a sorted run."""
    high, low, count = paths
    half = np.uint64(32)
    words = [high >> half, high & np.uint64(0xFFFFFFFF), low >> half, low & np.uint64(0xFFFFFFFF)]
    change = np.zeros(len(high), bool)
    change[:1] = True
    for n in range(LONGEST):
        change[1:] |= words[n][1:] != words[n][:-1]
        heads = np.flatnonzero(change)
        total = np.add.reduceat(count, heads)
        whole = words[n][heads] > 0
        yield np.array([w[heads][whole] for w in words[: n + 1]], np.uint32), total[whole]


# ---- runs

_RUN = pa.struct([("lang", pa.string()), ("lines", pa.binary()), ("counts", pa.binary())])
_RUNS = pa.schema([("part", pa.int64()), ("runs", pa.list_(_RUN))])
_RUNS_TYPE = "part long, runs array<struct<lang:string,lines:binary,counts:binary>>"


def packed(lines: list[memoryview], counts: list[np.ndarray]) -> tuple[bytes, bytes]:
    pack = zstandard.ZstdCompressor(level=1).compress
    return pack(b"".join(lines)), pack(np.concatenate(counts).tobytes())


def unpacked(lines: bytes, counts: bytes) -> pa.Table:
    """phrase, count of a packed run, in which a line end follows every phrase."""
    unpack = zstandard.ZstdDecompressor().decompress
    split = pc.split_pattern(pa.array([unpack(lines)], pa.large_binary()).cast(pa.large_string()), "\n")
    counts = pa.array(np.frombuffer(unpack(counts), np.int64))
    return pa.table({"phrase": split.values[: len(counts)], "count": counts})


class Tally:
    """Tries of the languages of one task, and the packed runs that left them."""

    def __init__(self, parts: int, burst: int, most: int):
        self.parts, self.burst, self.most = parts, burst, most
        self.ready: list[tuple] = []
        self.reset()

    def reset(self) -> None:
        self.words: dict[str, Words] = {}
        self.tries: dict[str, HatTrie] = {}

    def add(self, lang: str, texts: Iterable[bytes]) -> None:
        if lang not in self.tries:
            words = self.words[lang] = Words()
            self.tries[lang] = HatTrie(lambda p: self.ready.extend(self.runs(lang, words, p)), self.burst, self.most)
        rest = np.empty(0, np.uint64)
        for ids in numbered(texts, self.words[lang]):
            ids = np.concatenate([rest, ids])
            self.tries[lang].add(ids)
            rest = ids[max(0, len(ids) - LONGEST + 1) :]
        self.tries[lang].add(np.concatenate([rest, np.zeros(LONGEST - 1, np.uint64)]))
        if sum(t.size() for t in self.tries.values()) > self.most or sum(map(len, self.words.values())) > self.most // 2:
            self.close()

    def close(self) -> None:
        for trie in self.tries.values():
            trie.close()
        self.reset()

    def runs(self, lang: str, words: Words, paths: Paths) -> Iterator[tuple]:
        """(part, lang, packed run) of all phrases of a sorted run."""
        names = pa.array(words.names, pa.large_binary())
        ends = pa.array([n + b"\n" for n in words.names], pa.large_binary())
        own = np.fromiter(map(xxhash.xxh3_64_intdigest, words.names), np.uint64, len(words.names))
        found: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
        for numbers, count in phrases_of(paths):
            key = np.zeros(len(count), np.uint64)
            with np.errstate(over="ignore"):
                for row in numbers:
                    key = mixed(key * _MIX + own[row])
            part = (key % np.uint64(self.parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            columns = [held.take(pa.array(row[order])) for row, held in zip(numbers, [names] * (len(numbers) - 1) + [ends])]
            whole = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()))
            offsets, text = np.frombuffer(whole.buffers()[1], np.int64), memoryview(whole.buffers()[2] or b"")
            firsts = np.searchsorted(part[order], np.arange(self.parts + 1))
            counts = count[order]
            for number in np.flatnonzero(np.diff(firsts)).tolist():
                a, b = firsts[number : number + 2]
                found[number][0].append(text[offsets[a] : offsets[b]])
                found[number][1].append(counts[a:b])
        for number, (lines, counts) in found.items():
            yield number, lang, *packed(lines, counts)


def runs_of(docs: DataFrame, parts: int, burst: int, most: int) -> DataFrame:
    """part, runs: packed sorted runs of the phrases of all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(parts, burst, most)

        def ready() -> Iterator[pa.RecordBatch]:
            by_part: dict[int, list[dict]] = defaultdict(list)
            for part, lang, lines, counts in tally.ready:
                by_part[part].append({"lang": lang, "lines": lines, "counts": counts})
            tally.ready = []
            while by_part:
                some = [by_part.popitem() for _ in range(min(64, len(by_part)))]
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*some), _RUNS)], schema=_RUNS)

        for batch in batches:
            by_lang: dict[str, list[bytes]] = defaultdict(list)
            weight = 0
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary())):
                by_lang[lang].append(raw := text.as_py())
                weight += len(raw)
                if weight > SLICE:
                    for name, texts in by_lang.items():
                        tally.add(name, texts)
                    by_lang, weight = defaultdict(list), 0
                    yield from ready()
            for name, texts in by_lang.items():
                tally.add(name, texts)
            yield from ready()
        tally.close()
        yield from ready()

    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(work, _RUNS_TYPE)


_COUNTS = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def frequent(runs: DataFrame, parts: int, least: int) -> DataFrame:
    """lang, n, phrase, f: phrases of at least `least` occurrences; n = 0 rows sum up all words of a part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(held: dict[str, list[tuple]]) -> Iterator[pa.RecordBatch]:
            for lang, packs in held.items():
                tables = pa.concat_tables([unpacked(*p) for p in packs])
                total = tables.group_by("phrase", use_threads=False).aggregate([("count", "sum")])
                single = pc.invert(pc.match_substring(total["phrase"], " "))
                words = pc.sum(total["count_sum"].filter(single)).as_py() or 0
                often = total.filter(pc.greater_equal(total["count_sum"], least))
                n = pc.add(pc.count_substring(often["phrase"], " "), 1).cast(pa.int32())
                lang_rows = pa.array([lang] * len(often), pa.string())
                rows = pa.table([lang_rows, n, often["phrase"].cast(pa.string()), often["count_sum"]], schema=_COUNTS)
                yield from rows.combine_chunks().to_batches(max_chunksize=1 << 16)
                yield pa.record_batch([[lang], [0], [None], [words]], schema=_COUNTS)

        for _, rows in groupby(rows_of(batches, "part", "runs"), key=lambda r: r[0]):
            held: dict[str, list[tuple]] = defaultdict(list)
            for _, some in rows:
                for run in some:
                    held[run["lang"]].append((run["lines"], run["counts"]))
            yield from merged(held)

    dealt = runs.repartition(max(1, parts // PARTS_PER_TASK), "part").sortWithinPartitions("part")
    return dealt.mapInArrow(work, "lang string, n int, phrase string, f long")


# ---- scores

def _words(phrase: Column) -> Column:
    return F.split(phrase, " ")


def _exact(count: Column) -> Column:
    return count.cast("decimal(20,0)")


def scored(counted: DataFrame, least: int) -> DataFrame:
    """lang, phrase, a, l, r, score of all candidates at their lowest cut."""
    part = counted.filter("n > 0").select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("f"))
    first, rest = part.withColumnRenamed("f", "l"), part.withColumnRenamed("f", "r")
    cuts = counted.filter((F.col("n") > 1) & (F.col("f") >= least)).select(
        "lang", "phrase", F.col("f").alias("a"), _words(F.col("phrase")).alias("w"),
        F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("before"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("after"),
    )
    met = cuts.join(first, (F.col("lang") == F.col("part_lang")) & (F.col("before") == F.col("part"))).drop("part_lang", "part")
    met = met.join(rest, (F.col("lang") == F.col("part_lang")) & (F.col("after") == F.col("part"))).drop("part_lang", "part")
    # a quotient of integers, not of rounded decimals
    score = F.expr(f"cast(a as decimal(20,0)) * cast({SCORE_SCALE} as decimal(10,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    cut = F.struct(score.alias("score"), "k", "l", "r")
    return met.groupBy("lang", "phrase", "a").agg(F.min(cut).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def hidden(counted: DataFrame, least: int) -> DataFrame:
    """lang, phrase, widest: for each candidate within longer ones, the most frequent of these."""
    longer = counted.filter((F.col("n") > 2) & (F.col("f") >= least)).select("lang", "n", "f", _words(F.col("phrase")).alias("w"))
    spans = longer.select(
        "lang", "f", "w", "n", F.explode(F.expr("sequence(2, n - 1)")).alias("size")
    ).select("lang", "f", "w", "size", F.explode(F.expr("sequence(1, n - size + 1)")).alias("at"))
    inside = spans.select("lang", "f", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"))
    return inside.groupBy("lang", "phrase").agg(F.max("f").alias("widest"))


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, burst: int = BURST, most: int = MOST_HELD
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of every language."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = tasks * PARTS_PER_TASK
    counted = stored(frequent(runs_of(docs, parts, burst, most), parts, least), "phrase-counts")
    words = counted.filter("n = 0").groupBy("lang").agg(F.sum("f").cast("long").alias("n"))
    held = scored(counted, least).join(hidden(counted, least), ["lang", "phrase"], "left").filter(
        F.col("widest").isNull() | (_exact(F.col("widest")) * 100 < _exact(F.col("a")) * HIDING_PERCENT)
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]

    def first(rows: DataFrame, *by: Column) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn("rank", place).filter(F.col("rank") <= top)

    # a language's phrases are ranked together only after each heat has kept its first ones
    heats = first(held, F.col("lang"), F.pmod(F.xxhash64("phrase"), F.lit(HEATS))).drop("rank")
    return first(heats, F.col("lang")).join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
