"""Benchmark decontamination: latent semantic retrieval, then subsequence and answer checks.

1. Documents are scanned once for the terms of the benchmark: words of few items and, where
   these make up less than LEAST_COVER of an item, the next rarest of its words, so that no
   match of an item is without any of its terms. Which words of the benchmark stand where is
   written; all that follows works on that small table, as other words decide nothing. No
   text is read again, joined or shuffled.
2. Frequencies over all passages give the weights; every term has one above 0. A randomised
   SVD of the weighted passages takes one pass: tasks add up the range sketch, and the small
   matrix follows from the sketch itself. Each item's own row weighs as much there as the
   corpus, so the space spans the items as far as its rank allows. Partial sums are matrices
   of terms by rank, added block by block.
3. Windows of three blocks, each as long as the items of a length class, are candidates for
   the items of that class that their cosine with the item's latent vector says. The bound
   of an item is what planted paraphrases of it reach (LEAST_PART of its words, drawn at
   random) in windows as noisy as all but one in a hundred passages of the corpus. Of these
   candidates, those that lack terms which a match must hold are passed over.
4. For each candidate the longest common subsequence of words with the item is measured,
   and that of the item's answer (its last sentence). A document is contaminated by an item
   if most of the item is there, or a good part of it with the answer.

All items share one scan and one space. The benchmark must fit a checked size; terms are
dealt to BUCKETS rows of the space at most, and its rank is MOST_RANK and some at most.

Words are runs of word characters in lower case. Defined cases: a null or empty text holds
nothing, a null or wordless item matches nothing; rows that share a doc_id are searched
each; long texts are cut into windows over their whole length; ties between windows of an
item go to the first; an empty table on either side gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerstar.llm.common import SMALL_TABLE_BYTES, bounded_rows, in_batches, rows_of, stored

COMMON_SHARE, LEAST_COVER = 0.02, 0.6
PASSAGE, UNIT = 64, 16
BUCKETS, MOST_RANK = 1 << 15, 256
PLANTED, NOISY = 64, 0.99
LEAST_MOST, LEAST_PART, LEAST_ANSWER = 0.8, 0.6, 0.6
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?。])\s+|\n+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def answer_of(text: str) -> list[str]:
    """Words of the last sentence, or of the last quarter where there is one sentence."""
    sentences = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    if len(sentences) > 1:
        return sentences[-1]
    words = words_of(text)
    return words[-max(1, len(words) // 4):]


def common_subsequence(pattern: list[str], words: list[str]) -> int:
    """Length of the longest common subsequence, with the pattern as bits of one number."""
    places: dict[str, int] = {}
    for at, word in enumerate(pattern):
        places[word] = places.get(word, 0) | 1 << at
    full = (1 << len(pattern)) - 1
    row = full
    for word in words:
        match = places.get(word)
        if match:
            hit = row & match
            row = ((row + hit) | (row - hit)) & full
    return len(pattern) - row.bit_count()


class Items:
    """The benchmark's items: words, terms, and length classes."""

    def __init__(self, rows: list[tuple[int, str]]):
        known = [(i, text, words_of(text)) for i, text in rows]
        self.ids = [i for i, _, _ in known]
        self.words = [w for _, _, w in known]
        self.answers = [answer_of(t or "") for _, t, _ in known]
        held = Counter(w for words in self.words for w in set(words))
        most = max(2, COMMON_SHARE * len(known))
        chosen: dict[str, None] = {}
        for words in self.words:
            times, covered = Counter(words), 0
            for word in sorted(times, key=lambda w: (held[w], w)):
                if held[word] > most and covered >= LEAST_COVER * len(words):
                    break
                covered += times[word]
                chosen.setdefault(word)
        self.numbers = {word: n for n, word in enumerate(dict.fromkeys([*chosen, *held]))}
        self.width = min(len(chosen), BUCKETS)
        # terms have the first numbers; the row of the space that stands for a word, or -1
        self.rows = np.full(len(self.numbers), -1, np.int32)
        self.rows[: len(chosen)] = np.arange(len(chosen)) % BUCKETS
        self.coded = [[self.numbers[w] for w in words] for words in self.words]
        self.coded_answers = [[self.numbers[w] for w in words] for words in self.answers]
        self.held = [rows[rows >= 0] for rows in (self.rows[np.array(words, np.int32)] for words in self.coded)]
        # a window twice as long as the class, moved by the class, holds any of its items
        self.spans = [UNIT << max(0, math.ceil(math.log2(max(1, len(w)) / UNIT))) for w in self.words]

    def least(self, item: int) -> float:
        """Terms that a match holds at the least: all words that it may lack can be terms."""
        return len(self.held[item]) - (1 - LEAST_PART) * len(self.words[item]) - 1e-9


# ---- 1: the scan

_HITS = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("places", pa.binary()), ("words", pa.binary()),
])


def scanned(docs: DataFrame, items: Items) -> DataFrame:
    """Where the benchmark's words stand in each document that holds any of its terms."""
    numbers, terms = items.numbers, int((items.rows >= 0).sum())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text_hash, text in rows_of(batches, "doc_id", "text_hash", "text"):
                found = np.array([numbers.get(w, -1) for w in words_of(text)], np.int32)
                places = np.flatnonzero(found >= 0).astype(np.int32)
                held = found[places]
                if (held < terms).any():
                    yield doc_id, text_hash, places.tobytes(), held.tobytes()

        yield from in_batches(rows(), _HITS)

    kind = "doc_id long, text_hash long, places binary, words binary"
    return stored(docs.mapInArrow(work, kind), "benchmark-terms")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner (row of the batch), place and number of all words found in a batch."""
    places = [np.frombuffer(p, np.int32) for p in batch["places"].to_pylist()]
    owner = np.repeat(np.arange(len(places)), [len(p) for p in places])
    return owner, np.concatenate(places), np.frombuffer(b"".join(batch["words"].to_pylist()), np.int32)


def _runs(owner: np.ndarray, place: np.ndarray, row: np.ndarray, span: int):
    """(where each passage begins, terms, row of each passage, number of each passage)."""
    term = row >= 0
    owner, number, row = owner[term], place[term] // span, row[term]
    heads = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (owner[1:] != owner[:-1])])
    return heads, row, owner[heads], number[heads]


# ---- 2: weights and the latent space

def _sums(rows: np.ndarray, heads: np.ndarray, held: np.ndarray, longest: int = 16, at_once: int = 1024) -> np.ndarray:
    """Sums of rows[held] over the runs that begin at `heads`.

    Runs are put in order of length, so the n-th members of all that have one are a slice;
    long runs are summed in pieces first.
    """
    sizes = np.diff(np.r_[heads, len(held)])
    if len(sizes) and sizes.max() > longest:
        pieces = -(-sizes // longest)
        firsts = np.cumsum(pieces) - pieces
        within = np.arange(int(pieces.sum())) - np.repeat(firsts, pieces)
        parts = _sums(rows, np.repeat(heads, pieces) + longest * within, held, longest, at_once)
        return _sums(parts, firsts, np.arange(len(parts)), longest, at_once)
    out = np.empty((len(heads), rows.shape[1]), rows.dtype)
    room = np.empty((at_once, rows.shape[1]), rows.dtype)
    for at in range(0, len(heads), at_once):
        order = np.argsort(-sizes[at : at + at_once], kind="stable") + at
        total = rows[held[heads[order]]]
        for n in range(1, int(sizes[order[0]])):
            have = int(np.searchsorted(-sizes[order], -n, "left"))
            total[:have] += np.take(rows, held[heads[order[:have]] + n], axis=0, out=room[:have], mode="clip")
        out[order] = total
    return out


def _summed(parts: DataFrame) -> DataFrame:
    """Add up equally long float64 vectors (place, total) by place, one batch after the other."""
    schema = pa.schema([("place", pa.int32()), ("total", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for place, total in rows_of(batches, "place", "total"):
            more = np.frombuffer(total, np.float64)
            held[place] = held[place] + more if place in held else more
        yield from in_batches(((p, t.tobytes()) for p, t in held.items()), schema)

    return parts.repartition("place").mapInArrow(work, "place int, total binary")


def _total(hits: DataFrame, rows: np.ndarray, shape: tuple[int, int], partial, rows_at_once: int = 256) -> np.ndarray:
    """Sum of what `partial(heads, terms, total)` adds for the passages of all batches and tasks."""
    schema = pa.schema([("place", pa.int32()), ("total", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for at in range(0, len(batch), 512):
                owner, place, word = _flat(batch.slice(at, 512))
                partial(*_runs(owner, place, rows[word], PASSAGE)[:2], total)
        blocks = ((at // rows_at_once, total[at : at + rows_at_once].tobytes()) for at in range(0, shape[0], rows_at_once))
        yield from in_batches(blocks, schema)

    # a partial sum of terms times rank numbers for up to sixteen parts of the scan
    cores = hits.sparkSession.sparkContext.defaultParallelism
    hits = hits.coalesce(max(cores, hits.rdd.getNumPartitions() // 16))
    added = _summed(hits.mapInArrow(work, "place int, total binary")).collect()
    out = np.zeros(shape)
    for place, total in added:
        block = np.frombuffer(total, np.float64).reshape(-1, shape[1])
        out[place * rows_at_once : place * rows_at_once + len(block)] = block
    return out


def frequencies(hits: DataFrame, rows: np.ndarray, terms: int) -> tuple[np.ndarray, float]:
    """Passages that hold each term, and passages that hold any."""

    def partial(heads: np.ndarray, held: np.ndarray, total: np.ndarray) -> None:
        passage = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(held)]))
        once = np.unique(passage.astype(np.int64) * (terms + 1) + held) % (terms + 1)
        total[:terms, 0] += np.bincount(once, minlength=terms)
        total[terms, 0] += len(heads)

    out = _total(hits, rows, (terms + 1, 1), partial)[:, 0]
    return out[:terms], float(out[terms])


def weighted(held: np.ndarray, passages: float) -> np.ndarray:
    """Inverse passage frequencies, 1 at least, so that an item leaked everywhere still counts."""
    return (1 + np.log((2 + passages) / (2 + held))).astype(np.float32)


def _levels(energy: np.ndarray) -> np.ndarray:
    """Numbers of the steps, sixty-four to a doubling, on which passages' energies are counted."""
    return np.minimum((64 * np.log2(1 + energy)).astype(np.int64), LEVELS - 1)


LEVELS = 2048


def latent_space(hits: DataFrame, weights: np.ndarray, items: Items, passages: float) -> tuple[np.ndarray, float]:
    """Singular vectors (terms by rank) of all passages and items; energy of a noisy passage.

    The energy of a passage is the sum of its terms' squared weights; all but one in a
    hundred passages have no more than a noisy one.
    """
    width = len(weights)
    rank = min(width, min(len(items.ids), MOST_RANK) + 26)
    sketch = np.random.default_rng(3).standard_normal((width, rank)).astype(np.float32)
    weights = weights.astype(np.float32)
    weighed = sketch * weights[:, None]
    extra = -(-LEVELS // rank)

    def added(heads: np.ndarray, held: np.ndarray, lengths: np.ndarray, total: np.ndarray) -> None:
        """Passages, each of length one, times their products with the sketch."""
        seen = _sums(weighed, heads, held) / lengths[:, None]
        order = np.argsort(held, kind="stable")
        passage = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(held)]))[order]
        firsts = np.flatnonzero(np.r_[True, np.diff(held[order]) > 0])
        term = held[order][firsts]
        total[term] += _sums(seen, firsts, passage) * weights[term][:, None]

    def sketched(heads: np.ndarray, held: np.ndarray, total: np.ndarray) -> None:
        # passages are short, so terms that repeat in one are added up as if they differed
        energy = np.add.reduceat(weights[held].astype(np.float64) ** 2, heads)
        added(heads, held, energy.astype(np.float32), total[:width])
        total[width:].reshape(-1)[:LEVELS] += np.bincount(_levels(energy), minlength=LEVELS)

    found = _total(hits, items.rows, (width + extra, rank), sketched)
    image, levels = found[:width], np.cumsum(found[width:].reshape(-1)[:LEVELS])
    noisy = 2 ** ((1 + np.searchsorted(levels, NOISY * levels[-1])) / 64) - 1
    own = np.zeros((width, rank))
    held = [h for h in items.held if len(h)]
    heads = np.cumsum([0] + [len(h) for h in held[:-1]])
    flat = np.concatenate(held)
    added(heads, flat, np.add.reduceat(weights[flat] ** 2, heads), own)
    image = image + max(1.0, passages) * own
    basis = np.linalg.qr(image)[0]
    # image = matrix @ sketch gives the small matrix in the basis without another pass
    small = np.linalg.lstsq((basis.T @ sketch).T, (basis.T @ image).T, rcond=1e-9)[0]
    _, vectors = np.linalg.eigh((small + small.T) / 2)
    return (basis @ vectors[:, ::-1]).astype(np.float32), float(noisy)


def targets_of(items: Items, weights: np.ndarray, space: np.ndarray, noisy: float) -> tuple[np.ndarray, np.ndarray]:
    """Each item's latent vector, of length one, and the least cosine of a window with a match.

    PLANTED paraphrases of each item keep LEAST_PART of its words; the window around them
    holds noise, at right angles to the item, as a noisy passage does.
    """
    rows = space * weights[:, None].astype(np.float32)
    targets, bounds = np.zeros((len(items.ids), space.shape[1]), np.float32), np.ones(len(items.ids), np.float32)
    draw = np.random.default_rng(5)
    for at, (words, held, span) in enumerate(zip(items.words, items.held, items.spans)):
        latent = rows[held].sum(axis=0)
        size = float(np.linalg.norm(latent))
        if not size:
            continue
        targets[at] = latent / size
        number = items.rows[items.coded[at]]
        keep = math.ceil(LEAST_PART * len(words))
        kept = number[np.argsort(draw.random((PLANTED, len(words))), axis=1)[:, :keep]]
        worth = np.where(kept >= 0, (rows @ targets[at])[kept], 0).sum(axis=1)
        energy = np.where(kept >= 0, weights[kept] ** 2, 0).sum(axis=1)
        noise = noisy / PASSAGE * (3 * span - keep)
        bounds[at] = np.min(worth / np.sqrt(energy + noise + 1e-9))
    return targets, bounds


# ---- 3 and 4: candidates and checks

_MATCHES = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()),
    ("cosine", pa.float64()), ("share", pa.float64()), ("answer_share", pa.float64()),
])
_KIND = "doc_id long, text_hash long, item_id long, start long, cosine double, share double, answer_share double"


def _windows(owner: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and middle block of windows of three blocks, and where the three stand, or -1.

    `owner` and `block` list blocks that hold any term, in order.
    """
    stride = int(block.max()) + 3
    keys = owner.astype(np.int64) * stride + block + 1
    last = np.repeat(keys[np.flatnonzero(np.r_[owner[1:] != owner[:-1], True])], np.unique(owner, return_counts=True)[1])
    middle = np.concatenate([keys - 1, keys, keys + 1])
    middle = np.unique(middle[(middle % stride > 0) & (middle <= np.tile(last, 3))])
    three = middle[:, None] + np.arange(-1, 2)
    places = np.searchsorted(keys, three)
    places[keys[np.minimum(places, len(keys) - 1)] != three] = -1
    return middle // stride, middle % stride - 1, places


def matches(
    hits: DataFrame, items: Items, weights: np.ndarray, space: np.ndarray, noisy: float, items_at_once: int = 256
) -> DataFrame:
    """Per text and item the best window, of those whose cosine reaches the item's bound, that holds it."""
    weights = weights.astype(np.float32)
    targets, bounds = targets_of(items, weights, space, noisy)
    bounds = 0.999 * bounds
    spans = np.array(items.spans)
    rows_of_terms = space * weights[:, None]
    squares = weights**2
    least = [items.least(i) for i in range(len(items.ids))]
    wanted = [Counter(h.tolist()) for h in items.held]
    rows_of_words, coded, answers, item_ids = items.rows, items.coded, items.coded_answers, items.ids

    def enough(terms: np.ndarray, item: int) -> bool:
        own = wanted[item]
        return sum(min(n, own[t]) for t, n in Counter(terms.tolist()).items() if t in own) >= least[item]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for at in range(0, len(batch), 128):
                    yield from found_in(batch.slice(at, 128))

        def found_in(batch: pa.RecordBatch):
            ids, hashes = batch["doc_id"].to_pylist(), batch["text_hash"].to_pylist()
            owners, place, word = _flat(batch)
            begins = np.searchsorted(owners, np.arange(len(ids) + 1))
            row = rows_of_words[word]
            best: dict[tuple[int, int], tuple] = {}
            for text, start, item, cosine in near(owners, place, row):
                own = slice(begins[text], begins[text + 1])
                span = spans[item]
                # words that are not the benchmark's are in no common subsequence
                a, b = begins[text] + np.searchsorted(place[own], [start - span, start + 2 * span])
                if not enough(row[a:b], item):
                    continue
                window = word[a:b].tolist()
                share = common_subsequence(coded[item], window) / len(coded[item])
                if share < LEAST_PART or (text, item) in best and best[text, item][2] >= share:
                    continue
                answer = common_subsequence(answers[item], window) / len(answers[item])
                if share >= LEAST_MOST or answer >= LEAST_ANSWER:
                    best[text, item] = (start, cosine, share, answer)
            for (text, item), match in sorted(best.items()):
                yield ids[text], hashes[text], item_ids[item], *match

        def near(owner: np.ndarray, place: np.ndarray, row: np.ndarray):
            """(text, start of the middle block, item, cosine) of candidates."""
            heads, terms, owner, block = _runs(owner, place, row, UNIT)
            latent, energy = _sums(rows_of_terms, heads, terms), np.add.reduceat(squares[terms], heads)
            before = UNIT
            for span in np.unique(spans).tolist():
                block = block // (span // before)
                firsts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (owner[1:] != owner[:-1])])
                latent, energy = _sums(latent, firsts, np.arange(len(latent))), np.add.reduceat(energy, firsts)
                block, owner, before = block[firsts], owner[firsts], span
                who, middle, three = _windows(owner, block)
                size = np.r_[energy, 0][three].sum(axis=1)
                size = np.sqrt(np.maximum(size, 1e-9)).astype(np.float32)
                members = np.flatnonzero(spans == span)
                for some in np.split(members, range(items_at_once, len(members), items_at_once)):
                    product = np.vstack([latent @ targets[some].T, np.zeros((1, len(some)), np.float32)])
                    cosine = product[three[:, 0]]
                    cosine += product[three[:, 1]]
                    cosine += product[three[:, 2]]
                    cosine /= size[:, None]
                    for w, m in zip(*(x.tolist() for x in np.nonzero(cosine >= bounds[some]))):
                        yield int(who[w]), int(middle[w]) * span, int(some[m]), float(cosine[w, m])

        yield from in_batches(rows(), _MATCHES)

    return hits.mapInArrow(work, _KIND)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, start, cosine, share, answer_share of contaminated documents."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    listed = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = sorted(
        {(r.item_id, r.text) for r in bounded_rows(listed, SMALL_TABLE_BYTES, "the benchmark") if words_of(r.text)},
        key=lambda r: (r[0] is None, r[0] or 0, r[1]),
    )
    if not rows:
        return docs.sparkSession.createDataFrame([], _KIND)
    items = Items(rows)
    hits = scanned(docs, items)
    held, passages = frequencies(hits, items.rows, items.width)
    weights = weighted(held, passages)
    space, noisy = latent_space(hits, weights, items, passages)
    return matches(hits, items, weights, space, noisy)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that no benchmark item has leaked into."""
    found = stored(leaks(docs, benchmark), "leaks").select(
        F.col("doc_id").alias("__leak_doc"), F.col("text_hash").alias("__leak_hash")
    ).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__leak_doc"))
    return docs.join(found, same & (F.xxhash64(docs["text"].cast("string")) == F.col("__leak_hash")), "left_anti")
