"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Input per word: an embedding of the word (hashed; words rare in the sample share one row)
next to the mean of the embeddings of its character trigrams. A window of `WINDOW` words
runs through a forward and a backward GRU; attention pools the states; a logistic unit
gives the window's logit. A document's logit is the largest over all its windows, which
overlap by half and cover the whole text, and its score the logistic of that.

Training uses a bounded sample of labelled documents (`MOST_TOXIC` and `MOST_CLEAN`,
lowest hashes first, at most `MOST_WINDOWS` windows each) outside the held-out fold, and
learns through each document's largest window. Scoring reads every whole text where it
lies: the model goes to the tasks, no text is shuffled.

Defined cases: a null text is empty; an empty text, or one without words, gets the score
of the bias; a null label is no label, of labels that share a doc_id the largest counts;
without usable labels of both classes every score is 0 and nothing is predicted; rows that
repeat are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

WINDOW, STRIDE = 48, 24
MOST_TOXIC, MOST_CLEAN, MOST_WINDOWS = 1200, 2400, 6
WORD_ROWS, CHAR_ROWS = 1 << 14, 1 << 12
WORD_DIM, CHAR_DIM, STATE, ATTEND = 12, 12, 8, 8
LEAST_DOCS = 3
FOLDS = 5
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def starts_of(n: int) -> np.ndarray:
    """First words of the windows that cover n words; one window for a short text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - WINDOW + 1, STRIDE)
    return starts if starts[-1] == n - WINDOW else np.append(starts, n - WINDOW)


def word_rows(types: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(w.encode()) % WORD_ROWS for w in types], np.int64)


def trigrams(types: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all character trigrams (bytes, with both ends) and where each word begins."""
    raw = np.frombuffer((" " + " ".join(types) + " ").encode(), np.uint8).astype(np.uint32)
    code = (raw[:-2] * 961 + raw[1:-1] * 31 + raw[2:]) * np.uint32(2654435761) >> np.uint32(20)
    ends = np.flatnonzero(raw == 32)  # words hold no blank
    begins = ends[:-1]
    own = np.ones(len(code), bool)
    own[ends[1:-1] - 1] = False  # a trigram that spans two words
    place = np.cumsum(own) - own
    return (code[own] % CHAR_ROWS).astype(np.int64), place[begins]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.clip(x, -60, 60, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values' rows by row number."""
    columns = [np.bincount(rows, values[:, c], n) for c in range(values.shape[1])]
    return np.stack(columns, axis=1).astype(np.float32)


class Network:
    """Parameters in one dict; `types` are distinct words, ids index them, -1 is padding."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        inputs, wide = WORD_DIM + CHAR_DIM, 2 * STATE

        def some(*shape, scale):
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "word": some(WORD_ROWS + 1, WORD_DIM, scale=0.1),
            "char": some(CHAR_ROWS, CHAR_DIM, scale=0.3),
            "att": some(wide, ATTEND, scale=wide**-0.5), "att_b": np.zeros(ATTEND, np.float32),
            "att_v": some(ATTEND, scale=0.5),
            "out": some(wide, scale=wide**-0.5), "out_b": np.full(1, -1.0, np.float32),
        }
        for d in "fb":
            self.p[f"in_{d}"] = some(inputs, 3 * STATE, scale=inputs**-0.5)
            self.p[f"bias_{d}"] = np.zeros(3 * STATE, np.float32)
            self.p[f"zr_{d}"] = some(STATE, 2 * STATE, scale=STATE**-0.5)
            self.p[f"new_{d}"] = some(STATE, STATE, scale=STATE**-0.5)
        self.frequent = np.zeros(WORD_ROWS, bool)

    # ---- inputs
    def rows_of_types(self, types: list[str]) -> np.ndarray:
        rows = word_rows(types)
        return np.where(self.frequent[rows], rows, WORD_ROWS)

    def inputs(self, types: list[str]) -> tuple[np.ndarray, tuple]:
        rows = self.rows_of_types(types)
        grams, begins = trigrams(types)
        sizes = np.diff(np.append(begins, len(grams)))
        chars = np.add.reduceat(self.p["char"][grams], begins, axis=0) / sizes[:, None]
        x = np.concatenate([self.p["word"][rows], chars.astype(np.float32)], axis=1)
        return x, (rows, grams, sizes)

    def projections(self, x: np.ndarray, d: str) -> np.ndarray:
        """Gate inputs per type; the last row is padding, which leaves a state as it is."""
        pad = np.zeros((1, 3 * STATE), np.float32)
        pad[:, :STATE] = 30
        return np.concatenate([x @ self.p[f"in_{d}"] + self.p[f"bias_{d}"], pad])

    # ---- one direction over windows; ids is (windows, steps)
    def run(self, table: np.ndarray, ids: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        zr, new = self.p[f"zr_{d}"], self.p[f"new_{d}"]
        gates, fresh = np.ascontiguousarray(table[:, : 2 * STATE]), np.ascontiguousarray(table[:, 2 * STATE :])
        n, steps = ids.shape
        states = np.empty((steps, n, STATE), np.float32)
        h = np.zeros((n, STATE), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            at = ids[:, t]
            s = gates[at]
            s += h @ zr
            s = _sigmoid(s)
            z, r = s[:, :STATE], s[:, STATE:]
            back = h @ new
            c = np.tanh(fresh[at] + r * back)
            if keep is not None:
                keep.append((t, h, z, r, back, c))
            h = c + z * (h - c)
            states[t] = h
        return states

    def pool(self, f: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, tuple]:
        h = np.concatenate([f, b], axis=2)
        u = np.tanh(h @ self.p["att"] + self.p["att_b"])
        score = u @ self.p["att_v"]
        here = ids.T >= 0
        score = np.where(here, score, np.float32(-1e9))
        weight = np.exp(score - score.max(axis=0))
        weight *= here
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (weight[:, :, None] * h).sum(axis=0)
        return pooled @ self.p["out"] + self.p["out_b"][0], (h, u, weight, pooled)

    def logits(self, types: list[str], ids: np.ndarray, most: int = 4096) -> np.ndarray:
        if not types:
            return np.full(len(ids), self.p["out_b"][0], np.float32)
        x, _ = self.inputs(types)
        tables = {d: self.projections(x, d) for d in "fb"}
        out = np.empty(len(ids), np.float32)
        for at in range(0, len(ids), most):
            some = ids[at : at + most]
            f, b = (self.run(tables[d], some, d) for d in "fb")
            out[at : at + most] = self.pool(f, b, some)[0]
        return out

    # ---- learning
    def gradients(self, types: list[str], ids: np.ndarray, of_logits) -> dict[str, np.ndarray]:
        """Gradients of a loss, whose gradient by the logits `of_logits` gives."""
        x, (rows, grams, sizes) = self.inputs(types)
        kept: dict[str, list] = {"f": [], "b": []}
        tables = {d: self.projections(x, d) for d in "fb"}
        states = {d: self.run(tables[d], ids, d, kept[d]) for d in "fb"}
        logits, (h, u, weight, pooled) = self.pool(states["f"], states["b"], ids)
        g = {k: np.zeros_like(v) for k, v in self.p.items() if k[:2] in ("zr", "ne")}
        d_logit = of_logits(logits).astype(np.float32)
        g["out"], g["out_b"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * self.p["out"]
        d_h = weight[:, :, None] * d_pooled
        d_weight = (h * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att_v"] = np.einsum("tna,tn->a", u, d_score)
        d_u = d_score[:, :, None] * self.p["att_v"] * (1 - u * u)
        g["att"] = np.einsum("tnh,tna->ha", h, d_u)
        g["att_b"] = d_u.sum(axis=(0, 1))
        d_h += d_u @ self.p["att"].T
        d_x = np.zeros_like(x)
        flat = np.where(ids < 0, len(types), ids)
        for d, part in (("f", d_h[:, :, :STATE]), ("b", d_h[:, :, STATE:])):
            zr, new = self.p[f"zr_{d}"], self.p[f"new_{d}"]
            carry = np.zeros_like(part[0])
            d_gates = np.empty((ids.shape[1], len(ids), 3 * STATE), np.float32)
            for t, before, z, r, back, c in reversed(kept[d]):
                dh = carry + part[t]
                dz = dh * (before - c) * z * (1 - z)
                dc = dh * (1 - z) * (1 - c * c)
                dr = dc * back * r * (1 - r)
                d_back = dc * r
                gate = np.concatenate([dz, dr], axis=1)
                g[f"zr_{d}"] += before.T @ gate
                g[f"new_{d}"] += before.T @ d_back
                carry = dh * z + gate @ zr.T + d_back @ new.T
                d_gates[t, :, : 2 * STATE], d_gates[t, :, 2 * STATE :] = gate, dc
            # padding, the last row, learns nothing
            d_table = summed(flat.T.ravel(), d_gates.reshape(-1, 3 * STATE), len(types) + 1)[:-1]
            g[f"in_{d}"], g[f"bias_{d}"] = x.T @ d_table, d_table.sum(axis=0)
            d_x += d_table @ self.p[f"in_{d}"].T
        g["word"] = summed(rows, d_x[:, :WORD_DIM], WORD_ROWS + 1)
        per_gram = np.repeat(d_x[:, WORD_DIM:] / sizes[:, None], sizes, axis=0)
        g["char"] = summed(grams, per_gram, CHAR_ROWS)
        return g


def window_ids(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of words in a row of texts, by window (-1: padding), and each text's first window."""
    places, firsts, at, made = [], [], 0, 0
    steps = np.arange(WINDOW)
    for n in lengths:
        starts = starts_of(n)
        place = starts[:, None] + steps
        if n < WINDOW:
            place = np.where(place < n, place + at, -1)
        else:
            place += at
        places.append(place)
        firsts.append(made)
        made += len(starts)
        at += n
    return np.concatenate(places), np.array(firsts)


class Vocabulary(defaultdict):
    """Numbers words in the order in which they are met."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def score_texts(network: Network, texts: list[str], most_words: int = 300_000) -> np.ndarray:
    """Scores of whole texts, a bounded number of words at a time."""
    out, held, total = [], [], 0

    def flush():
        nonlocal held, total
        if not held:
            return
        types = Vocabulary()
        ids = np.array([types[w] for words in held for w in words] + [-1], np.int64)
        places, firsts = window_ids([len(w) for w in held])
        logits = network.logits(list(types), ids[places])
        out.append(np.maximum.reduceat(logits, firsts))
        held, total = [], 0

    for text in texts:
        words = words_of(text)
        if len(words) > most_words:
            flush()
            # a very long text: parts that share one window's words, so that no window is lost
            step = most_words // STRIDE * STRIDE
            best = -np.inf
            for at in range(0, len(words), step):
                part = words[at : at + step + WINDOW]
                types = Vocabulary()
                ids = np.array([types[w] for w in part] + [-1], np.int64)
                best = max(best, network.logits(list(types), ids[window_ids([len(part)])[0]]).max())
            out.append(np.array([best], np.float32))
            continue
        held.append(words)
        total += len(words)
        if total >= most_words:
            flush()
    flush()
    logits = np.concatenate(out).astype(np.float64) if out else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def train(samples: list[tuple[list[list[str]], int]], steps: int = 900, batch: int = 32, rate: float = 0.02) -> Network:
    """Learn from (windows of words, label) per document, in as many steps for any sample."""
    network = Network()
    held: dict[int, int] = defaultdict(int)
    for windows, _ in samples:
        for row in np.unique(word_rows(list({w for win in windows for w in win}) or [""])):
            held[int(row)] += 1
    for row, n in held.items():
        network.frequent[row] = n >= LEAST_DOCS
    draw = np.random.default_rng(11)
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    step, batch = 0, min(batch, len(samples))
    while step < steps:
        order = draw.permutation(len(samples))
        for at in range(0, len(order) - batch + 1, batch)[: steps - step]:
            some = [samples[i] for i in order[at : at + batch]]
            types = Vocabulary()
            windows = [w for wins, _ in some for w in wins]
            ids = np.full((len(windows), WINDOW), -1, np.int64)
            for i, words in enumerate(windows):
                ids[i, : len(words)] = [types[w] for w in words]
            drop = draw.random(ids.shape) < 0.1
            ids[drop & (ids >= 0)] = -1  # some words are left out
            step += 1
            if not types:
                continue
            firsts = np.cumsum([0, *[len(wins) for wins, _ in some]])[:-1]
            labels = np.array([label for _, label in some], np.float32)

            def of_logits(logits: np.ndarray, firsts=firsts, labels=labels) -> np.ndarray:
                g = np.zeros_like(logits)
                best = np.maximum.reduceat(logits, firsts)
                ends = np.append(firsts[1:], len(logits))
                for i, (a, b) in enumerate(zip(firsts, ends)):
                    g[a + logits[a:b].argmax()] = 1 / (1 + np.exp(-best[i])) - labels[i]
                return g / len(labels)

            slope = rate * min(1, step / 30) * (1 - step / (steps + 1))
            for k, v in network.gradients(list(types), ids, of_logits).items():
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.001 * (v * v - second[k])
                change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                network.p[k] -= slope * change
                if k in ("word", "char"):
                    network.p[k] *= 1 - 0.01 * slope
    return network


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[list[list[str]], int]]:
    """Windows of a bounded number of labelled documents outside the held-out fold."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .filter(~held_out(F.col("doc_id")))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = known.filter("toxic = 1").orderBy(*order).limit(MOST_TOXIC).unionByName(
        known.filter("toxic <> 1").orderBy(*order).limit(MOST_CLEAN)
    )

    @F.udf("array<array<string>>")
    def windows(doc_id: int, text: str) -> list[list[str]]:
        words = words_of(text or "")
        starts = starts_of(len(words))
        if len(starts) > MOST_WINDOWS:
            draw = np.random.default_rng(doc_id & 0xFFFFFFFF)
            starts = draw.choice(starts, MOST_WINDOWS, replace=False)
        return [words[s : s + WINDOW] for s in starts.tolist()]

    # at most MOST_TOXIC + MOST_CLEAN ids are broadcast; rows that share an id count once
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    rows = rows.select("doc_id", "toxic", windows("doc_id", "text").alias("windows")).collect()
    return [(r.windows, int(r.toxic == 1)) for r in sorted(rows, key=lambda r: r.doc_id)]


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    samples = sample(docs, labels)
    if len({label for _, label in samples}) < 2:
        return None
    return train(samples)


def scorer(network: Network | None):
    """A column function from text to score."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if network is None:
                yield pd.Series(np.zeros(len(texts)))
            else:
                yield pd.Series(score_texts(network, [t or "" for t in texts]))

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    score = scorer(fit(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        score("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that are not predicted toxic."""
    score = scorer(fit(docs, labels))
    return docs.filter(score(F.col("text").cast("string")) < 0.5)
