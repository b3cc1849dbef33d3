"""Pack tokenised documents into sequences: first-fit decreasing in randomised groups.

Texts become token ids where they are read. Whole sequences of a long document are
finished there; only the rest of each document, shorter than one sequence, is dealt at
random into groups of bounded size. Each group is packed on its own: the rests by falling
length, each into the first sequence with room, which a tournament tree over the free
room of the sequences finds in logarithmic time. Then the emptiest sequences are cut up
to fill gaps in the others, and what remains is split into powers of two, which need no
padding.

Defined cases: a null text is an empty one, and any document ends with `end_id`, so an
empty text gives one token; a null doc_id stays null; rows repeated or sharing a doc_id
are documents of their own; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerstar.llm.common import in_batches, rows_of

# Fixed value: how a byte-level vocabulary splits text into words.
_WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SPLIT = re.compile(r" (?=\S)")
_ODD_SPACE = re.compile(r" (?:\s|\Z)")

_NOTHING, _BLANK = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())

_TOKENS = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()),
    ("pack_draw", pa.int64()),
])
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_GROUP_BITS = 24


class WordTokenizer:
    """Ids of whole texts from the ids of the different words in them.

    The byte-level vocabulary splits a text before every blank that precedes a visible
    character, whatever stands around it, so the ids of a text are those of such parts
    one after the other. Arrow splits the texts and numbers their words, each different
    word is encoded once for the texts of a call, and Arrow puts the ids in their places.

    If the ids of a vocabulary follow its merges, a rank encoder over the same entries
    gives the same ids in a third of the time, and serves for all words after a blank at
    once. Other parts go one by one; about twice `memory` of those met lately are remembered.
    """

    def __init__(self, path: str, memory: int = 350_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.memory = memory
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.added = [t["content"] for t in described.get("added_tokens", [])]
        self.ranked, self.widths = _rank_encoder(described)

    def _one_by_one(self, parts: list[str]) -> pa.Array:
        if len(self.known) > self.memory:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        for part in set(parts).difference(known):
            if part in older:
                known[part] = older[part]
            elif self.ranked is None or _holds(part, self.added):
                ids = self.tokenizer.encode(part, add_special_tokens=False).ids
                known[part] = np.array(ids, dtype=self.kind).tobytes()
            else:
                known[part] = np.array(self.ranked.encode_ordinary(part), self.kind).tobytes()
        return pa.array([known[p] for p in parts], pa.large_binary())

    def _after_blanks(self, words: pa.Array) -> pa.Array:
        """Encode words that each follow a blank as one text, then cut its ids at their ends."""
        if not len(words):
            return pa.array([], pa.large_binary())
        if self.ranked is None:
            return self._one_by_one([" " + w for w in words.to_pylist()])
        spaced = pc.binary_join_element_wise(_NOTHING, words, _BLANK)
        ends = np.frombuffer(spaced.buffers()[1], np.int64)[1 : len(words) + 1]
        text = str(memoryview(spaced.buffers()[2])[: ends[-1]], "utf-8")
        if _holds(text, self.added):
            held = words.to_pylist()
            special = np.array([_holds(" " + w, self.added) for w in held])
            easy, hard = np.flatnonzero(~special), np.flatnonzero(special)
            if len(hard):
                ids = pa.concat_arrays([
                    self._after_blanks(words.take(pa.array(easy))), self._one_by_one([" " + held[i] for i in hard])
                ])
                return ids.take(pa.array(np.argsort(np.concatenate([easy, hard]))))
        ids = self.ranked.encode_to_numpy(text, disallowed_special=())
        cuts = np.searchsorted(np.cumsum(self.widths[ids]), ends, side="right")
        offsets = np.concatenate([[0], cuts]).astype(np.int64) * self.kind.itemsize
        data = ids.astype(self.kind).tobytes()
        return pa.Array.from_buffers(
            pa.large_binary(), len(words), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
        )

    def _joined(self, lists: pa.Array) -> list[bytes]:
        """Ids of texts given as lists of parts, each part but the first without its blank."""
        if not len(lists):
            return []
        offsets = np.asarray(lists.offsets).astype(np.int64)
        coded = lists.values.dictionary_encode()
        words, codes = coded.dictionary, np.asarray(coded.indices)
        first = np.zeros(len(codes), dtype=bool)
        first[offsets[:-1]] = True
        # a word that only begins texts is not encoded with a blank
        later = np.flatnonzero(np.bincount(codes[~first], minlength=len(words)))
        begin, place = np.unique(codes[first], return_inverse=True)
        held = pa.concat_arrays([
            self._after_blanks(words.take(pa.array(later))),
            self._one_by_one(words.take(pa.array(begin)).to_pylist()),
        ])
        row = np.zeros(len(words), dtype=np.int64)
        row[later] = np.arange(len(later))
        rows = row[codes]
        rows[first] = len(later) + place
        ids = held.take(pa.array(rows))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
        cuts, data = ends[offsets].tolist(), memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if _ODD_SPACE.search(t)]
        if not odd:
            return self._joined(pc.split_pattern(pa.array(texts, pa.large_string()), " "))
        found = [b""] * len(texts)
        plain = sorted(set(range(len(texts))).difference(odd))
        for some, lists in (
            (plain, pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")),
            (odd, pa.array([_SPLIT.split(texts[i]) for i in odd], pa.large_list(pa.large_string()))),
        ):
            for i, ids in zip(some, self._joined(lists)):
                found[i] = ids
        return found


def _holds(text: str, strings: list[str]) -> bool:
    return any(s in text for s in strings)


def _rank_encoder(described: dict):
    """An encoder by ranks, if the file is a byte-level BPE whose ids follow its merges."""
    import tiktoken

    model, before = described["model"], described.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and described.get("normalizer") is None
        and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
        and not model.get("dropout") and not model.get("ignore_merges")
    )
    if not plain:
        return None, None
    vocabulary = model["vocab"]
    for number, merge in enumerate(model["merges"], 256):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        if vocabulary.get(left + right) != number:
            return None, None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    limit = 256 + len(model["merges"])
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if i < limit}
    encoder = tiktoken.Encoding("ranked", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
    return encoder, np.array([len(t) for t, _ in sorted(ranks.items(), key=lambda r: r[1])])


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _mixed(number: int) -> int:
    """A well spread 62-bit number for a row's place in its task."""
    x = (number + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 31)) >> 2


def _some_texts(rows, most_rows: int = 4096, most_chars: int = 1 << 23):
    held, chars = [], 0
    for doc_id, text in rows:
        held.append((doc_id, text or ""))
        chars += len(held[-1][1])
        if len(held) >= most_rows or chars >= most_chars:
            yield held
            held, chars = [], 0
    if held:
        yield held


def tokenised(docs: DataFrame, vocabulary: str, length: int, end_id: int) -> DataFrame:
    """Finished full sequences (ids null) and the rest of each document (ids as binary)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary)
        end = np.array([end_id], dtype=tokenizer.kind).tobytes()
        place = TaskContext.get().partitionId() << 40

        def pieces():
            nonlocal place
            for some in _some_texts(rows_of(batches, "doc_id", "text")):
                for (doc_id, _), ids in zip(some, tokenizer.encode([t for _, t in some])):
                    ids = np.frombuffer(ids + end, dtype=tokenizer.kind)
                    whole = len(ids) // length * length
                    for start in range(0, whole, length):
                        place += 1
                        crc = crc_of(ids[start : start + length])
                        yield doc_id, start, length, crc, len(ids), None, _mixed(place)
                    if whole < len(ids):
                        place += 1
                        rest = ids[whole:].astype("<u4" if tokenizer.kind.itemsize == 4 else "<u2")
                        yield doc_id, whole, len(rest), None, len(ids), rest.tobytes(), _mixed(place)

        yield from in_batches(pieces(), _TOKENS)

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, pack_draw long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, kind)


class Tournament:
    """Free room of the sequences as leaves; each inner node holds the larger of its two."""

    def __init__(self, room: int, most: int):
        self.size = 1 << max(0, (most - 1).bit_length())
        self.tree = [room] * (2 * self.size)

    def place(self, length: int) -> int:
        """First sequence with room for `length`; its room shrinks."""
        tree, node = self.tree, 1
        while node < self.size:
            node *= 2
            if tree[node] < length:
                node += 1
        tree[node] -= length
        leaf = node - self.size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
        return leaf


def first_fit_decreasing(lengths: list[int], room: int) -> list[list[int]]:
    """Indices by sequence; every length is at most `room`."""
    tree = Tournament(room, max(1, len(lengths)))
    bins: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = tree.place(lengths[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def fill_gaps(
    bins: list[list[tuple[int, int, int]]], room: int, least_gap: int
) -> list[list[tuple[int, int, int]]]:
    """Cut up the emptiest sequences, so that the others have gaps under `least_gap` only.

    Pieces are (item, start, length). At most one sequence stays with a larger gap; it is
    split into powers of two.
    """
    used = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: (used[i], i))
    gaps = [(-used[i], i) for i in order if room - used[i] >= least_gap]
    heapq.heapify(gaps)  # the fullest first
    gone: set[int] = set()
    full: set[int] = set()
    for donor in order:
        if donor in full or room - used[donor] < least_gap:
            continue
        while bins[donor]:
            while gaps and (gaps[0][1] in gone or gaps[0][1] == donor or gaps[0][1] in full):
                heapq.heappop(gaps)
            if not gaps:
                break
            at = gaps[0][1]
            item, start, length = bins[donor].pop()
            take = min(length, room - used[at])
            bins[at].append((item, start + length - take, take))
            used[at] += take
            used[donor] -= take
            if take < length:
                bins[donor].append((item, start, length - take))
            if room - used[at] < least_gap:
                full.add(at)
            else:
                heapq.heapreplace(gaps, (-used[at], at))
        gone.add(donor)
        if bins[donor]:
            break
    done = []
    for i, pieces in enumerate(bins):
        if not pieces:
            continue
        if room - used[i] < least_gap:
            done.append(pieces)
        else:
            done += split_powers(pieces, used[i])
    return done


def split_powers(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """Sequences whose lengths are the powers of two that add up to `total`."""
    out, pieces = [], list(pieces)
    for power in (1 << b for b in reversed(range(total.bit_length())) if total >> b & 1):
        held: list[tuple[int, int, int]] = []
        while power:
            item, start, length = pieces.pop(0)
            take = min(power, length)
            held.append((item, start, take))
            power -= take
            if take < length:
                pieces.insert(0, (item, start + take, length - take))
        out.append(held)
    return out


def pack(
    docs: DataFrame, vocabulary: str, length: int = 2048, end_id: int = 1,
    group_bytes: int = 16 << 20, least_gap: int = 8,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A group holds about `group_bytes` of text; the number of groups follows the input, and
    rows are dealt by their place in their task, so no key or copy can fill one group.
    """
    wide = docs.agg(
        F.sum(F.octet_length(F.col("text").cast("string")).cast("long")).alias("octets"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    groups = max(1, -(-(wide.octets or 0) // group_bytes), -(-wide.n // 32768))
    if groups >= 1 << 62 - _GROUP_BITS:
        raise ValueError("too many groups for a long sequence_id")
    wide_ids = vocabulary_width(vocabulary)

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "pack_draw"], ascending=[False, True, True, True])
        rows = rows.reset_index(drop=True)
        base = int(rows.pack_group.iloc[0]) << _GROUP_BITS
        whole = rows[rows.ids.isna()]
        rest = rows[rows.ids.notna()].reset_index(drop=True)
        lengths = rest.length.tolist()
        bins = [[(i, 0, lengths[i]) for i in b] for b in first_fit_decreasing(lengths, length)]
        bins = fill_gaps(bins, length, least_gap)
        ids = [np.frombuffer(b, dtype=wide_ids) for b in rest.ids]
        doc, begin, tokens = rest.doc_id.tolist(), rest.start.tolist(), rest.doc_tokens.tolist()
        out = []
        for number, pieces in enumerate(bins):
            offset = 0
            for item, start, n in pieces:
                crc = crc_of(ids[item][start : start + n])
                out.append((doc[item], begin[item] + start, n, crc, tokens[item], base + number, offset))
                offset += n
        for number, row in enumerate(whole.itertuples(index=False), len(bins)):
            out.append((row.doc_id, row.start, row.length, row.ids_crc32, row.doc_tokens, base + number, 0))
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        frame = pd.DataFrame(out, columns=names)
        return frame.astype({"doc_id": "Int64", "ids_crc32": "int64"})

    dealt = tokenised(docs, vocabulary, length, end_id).withColumn(
        "pack_group", F.pmod(F.col("pack_draw"), F.lit(groups))
    )
    return dealt.groupBy("pack_group").applyInPandas(work, _PIECES)


def vocabulary_width(path: str) -> np.dtype:
    return _tokenizer(path).kind
