"""Drop lines that many documents repeat, found in a sharded minimal perfect hash.

1. Each document is split at line ends where it is read; every line key of at least
   `least_chars` gives one row (128-bit hash of the key, doc_id) per document.
2. Rows are counted per hash, with the largest doc_id, combined before the shuffle.
   Hashes met once can never be dropped and are left out of the index.
3. The others are dealt by hash into shards of bounded size. Each shard becomes a minimal
   perfect hash (levels of bit arrays with ranks) over arrays: fingerprint, count, keeper.
4. Documents probe the arrays: their line hashes travel to the shards, no line text does.
   A shard that many lines probe is copied, and its probes dealt over the copies by
   document, so a line that a third of all documents hold stays spread.
5. What a document loses goes back to it as a list of hashes, and its text is put together.
   Documents are known by doc_id and a hash of the text, so rows without an id are apart.

Defined cases: a null or empty text is one empty line and stays so; a line counts once per
row; rows that share a doc_id count each, and all rows with the largest doc_id keep the
line; a null doc_id is smaller than any other; an empty table gives none; other columns of
the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerstar.llm.common import in_batches, rows_of, stored

# Fixed value: what is stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"

SHARD_ROWS = 1 << 17
MOST_SHARDS = 1 << 20
PROBES_PER_COPY = 1 << 17
_HASHES = pa.schema([
    ("low", pa.int64()), ("high", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
])


def line_key(line: str) -> bytes:
    return line.strip(BLANKS).encode().lower()  # bytes.lower() changes A-Z only


def key_hash(key: bytes) -> tuple[int, int]:
    """128 bits as two signed longs."""
    wide = xxhash.xxh3_128_intdigest(key)
    low, high = wide & 0xFFFFFFFFFFFFFFFF, wide >> 64
    return low - (low >> 63 << 64), high - (high >> 63 << 64)


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least:
        return False
    return key.isascii() or len(key) >= 4 * least or len(key.decode()) >= least


def line_hashes(docs: DataFrame, least_chars: int) -> DataFrame:
    """(low, high, doc_id, text_hash) once per row of `docs` and distinct line key."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for doc_id, text_hash, text in rows_of(batches, "doc_id", "text_hash", "text"):
                keys = {line_key(line) for line in (text or "").split("\n")}
                for key in keys:
                    if _long_enough(key, least_chars):
                        yield *key_hash(key), doc_id, text_hash

        yield from in_batches(found(), _HASHES, size=65536)

    kind = "low long, high long, doc_id long, text_hash long"
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(work, kind)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit numbers, as levels of bit arrays.

    A number belongs to the first level where no other shares its bit; its index is the
    rank of that bit over all levels.
    """

    GAMMA = 2.0

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        starts = np.cumsum([0, *[int(level.sum()) for level in levels]])
        self.ranks = [
            start + np.cumsum(level, dtype=np.int64) - level for start, level in zip(starts, levels)
        ]

    @staticmethod
    def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
        return (x % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = int(len(keys) * cls.GAMMA) + 1
            slots = cls._slots(keys, len(levels), size)
            alone = np.bincount(slots, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[slots]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys; -1 where a number met no level."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for number, level in enumerate(self.levels):
            slots = self._slots(keys[left], number, len(level))
            hit = level[slots]
            out[left[hit]] = self.ranks[number][slots[hit]]
            left = left[~hit]
        return out

    def pack(self) -> tuple[bytes, list[int]]:
        return b"".join(np.packbits(x).tobytes() for x in self.levels), [len(x) for x in self.levels]

    @classmethod
    def unpack(cls, bits: bytes, sizes: list[int]) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            wide = (size + 7) // 8
            held = np.frombuffer(bits, np.uint8, wide, at)
            levels.append(np.unpackbits(held, count=size).astype(bool))
            at += wide
        return cls(levels)


_NO_ID = np.iinfo(np.int64).min
_SHARD = (
    "line_shard int, bits binary, level_sizes array<int>, fingerprints binary, "
    "counts binary, keepers binary, fold int, copies int"
)


def shard_count(hashes: DataFrame) -> int:
    """Follows the number of probes, which bounds the number of keys."""
    return min(MOST_SHARDS, max(1, -(-hashes.count() // SHARD_ROWS)))


def build_index(hashes: DataFrame, shards: int, index_from: int = 2) -> DataFrame:
    """One row per shard: a perfect hash over the repeated line hashes, and its arrays."""
    counted = stored(
        hashes.groupBy("low", "high")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n") >= index_from),
        "line-counts",
    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows.low.to_numpy(np.int64).view(np.uint64)
        # 128 bits are folded into 64 in the first way that keeps the shard's keys apart
        fold, held = 0, rows.assign(key=keys ^ _spread(rows.high.to_numpy(np.int64), 0))
        while held.key.duplicated().any():
            fold += 1
            held = rows.assign(key=keys ^ _spread(rows.high.to_numpy(np.int64), fold))
        table = PerfectHash.build(held.key.to_numpy())
        at = table.index(held.key.to_numpy())
        prints, counts, keepers = (np.empty(len(held), np.int64) for _ in range(3))
        prints[at] = held.high.to_numpy(np.int64)
        counts[at] = held.n.to_numpy(np.int64)
        keepers[at] = held.keeper.fillna(_NO_ID).to_numpy(np.int64)
        bits, sizes = table.pack()
        copies = max(1, -(-int(counts.sum()) // PROBES_PER_COPY))
        small = counts.max(initial=0) < 1 << 32
        return pd.DataFrame([{
            "line_shard": int(rows.line_shard.iloc[0]), "bits": bits, "level_sizes": sizes,
            "fingerprints": prints.tobytes(),
            "counts": counts.astype("<u4" if small else "<i8").tobytes(),
            "keepers": keepers.tobytes(), "fold": fold, "copies": copies,
        }])

    dealt = counted.withColumn("keeper", F.coalesce("keeper", F.lit(_NO_ID))).withColumn(
        "line_shard", _shard_of(shards)
    )
    return stored(dealt.groupBy("line_shard").applyInPandas(build, _SHARD), "line-index")


def _spread(high: np.ndarray, fold: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return high.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93 + 2 * fold)


def _shard_of(shards: int):
    return F.pmod(F.xxhash64("low"), F.lit(shards)).cast("int")


def dropped_lines(hashes: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """(doc_id, text_hash, lost): hashes of the lines that a document loses.

    Rows of one doc_id whose texts hash alike would lose the same lines, as the id decides.
    """
    spark = index.sparkSession
    # one small row per shard, of which there are MOST_SHARDS at most
    copies = F.broadcast(index.select("line_shard", "copies"))
    arrays = [c for c in index.columns if c not in ("line_shard", "copies")]
    shard_rows = index.select(
        "line_shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("line_copy"),
        *arrays, *[F.lit(None).cast("long").alias(c) for c in ("low", "high", "doc_id", "text_hash")],
    )
    copy = F.pmod(F.xxhash64("doc_id", "text_hash", "low"), F.coalesce("copies", F.lit(1))).cast("int")
    probes = hashes.withColumn("line_shard", _shard_of(shards)).join(copies, "line_shard", "left").select(
        "line_shard", copy.alias("line_copy"),
        *[F.lit(None).cast(index.schema[c].dataType).alias(c) for c in arrays],
        "low", "high", "doc_id", "text_hash",
    )
    kind = "doc_id long, text_hash long, lost_low long, lost_high long"
    names = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("lost_low", pa.int64()), ("lost_high", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, table = None, None
        for batch in batches:
            for piece in _runs(batch):
                shard = (piece["line_shard"][0].as_py(), piece["line_copy"][0].as_py())
                if shard != held:
                    held, table = shard, None
                first = piece["bits"][0]
                if first.is_valid:
                    table = (
                        PerfectHash.unpack(first.as_py(), piece["level_sizes"][0].as_py()),
                        np.frombuffer(piece["fingerprints"][0].as_py(), np.int64),
                        _wide(piece["counts"][0].as_py(), len(piece["keepers"][0].as_py()) // 8),
                        np.frombuffer(piece["keepers"][0].as_py(), np.int64),
                        piece["fold"][0].as_py(),
                    )
                    piece = piece.slice(1)
                if table is None or not len(piece):
                    continue
                low, high = (piece[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "high"))
                doc = piece["doc_id"].fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                function, prints, counts, keepers, fold = table
                at = function.index(low.view(np.uint64) ^ _spread(high, fold))
                hit = np.flatnonzero(at >= 0)
                at = at[hit]
                lost = (prints[at] == high[hit]) & (counts[at] >= min_docs) & (keepers[at] != doc[hit])
                hit = hit[lost]
                if len(hit):
                    yield pa.RecordBatch.from_arrays(
                        [*(piece[c].take(pa.array(hit)) for c in ("doc_id", "text_hash")), pa.array(low[hit]), pa.array(high[hit])],
                        schema=names,
                    )

    parts = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lost = (
        shard_rows.unionByName(probes)
        .repartition(parts, "line_shard", "line_copy")
        .sortWithinPartitions("line_shard", "line_copy", F.col("bits").isNull())
        .mapInArrow(work, kind)
    )
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("lost_low", "lost_high")).alias("lost"))


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if len(raw) == 4 * n else "<i8").astype(np.int64)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a sorted batch that belong to one shard and begin with its row, if it has one."""
    shard = batch["line_shard"].to_numpy() * np.int64(1 << 32) + batch["line_copy"].to_numpy()
    heads = batch["bits"].is_valid().to_numpy(zero_copy_only=False)
    cut = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | heads[1:]])
    for begin, end in zip(cut, np.r_[cut[1:], len(shard)]):
        yield batch.slice(begin, end - begin)


def kept_text(text: str | None, lost: set[tuple[int, int]], least_chars: int) -> tuple[str, int, int]:
    """The text that stays, its lines before, and how many went."""
    lines = (text or "").split("\n")
    if not lost:
        return text or "", len(lines), 0
    kept = []
    for line in lines:
        key = line_key(line)
        if not (_long_enough(key, least_chars) and key_hash(key) in lost):
            kept.append(line)
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def lost_by_document(docs: DataFrame, least_chars: int, min_docs: int) -> DataFrame:
    hashes = stored(line_hashes(docs, least_chars), "line-hashes")
    shards = shard_count(hashes)
    index = build_index(hashes, shards, index_from=min(2, min_docs))
    return dropped_lines(hashes, index, shards, min_docs)


def dedup_lines(docs: DataFrame, least_chars: int = 20, min_docs: int = 3, text: str = "text") -> DataFrame:
    """All rows and columns of `docs`, with the lines dropped that other documents keep."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    lost = lost_by_document(source, least_chars, min_docs).select(
        F.col("doc_id").alias("__line_doc"), F.col("text_hash").alias("__line_hash"), F.col("lost").alias("__line_lost")
    )

    @F.pandas_udf("string")
    def put_together(texts: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([
            t if g is None else kept_text(t, _as_set(g), least_chars)[0] for t, g in zip(texts, gone)
        ])

    same = docs["doc_id"].cast("long").eqNullSafe(lost["__line_doc"])
    joined = docs.join(lost, same & (F.xxhash64(docs[text].cast("string")) == lost["__line_hash"]), "left")
    return joined.withColumn(text, put_together(F.col(text), F.col("__line_lost"))).select(docs.columns)


def _as_set(gone) -> set[tuple[int, int]]:
    return {(int(g["lost_low"]), int(g["lost_high"])) for g in gone}


def digests(docs: DataFrame, least_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the text that stays, per row of `docs`."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lost = lost_by_document(source, least_chars, min_docs).withColumnsRenamed(
        {"doc_id": "lost_doc", "text_hash": "lost_hash"}
    )
    out = pa.schema([
        ("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()),
        ("kept_sha256", pa.string()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text, gone in rows_of(batches, "doc_id", "text", "lost"):
                kept, lines, dropped = kept_text(text, _as_set(gone or ()), least_chars)
                yield doc_id, lines, dropped, hashlib.sha256(kept.encode()).hexdigest()

        yield from in_batches(rows(), out)

    same = F.col("doc_id").eqNullSafe(F.col("lost_doc")) & (F.xxhash64("text") == F.col("lost_hash"))
    joined = source.join(lost, same, "left")
    kind = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    return joined.select("doc_id", "text", "lost").mapInArrow(work, kind)
