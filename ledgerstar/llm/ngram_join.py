"""N-gram Jaccard join: a MinHash LSH forest with shortened prefixes.

1. Every text becomes the set of its five-word shingles (64-bit hashes). Texts with equal
   sets form one class; only one text per class goes on, with the number of its copies.
2. A class has TREES paths of min-hashes. Sorted, the paths of a tree form a prefix trie;
   classes below one node share a prefix. Matching starts with long prefixes, which are
   shortened until a pair at the threshold itself is found with the chance of the target,
   whatever other pairs the table holds.
3. A trie node becomes tiles of at most two blocks of BLOCK classes; equal tiles of several
   trees are one. A tile holds its texts and verifies, exactly, the pairs that belong to
   it: those whose first common prefix is that of the tile's tree, and that share no longer
   prefix met before. So each pair is counted once, and no pair is ever a row: a tile gives
   each class its number of linked documents and the least class it is linked with.
4. Connected components of these stars are the groups.

Words are runs of letters, digits and underscores, or of any characters beyond ASCII, in
lower case; a text of fewer than five words is one shingle. Defined cases: a null text is empty; a text without words is linked with nothing,
not even its copies; a null doc_id stays null and is larger than any other as a class id;
rows that repeat are copies; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstar.llm.common import in_batches, rows_of, stored
from ledgerstar.llm.components import components
from ledgerstar.llm.words import gram_hashes, mixed, word_hashes

THRESHOLD, TARGET = 0.8, 0.9999
TREES, DEPTHS = 20, (6, 4)
BLOCK = 1024

_draw = np.random.default_rng(20)
_FACTORS = (_draw.integers(0, 1 << 32, TREES * DEPTHS[0], dtype=np.uint32) | 1)[:, None]
_SHIFTS = _draw.integers(0, 1 << 32, TREES * DEPTHS[0], dtype=np.uint32)[:, None]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a text."""
    return np.unique(gram_hashes(word_hashes(text)))


def paths(grams: np.ndarray) -> np.ndarray:
    """Min-hashes of a non-empty set, one row of the longest depth per tree."""
    low = np.full(len(_FACTORS), 0xFFFFFFFF, np.uint32)
    seeds = (grams >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(seeds), 2048):
            some = _FACTORS * seeds[None, at : at + 2048]
            some += _SHIFTS
            np.minimum(low, some.min(axis=1), out=low)
    return low.reshape(TREES, DEPTHS[0])


def prefix_keys(path: np.ndarray, depth: int) -> np.ndarray:
    """One 64-bit key per tree for the first `depth` steps of its path."""
    key = np.arange(1, TREES + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(depth):
            key = mixed(key * _MIX + path[:, at])
    return key.view(np.int64)


def found_chance(similarity: float | np.ndarray, depth: int):
    """Chance that two sets of this similarity share a prefix of this length in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


# ---- classes of equal sets

_SETS = pa.schema([
    ("doc_id", pa.int64()), ("hash_a", pa.int64()), ("hash_b", pa.int64()), ("set_key", pa.binary()), ("grams", pa.int64()),
    *[(f"keys_{d}", pa.list_(pa.int64())) for d in DEPTHS],
])


def set_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, hashes of the text, set_key, number of shingles and prefix keys of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, hash_a, hash_b, text in rows_of(batches, "doc_id", "hash_a", "hash_b", "text"):
                grams = shingles(text)
                if len(grams):
                    path = paths(grams)
                    keys = [prefix_keys(path, d).tolist() for d in DEPTHS]
                else:
                    keys = [None for _ in DEPTHS]
                yield doc_id, hash_a, hash_b, set_key(grams), len(grams), *keys

        yield from in_batches(rows(), _SETS)

    keys = ", ".join(f"keys_{d} array<long>" for d in DEPTHS)
    return docs.mapInArrow(work, f"doc_id long, hash_a long, hash_b long, set_key binary, grams long, {keys}")


def classes(signed: DataFrame) -> DataFrame:
    """set_id, set_key, first row, copies and prefix keys, one row per distinct non-empty set."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash_a", "hash_b")
    named = signed.filter("grams > 0").groupBy("set_key").agg(
        F.min(row).alias("first"), F.count(F.lit(1)).alias("copies"),
        *[F.any_value(f"keys_{d}").alias(f"keys_{d}") for d in DEPTHS],
    )
    named = named.withColumn("first_doc", F.col("first.doc_id"))
    return stored(named.withColumn("set_id", F.monotonically_increasing_id()), "gram-classes")


# ---- tiles

def tiles(held: DataFrame, depth: int) -> DataFrame:
    """tile, tree, within, members: distinct groups of classes below one trie node."""
    rows = held.select(
        "set_id", F.posexplode(f"keys_{depth}").alias("tree", "prefix")
    )
    nodes = stored(
        rows.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "trie-nodes"
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = rows.join(nodes, ["tree", "prefix"]).select(
        "tree", "prefix", "set_id", blocks.alias("blocks"),
        F.pmod(F.xxhash64("set_id"), blocks).cast("int").alias("block"),
    )
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("left", F.least("block", "other")).withColumn(
        "right", F.greatest("block", "other")
    )
    second = (F.col("left") < F.col("right")) & (F.col("block") == F.col("right"))
    gathered = met.withColumn("second", second).groupBy("tree", "prefix", "left", "right").agg(
        F.array_sort(F.collect_list(F.struct("set_id", "second"))).alias("members")
    )
    once = (
        gathered.filter(F.size("members") > 1)
        .withColumn("within", F.col("left") == F.col("right"))
        .groupBy("members", "within").agg(F.min("tree").alias("tree"))
    )
    return stored(once.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def texts_of(docs: DataFrame, held: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id, text, copies and keys of the wanted classes: one text each.

    The first row of a class is known by its id and 128 bits of its text's hashes, so rows
    without an id, or with the same, meet their own class only.
    """
    wanted = held.join(wanted, "set_id", "left_semi")
    same = (
        docs["doc_id"].eqNullSafe(wanted["first.doc_id"])
        & (docs["hash_a"] == wanted["first.hash_a"]) & (docs["hash_b"] == wanted["first.hash_b"])
    )
    rows = docs.join(wanted, same).select("set_id", "text", "copies", *[f"keys_{d}" for d in DEPTHS])
    return rows.dropDuplicates(["set_id"])  # a row that repeats counts once


def common_sizes(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (left, right)."""
    if len(left) <= 8 * len(sets):
        return np.array([
            len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
            for a, b in ((sets[i], sets[j]) for i, j in zip(left.tolist(), right.tolist()))
        ], np.int64).reshape(len(left))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    renamed = np.cumsum(count > 1) - 1
    owner, column = owner[shared], renamed[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 2048
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        total += part @ part.T
    return total[left, right].astype(np.int64)


def links_of(
    sets: list[np.ndarray], second: np.ndarray, within: bool, tree: int,
    keys: np.ndarray, longer: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, similarity) of the linked pairs that belong to this tile."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    lefts, rights = [], []
    for i in range(n):
        others = np.arange(i + 1, n) if within else np.flatnonzero(second) if not second[i] else None
        if others is None or not len(others):
            continue
        small, large = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
        others = others[small >= THRESHOLD * large - 1e-9]
        same = keys[others] == keys[i]
        mine = same[:, tree] & ~same[:, :tree].any(axis=1)
        if longer is not None:
            mine &= ~(longer[others] == longer[i]).any(axis=1)
        others = others[mine]
        lefts.append(np.full(len(others), i))
        rights.append(others)
    if not lefts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    left, right = np.concatenate(lefts), np.concatenate(rights)
    common = common_sizes(sets, left, right)
    union = sizes[left] + sizes[right] - common
    linked = common >= THRESHOLD * union - 1e-9
    return left[linked], right[linked], common[linked] / union[linked]


_LINKS = pa.schema([("set_id", pa.int64()), ("least", pa.int64()), ("links", pa.int64())])


def verified(members: DataFrame, depth: int, longer_depth: int | None) -> DataFrame:
    """set_id, least, links per tile.

    `members` is dealt by tile and sorted by it; one tile is held at a time.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(tile):
            ids = np.array([r[0] for r in tile])
            sets = [shingles(r[4]) for r in tile]
            keys = np.array([r[6] for r in tile])
            longer = np.array([r[7] for r in tile]) if longer_depth else None
            copies = np.array([r[5] for r in tile])
            second = np.array([r[1] for r in tile])
            left, right, _ = links_of(sets, second, tile[0][2], tile[0][3], keys, longer)
            if not len(left):
                return
            links = np.bincount(left, copies[right], len(tile)) + np.bincount(right, copies[left], len(tile))
            label = ids.copy()
            while True:  # the least id reachable over this tile's links
                before = label.copy()
                low = np.minimum(label[left], label[right])
                np.minimum.at(label, left, low)
                np.minimum.at(label, right, low)
                if (before == label).all():
                    break
            for i in np.flatnonzero(links).tolist():
                yield int(ids[i]), int(label[i]), int(links[i])

        def rows():
            tile, number = [], None
            names = ["tile", "set_id", "second", "within", "tree", "text", "copies", f"keys_{depth}"]
            names.append(f"keys_{longer_depth or depth}")
            for row in rows_of(batches, *names):
                if row[0] != number and tile:
                    yield from solve(tile)
                    tile = []
                number = row[0]
                tile.append(row[1:])
            if tile:
                yield from solve(tile)

        yield from in_batches(rows(), _LINKS, size=16384)

    return members.mapInArrow(work, "set_id long, least long, links long")


def forest_links(docs: DataFrame, held: DataFrame, target: float = TARGET) -> DataFrame:
    """set_id, least, links of all rounds."""
    rounds, longer = [], None
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for depth in DEPTHS:
        made = tiles(held, depth)
        flat = made.select("tile", "within", "tree", F.explode("members").alias("m")).select(
            "tile", "within", "tree", "m.set_id", "m.second"
        )
        texts = texts_of(docs, held, flat.select("set_id").distinct())
        members = flat.join(texts, "set_id").repartition(parts * 4, "tile").sortWithinPartitions("tile")
        links = stored(verified(members, depth, longer), "gram-links")
        rounds.append(links.select("set_id", "least", "links"))
        longer = depth
        if found_chance(THRESHOLD, depth) >= target:
            break
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out


def join(docs: DataFrame, target: float = TARGET) -> DataFrame:
    """doc_id, set_key, class_id, n_links, n_copies for every row of `docs`.

    class_id is the least doc_id of the documents connected by links of a similarity of
    THRESHOLD or more; n_links counts the other documents linked directly, copies included.
    """
    return rooted_join(docs, target).drop("root")


def rooted_join(docs: DataFrame, target: float = TARGET) -> DataFrame:
    """What `join` gives, and root: one number per class, null for a text without words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.select(
        "*", F.xxhash64(F.lit(1), "text").alias("hash_a"), F.xxhash64(F.lit(2), "text").alias("hash_b")
    )
    signed = stored(signatures(docs), "gram-sets")
    held = classes(signed)
    links = forest_links(docs, held, target)
    total = stored(links.groupBy("set_id").agg(F.sum("links").alias("links")), "gram-link-counts")
    roots = components(links.select(F.col("set_id").alias("a"), F.col("least").alias("b")))
    rooted = held.select("set_id", "set_key", "first_doc", "copies").join(
        roots, F.col("set_id") == F.col("node"), "left"
    ).withColumn("root", F.coalesce("root", "set_id"))
    least = rooted.groupBy("root").agg(F.min("first_doc").alias("class_id"))
    named = stored(
        rooted.join(least, "root").join(total, "set_id", "left").select(
            F.col("set_key").alias("class_key"), "class_id", "copies", "root",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "gram-named",
    )
    return signed.select("doc_id", "set_key").join(
        named, F.col("set_key") == F.col("class_key"), "left"
    ).select(
        "doc_id", "set_key", F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"), "root",
    )


def _row_key(doc_id: Column, key: Column) -> Column:
    return F.concat_ws("/", F.hex(key), doc_id.cast("string"))


def keep_one(docs: DataFrame, target: float = TARGET) -> DataFrame:
    """The rows of `docs`, with all their columns, that stand first in their class."""

    @F.pandas_udf("binary")
    def key_of(texts: pd.Series) -> pd.Series:
        return pd.Series([set_key(shingles(t)) for t in texts])

    found = rooted_join(docs, target)
    # a class may hold several texts of one doc_id, or of none: its least text stands first
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set_key")).alias("first")
    heads = found.filter("root is not null").groupBy("root").agg(first, F.max(F.col("n_links") > 0).alias("linked"))
    wordless = found.filter("root is null").select("doc_id", "set_key", F.lit(False).alias("linked"))
    found = heads.select("first.doc_id", "first.set_key", "linked").unionByName(wordless).select(
        _row_key(F.col("doc_id"), F.col("set_key")).alias("__gram_row"), F.col("linked").alias("__gram_linked")
    )
    kept = found.groupBy("__gram_row").agg(F.max("__gram_linked").alias("__gram_linked"))
    keyed = docs.withColumn(
        "__gram_row", _row_key(docs["doc_id"].cast("long"), key_of(docs["text"].cast("string")))
    )
    # of rows that share id and text one stays; texts without words are linked with nothing
    place = F.row_number().over(Window.partitionBy("__gram_row").orderBy(F.lit(1)))
    return (
        keyed.join(kept, "__gram_row").withColumn("__gram_place", place)
        .filter((F.col("__gram_place") == 1) | ~F.col("__gram_linked")).select(*docs.columns)
    )
