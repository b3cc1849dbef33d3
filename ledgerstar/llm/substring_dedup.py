"""Near-duplicate passages by compact windows over min-hashed word shingles.

1. Every position of a text has a five-word shingle. For each of HASHES orders, the
   Cartesian tree of a text's hashed shingles gives compact windows (l, c, r): all passages
   of LEAST_WORDS words or more between l and r that contain c have their minimum at c.
   They are few, about two for every LEAST_WORDS words; of equal minima one drawn by place is
   the centre, so a text of one repeated word has a flat tree too.
2. Windows are dealt by (order, shingle at c) in packed blocks. In a bucket, windows with
   one signature are linked: all pairs of a group of SMALL_GROUP or less. Links of a pair of
   texts are joined by interval: windows of at least ENOUGH orders must cover a common place
   along one diagonal. Both texts of such a pair are compared exactly.
3. Larger groups never become pairs. First, passages of LEAST_WORDS words that texts hold word
   for word are put together by their hash: a task keeps one representative for each and
   links its others to it, and only representatives meet those of other tasks. A stretch that
   lies in such a passage is left to its representative. What is left of a group becomes tiles
   of at most two blocks; a tile holds the shingles around its centres, looks up by the rarest
   of them who may be alike, which leaves out no pair that would hold, and verifies pairs only as
   far as they are not yet connected, so it gives a forest, not pairs.
4. Pairs are verified by position: places whose shingles agree along the diagonal are cut at
   the widest gaps until a passage has a similarity of THRESHOLD or more on both sides; one a
   little short is taken with the places beside it, and shorter passages than LEAST_WORDS are
   dropped.
5. Spans of one text that overlap by half a passage are one node; connected components of
   nodes are the classes. Texts that are equal are collapsed before and stand in each class
   with all their rows.

Result: one row per document and repeated passage, with the class, and one row with the whole
text for each document of a text that several have. No pair is ever returned, so rows grow with
the documents that hold a passage. Words are runs of letters, digits and underscores, or of any
characters beyond ASCII, in lower case. Defined cases: a null text is empty; texts under
LEAST_WORDS words take no part; texts are told apart by content, never by doc_id, so null and
repeated ids change nothing but the ids shown; rows that repeat are copies; passages that repeat
inside one text only are not reported; very long texts are read whole, and their trees walked
level by level; an empty table gives no rows; other columns are not read. Two passages at
exactly the threshold share fewer than ENOUGH orders with a chance of at most 0.2 %; passages
that agree word by word agree in all. A near copy of a passage that many texts hold is compared
with the passage's representative, whose surroundings may be other than its own.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstar.llm.common import in_batches, rows_of, stored
from ledgerstar.llm.components import components
from ledgerstar.llm.words import GRAM, gram_hashes, lowered, mixed, word_count, word_hashes

THRESHOLD, LEAST_WORDS = 0.8, 50
HASHES, ENOUGH = 6, 2
LEAST_GRAMS = LEAST_WORDS - GRAM + 1
SMALL_GROUP, TILE_BLOCK = 8, 32_768
LEAST_SHARE = 0.87  # of a passage of 46 places, 0.889 but for places that repeat
AROUND = LEAST_GRAMS  # places on both sides of a centre that are compared
CHUNK_SPANS = 2_000_000
BUCKET_BYTES = 8 << 20
CHUNK_WORDS = 2_000_000
WALK_WORDS = 600_000
NEAR_DIAGONAL = 64
WIDE = 4 * NEAR_DIAGONAL
LEAST_COMMON = int(LEAST_SHARE * LEAST_GRAMS) // 4 + 1  # a shingle in common votes for four shifts at most
_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNMIX = np.uint64(pow(int(_MIX), -1, 1 << 64))

WINDOW = np.dtype([
    ("value", "<u8"), ("doc", "<i8"), ("left", "<i4"), ("centre", "<i4"), ("right", "<i4"),
])


def grams_of(text: str | None) -> np.ndarray:
    """Hash of the five words from every position on, where there are five."""
    words = word_hashes(text)
    return gram_hashes(words) if len(words) >= GRAM else np.empty(0, np.uint64)


def text_key(text: Column) -> Column:
    """A 64-bit hash of the text in lower case; texts with one key are copies."""
    return F.xxhash64(F.lower(text))


def _woven(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Values of two arrays in turn."""
    out = np.empty(2 * len(one), one.dtype)
    out[::2], out[1::2] = one, two
    return out


def compact_windows(hashed: np.ndarray, begins: np.ndarray, ends: np.ndarray, least: int):
    """(l, c, r) of all compact windows of `least` places or more, r exclusive.

    The Cartesian trees of all texts are walked together, one level at a time. A place is
    carried, scattered, in the lowest bits of its hash, so that the least of a stretch names
    its place; the bits above decide, and of equal ones a place as good as drawn, which keeps
    the tree of a run of equal hashes flat.
    """
    bits = np.uint64(max(1, len(hashed).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    scatter = int(_MIX) & int(mask) | 1
    gather = np.uint64(pow(scatter, -1, int(mask) + 1))
    with np.errstate(over="ignore"):
        keys = hashed >> bits << bits | np.arange(len(hashed), dtype=np.uint64) * np.uint64(scatter) & mask
    lefts, centres, rights = [], [], []
    wide = ends - begins >= least
    begins, ends = begins[wide], ends[wide]
    moved = np.zeros(len(begins), np.int64)  # from a place to its index in `keys`
    while len(begins):
        sizes = ends - begins
        total = int(sizes.sum())
        if 2 * total < len(keys):  # most stretches have ended: keep the others only
            offsets = np.cumsum(sizes) - sizes
            keys = keys[np.repeat(begins + moved - offsets, sizes) + np.arange(total)]
            moved = offsets - begins
        bounds = _woven(begins + moved, ends + moved)
        if bounds[-1] == len(keys):
            bounds = bounds[:-1]
        with np.errstate(over="ignore"):
            centre = (np.minimum.reduceat(keys, bounds)[::2] * gather & mask).astype(np.int64)
        lefts.append(begins)
        centres.append(centre)
        rights.append(ends)
        begins, ends = _woven(begins, centre + 1), _woven(centre, ends)
        wide = ends - begins >= least
        begins, ends, moved = begins[wide], ends[wide], np.repeat(moved, 2)[wide]
    if not lefts:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(lefts), np.concatenate(centres), np.concatenate(rights)


def windows_of(texts: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Compact windows of all orders for (key, grams) of some texts."""
    sizes = np.array([len(g) for _, g in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    grams = np.concatenate([g for _, g in texts])
    keys = np.array([k for k, _ in texts], np.int64)
    out = []
    for order in range(HASHES):
        salt = np.uint64(int(_MIX) * (2 * order + 1) & 0xFFFFFFFFFFFFFFFF)
        left, centre, right = compact_windows(mixed(grams ^ salt), begins, ends, LEAST_GRAMS)
        text = np.searchsorted(ends, centre, side="right")
        base = begins[text]
        part = np.empty(len(centre), WINDOW)
        # the order is read off the lowest bits, which no two orders share
        # 56 bits: shingles that fall together only make a few more candidates
        part["value"] = mixed(grams[centre]) >> np.uint64(11) << np.uint64(3) | np.uint64(order)
        part["doc"] = keys[text]
        part["left"], part["centre"], part["right"] = left - base, centre - base, right - base
        out.append(part)
    return np.concatenate(out)


def _to_walk(texts: list[tuple[int, np.ndarray]]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Runs of texts whose trees are walked together."""
    held, words = [], 0
    for text in texts:
        held.append(text)
        words += len(text[1])
        if words >= WALK_WORDS:
            yield held
            held, words = [], 0
    if held:
        yield held


LINK = np.dtype([
    ("a", "<i8"), ("b", "<i8"), ("order", "<i4"), ("a_left", "<i4"), ("a_centre", "<i4"),
    ("a_right", "<i4"), ("b_centre", "<i4"),
])


def _links(rows: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Links between rows `one` and `two`, the lesser key first, between different texts."""
    one, two = rows[one], rows[two]
    swap = one["doc"] > two["doc"]
    one, two = np.where(swap, two, one), np.where(swap, one, two)
    out = np.empty(len(one), LINK)
    out["a"], out["b"] = one["doc"], two["doc"]
    out["order"] = one["value"] & np.uint64(7)
    out["a_left"], out["a_centre"], out["a_right"] = one["left"], one["centre"], one["right"]
    out["b_centre"] = two["centre"]
    return out[out["a"] != out["b"]]


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and sizes of the runs of equal rows in sorted columns."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    begins = np.flatnonzero(change)
    return begins, np.diff(np.r_[begins, len(change)])


def _distinct(rows: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
    """Rows sorted by the named columns, one of those that agree in them."""
    order = np.lexsort([rows[n] for n in reversed(names)])
    begins, _ = _groups(*[rows[n][order] for n in names])
    return rows[order[begins]]


def _pairs_in(begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places within groups of SMALL_GROUP or less."""
    one, two = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in range(2, SMALL_GROUP + 1):
        some = begins[sizes == n]
        if len(some):
            left, right = np.triu_indices(n, 1)
            one.append((some[:, None] + left).ravel())
            two.append((some[:, None] + right).ravel())
    return np.concatenate(one), np.concatenate(two)


STRETCH = np.dtype([
    ("value", "<u8"), ("doc", "<i8"), ("left", "<i4"), ("right", "<i4"), ("first", "<i4"),
    ("last", "<i4"),
])


def stretches(rows: np.ndarray) -> np.ndarray:
    """Overlapping windows of a text with one signature as one stretch, with its centres' range."""
    rows = rows[np.lexsort((rows["left"], rows["doc"], rows["value"]))]
    begins, sizes = _groups(rows["value"], rows["doc"])
    # ends so far within a text: lifted by a step per text, so that one running maximum does
    lift = np.repeat(np.arange(len(begins), dtype=np.int64) << np.int64(32), sizes)
    reach = np.maximum.accumulate(rows["right"] + lift)
    change = np.ones(len(rows), bool)
    change[1:] = rows["left"][1:] + lift[1:] >= reach[:-1]
    change[begins] = True
    heads = np.flatnonzero(change)
    out = np.empty(len(heads), STRETCH)
    for name in ("value", "doc", "left"):
        out[name] = rows[name][heads]
    out["right"] = np.maximum.reduceat(rows["right"], heads)
    out["first"] = np.minimum.reduceat(rows["centre"], heads)
    out["last"] = np.maximum.reduceat(rows["centre"], heads)
    return out


def link_bucket(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All links within small groups of one signature; the stretches of larger groups."""
    rows = _distinct(rows, ("value", "doc", "centre"))  # copies of a text give equal windows
    begins, sizes = _groups(rows["value"])
    # sorted by text within a signature: the first and the last window tell whether it has several
    several = rows["doc"][begins] != rows["doc"][begins + sizes - 1] if len(rows) else np.empty(0, bool)
    rows = rows[np.repeat(several, sizes)]
    if not len(rows):
        return np.empty(0, LINK), np.empty(0, STRETCH)
    begins, sizes = _groups(rows["value"])
    large = rows[np.repeat(sizes > SMALL_GROUP, sizes)]
    return _links(rows, *_pairs_in(begins, sizes)), stretches(large) if len(large) else np.empty(0, STRETCH)


def _lists(of: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of each number in `of`, side by side, and where each list begins."""
    return values[np.argsort(of, kind="stable")], np.r_[0, np.cumsum(np.bincount(of, minlength=size))]


def least_distinct(place: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many different shingles LEAST_GRAMS places in a row have at least, for every stretch."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((place, owner))  # stable: equal shingles of a stretch stand in order
    again = np.zeros(len(place) + 1, np.int64)  # places whose shingle stands a little before
    same = (place[order[1:]] == place[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    again[1:][order[1:]] = same & (np.diff(order) < LEAST_GRAMS)
    again = np.cumsum(again)
    at = np.arange(len(place))
    inside = at + LEAST_GRAMS <= (begins + sizes)[owner]
    held = np.where(inside, again[np.minimum(at + LEAST_GRAMS, len(place))] - again[at], 0)
    return LEAST_GRAMS - np.maximum.reduceat(held, begins)


class Places:
    """Which shingles the stretches of a tile share: per place of a stretch, and by rarity.

    Passages of similarity J have J times the different shingles of either in common, so a stretch
    has `least` in common with any other it is linked to, and LEAST_COMMON where the centres
    are WIDE apart (see `shifts_of`). With the shingles of each ordered from the rarest in the
    tile, all but the last least - 1 are its head, and both heads hold a shingle in common. So
    stretches meet by the shingles of their heads only, and what all the tile holds joins no two.
    """

    def __init__(self, rows: np.ndarray, grams: list[np.ndarray], second: np.ndarray | None = None):
        n = len(grams)
        self.spread = (rows["last"] - rows["first"]).astype(np.int64)
        self.sizes = np.array([len(g) for g in grams], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        _, place, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
        owner, gram = np.divmod(np.unique(np.repeat(np.arange(n), self.sizes) * len(count) + place), len(count))
        self.shared = np.bincount(owner[count[gram] > 1], minlength=n)
        holders = np.bincount(gram, minlength=len(count))
        self.least = np.ceil(THRESHOLD * least_distinct(place, self.begins, self.sizes) - 1e-9).astype(np.int64)
        self.least = np.maximum(self.least, np.where(self.spread >= WIDE, LEAST_COMMON, 1))
        distinct = np.bincount(owner, minlength=n)
        order = np.lexsort((gram, holders[gram], owner))
        owner, gram = owner[order], gram[order]
        head = np.arange(len(owner)) - (np.cumsum(distinct) - distinct)[owner] <= (distinct - self.least)[owner]
        # shingles of one stretch only are in the last column
        self.columns = int((holders > 1).sum())
        column = np.where(holders > 1, np.cumsum(holders > 1) - 1, self.columns)
        self.at = column[place]
        # where nobody could be met no list is needed: stretches of one block do not meet
        heads = np.bincount(gram[head], minlength=len(count))
        meeting = heads > 1
        if second is not None:
            others = np.bincount(gram[head], second[owner[head]], minlength=len(count))
            meeting &= (others > 0) & (others < heads)
        head &= meeting[gram]
        owner, gram = owner[head], column[gram[head]]
        self.heads, self.holders = _lists(owner, gram, n), _lists(gram, owner, self.columns)
        self.settled = np.zeros(self.columns, bool)
        self._named = np.full(self.columns + 1, -1, np.int64)

    def near(self, one: int, root: np.ndarray) -> np.ndarray:
        """Stretches not connected with one with which its head has a shingle in common."""
        (shingles, ends), (members, begins) = self.heads, self.holders
        met = []
        for g in shingles[ends[one] : ends[one + 1]].tolist():
            if not self.settled[g]:  # of a list that is connected none is left
                some = members[begins[g] : begins[g + 1]]
                roots = root[some]
                self.settled[g] = (roots == roots[0]).all()
                met.append(some[roots != root[one]])
        return np.unique(np.concatenate(met)) if met else np.empty(0, np.int64)

    def may_hold(self, one: int, others: np.ndarray) -> np.ndarray:
        """Those of the others with which a stretch may have a passage in common.

        Of two passages of similarity J the one with fewer shingles has 2 J / (1 + J) of them in
        common. Some run of LEAST_GRAMS places or more of either stretch must be as full.
        """
        names, mine = np.unique(self.at[self.begins[one] : self.begins[one] + self.sizes[one]], return_inverse=True)
        self._named[names] = np.arange(len(names))
        self._named[-1] = -1
        out = []
        widest = int(max(self.sizes[others].max(), self.sizes[one]))
        for some in np.array_split(others, max(1, len(others) * widest // (1 << 20))):
            place = np.arange(self.sizes[some].max())
            inside = place < self.sizes[some][:, None]
            at = np.where(inside, self.at[np.minimum(self.begins[some][:, None] + place, len(self.at) - 1)], self.columns)
            named = self._named[at]
            held = np.zeros((len(some), len(names) + 1), bool)
            held[np.arange(len(some))[:, None], named] = True
            held[:, -1] = False
            wide = self.spread[one] + self.spread[some] >= WIDE
            least = np.maximum(np.maximum(self.least[some], self.least[one]), np.where(wide, LEAST_COMMON, 1))
            enough = held.sum(axis=1) >= least
            some, held, named = some[enough], held[enough], named[enough]
            out.append(some[_full(held[:, mine]) | _full(named >= 0)])
        self._named[names] = -1
        return np.concatenate(out)


def _full(met: np.ndarray) -> np.ndarray:
    """Whether LEAST_GRAMS places or more in a row are met to LEAST_SHARE, for every row."""
    over = np.zeros((len(met), met.shape[1] + 1), np.float32)
    np.cumsum(met - np.float32(LEAST_SHARE), axis=1, out=over[:, 1:])
    if over.shape[1] <= LEAST_GRAMS:
        return np.zeros(len(met), bool)
    return (over[:, LEAST_GRAMS:] - np.minimum.accumulate(over[:, :-LEAST_GRAMS], axis=1)).max(axis=1) >= -1e-3


def shifts_of(one: np.void, two: np.void, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Shifts between the places held of two stretches at which a passage may lie.

    Few centres: one for every NEAR_DIAGONAL that they can be apart. Stretches of many centres,
    whose texts repeat the shingle: where a passage of shared shingles agrees in the shift
    of their first or last places.
    """
    apart = int(one["left"]) - int(two["left"])
    swept = range(int(two["first"]) - int(one["last"]), int(two["last"]) - int(one["first"]) + 1, NEAR_DIAGONAL)
    if len(swept) <= WIDE // NEAR_DIAGONAL:
        return [shift + apart for shift in swept]
    _, first_a, first_b = np.intersect1d(a, b, return_indices=True)
    _, last_a, last_b = np.intersect1d(a[::-1], b[::-1], return_indices=True)
    last_a, last_b = len(a) - 1 - last_a, len(b) - 1 - last_b
    shift = np.concatenate([y - x for x in (first_a, last_a) for y in (first_b, last_b)])
    step = np.round(shift / NEAR_DIAGONAL).astype(np.int64)
    steps, count = np.unique(np.r_[step, step + 1], return_counts=True)  # of two steps side by side
    full = steps[count >= LEAST_SHARE * LEAST_GRAMS]
    return [int(np.median(shift[(step == s) | (step == s - 1)])) for s in full.tolist()]


def forest(rows: np.ndarray, grams: list[np.ndarray], second: np.ndarray, within: bool) -> Iterator[tuple]:
    """Verified passages (one, two, spans, similarity) that connect a tile's stretches.

    Stretches are taken up from the one most are like; each is compared with its like that are
    not connected with it yet, so of n connected stretches there are n - 1 pairs that hold.
    """
    places = Places(rows, grams, None if within else second)
    doc = rows["doc"]
    root, met = np.arange(len(rows)), np.zeros(len(rows), bool)
    # those that share most with others come first
    waiting = deque(np.argsort(-places.shared, kind="stable").tolist())
    queue: deque[int] = deque()
    while waiting or queue:
        one = queue.popleft() if queue else waiting.popleft()
        if met[one]:
            continue
        met[one] = True
        # not connected, and not yet compared from the other side
        others = places.near(one, root)
        others = others[~met[others] & (doc[others] != doc[one])]
        if not within:
            others = others[second[others] != second[one]]
        for two in places.may_hold(one, others).tolist() if len(others) else ():
            if root[one] == root[two]:
                continue
            for shift in shifts_of(rows[one], rows[two], grams[one], grams[two]):
                found = passages(grams[one], grams[two], shift)
                if found:
                    root[root == root[two]] = root[one]
                    queue.append(two)
                    for a, a_end, b, b_end, alike in found:
                        yield one, two, a, a_end, b, b_end, alike
                    break


def _pack(rows: np.ndarray) -> bytes:
    """Byte planes of the columns, compressed: equal high bytes stand side by side."""
    planes = [np.ascontiguousarray(rows[n]).view(np.uint8).reshape(len(rows), -1).T.tobytes() for n in rows.dtype.names]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(data: bytes, kind: np.dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n, at = len(raw) // kind.itemsize, 0
    out = np.empty(n, kind)
    for name in kind.names:
        wide = kind[name].itemsize
        plane = raw[at : at + wide * n].reshape(wide, n).T
        out[name] = np.ascontiguousarray(plane).view(kind[name]).ravel()
        at += wide * n
    return out


_BLOCKS = pa.schema([("bucket", pa.int64()), ("windows", pa.binary())])


def window_blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, windows: the compact windows of a chunk of texts that belong to one bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            held, seen, words = [], set(), 0
            for key, text in rows_of(batches, "key", "text"):
                if key in seen:
                    continue
                seen.add(key)
                grams = grams_of(text)
                if len(grams) < LEAST_GRAMS:
                    continue
                held.append((key, grams))
                words += len(grams)
                if words >= CHUNK_WORDS:
                    yield from dealt(held)
                    held, seen, words = [], set(), 0
            if held:
                yield from dealt(held)

        def dealt(held):
            rows = np.concatenate([windows_of(some) for some in _to_walk(held)])
            bucket = (rows["value"] >> np.uint64(3)) % np.uint64(buckets)
            order = np.lexsort((rows["doc"], bucket))  # a text's windows side by side pack better
            rows, bucket = rows[order], bucket[order]
            begins, sizes = _groups(bucket)
            for begin, n in zip(begins.tolist(), sizes.tolist()):
                yield int(bucket[begin]), _pack(rows[begin : begin + n])

        yield from in_batches(blocks(), _BLOCKS, size=256)

    return docs.mapInArrow(work, "bucket long, windows binary")


_LINK_ROWS = pa.schema([(n, pa.int64() if n in "ab" else pa.int32()) for n in LINK.names])
_LINK_TYPE = ", ".join(f"`{n}` {'long' if n in 'ab' else 'int'}" for n in LINK.names)
_STRETCH_ROWS = pa.schema([(n, pa.int64() if n in ("value", "doc") else pa.int32()) for n in STRETCH.names])
_STRETCH_TYPE = ", ".join(f"`{n}` {'long' if n in ('value', 'doc') else 'int'}" for n in STRETCH.names)


def _arrays(rows: np.ndarray, schema: pa.Schema) -> list[pa.Array]:
    return [
        pa.array(np.ascontiguousarray(rows[f.name]).view(np.int64 if f.type == pa.int64() else np.int32)) for f in schema
    ]


def window_links(blocks: DataFrame, buckets: int) -> DataFrame:
    """Links within small groups, bucket by bucket; of larger groups the stretches (a is null)."""
    schema = pa.schema([*_LINK_ROWS, *_STRETCH_ROWS])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(windows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            links, rest = link_bucket(np.concatenate(windows))
            for rows, mine in ((links, _LINK_ROWS), (rest, _STRETCH_ROWS)):
                for at in range(0, len(rows), 1 << 16):
                    some = rows[at : at + (1 << 16)]
                    held = dict(zip(mine.names, _arrays(some, mine)))
                    columns = [held[f.name] if f.name in held else pa.nulls(len(some), f.type) for f in schema]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

        held, number = [], None
        for bucket, windows in rows_of(batches, "bucket", "windows"):
            if bucket != number and held:
                yield from table(held)
                held = []
            number = bucket
            held.append(_unpack(windows, WINDOW))
        if held:
            yield from table(held)

    dealt = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(work, f"{_LINK_TYPE}, {_STRETCH_TYPE}")


# ---- large groups: word for word first, then tiles

_CONTENTS = pa.schema([
    ("value", pa.int64()), ("doc", pa.int64()), ("left", pa.int32()), ("first", pa.int32()), ("last", pa.int32()),
    ("sides", pa.list_(pa.int64())), ("grams", pa.binary()),
])
_CONTENTS_TYPE = "value long, doc long, left int, first int, last int, sides array<long>, grams binary"
HALF = LEAST_GRAMS // 2


def _narrow(grams: np.ndarray) -> bytes:
    """The first three bytes of each hash, as planes."""
    return (grams >> np.uint64(40)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes()


def _wide(planes: bytes) -> np.ndarray:
    out = np.zeros((len(planes) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(planes, np.uint8).reshape(3, -1).T
    return out.view("<u4").ravel()


def contents_of(held: DataFrame) -> DataFrame:
    """The shingles around the centres `held` in each text (key, text); left is where they begin.

    The two sides hold the least shingle of half a passage before and after the centre, in an
    order of their own: of two near passages one side at least lies in both.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for key, text, held in rows_of(batches, "key", "text", "held"):
                grams = grams_of(text)
                drawn = mixed(grams ^ _MIX)
                for h in held:
                    first, last = h["first"], h["last"]
                    # picked centres stand for those less than AROUND after them
                    wide = AROUND if h["value"] is not None else 2 * AROUND
                    left, right = max(0, first - wide), last + wide + 1
                    before, after = drawn[max(0, first - HALF) : last + 1], drawn[first : last + HALF + 1]
                    sides = [_signed(before.min()), _signed(after.min())]
                    yield h["value"], key, left, first, last, sides, _narrow(grams[left:right])

        yield from in_batches(rows(), _CONTENTS)

    return held.mapInArrow(work, _CONTENTS_TYPE)


def _signed(value: np.uint64) -> int:
    return int(value) - (int(value) >> 63 << 64)


SPAN = np.dtype([("code", "<u8"), ("doc", "<i8"), ("start", "<i4")])
RUN = np.dtype([("a", "<i8"), ("b", "<i8"), ("a_begin", "<i4"), ("a_end", "<i4"), ("b_begin", "<i4")])


def spans_in(doc: int, left: int, first: int, last: int, grams: np.ndarray) -> np.ndarray:
    """Hashes of all passages of LEAST_GRAMS places that hold a centre, each distinct one once."""
    n = len(grams) - LEAST_GRAMS + 1
    if n <= 0:
        return np.empty(0, SPAN)
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.full(len(grams), base, np.uint64)) for base in (_MIX, _UNMIX))
        sums = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(mixed(grams.astype(np.uint64)) * up, out=sums[1:])
        # the inverse powers bring passages to a common start
        code = mixed((sums[LEAST_GRAMS:] - sums[:n]) * down[:n])
    start = np.arange(left, left + n)
    holds = (start <= last) & (start + LEAST_GRAMS > first)
    code, at = np.unique(code[holds], return_index=True)
    out = np.empty(len(code), SPAN)
    out["code"], out["doc"], out["start"] = code, doc, start[holds][at]
    return out


def runs_to_first(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first text's span of each code, and the others' as runs of places linked to it."""
    rows = rows[np.lexsort((rows["start"], rows["doc"], rows["code"]))]
    begins, sizes = _groups(rows["code"])
    firsts = rows[begins]
    first = np.repeat(firsts, sizes)
    other = rows["doc"] != first["doc"]
    rows, first = rows[other], first[other]
    shift = first["start"].astype(np.int64) - rows["start"]
    order = np.lexsort((rows["start"], shift, first["doc"], rows["doc"]))
    rows, first, shift = rows[order], first[order], shift[order]
    change = np.ones(len(rows), bool)
    change[1:] = (
        (rows["doc"][1:] != rows["doc"][:-1]) | (first["doc"][1:] != first["doc"][:-1])
        | (shift[1:] != shift[:-1]) | (rows["start"][1:] > rows["start"][:-1] + 1)
    )
    heads = np.flatnonzero(change)
    ends = np.r_[heads[1:], len(rows)] - 1
    runs = np.empty(len(heads), RUN)
    runs["a"], runs["b"] = rows["doc"][heads], first["doc"][heads]
    runs["a_begin"], runs["b_begin"] = rows["start"][heads], first["start"][heads]
    runs["a_end"] = rows["start"][ends] + LEAST_GRAMS if len(heads) else 0
    return firsts, runs


_RUN_ROWS = pa.schema([(n, pa.int64() if n in "ab" else pa.int32()) for n in RUN.names])
_RUN_TYPE = ", ".join(f"`{n}` {'long' if n in 'ab' else 'int'}" for n in RUN.names)
_EXACT = pa.schema([("bucket", pa.int64()), ("spans", pa.binary()), *_RUN_ROWS])


def exact_runs(contents: DataFrame, buckets: int) -> DataFrame:
    """Runs (a, b, a_begin, a_end, b_begin) of places from which both texts agree word for word.

    A task links what it holds to one representative per passage; representatives are dealt by
    passage and linked again, one row for every task at most.
    """

    def links(runs: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(runs), 1 << 16):
            some = runs[at : at + (1 << 16)]
            columns = [pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.binary()), *_arrays(some, _RUN_ROWS)]
            yield pa.RecordBatch.from_arrays(columns, schema=_EXACT)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            firsts, runs = runs_to_first(np.concatenate(held))
            yield from links(runs)
            bucket = firsts["code"] % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            firsts, bucket = firsts[order], bucket[order]
            begins, sizes = _groups(bucket)
            blocks = (
                (int(bucket[at]), _pack(firsts[at : at + n]), *(None,) * len(RUN.names))
                for at, n in zip(begins.tolist(), sizes.tolist())
            )
            yield from in_batches(blocks, _EXACT, size=256)

        held, size = [], 0
        for doc, left, first, last, grams in rows_of(batches, "doc", "left", "first", "last", "grams"):
            held.append(spans_in(doc, left, first, last, _wide(grams)))
            size += len(held[-1])
            if size >= CHUNK_SPANS:
                yield from settled(held)
                held, size = [], 0
        if size:
            yield from settled(held)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blocks in groupby(rows_of(batches, "bucket", "spans"), key=lambda r: r[0]):
            _, runs = runs_to_first(np.concatenate([_unpack(spans, SPAN) for _, spans in blocks]))
            for at in range(0, len(runs), 1 << 16):
                yield pa.RecordBatch.from_arrays(_arrays(runs[at : at + (1 << 16)], _RUN_ROWS), schema=_RUN_ROWS)

    local = stored(contents.mapInArrow(own, f"bucket long, spans binary, {_RUN_TYPE}"), "exact-spans")
    blocks = local.filter("bucket is not null").select("bucket", "spans")
    across = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(met, _RUN_TYPE)
    return stored(local.filter("bucket is null").select(*RUN.names).unionByName(across), "exact-runs")


def left_over(contents: DataFrame, runs: DataFrame) -> DataFrame:
    """value, doc, first, last, sides of stretches whose centres no passage covers that is represented elsewhere."""
    covered = runs.select(F.col("a").alias("c_doc"), "a_begin", "a_end").distinct()
    inside = (F.col("doc") == F.col("c_doc")) & (F.col("first") >= F.col("a_begin")) & (F.col("last") < F.col("a_end"))
    return contents.select("value", "doc", "first", "last", "sides").join(covered, inside, "left_anti")


_FOUND = pa.schema([
    ("a", pa.int64()), ("b", pa.int64()), ("a_begin", pa.int32()), ("a_end", pa.int32()), ("b_begin", pa.int32()),
    ("b_end", pa.int32()), ("similarity", pa.float64()),
])
_FOUND_TYPE = "a long, b long, a_begin int, a_end int, b_begin int, b_end int, similarity double"


def tile_passages(contents: DataFrame, left: DataFrame, parts: int) -> DataFrame:
    """Passages, in places of shingles, that connect the stretches of one signature and side.

    A stretch stands in two groups, one for each side, so a shingle that many unrelated texts
    share makes no large group of them.
    """
    sided = left.withColumn("side", F.explode(F.array_distinct("sides"))).select("value", "side", "doc", "first", "last")
    sizes = sided.groupBy("value", "side").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / TILE_BLOCK).cast("int")
    placed = sided.join(sizes, ["value", "side"]).withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("doc", "first"), F.col("blocks")).cast("int")
    )
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    wanted = met.select(
        F.xxhash64("value", "side").alias("group"), low.alias("low"), high.alias("high"),
        ((low < high) & (F.col("block") == high)).alias("second"), "value", "doc", "first", "last",
    )
    tiles = wanted.join(contents.drop("sides"), ["value", "doc", "first", "last"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved():
            read = rows_of(batches, "group", "low", "high", "second", "doc", "left", "first", "last", "grams")
            for (_, low, high), group in groupby(read, key=lambda r: r[:3]):
                tile = list(group)
                rows = np.zeros(len(tile), STRETCH)
                for name, at in (("doc", 4), ("left", 5), ("first", 6), ("last", 7)):
                    rows[name] = [r[at] for r in tile]
                grams = [_wide(r[8]) for r in tile]
                second = np.array([r[3] for r in tile])
                left = rows["left"].tolist()
                doc = rows["doc"].tolist()
                for one, two, a, a_end, b, b_end, alike in forest(rows, grams, second, low == high):
                    yield doc[one], doc[two], a + left[one], a_end + left[one], b + left[two], b_end + left[two], alike

        yield from in_batches(solved(), _FOUND)

    names = ("group", "low", "high")
    return tiles.repartition(parts, *names).sortWithinPartitions(*names, "doc", "first").mapInArrow(work, _FOUND_TYPE)


# ---- interval join and exact comparison

def diagonals(
    order: np.ndarray, left: np.ndarray, right: np.ndarray, centre: np.ndarray, other: np.ndarray
) -> list[int]:
    """Diagonals along which windows of ENOUGH orders cover a common place of the first text.

    Links are an order, a window [left, right) and its centre in the first text, and the
    centre in the other.
    """
    shift = other - centre
    sort = np.argsort(shift, kind="stable")
    shift = shift[sort]
    cuts = np.flatnonzero(np.diff(shift) > NEAR_DIAGONAL) + 1
    out = []
    for group in np.split(np.arange(len(sort)), cuts):
        some = sort[group]
        orders = np.unique(order[some])
        if len(orders) < ENOUGH:
            continue
        begins = left[some]
        depth = np.zeros(len(some), np.int64)
        for one in orders:
            mine = some[order[some] == one]
            opened = np.searchsorted(np.sort(left[mine]), begins, side="right")
            closed = np.searchsorted(np.sort(right[mine]), begins, side="right")
            depth += opened > closed
        if depth.max() >= ENOUGH:
            mine = shift[group]
            if mine[-1] - mine[0] <= NEAR_DIAGONAL:
                out.append(int(mine[len(mine) // 2]))
                continue
            while len(mine):  # a wide group may hold many: each of its shifts is near one that is tried
                out.append(int(mine[0]))
                mine = mine[np.searchsorted(mine, mine[0] + NEAR_DIAGONAL, side="right"):]
    return out


def _similarity(a: list[int], b: list[int]) -> float:
    one, two = set(a), set(b)
    common = len(one & two)
    return common / max(1, len(one) + len(two) - common)


def _spans(p: np.ndarray, q: np.ndarray, a_size: int, b_size: int) -> set[tuple[int, int, int, int]]:
    """From the first to the last match in both texts; a short span with places beside it, each way.

    A word changed near an end of a passage takes the shingles over it out of the matches.
    """
    spans = [(p[0], p[-1] + 1, a_size), (q.min(), q.max() + 1, b_size)]
    lacks = [max(0, LEAST_GRAMS - (end - begin)) for begin, end, _ in spans]
    out = set()
    for before in range(max(lacks) + 1):
        held = []
        for (begin, end, size), lack in zip(spans, lacks):
            first = max(0, begin - min(before, lack))
            last = min(size, max(end, first + LEAST_GRAMS))
            first = max(0, min(first, last - LEAST_GRAMS))
            held += [int(first), int(last)]
        if held[1] - held[0] >= LEAST_GRAMS and held[3] - held[2] >= LEAST_GRAMS:
            out.add(tuple(held))
    return out


def _index(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, and number of the gram and place as one sorted number."""
    order = np.argsort(grams, kind="stable")
    begins, sizes = _groups(grams[order])
    return grams[order[begins]], np.repeat(np.arange(len(begins)), sizes) * np.int64(len(grams) + 1) + order


def _matches(a: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram the other text has too, and the number of the gram there."""
    known, _ = index
    mine = np.searchsorted(known, a)
    place = np.flatnonzero(known[np.minimum(mine, len(known) - 1)] == a)
    return place, mine[place]


def passages(
    a: np.ndarray, b: np.ndarray, shift: int
) -> list[tuple[int, int, int, int, float]]:
    """(a_begin, a_end, b_begin, b_end, similarity) in places of grams, ends exclusive."""
    size = np.int64(len(b) + 1)
    index = _index(b)
    place, mine = _matches(a, index)
    if len(place) < LEAST_SHARE * LEAST_GRAMS:
        return []
    keys = index[1]
    wanted = np.clip(place + shift, 0, len(b) - 1)
    at = np.searchsorted(keys, mine * size + wanted)
    best, far = np.full(len(place), -1), np.full(len(place), np.iinfo(np.int64).max)
    for near in (at - 1, at):
        near = np.clip(near, 0, len(keys) - 1)
        fits = keys[near] // size == mine
        off = np.abs(keys[near] % size - (place + shift))
        closer = fits & (off < far)
        best[closer], far[closer] = (keys[near] % size)[closer], off[closer]
    found = []
    one, two = a.tolist(), b.tolist()
    close = far <= 2 * NEAR_DIAGONAL
    stack = [(place[close], best[close])]
    while stack:
        p, q = stack.pop()
        if len(p) < LEAST_SHARE * LEAST_GRAMS:
            continue
        best_of = max(
            (
                (_similarity(one[begin:end], two[other:other_end]), int(begin), int(end), int(other), int(other_end))
                for begin, end, other, other_end in _spans(p, q, len(a), len(b))
            ),
            default=None,
        )
        if best_of and best_of[0] >= THRESHOLD:
            found.append((*best_of[1:], best_of[0]))
            continue
        gap = np.maximum(np.diff(p), np.abs(np.diff(q)))
        cut = int(gap.argmax()) + 1
        if gap[cut - 1] <= 1:
            cut = len(p) // 2
        stack += [(p[:cut], q[:cut]), (p[cut:], q[cut:])]
    return found


_PICKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("a_at", pa.int32()), ("b_at", pa.int32())])


def picked(pairs: DataFrame) -> DataFrame:
    """a, b, a_at, b_at: centres at which the texts of each pair (a, b, links) are to be compared.

    Along each diagonal that enough orders agree on, centres at least AROUND apart.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                ends = batch["links"].offsets.to_numpy()
                flat = batch["links"].values
                links = [flat.field(n).to_numpy() for n in LINK.names[2:]]
                keys = zip(batch["a"].to_pylist(), batch["b"].to_pylist())
                for row, (a, b) in enumerate(keys):
                    order, left, centre, right, other = (c[ends[row] : ends[row + 1]] for c in links)
                    for shift in diagonals(order, left, right, centre, other):
                        near = np.abs(other - centre - shift) <= NEAR_DIAGONAL
                        last = None
                        for at, to in sorted(zip(centre[near].tolist(), other[near].tolist())):
                            if last is None or at - last >= AROUND:
                                last = at
                                yield a, b, at, to

        yield from in_batches(rows(), _PICKS, size=16384)

    return pairs.mapInArrow(work, "a long, b long, a_at int, b_at int")


def compared(picks: DataFrame, contents: DataFrame) -> DataFrame:
    """The passages, in places of shingles, around picked centres."""

    def side(name: str) -> DataFrame:
        return contents.select(
            F.col("doc").alias(name), F.col("first").alias(f"{name}_at"), F.col("left").alias(f"{name}_left"),
            F.col("grams").alias(f"{name}_grams"),
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            names = ("a", "b", "a_at", "b_at", "a_left", "b_left", "a_grams", "b_grams")
            for a, b, a_at, b_at, a_left, b_left, one, two in rows_of(batches, *names):
                shift = b_at - a_at + a_left - b_left
                for begin, end, other, other_end, alike in passages(_wide(one), _wide(two), shift):
                    yield a, b, begin + a_left, end + a_left, other + b_left, other_end + b_left, alike

        yield from in_batches(rows(), _FOUND, size=16384)

    return picks.join(side("a"), ["a", "a_at"]).join(side("b"), ["b", "b_at"]).mapInArrow(work, _FOUND_TYPE)


_KEYS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("words", pa.int64())])


def text_words(docs: DataFrame) -> DataFrame:
    """doc_id, key, words of every text that is long enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, key, text in rows_of(batches, "doc_id", "key", "text"):
                words = word_count(lowered(text))
                if words >= LEAST_WORDS:
                    yield doc_id, key, words

        yield from in_batches(rows(), _KEYS, size=65536)

    return docs.mapInArrow(work, "doc_id long, key long, words long")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, text of the wanted keys, one text each; copies are reduced in each task."""
    return docs.select("key", "text").join(wanted, "key", "left_semi").groupBy("key").agg(F.any_value("text").alias("text"))


# ---- classes

def classes(found: DataFrame) -> DataFrame:
    """key, start, end, root of the connected passages, in words; found are links in places of shingles."""
    ends = [
        found.select(F.col(s).alias("key"), F.col(f"{s}_begin").alias("begin"), F.col(f"{s}_end").alias("end")) for s in "ab"
    ]
    spans = ends[0].unionByName(ends[1]).distinct()
    # a span that overlaps what came before it by less than half a passage begins a node
    before = Window.partitionBy("key").orderBy("begin", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (reach.isNull() | (F.col("begin") > reach - LEAST_GRAMS // 2)).cast("int")
    numbered = spans.withColumn("fresh", fresh).withColumn("number", F.sum("fresh").over(before))
    spans = stored(numbered.withColumn("node", F.xxhash64("key", "number")), "passage-spans")

    def named(side: str) -> DataFrame:
        return spans.select(
            F.col("key").alias(side), F.col("begin").alias(f"{side}_begin"), F.col("end").alias(f"{side}_end"),
            F.col("node").alias(f"{side}_node"),
        )

    edges = found.join(named("a"), ["a", "a_begin", "a_end"]).join(named("b"), ["b", "b_begin", "b_end"])
    roots = components(edges.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct())
    nodes = spans.groupBy("key", "node").agg(F.min("begin").alias("start"), F.max("end").alias("end"))
    return nodes.join(roots, "node").select(
        "key", "start", (F.col("end") + GRAM - 1).alias("end"), "root"
    )


def linked_passages(docs: DataFrame, octets: int) -> DataFrame:
    """a, b, spans and similarity, in places of shingles, of the passages that connect texts (key, text)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, -(-octets // BUCKET_BYTES))
    linked = stored(window_links(window_blocks(docs.select("key", "text"), buckets), buckets), "window-links")
    links, large = linked.filter("a is not null").select(*LINK.names), linked.filter("a is null").select(*STRETCH.names)
    # groups of a few: centres of pairs of texts that enough orders link
    pairs = links.groupBy("a", "b").agg(
        F.collect_set(F.struct(*LINK.names[2:])).alias("links")
    ).filter(F.size(F.array_distinct(F.transform("links", lambda k: k["order"]))) >= ENOUGH)
    picks = stored(picked(pairs).distinct(), "passage-picks")
    ends = [picks.select(F.col(s).alias("doc"), F.col(f"{s}_at").alias("at")) for s in "ab"]
    single = ends[0].unionByName(ends[1]).distinct().select(
        "doc", F.lit(None).cast("long").alias("value"), F.col("at").alias("first"), F.col("at").alias("last")
    )
    # what is to be compared of a text is taken from it once
    held = stored(
        large.select("doc", "value", "first", "last").unionByName(single).groupBy(F.col("doc").alias("key")).agg(
            F.collect_list(F.struct("value", "first", "last")).alias("held")
        ), "passage-places",
    )
    contents = stored(contents_of(texts_of(docs, held.select("key")).join(held, "key")), "passage-contents")
    grouped = contents.filter("value is not null")
    # equal passages agree in every order, so one order finds them all
    runs = exact_runs(grouped.filter("value & 7 = 0"), buckets)
    exact = runs.select(
        "a", "b", "a_begin", "a_end", "b_begin", (F.col("b_begin") + F.col("a_end") - F.col("a_begin")).alias("b_end"),
        F.lit(1.0).alias("similarity"),
    )
    tiled = tile_passages(grouped, left_over(grouped, runs), 4 * parts)
    small = compared(picks, contents.filter("value is null"))
    return stored(exact.unionByName(tiled).unionByName(small), "passages-found")


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, start_word, end_word, n_rows: the repeated passages of every document.

    class_id is the least doc_id of the class, n_rows the number of its rows. A passage that
    differs from the others of its class is near one of them. The rows of a text that several
    documents have make up a class of their own, from the first word to the last.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("key", text_key(F.col("text")))
    octets = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rows = stored(text_words(docs), "text-words")
    found = classes(linked_passages(docs, octets))
    passages_of = rows.select("doc_id", "key").join(found, "key").select(
        "doc_id", "root", F.lit(False).alias("whole"), F.col("start").cast("long").alias("start_word"),
        F.col("end").cast("long").alias("end_word"),
    )
    copied = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("key")
    whole = rows.join(copied, "key").select(
        "doc_id", F.col("key").alias("root"), F.lit(True).alias("whole"), F.lit(0).cast("long").alias("start_word"),
        F.col("words").alias("end_word"),
    )
    held = stored(passages_of.unionByName(whole), "passage-rows")
    named = held.groupBy("root", "whole").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_rows"))
    return held.join(named, ["root", "whole"]).select("doc_id", "class_id", "start_word", "end_word", "n_rows")
