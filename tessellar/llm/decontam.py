"""Benchmark decontamination by SimHash of item-sized windows.

A document's windows of as many words as an item has are compared with the item. Fingerprints are SimHash values of
``BITS`` bits over the window's word shingles, each shingle weighted by its count. The fingerprint is cut into blocks of 16 bits;
by the pigeonhole principle two fingerprints within ``RADIUS`` differ in at most ``RADIUS // blocks`` bits of some block. Items are
kept by size, and each block's distinct values with the items that have them: a window looks up the values within that many bits of its
own, block by block, among the items of its size. So every pair
within the radius is found; candidates are then verified by the exact similarity of weighted shingles,
``sum of smaller counts / sum of larger counts``, of at least ``percent``.

Only windows that hold a shingle of some item of their size are looked at: any other has similarity 0. A text of fewer shingles
than an item, but enough for ``percent``, is its own one window. Similarities are of
window and item as multisets, so the radius leaves room for the angle that similarity 0.8 allows: at 0.8 about 38 of
256 bits differ, and more than 76 in fewer than one of a million windows.

An item of fewer words than a shingle has its whole sequence as its one shingle; items of null or empty text match nothing, and
neither do null or empty texts; items without an id are reported with a null one; equal items are each reported; rows repeated in ``docs`` each give their own rows.
The index is built once on the driver and broadcast, a few words for each shingle of an item; items are taken in
blocks of about ``block_bytes`` of text (one longer item is a block), so that what a task holds has a bound however many items there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.llm.common import U, mix64, sheltered, shingles, slices, small_batches, word_hashes

BITS, RADIUS, WIDTH = 256, 76, 16
BLOCKS = BITS // WIDTH
ERRORS = RADIUS // BLOCKS
BLOOM = 1 << 22


def bit_signs(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each fingerprint bit of each shingle hash."""
    parts = [mix64(h * U(2 * i + 3) + U(i)) for i in range(BITS // 64)]
    bits = np.unpackbits(np.stack(parts, axis=1).view(np.uint8), axis=1, bitorder="little")
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def fingerprints(h: np.ndarray, size: int) -> np.ndarray:
    """Packed SimHash of each run of ``size`` shingles."""
    total = np.zeros((len(h) + 1, BITS), np.int32)
    np.cumsum(bit_signs(h), axis=0, dtype=np.int32, out=total[1:])
    return np.packbits(total[size:] - total[:-size] > 0, axis=1, bitorder="little")


def similarity(values: np.ndarray, counts: np.ndarray, window: np.ndarray) -> float:
    """Weighted Jaccard of a multiset, as sorted values and their counts, and a window."""
    own, n = np.unique(window, return_counts=True)
    at = np.minimum(np.searchsorted(values, own), len(values) - 1)
    both = int(np.where(values[at] == own, np.minimum(counts[at], n), 0).sum())
    return both / max(1, int(counts.sum()) + len(window) - both)


class Lookup:
    """The fingerprints of the items of one size, by the values of their blocks."""

    def __init__(self, items: np.ndarray, prints: np.ndarray):
        self.items, self.prints = items, prints.view(np.uint64)
        blocks = prints.view(np.uint16)
        self.values = [np.unique(blocks[:, b], return_inverse=True) for b in range(BLOCKS)]

    def candidates(self, prints: np.ndarray, cells: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) within the radius; ``cells`` bounds the windows that are looked up at a time."""
        step, out = max(1, cells // len(self.items)), [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for a in range(0, len(prints), step):
            part = prints[a : a + step]
            blocks = part.view(np.uint16)
            some = np.zeros((len(part), len(self.items)), bool)
            for b, (value, of) in enumerate(self.values):
                some |= (np.bitwise_count(blocks[:, b, None] ^ value) <= ERRORS)[:, of]
            w, i = np.nonzero(some)
            ok = np.bitwise_count(part.view(np.uint64)[w] ^ self.prints[i]).sum(axis=1) <= RADIUS
            out.append((w[ok] + a, self.items[i[ok]]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Index:
    """Items that share a shingle length ``k``: (id, shingles) of each."""

    def __init__(self, k: int, rows: list[tuple]):
        self.k, self.ids = k, [i for i, _ in rows]
        size = np.array([len(g) for _, g in rows])
        prints = np.concatenate([fingerprints(g, len(g)) for _, g in rows])
        self.sets = [np.unique(g, return_counts=True) for _, g in rows]
        self.sizes, which = np.unique(size, return_inverse=True)
        self.lookups = [Lookup(at := np.flatnonzero(which == w), prints[at]) for w in range(len(self.sizes))]
        # the sizes of the items that have each shingle
        h = np.concatenate([v for v, _ in self.sets])
        of = np.repeat(which, [len(v) for v, _ in self.sets])
        order = np.lexsort((of, h))
        h, of = h[order], of[order]
        new = np.append(True, (h[1:] != h[:-1]) | (of[1:] != of[:-1]))
        h, self.size_of = h[new], of[new]
        begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        self.hashes, self.begin = h[begin], np.append(begin, len(h))
        self.bloom = np.zeros(BLOOM, bool)
        self.bloom[(self.hashes >> U(20)) & U(BLOOM - 1)] = True

    def hits(self, g: np.ndarray) -> np.ndarray:
        """Places of shingles that some item has."""
        at = np.flatnonzero(self.bloom[(g >> U(20)) & U(BLOOM - 1)])
        to = np.minimum(np.searchsorted(self.hashes, g[at]), len(self.hashes) - 1)
        return at[self.hashes[to] == g[at]]

    def by_size(self, g: np.ndarray, hit: np.ndarray):
        """For each size of items with a shingle among ``hit``: its number, and the places of these shingles."""
        to = np.searchsorted(self.hashes, g[hit])
        n = self.begin[to + 1] - self.begin[to]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.begin[to], n)
        which, place = self.size_of[at], np.repeat(hit, n)
        order = np.argsort(which, kind="stable")
        which, place = which[order], place[order]
        cut = np.flatnonzero(which[1:] != which[:-1]) + 1
        return zip(which[np.append(0, cut)].tolist(), np.split(place, cut), strict=True) if len(which) else ()


def indexes(items: list[tuple], words: int) -> list[Index]:
    """An index for each shingle length among the items (id, text)."""
    by: dict[int, list] = {}
    for item, text in items:
        for _, _, data, off in slices(pa.array([text], pa.string())):
            h, first = word_hashes(data, off)
            if len(h):
                k = min(words, len(h))
                by.setdefault(k, []).append((item, shingles(h, first, k)[0]))
    return [Index(k, rows) for k, rows in by.items()]


def matches(g: np.ndarray, hit: np.ndarray, ix: Index, percent: int) -> list[tuple]:
    """(item, similarity, first word, words) for one text: shingles ``g``, of which ``hit`` are some item's."""
    best: dict = {}
    for which, own in ix.by_size(g, hit):
        size = int(ix.sizes[which])
        # a text that is shorter is one window as a whole, if it can be similar enough
        width = min(size, len(g))
        if width * 100 < size * percent:
            continue
        # starts of windows of this size that hold a shingle of an item of this size, as far as the text goes
        lo = np.maximum(own - width + 1, 0)
        hi = np.minimum(own, len(g) - width)
        cover = np.zeros(len(g) + 1, np.int32)
        ok = lo <= hi
        np.add.at(cover, lo[ok], 1)
        np.add.at(cover, hi[ok] + 1, -1)
        starts = np.flatnonzero(np.cumsum(cover) > 0)
        cut = np.flatnonzero(np.diff(starts) != 1) + 1
        for run in np.split(starts, cut):
            if not len(run):
                continue
            part = g[run[0] : run[-1] + width]
            w, i = ix.lookups[which].candidates(fingerprints(part, width))
            for x, item in zip(w.tolist(), i.tolist(), strict=True):
                s = similarity(*ix.sets[item], part[x : x + width])
                if s * 100 >= percent and s > best.get(item, (0,))[0]:
                    best[item] = (s, int(run[0]) + x, width + ix.k - 1)
    return [(ix.ids[i], *v) for i, v in best.items()]


FOUND = "array<struct<item_id:long,similarity:double,first_word:long,n_words:long>>"
KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())]))


def scan(docs: DataFrame, items: list[tuple], keep: list[str], words: int = 5, percent: int = 80) -> DataFrame:
    """``keep`` and ``decon_found``: the items of one block found in each row's text, each at its best place."""
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(indexes(items, words))

    def run(batches):
        built = shared.value
        for b in batches:
            found: list[list] = [[] for _ in range(b.num_rows)]
            for lo, _, data, off in slices(b.column("text")):
                h, first = word_hashes(data, off)
                for ix in built:
                    g, begin = shingles(h, first, ix.k)
                    # a text of fewer words than the shingle has a shingle that no item has
                    at = ix.hits(g)
                    row = np.searchsorted(begin, at, "right") - 1
                    for r in np.unique(row).tolist():
                        found[lo + r] += matches(g[begin[r] : begin[r + 1]], at[row == r] - begin[r], ix, percent)
            rows = [[dict(zip(("item_id", "similarity", "first_word", "n_words"), x, strict=True)) for x in sorted(f, key=lambda x: (x[0] is None, x[0] or 0, *x[1:]))] for f in found]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(rows, KIND)], [*keep, "decon_found"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.mapInArrow(run, f"{ddl}, decon_found {FOUND}")


def item_blocks(benchmark: DataFrame, block_bytes: int):
    """The benchmark's items, a block at a time, without a collect of more."""
    items = benchmark.filter("text is not null").select("item_id", "text")
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0) // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return ([(r["item_id"], r["text"]) for r in items.filter(part == i).collect()] for i in range(blocks))


def contaminated(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80, block_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words for every item that a document holds."""
    out = None
    for items in item_blocks(benchmark, block_bytes):
        one = scan(docs.select("doc_id", "text"), items, ["doc_id"], words, percent).select("doc_id", F.inline("decon_found"))
        out = one if out is None else out.unionByName(one)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80, block_bytes: int = 16 << 20) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    rows, names = sheltered(docs, "text")
    for items in item_blocks(benchmark, block_bytes):
        rows = scan(rows, items, [*names, "text"], words, percent).filter(F.size("decon_found") == 0).drop("decon_found")
    return rows.select(*names).toDF(*docs.columns)
