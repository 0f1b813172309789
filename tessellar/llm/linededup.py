"""Line deduplication by an exact set-similarity join with prefix, positional and length filters.

A line's set holds its distinct lower-case words. Words are ordered by rarity: by the count of a hashed bucket of
a sketch over all lines, then by hash; any such order is the same for all lines, which is all that the filters need. Two
sets with Jaccard similarity of at least t share a word within their first ``n - ceil(t n) + 1`` words, and the first word that
they share, with those after it, leaves either room for the overlap of ``ceil(t (n + m) / (1 + t))``, which holds their sizes together too. Lines that
share a prefix word are compared as if it were the first: by this and by bit maps of their words from there on, whose difference
bounds the overlap from above. Under the word that is the first, neither drops a similar pair.

A line goes if any line before it is that similar, whether or not that one goes too; lines are ordered by (doc_id,
number in the text). So a line needs one match among those before it. Round one verifies its likeliest partner by bit maps
of 64 bits on their full sets. Lines for which that fails and that have other partners go through round two, whose bit maps have
512 bits, and what is then left through round three, which verifies all partners. Rows written grow with the
lines, and with pairs only in round three. The text is read three times: for the sketch, for the prefixes of round one, and for the
sets of the lines that met another there, which later rounds work on.

Lines of fewer than ``min_words`` words (one by default) stay and aren't compared; so do lines without words, null and empty
texts. Rows that share an id are told apart by the hash of the text, and lines of equal number by the hash of theirs; wholly
equal rows count as one row's lines, and lose the same. Rows without an id come first in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessellar.llm.common import U, materialize, mix64, prefix, sheltered, slices, small_batches, span_hash, sum_slices, text_hash
from tessellar.llm.filters import id_filter, maybe

SKETCH_BITS = 17
SKETCH = 1 << SKETCH_BITS
SLICES = 8
NO_ID = -(1 << 63)
#: pairs that are compared at a time, a quarter of the lines in a block of a word's group, lines of a word from which blocks of them are compared,
#: and entries that a task gathers before it puts such words aside
CHUNK = 1 << 19
BLOCK = 2048
HOT = 16_384
LIMIT = 2_000_000
MAPS = 8
M = [f"m{i}" for i in range(MAPS)]
LONG_WORD = 64
EIGHT = np.array([(1 << 8 * i) - 1 for i in range(9)], U)


def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word, as ``common.words`` finds them."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    seen = (data - np.uint8(9) > 4) & (data != 32)
    flips = np.flatnonzero(seen[1:] != seen[:-1]) + 1
    flips = np.concatenate((np.zeros(int(seen[0]), np.int64), flips, np.full(int(seen[-1]), len(data))))
    s, e = flips[::2], flips[1::2]
    # words that run into the next row's first
    edge = np.unique(off[(off > 0) & (off < len(data))])
    edge = edge[seen[edge - 1] & seen[edge]]
    return np.insert(s, np.searchsorted(s, edge), edge), np.insert(e, np.searchsorted(e, edge), edge)


def hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word in lower case, read 8 bytes at a time; of one longer than ``LONG_WORD`` by its span."""
    low = np.zeros(len(data) + 8, np.uint8)
    np.bitwise_or(data, (data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5), out=low[: len(data)])
    eight = np.ndarray((len(data) + 1,), "<u8", low, strides=(1,))
    n = e - s
    h = mix64((eight[s] & EIGHT[np.minimum(n, 8)]) + n.astype(U) * U(0x9E3779B97F4A7C15))
    at, k = np.flatnonzero((n > 8) & (n <= LONG_WORD)), 8
    while len(at):
        h[at] = mix64((h[at] + (eight[s[at] + k] & EIGHT[np.minimum(n[at] - k, 8)])) * U(0xD6E8FEB86659FD93))
        k += 8
        at = at[n[at] > k]
    at = np.flatnonzero(n > LONG_WORD)
    if len(at):
        byte, _ = runs(s[at], e[at])
        end = np.cumsum(n[at])
        h[at] = span_hash(prefix(low[byte]), end - n[at], end)
    return h


def lines(data: np.ndarray, off: np.ndarray, min_words: int):
    """(hashes of all words, first word of each line, word after its last, row, number in the row) of lines long
    enough."""
    s, e = spans(data, off)
    h = hashes(data, s, e)
    n = len(off) - 1
    breaks = np.flatnonzero(data == 10)
    # lines begin at rows' begins and after each line feed
    begin = np.concatenate((off[:-1], breaks + 1))
    row = np.concatenate((np.arange(n), np.searchsorted(off, breaks, "right") - 1))
    order = np.lexsort((np.concatenate((np.zeros(n, np.int8), np.ones(len(breaks), np.int8))), begin, row))
    begin, row = begin[order], row[order]
    number = np.arange(len(row)) - np.searchsorted(row, row)
    a = np.searchsorted(s, begin)
    b = np.append(a[1:], len(s))
    # a line that begins where its row ends has no word of the next row
    b = np.minimum(b, np.searchsorted(s, off)[row + 1])
    a = np.minimum(a, b)
    ok = (b - a) >= min_words
    return h, a[ok], b[ok], row[ok], number[ok]


def runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all words of the lines, and the line of each."""
    n = b - a
    line = np.repeat(np.arange(len(a)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + a[line], line


def identity(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each line's sequence of words."""
    return one_half(h, a, b), other_half(h, a, b)


def one_half(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    at, line = runs(a, b)
    place = U(2) * (at - a[line]).astype(U) + U(1)
    return _summed(mix64(h[at] * U(0xD6E8FEB86659FD93) + place * U(0x9E3779B97F4A7C15)), a, b)


def other_half(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    at, line = runs(a, b)
    place = U(2) * (at - a[line]).astype(U) + U(1)
    return _summed(mix64(h[at] ^ (place * U(0xC2B2AE3D27D4EB4F))), a, b)


def _summed(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    start = np.cumsum(b - a) - (b - a)
    return np.add.reduceat(x, start).view(np.int64) if len(start) else np.empty(0, np.int64)


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, th, line, k1, k2) of all lines; and, with a slice number instead, what each task adds to the
    sketch of word counts."""

    def run(batches):
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for lo, _, data, off in slices(batch.column("text")):
                h, a, b, row, number = lines(data, off, min_words)
                if not len(a):
                    continue
                total += np.bincount((h[runs(a, b)[0]] & U(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                k1, k2 = identity(h, a, b)
                at = pa.array(row + lo)
                none = pa.nulls(len(row), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("th").take(at), pa.array(number), pa.array(k1), pa.array(k2), none, none, pa.nulls(len(row), pa.binary())], NAMES)
        if total.any():
            parts = pa.array([x.tobytes() for x in np.split(total, SLICES)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.nulls(SLICES, pa.int64())] * 5 + [pa.array(range(SLICES), pa.int32()), pa.array([int(total.sum()) % 64] * SLICES, pa.int32()), parts], NAMES)

    return docs.mapInArrow(run, "doc_id long, th long, line long, k1 long, k2 long, slice int, part int, payload binary")


NAMES = ["doc_id", "th", "line", "k1", "k2", "slice", "part", "payload"]


def gathered(rows: DataFrame):
    """A broadcast of the rank of each sketch bucket by count, and the number of words."""
    counts = {r["slice"]: bytes(r["payload"]) for r in sum_slices(rows.filter("slice is not null").select("slice", "part", "payload"), "i8").collect()}
    total = np.frombuffer(b"".join(counts.get(i, bytes(8 * SKETCH // SLICES)) for i in range(SLICES)), np.int64)
    rank = np.empty(SKETCH, U)
    rank[np.argsort(total, kind="stable")] = np.arange(SKETCH, dtype=U)
    return rows.sparkSession.sparkContext.broadcast(rank), int(total.sum())


def ordered(h: np.ndarray, a: np.ndarray, b: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each line, rarest first, and the first of each line (the count at the end). A word is
    given as its place in the order of rarity, a one-to-one change of its hash."""
    at, line = runs(a, b)
    w = h[at]
    return distinct((rank[(w & U(SKETCH - 1)).astype(np.int64)] << U(64 - SKETCH_BITS)) | (w >> U(SKETCH_BITS)), line, len(a))


def distinct(w: np.ndarray, line: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each of ``n`` lines in order, and the first of each line (the count at the end)."""
    order = np.argsort(w)
    order = order[np.argsort(line[order].astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")]
    w, line = w[order], line[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (line[1:] != line[:-1])
    w, line = w[new], line[new]
    return w, np.searchsorted(line, np.arange(n + 1))


def earlier(seen: dict, k1: np.ndarray, doc: np.ndarray, number: np.ndarray, limit: int = 1 << 20) -> np.ndarray:
    """Which lines this task hasn't met at this place or before it; it forgets now and then, and what it repeats does no harm."""
    out = np.zeros(len(k1), bool)
    for i, (x, y) in enumerate(zip(k1.tolist(), zip(doc.tolist(), number.tolist(), strict=True), strict=True)):
        if x not in seen or seen[x] > y:
            seen[x], out[i] = y, True
    if len(seen) > limit:
        seen.clear()
    return out


#: columns of an entry, a line under one of its prefix words; doc_id and line are its place in the order. Its bit maps follow
ENTRY = [("word", np.int64), ("k1", np.int64), ("doc_id", np.int64), ("n", np.int32), ("place", np.int32), ("line", np.int32)]
WIDE = 8


def columns(maps: int) -> list[tuple[str, type]]:
    return [*ENTRY, *((f"m{i}", np.int64) for i in range(maps))]


def packed(cols: list[np.ndarray]) -> bytes:
    """Columns as bytes, the like bytes of all values together, so that those that hardly vary take no room."""
    n = len(cols[0])
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(n, -1).T) for c in cols]
    return squeezed(b"".join(p.tobytes() for p in planes))


def squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(payload: bytes, maps: int) -> list[np.ndarray]:
    kinds = columns(maps)
    raw = np.frombuffer(pa.decompress(payload[8:], int.from_bytes(payload[:8], "little"), codec="zstd"), np.uint8)
    n, at, out = len(raw) // sum(np.dtype(t).itemsize for _, t in kinds), 0, []
    for _, t in kinds:
        w = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(raw[at : at + w * n].reshape(w, n).T).view(t).ravel())
        at += w * n
    return out


def packer(buckets: int):
    """Gathers columns of entries and gives (bucket, payload): packed by a bucket of the word."""
    held: list[list] = []
    size = 0

    def flush():
        nonlocal held, size
        if not size:
            return
        cols = [np.concatenate(x) for x in zip(*held, strict=True)]
        held, size = [], 0
        bucket = (mix64(cols[0].view(U).copy()) % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, cols = bucket[order], [c[order] for c in cols]
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for lo in range(0, len(cut), 64):
            some = cut[lo : lo + 64].tolist()
            ends = cut[lo + 1 : lo + 65].tolist()
            ends += [len(bucket)] * (len(some) - len(ends))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[some]), pa.array([packed([c[x:y] for c in cols]) for x, y in zip(some, ends, strict=True)], pa.binary())], ["bucket", "payload"])

    def add(cols: list[np.ndarray]):
        nonlocal size
        held.append(cols)
        size += len(cols[0])
        if size > 500_000:
            yield from flush()

    return add, flush


def entries(w: np.ndarray, begin: np.ndarray, k1: np.ndarray, doc: np.ndarray, number: np.ndarray, percent: int, maps: int, words_of=None, met_of=None) -> list[np.ndarray]:
    """The entries of each line's prefix, of ordered words; an entry's bit maps are of its word and the line's words after it."""
    n = np.diff(begin)
    at, line = runs(begin[:-1], begin[:-1] + n + (-n * percent // 100) + 1)  # n - ceil(n * percent / 100) + 1
    if words_of is not None:
        ok = maybe(words_of.value, w[at].view(np.int64))
        at, line = at[ok], line[ok]
        ok = maybe(met_of.value, incidence(w[at].view(np.int64), k1[line]))
        at, line = at[ok], line[ok]
    bits = []
    for i in range(maps):
        up_to = np.zeros(len(w) + 1, U)
        np.bitwise_xor.accumulate(np.where((w >> U(6)) % U(maps) == U(i), U(1) << (w & U(63)), U(0)), out=up_to[1:])
        bits.append((up_to[begin[line + 1]] ^ up_to[at]).view(np.int64))
    return [w[at].view(np.int64), k1[line], doc[line], n[line].astype(np.int32), (at - begin[line]).astype(np.int32), number[line].astype(np.int32), *bits]


def prefix_rows(docs: DataFrame, min_words: int, percent: int, rank, buckets: int) -> DataFrame:
    """(bucket, payload): the entries of each line's prefix, with one bit map."""

    def run(batches):
        seen: dict = {}
        add, flush = packer(buckets)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            for lo, _, data, off in slices(batch.column("text")):
                h, a, b, row, number = lines(data, off, min_words)
                k1 = one_half(h, a, b)
                doc = ids[row + lo]
                new = earlier(seen, k1, doc, number)
                if new.any():
                    yield from add(entries(*ordered(h, a[new], b[new], rank.value), k1[new], doc[new], number[new], percent, 1))
        yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, "bucket long, payload binary")


def prefix_rows_again(full: DataFrame, percent: int, rank, buckets: int, words_of, met_of) -> DataFrame:
    """As ``prefix_rows``, of lines by their sets, with ``WIDE`` bit maps; ``words_of`` and ``met_of``: filters on the words, and on
    words with lines."""

    def run(batches):
        add, flush = packer(buckets)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                b = batch.slice(lo, 4096)
                sets = b.column("words")
                off = sets.offsets.to_numpy()
                h = sets.values.to_numpy().view(U)
                k1, doc, number = (b.column(c).to_numpy() for c in ("k1", "doc_id", "line"))
                yield from add(entries(*ordered(h, off[:-1], off[1:], rank.value), k1, doc, number, percent, WIDE, words_of, met_of))
        yield from flush()

    return full.select("k1", "doc_id", "line", "words").mapInArrow(run, "bucket long, payload binary")


def incidence(word: np.ndarray, k1: np.ndarray) -> np.ndarray:
    """A key of a line under a word."""
    return mix64(word.view(U) * U(0x9E3779B97F4A7C15) + k1.view(U)).view(np.int64)


def partners(group: np.ndarray, n: np.ndarray, p: np.ndarray, maps: list[np.ndarray], percent: int, side=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(one, other, likeness): pairs of entries of a group that pass all filters, some at a time. A pair is needed only under the first word
    that its lines share, where the overlap is no more than the words of either from there on. So the sizes of an entry's larger
    partners end where its own words don't suffice. ``side``: (0 or 1 for each entry) pairs only across the two."""
    side = np.zeros(len(n), np.int64) if side is None else side + 2
    key = ((group << 1 | side & 1) << 32) | n
    order = np.argsort(key)
    key, n, left, maps, side = key[order], n[order], (n - p)[order], [m[order] for m in maps], side[order]
    most = np.maximum(left * (100 + percent) // percent - n, 0)
    across = np.where(side > 1, key ^ (1 << 32), key) - n
    # of two of one size, the first is one, the second other
    start = np.where(side > 1, np.searchsorted(key, across + n + (side & 1)), np.arange(1, len(n) + 1))
    count = np.maximum(np.searchsorted(key, across + most, "right") - start, 0)
    ends = np.cumsum(count)
    a = 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - count[a] + CHUNK, "right")))
        many = count[a:b]
        i = np.repeat(np.arange(a, b), many)
        j = np.arange(len(i)) + np.repeat(start[a:b] - (ends[a:b] - many - ends[a] + count[a]), many)
        a = b
        total = n[i] + n[j]
        need = -(-total * percent // (100 + percent))
        ok = left[j] >= need
        i, j, total, need = i[ok], j[ok], total[ok], need[ok]
        rest = left[i] + left[j]
        spare = rest - 2 * need
        for m in maps:
            differ = np.bitwise_count((m[i] ^ m[j]).view(U)).astype(np.int64)
            ok = differ <= spare
            i, j, total, rest, spare = i[ok], j[ok], total[ok], rest[ok] - differ[ok], spare[ok] - differ[ok]
        yield order[i], order[j], rest / total


def likeliest(later: np.ndarray, earlier: np.ndarray, like: np.ndarray):
    """Of pairs, the likeliest for each later one (the earliest of equals), and whether it has more."""
    order = np.lexsort((-earlier, like, later))
    later, earlier, like = later[order], earlier[order], like[order]
    last = np.flatnonzero(np.append(later[1:] != later[:-1], True)) if len(later) else later
    return later[last], earlier[last], like[last], np.diff(np.append(-1, last)) > 1


def linked(group: np.ndarray, k: np.ndarray, n: np.ndarray, p: np.ndarray, maps: list[np.ndarray], percent: int, every_one: bool, probes=None, side=None):
    """(later, earlier, likeness, more, which entries met another) of entries that come in order within their groups: the likeliest partner of
    each entry, or ``every_one``; of the lines in ``probes`` only. ``side``: see ``partners``."""
    probe = None if probes is None else maybe(probes.value, k)
    met, several = np.zeros(len(k), bool), np.zeros(len(k), bool)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for x, y, s in partners(group, n.astype(np.int64), p.astype(np.int64), maps, percent, side):
        x, y = np.maximum(x, y), np.minimum(x, y)
        if probe is not None:
            x, y, s = x[probe[x]], y[probe[x]], s[probe[x]]
        met[x], met[y] = True, True
        if not every_one:
            x, y, s, more = likeliest(x, y, s)
            several[x[more]] = True
        found.append((x, y, s))
    x, y, s = (np.concatenate(z) for z in zip(*found, strict=True))
    if every_one:
        return x, y, s, np.zeros(len(x), bool), met
    x, y, s, more = likeliest(x, y, s)
    return x, y, s, more | several[x], met


def whole_groups(cols: list[np.ndarray], percent: int, every_one: bool, probes=None):
    """(word, later k1, earlier k1, likeness, more) of entries sorted by (word, doc_id, line, k1), each line once a word:
    the likeliest partner of each line in each group, or ``every_one``; of the lines in ``probes`` only. And (word, k1) of the
    lines that met another."""
    w, k, _, n, p, _, *maps = cols
    group = np.cumsum(np.append(False, w[1:] != w[:-1])) if len(w) else np.empty(0, np.int64)
    x, y, s, more, met = linked(group, k, n, p, maps, percent, every_one, probes)
    return [w[x], k[x], k[y], s, more], (w[met], k[met])


def in_order(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Entries of words that have two or more, sorted by word and place, each line once a word, at its first place."""
    order = np.argsort(cols[0])
    w = cols[0][order]
    new = np.append(True, w[1:] != w[:-1])
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    order, group = order[several], group[several]
    w, k, doc, n, p, line, *_ = cols = [c[order] for c in cols]
    if not len(w):
        return cols
    ids, row = np.unique(doc, return_inverse=True)
    widths = [int(x).bit_length() for x in (group[-1], len(ids), line.max())]
    if sum(widths) < 64:
        order = np.argsort((group.astype(U) << U(widths[1] + widths[2])) | (row.astype(U) << U(widths[2])) | line.astype(U), kind="stable")
        order = order if not _tied(group[order], row[order], line[order]) else np.lexsort((k, line, row, group))
    else:
        order = np.lexsort((k, line, row, group))
    cols, group = [c[order] for c in cols], group[order]
    both = mix64(cols[1].view(U) + group.astype(U) * U(0x9E3779B97F4A7C15))
    every = np.sort(both)
    if (every[1:] == every[:-1]).any():
        first = np.sort(np.unique(both, return_index=True)[1])
        cols = [c[first] for c in cols]
    return cols


def _tied(*cols: np.ndarray) -> bool:
    return bool(np.logical_and.reduce([c[1:] == c[:-1] for c in cols]).any())


MET = ["word", "a", "b", "more", "likeness", "payload"]


def grouped(rows: DataFrame, percent: int, maps: int = 1, every_one: bool = False, probes=None) -> DataFrame:
    """(word, later a, earlier b, more, likeness) of each word's group, and (word, a) alone for lines that are only
    somebody's partners; the entries of words with more than ``HOT``
    come out packed instead (payload), for ``dealt``. A task holds no more than the entries of words that aren't hot."""

    def hot_rows(cols):
        for lo in range(0, len(cols[0]), 1 << 16):
            part = packed([c[lo : lo + (1 << 16)] for c in cols])
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.float64())), pa.array([part], pa.binary())], MET)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        size, hot = 0, np.empty(0, np.int64)

        def fold():
            cols = [np.concatenate(x) for x in zip(*held, strict=True)]
            word, n = np.unique(cols[0], return_counts=True)
            over = np.union1d(hot, word[n > HOT])
            return cols, over, np.isin(cols[0], over)

        for batch in batches:
            for x in batch.column("payload"):
                held.append(unpacked(x.as_py(), maps))
                size += len(held[-1][0])
                if size > LIMIT:
                    cols, hot, full = fold()
                    if full.any():
                        yield from hot_rows([c[full] for c in cols])
                    held = [[c[~full] for c in cols]]
                    size = len(held[0][0])
        cols, hot, full = fold()
        if full.any():
            yield from hot_rows([c[full] for c in cols])
        if full.all():
            return
        pairs, (w, k) = whole_groups(in_order([c[~full] for c in cols]), percent, every_one, probes)
        if len(pairs[0]):
            alone = ~np.isin(incidence(w, k), incidence(pairs[0], pairs[1])) & (not every_one)
            n = int(alone.sum())
            x, a, b, like, more = (pa.array(x) for x in pairs)
            yield pa.RecordBatch.from_arrays([x, a, b, more, like, pa.nulls(len(x), pa.binary())], MET)
            yield pa.RecordBatch.from_arrays([pa.array(w[alone]), pa.array(k[alone]), *(pa.nulls(n, t) for t in (pa.int64(), pa.bool_(), pa.float64(), pa.binary()))], MET)

    return rows.groupBy("bucket").applyInArrow(run, "word long, a long, b long, more boolean, likeness double, payload binary")


def dealt(hot: DataFrame, percent: int, wide: int = 1, every_one: bool = False, probes=None) -> DataFrame:
    """(word, a, b, more, likeness) of words too common for a task: their entries are dealt by hash to blocks, and each pair
    of blocks is a task."""

    def run(key, t):
        k, doc, n, p, line, own = (t.column(c).to_numpy().astype(np.int64) for c in ("k1", "doc_id", "n", "place", "line", "own"))
        order = np.lexsort((k, line, doc))
        k, n, p, own = k[order], n[order], p[order], own[order]
        maps = [t.column(f"m{i}").to_numpy()[order] for i in range(wide)]
        side = None if key[1].as_py() == key[2].as_py() else (own == key[2].as_py()).astype(np.int64)
        x, y, s, _, met = linked(np.zeros(len(k), np.int64), k, n, p, maps, percent, every_one, probes, side)
        met = np.setdiff1d(k[met], k[x])
        w, none = np.full(len(x) + len(met), key[0].as_py()), pa.nulls(len(met), pa.int64())
        # other pairs of blocks can hold more
        return pa.table({"word": w, "a": np.append(k[x], met), "b": pa.chunked_array([pa.array(k[y]), none]), "more": np.ones(len(w), bool), "likeness": np.append(s, np.zeros(len(met)))})

    def loose(batches):
        for batch in batches:
            for x in batch.column("payload"):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in unpacked(x.as_py(), wide)], [c for c, _ in columns(wide)])

    hot = hot.select("payload").mapInArrow(loose, ", ".join(f"{c} {'long' if t is np.int64 else 'int'}" for c, t in columns(wide)))
    first = F.row_number().over(Window.partitionBy("word", "k1").orderBy("doc_id", "line"))
    one = hot.withColumn("_n", first).filter("_n = 1").drop("_n")
    many = one.groupBy("word").agg(F.ceil(F.count(F.lit(1)) / (4 * BLOCK)).alias("blocks"))
    one = one.join(many, "word").withColumn("own", F.pmod(F.xxhash64("k1"), "blocks"))
    one = one.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    one = one.select("word", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", *[c for c, _ in columns(wide)[1:]])
    return one.groupBy("word", "b1", "b2").applyInArrow(run, "word long, a long, b long, more boolean, likeness double")


def line_sets(docs: DataFrame, min_words: int, members: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, line, words) of the lines that ``members`` (column a) names, each once and at its first place; a few others
    may be among them."""
    bits = id_filter(members, "a")

    def run(batches):
        seen: dict = {}
        for batch in batches:
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            for lo, _, data, off in slices(batch.column("text")):
                h, a, b, row, number = lines(data, off, min_words)
                k1 = one_half(h, a, b)
                at = np.flatnonzero(maybe(bits.value, k1))
                at = at[earlier(seen, k1[at], ids[row[at] + lo], number[at])]
                if len(at):
                    of, line = runs(a[at], b[at])
                    w, begin = distinct(h[of], line, len(at))
                    s = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(w.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(k1[at]), pa.array(other_half(h, a[at], b[at])), pa.array(ids[row[at] + lo]), pa.array(number[at]), s], ["k1", "k2", "doc_id", "line", "words"])

    each = docs.select("doc_id", "text").mapInArrow(run, "k1 long, k2 long, doc_id long, line long, words array<long>")
    return each.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "line", "words")).alias("m")).select("k1", "k2", "m.*")


def verified(pairs: DataFrame, full: DataFrame, percent: int, most: int, few: int = 50_000) -> DataFrame:
    """(a, a2, other: the place of b) of the pairs, ``most`` at most, whose words are similar enough. If they are ``few``, their lines are picked out by a
    broadcast (some megabytes) before any set is shuffled."""
    if most <= few:
        full = full.join(F.broadcast(pairs.select(F.explode(F.array("a", "b")).alias("k1")).distinct()), "k1", "left_semi")
    one = full.select(F.col("k1").alias("a"), F.col("k2").alias("a2"), F.col("words").alias("sa"))
    two = full.select(F.col("k1").alias("b"), F.struct("doc_id", "line", "k1").alias("other"), F.col("words").alias("sb"))
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(common * 100 >= (F.size("sa") + F.size("sb") - common) * percent).select("a", "a2", "other")


def later_lines(docs: DataFrame, percent: int = 80, min_words: int = 1) -> DataFrame:
    """(doc_id, th, line) of the lines to remove."""
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    first_pass = materialize(line_rows(docs, min_words))
    all_lines = first_pass.filter("slice is null").select("doc_id", "th", "line", "k1", "k2")
    rank, n_words = gathered(first_pass)
    buckets = max(64, n_words // 500_000)

    links, rest, tried, met, full = None, None, None, None, None
    for maps, every_one in ((1, False), (WIDE, False), (WIDE, True)):
        if rest is None:
            probes, prefixes = None, prefix_rows(docs, min_words, percent, rank, buckets)
        else:
            probes = id_filter(rest, "a")
            prefixes = prefix_rows_again(full, percent, rank, buckets, id_filter(met.join(rest, "a", "left_semi"), "word"), id_filter(met, "word", "a", key=incidence))
        out = materialize(grouped(prefixes, percent, maps, every_one, probes))
        common = materialize(dealt(out.filter("payload is not null"), percent, maps, every_one, probes))
        met = out.filter("payload is null").select("word", "a", "b", "more", "likeness").union(common)
        if full is None:
            # the text is read for the last time: all lines that met another, as sets
            full = materialize(line_sets(docs, min_words, met.select("a")))
        pairs = met.filter("b is not null")
        if every_one:
            near = pairs.select("a", "b", F.lit(False).alias("more")).distinct()
        else:
            near = pairs.groupBy("a").agg(F.max_by("b", F.struct("likeness", F.bitwise_not("b"))).alias("b"), (F.max("more") | (F.max("b") != F.min("b"))).alias("more"))
        near = near if tried is None else near.join(rest, "a", "left_semi")
        near = materialize(near)
        fresh_pairs = near.select("a", "b") if tried is None else near.select("a", "b").join(tried, ["a", "b"], "left_anti")
        now = verified(fresh_pairs, full, percent, near.count())
        links = materialize(now if links is None else links.union(now))
        rest = materialize(near.filter("more").select("a").join(links.select("a"), "a", "left_anti"))
        tried = near.select("a", "b") if tried is None else materialize(tried.union(near.select("a", "b")))
        if rest.isEmpty():
            break
    # two lines of equal k1 but not k2 stay two: k2 is checked here
    there = links.groupBy(F.col("a").alias("k1"), F.col("a2").alias("k2")).agg(F.min("other").alias("other"))
    place = F.struct("doc_id", "line", "th")
    firsts = all_lines.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    best = firsts.join(there, ["k1", "k2"], "left").filter("n > 1 or other is not null").select("k1", "k2", "first", "other")
    known = F.struct(F.coalesce("doc_id", F.lit(NO_ID)), "line", "k1")
    return all_lines.join(best, ["k1", "k2"]).filter((place > F.col("first")) | F.coalesce(known > F.col("other"), F.lit(False))).select("doc_id", "th", "line")


def dedup(docs: DataFrame, percent: int = 80, min_words: int = 1) -> DataFrame:
    """All columns of ``docs``, ``text`` without the lines that go, and last the numbers of these (an array of longs)."""
    gone = later_lines(docs, percent, min_words).groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_h")).agg(F.sort_array(F.collect_set("line")).alias("_gone"))
    rows, names = sheltered(docs, "doc_id", "text")
    rows = rows.withColumn("_th", text_hash())
    # a row's numbers are few, so they go into a hash table of each task and the texts needn't be sorted
    rows = rows.join(gone.hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & F.col("_th").eqNullSafe(F.col("_h")), "left")
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i.cast("long"))), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(rest)
    removed = F.coalesce("_gone", F.array().cast("array<long>"))
    return rows.select(*[text if c == "text" else F.col(n) for c, n in zip(docs.columns, names, strict=True)], removed).toDF(*docs.columns, "line_removed")
