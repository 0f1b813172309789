"""Suffix-array dedup of long repeated passages with a run-length Burrows-Wheeler index.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts elsewhere, in the same text or another.

Sharding: equal strings of ``LENGTH`` bytes have the same least ``GRAM``-byte gram at the same place (their anchor), so all
matches of a string lie at one anchor. Texts are reduced to their anchors; those that occur once are dropped, which loses no
match, and each other occurrence brings its context, all bytes that a string through the anchor can cover. Equal contexts
are folded, and a context that occurs twice goes as a whole.

Index: the distinct contexts of a shard's anchors are aligned at the anchor, and their suffixes are sorted column by column from
the right, by the byte before and the order so far: a positional Burrows-Wheeler transform, whose column is kept as runs of equal
bytes. Inside a run the match with the neighbour grows by one byte; only where a run ends is it looked up, as
the least match between two run ends. So matching statistics (the longest match of each suffix with another context at
the same place) stream through the columns, and strings whose statistic reaches ``LENGTH`` are marked. Aligning keeps
a text's overlapping contexts from matching themselves, which a plain transform over them would.

An anchor with more than ``limit`` distinct contexts is split by hash into several shards. Each gives the 128-bit hashes of
its strings, once for those that match within it, and they are counted over all of that anchor's shards: a string without
a match in its own shard goes if another shard has it, matched there or not.

Null and empty texts, and texts shorter than ``LENGTH``, lose nothing. Rows that share an id are told apart by the hash
of the text; wholly equal rows of long enough texts repeat each other and lose all. What is kept can end inside a
character, so it is binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.llm.common import U, fresh, materialize, mix64, prefix, slices, small_batches, span_hash, text_hash
from tessellar.llm.filters import id_filter, maybe

LENGTH, GRAM = 200, 32
#: grams in a string, and so bytes that a context has at most before its anchor
SPAN = LENGTH - GRAM
COLUMNS = SPAN + LENGTH
#: ranges to remove; strings of a split anchor without a match in their shard, and those with one
MARKED, OPEN, MET = 0, 1, 2


def sliding(x: np.ndarray, w: int, op: np.ufunc, fill) -> np.ndarray:
    """op over x[i : i + w] for each i, in linear time."""
    n = len(x)
    m = -(-n // w) * w
    p = np.full(m, fill, x.dtype)
    p[:n] = x
    p = p.reshape(-1, w)
    left = op.accumulate(p, axis=1).ravel()
    right = op.accumulate(p[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(right[: n - w + 1], left[w - 1 : n])


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, gram hash, row, prefix sums) of the anchors of all strings of ``LENGTH`` bytes."""
    p = prefix(data)
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none.view(U), none, p
    at = np.arange(len(data) - GRAM + 1)
    g = span_hash(p, at, at + GRAM)
    low = sliding(g, SPAN + 1, np.minimum, U(0xFFFFFFFFFFFFFFFF))
    ends = np.repeat(off[1:], np.diff(off))
    low[ends[: len(low)] - np.arange(len(low)) < LENGTH] = 0  # strings that would leave their row
    top = sliding(np.concatenate((np.zeros(SPAN, U), low, np.zeros(SPAN, U))), SPAN + 1, np.maximum, U(0))
    place = np.flatnonzero((top[: len(g)] == g) & (g > 0))
    return place, g[place], np.searchsorted(off, place, "right") - 1, p


def contexts(place, g, row, p, off):
    """(begin, end, hash) of the anchors' contexts."""
    a, b = np.maximum(off[row], place - SPAN), np.minimum(off[row + 1], place + LENGTH)
    return a, b, mix64(span_hash(p, a, b) + (place - a).astype(U) * U(0x9E3779B97F4A7C15) + g)


def seen_anchors(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for _, _, data, off in slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(anchors(data, off)[1].view(np.int64))], ["a"])

    return docs.select("text").mapInArrow(run, "a long")


def occurrences(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """(a, c, doc_id, th, place, before, after) of anchors that may be repeated."""
    bits = id_filter(repeated, "a")

    def run(batches):
        for batch in batches:
            for lo, _, data, off in slices(batch.column("text")):
                place, g, row, p = anchors(data, off)
                some = np.flatnonzero(maybe(bits.value, g.view(np.int64)))
                place, g, row = place[some], g[some], row[some]
                a, b, c = contexts(place, g, row, p, off)
                at = pa.array(row + lo)
                cols = [pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), batch.column("doc_id").take(at), batch.column("th").take(at), *(pa.array(x.astype(np.int32)) for x in (place - off[row], place - a, b - place))]
                yield pa.RecordBatch.from_arrays(cols, ["a", "c", "doc_id", "th", "place", "before", "after"])

    return docs.mapInArrow(run, "a long, c long, doc_id long, th long, place int, before int, after int")


def context_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(a, c, before, context) of the contexts that ``wanted`` (column c) names; a few others may be among them."""
    bits = id_filter(wanted, "c")

    def run(batches):
        seen: set = set()
        for batch in batches:
            for _, _, data, off in slices(batch.column("text")):
                place, g, row, p = anchors(data, off)
                a, b, c = contexts(place, g, row, p, off)
                some = np.flatnonzero(maybe(bits.value, c.view(np.int64)))
                some = some[fresh(seen, c[some])]
                raw = data.tobytes()
                text = [raw[x:y] for x, y in zip(a[some].tolist(), b[some].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(g[some].view(np.int64)), pa.array(c[some].view(np.int64)), pa.array((place - a)[some].astype(np.int32)), pa.array(text, pa.binary())], ["a", "c", "before", "context"])

    return docs.select("text").mapInArrow(run, "a long, c long, before int, context binary")


def least_between(d: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of d[a..b] for each pair, a <= b, by doubling."""
    size = b - a + 1
    level = np.frexp(size)[1] - 1
    out = np.empty(len(a), d.dtype)
    table, step = d, 0
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            table = np.minimum(table[:-step], table[step:]) if step < len(table) else table
        step = 1 << k
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[a[at]], table[b[at] - step + 1])
    return out


def statistics(matrix: np.ndarray, group: np.ndarray):
    """Yields (column, statistic of each row) from the last column to the first: how many columns from there on
    a row shares with another of its group at least. ``matrix``: bytes, 0 where a context has none."""
    order = np.argsort(group, kind="stable")
    d = np.zeros(len(order), np.int32)
    key = group.astype(np.uint16)
    for col in range(matrix.shape[1] - 1, -1, -1):
        ch = matrix[order, col]
        step = np.argsort(ch, kind="stable")
        step = step[np.argsort(key[order[step]], kind="stable")]
        order, ch = order[step], ch[step]
        head = np.zeros(len(step), bool)
        grown = np.zeros(len(step), np.int32)
        same = (ch[1:] == ch[:-1]) & (group[order[1:]] == group[order[:-1]]) & (ch[1:] != 0)
        inside = same & (step[1:] == step[:-1] + 1)
        grown[1:][inside] = d[step[1:][inside]] + 1
        # between two runs of the same byte lies the least match of all that the column had in between
        head[1:] = same & ~inside
        at = np.flatnonzero(head)
        if len(at):
            grown[at] = least_between(d, step[at - 1] + 1, step[at]) + 1
        d = grown
        best = d.copy()
        best[:-1] = np.maximum(best[:-1], d[1:])
        out = np.empty(len(d), np.int32)
        out[order] = best
        yield col, out


def aligned(context: list[bytes], before: np.ndarray) -> np.ndarray:
    matrix = np.zeros((len(context), COLUMNS), np.uint8)
    flat = np.frombuffer(b"".join(context), np.uint8)
    size = np.fromiter(map(len, context), np.int64, len(context))
    at = np.repeat(np.arange(len(context)) * COLUMNS + SPAN - before - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(len(flat))
    # 0xFF is in no UTF-8 text, and so can stand for the byte 0
    matrix.ravel()[at] = np.where(flat == 0, np.uint8(255), flat)
    return matrix


def intervals(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of marked columns."""
    edge = np.diff(np.pad(marked.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def marks(shards: DataFrame) -> DataFrame:
    """(a, c, from, to, h1, h2, kind) of byte ranges relative to the anchor, of rows (shard, part, split, a, c, before, context)."""

    def run(_, t):
        t = t.combine_chunks()
        a, c, before, split = (t.column(x).to_numpy() for x in ("a", "c", "before", "split"))
        _, one = np.unique(np.stack((a, c)), axis=1, return_index=True)
        a, c, before = a[one], c[one], before[one].astype(np.int64)
        text = t.column("context").take(pa.array(one)).to_pylist()
        matrix, group = aligned(text, before), np.unique(a, return_inverse=True)[1]
        hit = np.zeros((len(a), SPAN + 1), bool)
        for col, stat in statistics(matrix, group):
            if col <= SPAN:
                hit[:, col] = stat >= LENGTH
        row, first, last = intervals(hit)
        out = [a[row], c[row], first - SPAN, last - SPAN + LENGTH, np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)]
        if split[0]:
            size = np.fromiter(map(len, text), np.int64, len(text))
            start = np.arange(SPAN + 1)
            valid = (start >= (SPAN - before)[:, None]) & (start + LENGTH <= (SPAN - before + size)[:, None])
            r, s = np.nonzero(valid)
            p1 = np.array([prefix(x) for x in matrix]) if len(matrix) else np.zeros((0, COLUMNS + 1), U)
            p2 = np.array([prefix(x ^ np.uint8(0x55)) for x in matrix]) if len(matrix) else p1
            h = [mix64((p[r, s + LENGTH] - p[r, s]) * U(k)).view(np.int64) for p, k in ((p1, 1), (p2, 3))]
            # strings that match here are marked by their ranges; others need to know of them, once
            met = np.flatnonzero(hit[r, s])
            met = met[np.lexsort((h[1][met], h[0][met], s[met]))]
            new = np.ones(len(met), bool)
            new[1:] = (s[met[1:]] != s[met[:-1]]) | (h[0][met[1:]] != h[0][met[:-1]]) | (h[1][met[1:]] != h[1][met[:-1]])
            at = np.concatenate((np.flatnonzero(~hit[r, s]), met[new]))
            r, s, h = r[at], s[at], [x[at] for x in h]
            out = [np.concatenate(x) for x in zip(out, (a[r], c[r], s - SPAN, s - SPAN + LENGTH, *h), strict=True)]
            kind = np.concatenate((np.full(len(row), MARKED), np.where(hit[r, s], MET, OPEN)))
        else:
            kind = np.full(len(row), MARKED)
        names = ["a", "c", "from", "to", "h1", "h2", "kind"]
        return pa.table([*(pa.array(x.astype(np.int64)) for x in out), pa.array(kind, pa.int32())], names)

    return shards.groupBy("shard", "part").applyInArrow(run, "a long, c long, from long, to long, h1 long, h2 long, kind int")


def spans(docs: DataFrame, limit: int = 65_536, per_shard: int = 4096) -> DataFrame:
    """(doc_id, th, spans) of rows (doc_id, th, text): byte ranges to remove, which can overlap."""
    repeated = seen_anchors(docs).groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    found = materialize(occurrences(docs, repeated))
    folded = materialize(found.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n")))
    per = folded.groupBy("a").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    active = materialize(folded.join(per, "a").select("a", "c", "n", "kinds"))
    shards = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / per_shard)).alias("shards")
    shards = active.agg(shards).first()["shards"]
    rows = context_rows(docs, active.select("c")).join(per, "a")
    rows = rows.withColumns({"split": F.col("kinds") > limit, "part": F.when(F.col("kinds") > limit, F.pmod(F.xxhash64("c"), F.ceil(F.col("kinds") * 2 / limit))).otherwise(F.lit(0).cast("long"))})
    rows = rows.withColumn("shard", F.when(F.col("split"), F.col("a")).otherwise(F.pmod(F.xxhash64("a"), F.lit(shards))))
    got = materialize(marks(rows.select("shard", "part", "split", "a", "c", "before", "context")))
    left = got.filter(F.col("kind") == OPEN)
    again = got.filter(F.col("kind") != MARKED).groupBy("a", "from", "h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    got = got.filter(F.col("kind") == MARKED).select("a", "c", "from", "to").union(left.join(again, ["a", "from", "h1", "h2"], "left_semi").select("a", "c", "from", "to"))
    part = F.struct(F.col("from").alias("from"), F.col("to").alias("to"))
    got = got.groupBy("a", "c").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    whole = folded.filter("n > 1").select("a", "c", F.lit(True).alias("whole"))
    both = found.join(whole.join(got, ["a", "c"], "full"), ["a", "c"])
    all_of = F.array(F.struct((F.col("place") - F.col("before")).cast("long").alias("start"), (F.col("place") + F.col("after")).cast("long").alias("end")))
    some = F.transform("parts", lambda x: F.struct((F.col("place") + x["from"]).alias("start"), (F.col("place") + x["to"]).alias("end")))
    both = both.select("doc_id", "th", F.explode(F.when(F.col("whole") & (F.col("before") + F.col("after") >= LENGTH), all_of).otherwise(some)).alias("x"))
    return both.groupBy("doc_id", "th").agg(F.collect_set("x").alias("spans"))


def union(parts: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((x["start"], x["end"]) for x in parts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def dedup(docs: DataFrame, limit: int = 65_536, per_shard: int = 4096) -> DataFrame:
    """doc_id, n_bytes, removed (byte ranges) and kept (bytes) of each row."""
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    gone = spans(rows, limit, per_shard).select(F.col("doc_id").alias("_d"), F.col("th").alias("_h"), "spans")
    both = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_h")), "left").select("doc_id", "text", "spans")

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                b = batch.slice(lo, 512)
                size, removed, kept = [], [], []
                for text, parts in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                    raw = text.encode()
                    cut = union(parts or [])
                    edges = [0, *(x for c in cut for x in c), len(raw)]
                    size.append(len(raw))
                    removed.append([{"start": x, "end": y} for x, y in cut])
                    kept.append(b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    return both.mapInArrow(run, "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
