"""MinHash near-deduplication by a multi-index Hamming join.

A document's set holds its distinct word shingles. Its signature has ``K`` min-wise hashes of ``BITS``
bits. The signature is cut into chunks so that, by the pigeonhole principle, two signatures that differ in at most
``RADIUS`` places differ in at most one place of some chunk; the allowed errors are enumerated by leaving out each place
of each chunk in turn, and what remains is a key. So all pairs under the signature-distance threshold share
a key. (Sets with similarity 0.8 differ in 12.8 of 64 places on average; above 25 in 2 of 10,000 cases.)

Equal sets are folded first. In each key's group every member is paired with the one that shares most keys with others
(an original rather than one of its copies), pairs are confirmed on full sets, and links merge into components. In groups
that still hold more than one component, the members outside of the largest one are compared with all others, block by
block, by prints of ``PRINT`` min-wise hashes (a pair with similarity 0.8 falls below ``LEAST`` of them in 3 of 100,000
cases), and what passes is confirmed on full sets too. So no link is given up, and a group whose members are already linked
isn't paired out.

Null or empty texts have an empty set and link with nothing; rows without an id never name a component (one whose rows all
lack it has none) and count as one document if their texts are equal; rows that share an id count as one document; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessellar.llm.common import U, materialize, sheltered, shingles, slices, small_batches, text_hash, word_hashes
from tessellar.llm.filters import id_filter, maybe

K, BITS, RADIUS = 64, 16, 25
CHUNKS = np.array_split(np.arange(K), (RADIUS + 1 + 1) // 2)
#: stand-ins of rows without an id, told apart by their texts, lie above this
NO_ID = (1 << 63) - 1 - (1 << 40)
BLOCK = 2048
#: hashes of the longer print (8 bits each), and how many must agree for a pair of 80 percent
PRINT, LEAST = 512, 374
_A = (np.random.default_rng(9).integers(1, 1 << 32, PRINT, np.uint64) | U(1)).astype(np.uint32)[:, None]
_B = np.random.default_rng(10).integers(0, 1 << 32, PRINT, np.uint64).astype(np.uint32)[:, None]


def sets(texts: pa.Array, k: int):
    """The sorted distinct shingles of each text, in order."""
    for _, _, data, off in slices(texts):
        h, first = word_hashes(data, off)
        g, begin = shingles(h, first, k)
        for i in range(len(off) - 1):
            yield np.unique(g[begin[i] : begin[i + 1]])


def signature(s: np.ndarray, k: int = K) -> bytes:
    low = np.full((k, 1), 0xFFFFFFFF, np.uint32)
    x = (s >> U(32)).astype(np.uint32)[None, :]
    for a in range(0, x.shape[1], 1 << 14):
        np.minimum(low, (x[:, a : a + (1 << 14)] * _A[:k] + _B[:k]).min(axis=1, keepdims=True), out=low)
    v = low[:, 0]
    v = (v ^ (v >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (v >> np.uint32(32 - BITS)).astype(np.uint16)


def key_rows(sig: np.ndarray) -> np.ndarray:
    """Keys of signatures (rows): each chunk with each of its places left out."""
    out = []
    wide = sig.astype(U) + U(1)
    for c, at in enumerate(CHUNKS):
        for gone in at:
            h = np.full(len(sig), c * K + gone, U)
            for j in at:
                if j != gone:
                    h = (h ^ wide[:, j]) * U(0x9E3779B97F4A7C15)
                    h ^= h >> U(29)
            out.append(h * U(0xBF58476D1CE4E5B9))
    return np.stack(out, axis=1)


def own_id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID + 1) + F.pmod(F.coalesce(text_hash(), F.lit(0)), F.lit((1 << 40) - 1)))


def described(docs: DataFrame, k: int) -> DataFrame:
    """id, th, n, 128 bits of the set, and the signature of each row."""

    def run(batches):
        for b in batches:
            n, h1, h2, sig = [], [], [], []
            for s in sets(b.column("text"), k):
                n.append(len(s))
                h1.append(int((s * U(0xD6E8FEB86659FD93)).sum(dtype=U).view(np.int64)))
                h2.append(int(((s ^ (s >> U(31))) * U(0xA0761D6478BD642F)).sum(dtype=U).view(np.int64)))
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(sig, pa.binary())], ["id", "th", "n", "h1", "h2", "sig"])

    return docs.mapInArrow(run, "id long, th long, n long, h1 long, h2 long, sig binary")


def keyed(reps: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(-1, K)
            keys = key_rows(sig)
            rid = np.repeat(b.column("rid").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(rid)], ["key", "rid"])

    return reps.select("rid", "sig").mapInArrow(run, "key long, rid long")


def confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough."""
    left, right = (full.select(F.col("rid").alias(x), F.col("s").alias(f"s{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b")
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    both = both.filter(small * 100 >= large * percent).withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.filter(F.col("common") * 100 >= (F.size("sa") + F.size("sb") - F.col("common")) * percent).select("a", "b")


def full_sets(docs: DataFrame, k: int, members: DataFrame) -> DataFrame:
    """(rid, s, print) of the documents that ``members`` (column rid) names; a few others may be among them."""
    bits = id_filter(members, "rid")

    def run(batches):
        for b in batches:
            ids = b.column("id").to_numpy()
            hit = np.flatnonzero(maybe(bits.value, ids))
            if len(hit):
                for lo in range(0, len(hit), 256):
                    some = hit[lo : lo + 256]
                    s = list(sets(b.column("text").take(pa.array(some)), k))
                    prints = [(signature(x, PRINT) >> np.uint16(8)).astype(np.uint8).tobytes() for x in s]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array([x.view(np.int64) for x in s], pa.list_(pa.int64())), pa.array(prints, pa.binary())], ["rid", "s", "print"])

    return docs.mapInArrow(run, "rid long, s array<long>, print binary")


def merged(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(rid, label) of all nodes of edges (a, b): the smallest node reachable. Min-label rounds with a
    jump to the label's label; each round is written to the shared folder."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    now = both.select(F.col("a").alias("rid")).distinct().withColumn("label", F.col("rid"))
    if labels is not None:
        now = now.select("rid").union(labels.select("rid")).distinct().join(labels, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
        both = materialize(both.union(labels.filter("rid <> label").select("rid", "label")).union(labels.filter("rid <> label").select("label", "rid")))
    now = materialize(now)
    while True:
        near = both.join(now.select(F.col("rid").alias("b"), F.col("label").alias("l")), "b").groupBy(F.col("a").alias("rid")).agg(F.min("l").alias("l"))
        step = now.join(near, "rid", "left").select("rid", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        up = step.select(F.col("rid").alias("label"), F.col("label").alias("up"))
        step = materialize(step.join(up, "label", "left").select("rid", "old", F.least("label", "up").alias("label")))
        now = step.select("rid", "label")
        if step.filter("old <> label").isEmpty():
            return now


def across(rest: DataFrame, least: int) -> DataFrame:
    """Pairs of different labels that agree in ``least`` hashes, of rows (key, rid, label, sig, print). A key's members
    outside of its largest label are dealt to blocks, and so are all its members; each task compares one block of
    either kind. A pair comes out under the first key that it shares."""

    def run(key, t):
        out = t.column("outer").to_numpy()
        rid, label, main = (t.column(c).to_numpy() for c in ("rid", "label", "main"))
        prints = np.frombuffer(b"".join(t.column("print").to_pylist()), np.uint8).reshape(-1, PRINT)
        keys = key_rows(np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(-1, K)).view(np.int64)
        inner, found = np.flatnonzero(~out), [(np.empty(0, np.int64),) * 2]
        for i in np.flatnonzero(out):
            at = inner[(label[inner] != label[i]) & ((label[inner] == main[i]) | (rid[inner] > rid[i]))]
            at = at[(prints[at] == prints[i]).sum(axis=1) >= least]
            if len(at):
                first = (keys[at] == keys[i]).argmax(axis=1)
                at = at[keys[i][first] == key[0].as_py()]
                found.append((np.minimum(rid[i], rid[at]), np.maximum(rid[i], rid[at])))
        return pa.table({"a": np.concatenate([x for x, _ in found]), "b": np.concatenate([x for _, x in found])})

    by_label = rest.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    size = by_label.groupBy("key").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("main"), F.sum("n").alias("n"), F.max("n").alias("most"))
    size = size.select("key", "main", F.ceil(F.col("n") / BLOCK).alias("inners"), F.ceil((F.col("n") - F.col("most")) / BLOCK).alias("outers"))
    dealt = rest.join(size, "key").withColumns({"at": F.xxhash64("rid"), "zero": F.lit(0).cast("long")})
    columns = ["key", "ob", "ib", "outer", "rid", "label", "main", "sig", "print"]
    inner = dealt.withColumns({"ib": F.pmod("at", "inners"), "ob": F.explode(F.sequence("zero", F.col("outers") - 1)), "outer": F.lit(False)})
    outer = dealt.filter("label <> main").withColumns({"ob": F.pmod("at", "outers"), "ib": F.explode(F.sequence("zero", F.col("inners") - 1)), "outer": F.lit(True)})
    return inner.select(*columns).union(outer.select(*columns)).groupBy("key", "ob", "ib").applyInArrow(run, "a long, b long").distinct()


def grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """id, th (the text's hash), n and component for each row of ``docs`` (doc_id, text); see ``own_id`` for ids."""
    docs = small_batches(docs).select(own_id().alias("id"), text_hash().alias("th"), "text")
    rows = materialize(described(docs, words))
    reps = rows.filter("n > 0").groupBy("h1", "h2").agg(F.min(F.struct("id", "sig")).alias("m")).select("h1", "h2", F.col("m.id").alias("rid"), F.col("m.sig").alias("sig"))
    reps = materialize(reps)
    keys = keyed(reps)
    many = keys.groupBy("key").agg(F.min("rid").alias("low"), F.max("rid").alias("high"), F.count(F.lit(1)).alias("n")).filter("low < high").select("key", "n")
    shared = materialize(keys.join(many, "key"))
    known = shared.groupBy("rid").agg(F.sum("n").alias("known"))
    centre = shared.join(known, "rid").groupBy("key").agg(F.max_by("rid", F.struct("known", -F.col("rid"))).alias("centre"))
    shared = materialize(shared.join(centre, "key").select("key", "rid", "centre"))
    star = shared.filter("rid <> centre").select(F.least("centre", "rid").alias("a"), F.greatest("centre", "rid").alias("b")).distinct()
    full = materialize(full_sets(docs, words, shared.select("rid")).dropDuplicates())
    links = materialize(confirm(star, full, percent))
    # sets of rows that share an id are one document's
    label = merged(links)
    named = shared.join(label, "rid", "left").select("key", "rid", F.coalesce("label", "rid").alias("label"))
    open_keys = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    rest = named.join(open_keys, "key").join(reps.select("rid", "sig"), "rid").join(full.select("rid", "print"), "rid")
    more = materialize(confirm(across(rest, LEAST * percent // 80), full, percent))
    if not more.isEmpty():
        label = merged(more, label)
    sets_of = reps.select("h1", "h2", "rid").join(label, "rid", "left").select("h1", "h2", F.coalesce("label", "rid").alias("component"))
    out = rows.select("id", "th", "n", "h1", "h2").join(sets_of, ["h1", "h2"], "left")
    return out.select("id", "th", "n", F.coalesce("component", "id").alias("component"))


def components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text)."""
    known = lambda c: F.when(F.col(c) <= NO_ID, F.col(c))
    return grouped(docs, words, percent).select(known("id").alias("doc_id"), F.col("n").alias("n_shingles"), known("component").alias("component_id"), (F.col("component") == F.col("id")).alias("kept"))


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest id of their component, with all their columns; of equal rows one."""
    gone = grouped(docs, words, percent).filter("component <> id").select(F.col("id").alias("_gone"), F.col("th").alias("_text")).distinct()
    rows, names = sheltered(docs, "doc_id", "text")
    rows = rows.join(gone, (own_id() == F.col("_gone")) & (text_hash() == F.col("_text")), "left_anti")
    again = F.row_number().over(Window.partitionBy("doc_id", text_hash()).orderBy("doc_id"))
    return rows.withColumn("_again", again).filter("_again = 1").select(*names).toDF(*docs.columns)
