"""Language-model scoring with a hashed maximum-entropy model and a class-factored softmax.

``P(word | history) = P(class | history) * P(word | class)``. Classes are bins of nearly equal mass over hashed words in order of
frequency, so the commonest words stand nearly alone. ``P(class | history)`` is a softmax over the weights of hashed features: the
word before, the two before, and the one before that (a skip). ``P(word | class)`` has the words' training counts less a
discount; what the discount leaves is the probability that a word of the class is none of the training words.

Training: every task runs gradient steps over all of its training tokens, from the same start; weights are averaged by how
often each task met each feature, for ``rounds`` rounds. Counts are exact: documents are taken in chunks, each chunk's distinct
words meet their counts in a shuffle by word and come back by chunk, so no task or driver holds the vocabulary.
Scoring goes over a chunk's texts and its words' counts in batches.

A token is a lower-cased word, and each text ends in one end token. Null and empty texts have the end token only; rows
without an id are in the training part; repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.llm.common import U, materialize, mix64, slices, small_batches, sum_slices, word_hashes

BUCKETS, CLASSES, ROWS, FEATURES = 1 << 17, 32, 1 << 14, 3
DISCOUNT = 0.6
END, BEGIN = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
SLICES = 16
BATCH = 16_384


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with an end after each text, and the first token of each text (the count at the end)."""
    h, first = word_hashes(data, off)
    begin = first + np.arange(len(first))
    out = np.full(begin[-1], END, U)
    out[np.arange(len(h)) + np.repeat(np.arange(len(off) - 1), np.diff(first))] = h
    return out, begin


def features(t: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Rows of the weight tables for each token, (tokens, FEATURES)."""
    place = np.arange(len(t)) - np.repeat(begin[:-1], np.diff(begin))
    back = []
    for k in (1, 2):
        x = np.full(len(t), BEGIN, U)
        x[k:] = np.where(place[k:] >= k, t[:-k], BEGIN)
        back.append(x)
    one, two = back
    both = mix64(one * U(0x9E3779B97F4A7C15) + two)
    return np.stack([one >> U(50), both >> U(50), two >> U(50)], axis=1).astype(np.int32) & (ROWS - 1)


@dataclass
class Model:
    weights: np.ndarray  # (FEATURES, ROWS, CLASSES)
    bias: np.ndarray
    of_bucket: np.ndarray  # class of each bucket
    mass: np.ndarray  # training tokens of each class
    known: np.ndarray  # training words of each class
    tokens: int
    words: int

    def logits(self, f: np.ndarray) -> np.ndarray:
        z = self.bias + self.weights[0][f[:, 0]]
        for i in range(1, FEATURES):
            z += self.weights[i][f[:, i]]
        return z

    def log10(self, t: np.ndarray, f: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 P of each token, given its feature rows and its training count."""
        cls = self.of_bucket[(t & U(BUCKETS - 1)).astype(np.int64)]
        out = np.empty(len(t))
        for a in range(0, len(t), BATCH):
            z = self.logits(f[a : a + BATCH])
            top = z.max(axis=1)
            own = z[np.arange(len(z)), cls[a : a + BATCH]]
            out[a : a + BATCH] = own - top - np.log(np.exp(z - top[:, None]).sum(axis=1))
        rest = np.maximum(DISCOUNT * self.known, 0.5) / np.maximum(self.mass, 1)
        word = np.where(c > 0, (c - DISCOUNT) / np.maximum(self.mass, 1)[cls], rest[cls])
        return out / np.log(10) + np.log10(word)


def steps(model: Model, t: np.ndarray, f: np.ndarray, rate: float, met: np.ndarray, power: np.ndarray) -> None:
    """Gradient steps over the tokens, in place; ``met`` counts each feature row, ``power`` sums its squared steps."""
    cls = model.of_bucket[(t & U(BUCKETS - 1)).astype(np.int64)]
    for a in range(0, len(t), BATCH):
        part = f[a : a + BATCH]
        z = model.logits(part)
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(len(z)), cls[a : a + BATCH]] -= 1
        for i in range(FEATURES):
            order = np.argsort(part[:, i].astype(np.uint16), kind="stable")
            row = part[order, i]
            start = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            g = np.add.reduceat(z[order], start, axis=0)
            at = row[start]
            met[i, at] += np.diff(np.append(start, len(row)))
            power[i, at] += (g * g).mean(axis=1)
            model.weights[i][at] -= rate * g / np.sqrt(power[i, at] + 1.0)[:, None]


def vocabulary(docs: DataFrame) -> DataFrame:
    """(chunk, token, n): the distinct tokens of each chunk with their training counts, of rows (chunk, train, text)."""

    def run(batches):
        held: list[tuple] = []
        size = 0

        def fold():
            chunk, t, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((t, chunk))
            chunk, t, n = chunk[order], t[order], n[order]
            new = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (chunk[1:] != chunk[:-1]))))
            return chunk[new], t[new], np.add.reduceat(n, new)

        def out(x):
            for a in range(0, len(x[0]), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(y[a : a + (1 << 18)].view(np.int64)) for y in x], ["chunk", "token", "n"])

        for batch in batches:
            chunk, train = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "train"))
            for lo, hi, data, off in slices(batch.column("text")):
                t, begin = tokens(data, off)
                reps = np.diff(begin)
                held.append((np.repeat(chunk[lo:hi], reps), t, np.repeat(train[lo:hi], reps).astype(np.int64)))
                held[-1] = fold_one(*held[-1])
                size += len(held[-1][0])
                if size > 4_000_000:
                    done = fold()
                    if len(done[0]) > 2_000_000:
                        yield from out(done)
                        held, size = [], 0
                    else:
                        held, size = [done], len(done[0])
        if held:
            yield from out(fold())

    return docs.mapInArrow(run, "chunk long, token long, n long")


def fold_one(chunk: np.ndarray, t: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((t, chunk)) if chunk.min() != chunk.max() else np.argsort(t)
    chunk, t, n = chunk[order], t[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (chunk[1:] != chunk[:-1]))))
    return chunk[new], t[new], np.add.reduceat(n, new)


def train(docs: DataFrame, model: Model, rate: float = 0.5) -> Model:
    """One round over rows (text): each task steps through its rows, and the tasks' weights are averaged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shape = (FEATURES, ROWS, CLASSES)

    def run(batches):
        m = shared.value
        m = Model(m.weights.copy(), m.bias, m.of_bucket, m.mass, m.known, m.tokens, m.words)
        met, power = np.zeros(shape[:2], np.float32), np.zeros(shape[:2], np.float32)
        for batch in batches:
            for _, _, data, off in slices(batch.column("text")):
                t, begin = tokens(data, off)
                if len(t):
                    steps(m, t, features(t, begin), rate, met, power)
        if met.any():
            moved = (m.weights - shared.value.weights) * met[:, :, None]
            whole = np.concatenate((moved.ravel(), met.ravel())).astype(np.float32)
            parts = [x.tobytes() for x in np.split(whole, SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([int(met.sum()) % 64] * SLICES, pa.int32()), pa.array(parts, pa.binary())], ["slice", "part", "payload"])

    rows = sum_slices(docs.select("text").mapInArrow(run, "slice int, part int, payload binary"), "f4").collect()
    if not rows:
        return model
    whole = np.concatenate([np.frombuffer(r["payload"], np.float32) for r in sorted(rows, key=lambda r: r["slice"])])
    moved, met = whole[: np.prod(shape)].reshape(shape), whole[np.prod(shape) :].reshape(shape[:2])
    return Model(model.weights + moved / np.maximum(met, 1)[:, :, None], model.bias, model.of_bucket, model.mass, model.known, model.tokens, model.words)


def start(counted: DataFrame) -> Model:
    """Classes and their sizes from rows (token, n, c, lead): a table of a fixed number of buckets comes to the driver."""
    got = counted.groupBy(F.col("token").bitwiseAND(F.lit(BUCKETS - 1)).alias("bucket")).agg(F.sum("n").alias("mass"), F.sum((F.col("lead") & (F.col("c") > 0)).cast("long")).alias("known")).toArrow()
    mass, known = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = got.column("bucket").to_numpy()
    mass[at], known[at] = got.column("mass").to_numpy(), got.column("known").to_numpy()
    order = np.argsort(-mass, kind="stable")
    done = np.cumsum(mass[order]) - mass[order] / 2
    of = np.zeros(BUCKETS, np.int64)
    of[order] = np.minimum(CLASSES - 1, done * CLASSES // max(1, mass.sum()))
    by = lambda x: np.bincount(of, x, minlength=CLASSES)
    bias = np.log((by(mass) + 1) / (mass.sum() + CLASSES)).astype(np.float32)
    return Model(np.zeros((FEATURES, ROWS, CLASSES), np.float32), bias, of, by(mass), by(known), int(mass.sum()), int(known.sum()))


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
HELD = "coalesce(pmod(crc32(cast(cast(doc_id as string) as binary)), 7) = 2, false)"


def chunk_of(file: Column, row: Column, size: Column, most: int = 26) -> Column:
    """A chunk of at most ``2 ** most`` bytes of text (or one longer row): rows of a file that lie together, 4,096 of those of up to 16 KB,
    and half as many for each doubling of the size, by classes of size."""
    kind = F.ceil(F.log2(F.greatest(F.coalesce(size, F.lit(0)), F.lit(1 << most - 12))))
    return F.xxhash64(file, kind, F.floor(row / F.pow(F.lit(2.0), F.lit(most) - kind)))


def score(docs: DataFrame, chunk: Column | None = None, rounds: int = 1, rate: float = 0.5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    ``chunk``: a long that deals rows to chunks of some megabytes, the same in every scan; rows of a chunk had better lie
    together. By default the id's hash deals them.
    """
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *([] if chunk is None else [chunk.alias("chunk")]))
    if chunk is None:
        size = rows.agg(F.sum(F.octet_length("text")).alias("s")).first()["s"] or 0
        rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // (12 << 20) + 1)))
    rows = rows.withColumn("held_out", F.expr(HELD))
    words = vocabulary(rows.select("chunk", (~F.col("held_out")).alias("train"), "text"))
    words = words.groupBy("chunk", "token").agg(F.sum("n").alias("n")) if chunk is None else words
    counted = words.select("*", F.expr("sum(n) over (partition by token)").alias("c"), F.expr("row_number() over (partition by token order by chunk, n) = 1").alias("lead"))
    counted = materialize(counted)
    model = start(counted)
    for r in range(rounds):
        model = train(rows.filter("not held_out"), model, rate / (r + 1))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts, counts):
        m = shared.value
        texts, counts = texts.combine_chunks(), counts.combine_chunks()
        token, c = counts.column("token").to_numpy().view(U), counts.column("c").to_numpy()
        order = np.argsort(token)
        token, c = token[order], c[order]
        n, known, base, own = [], [], [], []
        for _, _, data, off in slices(texts.column("text")):
            t, begin = tokens(data, off)
            k = c[np.searchsorted(token, t)]
            add = lambda x: np.add.reduceat(x, begin[:-1]).tolist()  # noqa: E731, B023
            n += np.diff(begin).tolist()
            known += add((k > 0).astype(np.int64))
            base += add(np.log10((k + 1) / (m.tokens + m.words + 1)))
            own += add(m.log10(t, features(t, begin), k))
        full = pa.array([m.tokens] * len(n), pa.int64())
        return pa.table([texts.column("doc_id"), texts.column("held_out"), pa.array(n, pa.int64()), pa.array(known, pa.int64()), full, pa.array(base, pa.float64()), pa.array(own, pa.float64())], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    counts = counted.select("chunk", "token", "c")
    return rows.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(run, RESULT)
