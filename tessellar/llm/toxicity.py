"""Toxicity by maximum-scoring segments over token log-odds.

Learning: training rows are counted by class for each word that they hold (lower-case, without punctuation around it), and for each word's first ``STEMS`` bytes, where a
word counts once a fold and class, so that one frequent word doesn't speak for all that begin like it. A word's
log-odds compare its toxic rate with its other rate, both under a Dirichlet prior whose means follow the longest of its
beginnings whose rates differ for sure, less a drift, so that a run of ordinary words loses score; a word that repeats the one before adds none. Words with positive scores open and
extend segments; the linear scan of Ruzzo and Tompa gives all maximal ones of a text.

Calibration is cross-fitted: each training row is scanned by a model of the other folds, so it looks like an unseen one. For
scores in ordinary text the decay ``lam`` solves ``E[exp(lam * score)] = 1``, and the best
segment of ``n`` words follows an extreme-value law, ``P(S >= s) = 1 - exp(-C n exp(-lam s))``; ``C`` is fitted to the
training rows of class 0. A document's significant segments are those with an expected count of at most ``E_MAX``; its evidence
is the negative log of the chance of its best segments (at most ``TOP``) together (Karlin and Altschul's sum statistic), and a logistic
curve, fitted to the training rows' evidence, turns it into the score.

Training uses at most about ``max_labels`` labelled ids (by the hash of the id), a text of each, and of equal or nearly equal texts about one
(those that share the least of their shingles' hashes, three times over). Null or empty texts
have no segment and the score of no evidence; labels that are null are ignored and repeated ones count as the ids'
highest; rows without an id are scored and not learnt from; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import lgamma
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.llm.common import U, materialize, mix64, prefix, sheltered, shingles, slices, small_batches, span_hash, word_hashes, words

STEMS = (3, 4, 5, 6)
FOLDS = 4
#: words that the prior counts for
KAPPA = 2.0
#: standard deviations, and log-odds, from which a difference of rates counts
SURE = 4.0
LEAST = 1.5
DRIFT = 0.2
E_MAX = 0.05
TOP = 64
CORE = np.array([b > 127 or chr(b).isalnum() for b in range(256)])
MASK = U((1 << 22) - 1)
SEGMENT = "struct<first_word:int,last_word:int,start_byte:int,end_byte:int,score:double,e_value:double>"


class Table:
    """Values of 64-bit keys; most keys that aren't there are ruled out by one look at a bit map."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], [v[order] for v in values]
        self.maybe = np.zeros(int(MASK) + 1, bool)
        self.maybe[keys & MASK] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``h`` are there, and their places."""
        at = np.flatnonzero(self.maybe[h & MASK])
        if not len(self.keys):
            return at[:0], at[:0]
        to = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[to] == h[at]
        return at[ok], to[ok]


def none() -> Table:
    return Table(np.empty(0, U), np.empty(0), np.empty(0))


@dataclass
class Model:
    """known: rows of class 0 and 1 that hold a word; stems: log-odds of words' beginnings; ratio: rows of class 1 over those of 0."""

    known: Table = field(default_factory=none)
    stems: Table = field(default_factory=none)
    ratio: float = 1.0
    lam: float = 1.0
    c: float = 1.0
    a: float = 1.0
    b: float = 0.0

    def odds(self, word: np.ndarray, stem: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(word))
        for h in stem:
            at, to = self.stems.find(h)
            out[at] = self.stems.values[0][to]
        at, to = self.known.find(word)
        odds, sd = posterior(*(v[to] for v in self.known.values), self.ratio, out[at])
        # a difference within what chance gives counts as none
        out[at] = np.where((out[at] != 0) | (differs(odds, sd)), odds, 0.0)
        return out - DRIFT

    def evidence(self, segs: list[float], n: int) -> float:
        """-ln of the chance that n ordinary words hold segments as good as the best r of these together,
        for the r that makes it least (the sum statistic of the extreme-value law), less ln r for the choice."""
        x = self.lam * np.sort(np.array(segs))[::-1][:TOP] - np.log(self.c * max(n, 1))
        best = max(0.0, -np.log(max(-np.expm1(-np.exp(min(-x[0], 50))), 1e-300))) if len(x) else 0.0
        total = 0.0
        for r, v in enumerate(x.tolist(), 1):
            if v <= 0:
                break
            total += v
            best = max(best, total - (r - 1) * np.log(total) + lgamma(r + 1) + lgamma(r) - np.log(r))
        return best

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * evidence + self.b, -700, 700)))


def posterior(n0: np.ndarray, n1: np.ndarray, ratio: float, prior) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of counts under a prior with these log-odds, and their standard deviation."""
    lift = np.exp(prior) * ratio
    a1 = KAPPA * lift / (1 + lift)
    a0 = KAPPA - a1
    return np.log((n1 + a1) / (n0 + a0) / ratio), np.sqrt(1 / (n0 + a0) + 1 / (n1 + a1))


def differs(odds: np.ndarray, sd: np.ndarray) -> np.ndarray:
    return np.abs(odds) > np.maximum(LEAST, SURE * sd)


def features(data: np.ndarray, off: np.ndarray):
    """Hashes of words without the ASCII punctuation around them (if that leaves any) and of their beginnings (of shorter words the
    whole again, marked as such)."""
    s, e, first = words(data, off)
    p = prefix(data, True)
    core = np.flatnonzero(CORE[data])
    a, b = np.searchsorted(core, s), np.searchsorted(core, e)
    bare = b > a
    begin, end = s.copy(), e.copy()
    begin[bare], end[bare] = core[a[bare]], core[b[bare] - 1] + 1
    stem = [span_hash(p, begin, np.minimum(end, begin + n)) ^ U(n) for n in STEMS]
    return span_hash(p, begin, end), stem, s, e, first


def sample(docs: DataFrame, labels: DataFrame, training: Column | None, max_labels: int) -> DataFrame:
    """(doc_id, y, fold, text) of at most about ``max_labels`` ids; of equal texts the smallest id, and of nearly equal ones about one."""
    y = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    y = y if training is None else y.filter(training)
    share = min(1.0, max_labels / max(1, y.count()))
    y = y.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    h = F.xxhash64("text").alias("h")
    # of a size that max_labels bounds, as is all that follows
    one = docs.select("doc_id", h).join(F.broadcast(y), "doc_id").groupBy("h").agg(F.min(F.struct("doc_id", "y")).alias("m"))
    one = one.groupBy("m.doc_id").agg(F.first("m.y").alias("y"), F.min("h").alias("h"))
    rows = docs.select("doc_id", h, "text").join(F.broadcast(one), ["doc_id", "h"]).dropDuplicates(["doc_id"])
    rows = materialize(rows.select("doc_id", "y", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold"), "text"))

    def least(batches):
        for b in batches:
            low = [[], [], []]
            for _, _, data, off in slices(b.column("text")):
                g, begin = shingles(*word_hashes(data, off), 5)
                full = np.flatnonzero(np.diff(begin))
                for i, out in enumerate(low):
                    m = np.arange(len(off) - 1, dtype=U)
                    if len(full):
                        m[full] = np.minimum.reduceat(mix64(g * U(2 * i + 1) + U(i)), begin[:-1][full])
                    out += m.tolist()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(np.array(x, U).view(np.int64)) for x in low)], ["doc_id", "m0", "m1", "m2"])

    ids = rows.mapInArrow(least, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, m0 long, m1 long, m2 long")
    for i in range(3):
        ids = ids.groupBy(f"m{i}").agg(F.min_by(F.struct(*ids.columns), "doc_id").alias("r")).select("r.*")
    return materialize(rows.join(F.broadcast(ids.select("doc_id")), "doc_id"))


CELLS = [f"n{c}{f}" for c in (0, 1) for f in range(FOLDS)]
LEVELS = [f"p{n}" for n in STEMS]


def counts(rows: DataFrame) -> DataFrame:
    """(w, p.., n..): each word, its beginnings, and the rows that hold it by class and fold."""

    def folded(held):
        w, cell, *stem = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((cell, w))
        w, cell = w[order], cell[order]
        new = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (cell[1:] != cell[:-1])))
        n = np.diff(np.append(new, len(w)))
        cols = [w[new].view(np.int64), *(x[order][new].view(np.int64) for x in stem), cell[new].astype(np.int32), n.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["w", *LEVELS, "cell", "n"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            cell = b.column("y").to_numpy().astype(bool).astype(np.int64) * FOLDS + b.column("fold").to_numpy()
            for lo, hi, data, off in slices(b.column("text")):
                w, stem, _, _, first = features(data, off)
                row = np.repeat(np.arange(lo, hi), np.diff(first))
                order = np.lexsort((w, row))
                at = order[np.append(True, (w[order][1:] != w[order][:-1]) | (row[order][1:] != row[order][:-1]))] if len(w) else order
                held.append([w[at], cell[row[at]], *(x[at] for x in stem)])
                size += len(at)
                if size > 500_000:
                    yield folded(held)
                    held, size = [], 0
        if size:
            yield folded(held)

    each = rows.select("y", "fold", "text").mapInArrow(run, f"w long, {', '.join(f'{p} long' for p in LEVELS)}, cell int, n int")
    sums = [F.sum(F.when(F.col("cell") == i, F.col("n")).otherwise(0)).alias(c) for i, c in enumerate(CELLS)]
    return materialize(each.groupBy("w").agg(*[F.first(p).alias(p) for p in LEVELS], *sums))


def without(fold: int | None, c: int) -> list[str]:
    """The cells of a class but one fold's."""
    return [f"n{c}{f}" for f in range(FOLDS) if f != fold]


def models(known: DataFrame, size: np.ndarray) -> list[Model]:
    """A model without each fold, and last one of all; ``size``: rows by class and fold."""
    every = [*range(FOLDS), None]
    # a beginning's counts are of words, so they are held against all words' counts
    once = known.select(*LEVELS, *[F.least(c, F.lit(1)).alias(c) for c in CELLS])
    sums = once.agg(*[F.sum(c).alias(c) for c in CELLS]).first()
    types = np.array([[sums[f"n{c}{f}"] or 0 for f in range(FOLDS)] for c in (0, 1)])
    ratios, type_ratios = ({f: max(1, x[1].sum() - (0 if f is None else x[1][f])) / max(1, x[0].sum() - (0 if f is None else x[0][f])) for f in every} for x in (size, types))

    def sure(ratio):
        tests = []
        for f in every:
            a1 = KAPPA * ratio[f] / (1 + ratio[f])
            n0, n1 = (sum((F.col(x) for x in without(f, c)), F.lit(a)) for c, a in ((0, KAPPA - a1), (1, a1)))
            tests.append(F.abs(F.log(n1 / n0 / ratio[f])) > F.greatest(F.lit(LEAST), SURE * F.sqrt(1 / n0 + 1 / n1)))
        return reduce(or_, tests)

    stems = once.select(F.explode(F.array(*LEVELS)).alias("p"), *CELLS).groupBy("p").agg(*[F.sum(c).alias(c) for c in CELLS]).filter(sure(type_ratios)).toArrow()
    key = stems.column("p").to_numpy()

    def under(batches):
        for b in batches:
            own = b.column("own").to_numpy(zero_copy_only=False)
            yield b.filter(pa.array(own | np.isin(np.stack([b.column(p).to_numpy() for p in LEVELS]), key).any(axis=0)))

    names = ["w", *LEVELS, *CELLS]
    some = known.withColumn("own", sure(ratios)).select(*names, "own").mapInArrow(under, f"{', '.join(f'{c} long' for c in names)}, own boolean").toArrow()

    def of(table, f):
        return [np.sum([table.column(x).to_numpy() for x in without(f, c)], axis=0, dtype=float) for c in (0, 1)]

    out = []
    for f in every:
        odds, sd = posterior(*of(stems, f), type_ratios[f], 0.0)
        ok = differs(odds, sd)
        out.append(Model(Table(some.column("w").to_numpy().view(U), *of(some, f)), Table(key.view(U)[ok], odds[ok]), ratios[f]))
    # scores of the words of class 0, each in the rows of one fold under the model without it; all other words score the drift
    word, stem = some.column("w").to_numpy().view(U), [some.column(p).to_numpy().view(U) for p in LEVELS]
    score = [m.odds(word, stem) for m in out]
    weight = [some.column(f"n0{f}").to_numpy().astype(float) for f in range(FOLDS)]
    words_0 = known.agg(F.sum(sum(F.col(c) for c in without(None, 0)))).first()[0] or 0
    rest = max(0.0, words_0 - sum(w.sum() for w in weight))
    # one more word with the highest score, so that a score which class 0 doesn't have is rare rather than impossible
    top = max((x.max() for x in score if len(x)), default=0.0)
    lam = decay(np.concatenate([*score[:FOLDS], [-DRIFT, top]]), np.concatenate([*weight, [rest, 1.0]]))
    for m in out:
        m.lam = lam
    return out


def decay(score: np.ndarray, weight: np.ndarray) -> float:
    """The positive root of E[exp(lam * score)] = 1 over weighted scores, by bisection."""
    p = weight / max(1, weight.sum())
    if not len(score) or score.max() <= 0 or (p * score).sum() >= 0:
        return 1.0
    lo, hi = 1e-4, 50.0 / score.max()
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(mid * score)).sum() < 1 else (lo, mid)
    return lo


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of one text, in linear time. Only words with positive
    scores are visited; what lies between them comes from prefix sums."""
    cum = np.concatenate(([0.0], np.cumsum(score, dtype=float)))
    at = np.flatnonzero(score > 0)
    stack: list[list] = []  # first, last, sum before, sum after, index of the nearest one before with a smaller left sum
    for i in at.tolist():
        new = [i, i, cum[i], cum[i + 1], -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            new[4] = j
            if j < 0 or stack[j][3] >= new[3]:
                stack.append(new)
                break
            new[0], new[2] = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, r - left) for a, b, left, r, _ in stack]


def scan(rows: DataFrame, model: Model, keep: list[str], spans: bool = False) -> DataFrame:
    """``keep``, and n_words, best (score of the best segment), evidence and score of each row under the prefix
    ``tox_``; ``spans``: also the significant passages."""
    shared = small_batches(rows).sparkSession.sparkContext.broadcast(model)
    names = ["tox_n_words", "tox_best", "tox_evidence", "tox_score"]

    def run(batches):
        m = shared.value
        for b in batches:
            n, best, ev, found = [], [], [], []
            for _, _, data, off in slices(b.column("text")):
                for count, segs, s, e in scanned(m, data, off):
                    n.append(count)
                    best.append(max((x for _, _, x in segs), default=0.0))
                    ev.append(m.evidence([x for _, _, x in segs], count) if segs else 0.0)
                    if spans:
                        all_of = ((x, y, z, m.c * count * np.exp(-m.lam * z)) for x, y, z in segs)
                        found.append([{"first_word": x, "last_word": y, "start_byte": int(s[x]), "end_byte": int(e[y]), "score": z, "e_value": float(v)} for x, y, z, v in all_of if v <= E_MAX])
            out = [b.column(c) for c in keep] + [pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(ev, pa.float64()), pa.array(m.score(np.array(ev, float)), pa.float64())]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(found, KIND)] if spans else []), [*keep, *names, *(["tox_passages"] if spans else [])])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(run, f"{ddl}, tox_n_words long, tox_best double, tox_evidence double, tox_score double" + (f", tox_passages array<{SEGMENT}>" if spans else ""))


def scanned(m: Model, data: np.ndarray, off: np.ndarray):
    """For each text: its words, its segments, and where its words start and end in it."""
    word, stem, s, e, first = features(data, off)
    odds = m.odds(word, stem)
    # a word straight after itself adds nothing
    again = np.flatnonzero(word[1:] == word[:-1]) + 1
    odds[again] = np.minimum(odds[again], -DRIFT)
    hits = np.diff(np.concatenate(([0], np.cumsum(odds > 0)))[first])
    for i, h in enumerate(hits.tolist()):
        a, b = first[i], first[i + 1]
        yield int(b - a), segments(odds[a:b]) if h else [], s[a:b] - off[i], e[a:b] - off[i]


KIND = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("start_byte", pa.int32()), ("end_byte", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method, with a slight pull to 0."""
    w, z = np.zeros(2), np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, z.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, training: Column | None = None, max_labels: int = 30_000) -> Model:
    """The model of labelled rows; ``training``: a condition on doc_id that they must meet."""
    rows = sample(small_batches(docs), labels, training, max_labels)
    size = np.zeros((2, FOLDS), np.int64)
    for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y"), "fold").count().collect():
        size[r["y"], r["fold"]] = r["count"]
    if not size.sum(axis=1).all():
        # without both classes, the rate of the labels stands for every text
        return Model(a=0.0, b=float(np.log((size[1].sum() + 0.5) / (size[0].sum() + 0.5))) if size.any() else -5.0)
    *left_out, model = models(counts(rows), size)
    shared = docs.sparkSession.sparkContext.broadcast(left_out)

    def run(batches):
        for b in batches:
            fold, n, segs = b.column("fold").to_numpy(), [], []
            for f in range(FOLDS):
                own = b.filter(pa.array(fold == f))
                for _, _, data, off in slices(own.column("text")):
                    for count, found, _, _ in scanned(shared.value[f], data, off):
                        n.append(count)
                        segs.append(sorted((x for _, _, x in found), reverse=True)[:TOP])
            at = pa.array(np.argsort(fold, kind="stable"))
            yield pa.RecordBatch.from_arrays([b.column("y").take(at).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(segs, pa.list_(pa.float64()))], ["y", "n", "segs"])

    got = rows.select("y", "fold", "text").mapInArrow(run, "y long, n long, segs array<double>").toArrow()
    y, n, segs = got.column("y").to_numpy() > 0, got.column("n").to_numpy(), got.column("segs").to_pylist()
    # the likelihood of class 0's best scores gives C: 1 over the mean of n exp(-lam s)
    null = ~y & (n > 0)
    reach = n[null] * np.exp(-model.lam * np.array([x[0] if x else 0.0 for x in segs])[null])
    model.c = float(np.clip(null.sum() / max(reach.sum(), 1e-9), 1e-6, 1e3)) if null.any() else 1.0
    model.a, model.b = logistic(np.array([model.evidence(x, k) if x else 0.0 for x, k in zip(segs, n.tolist(), strict=True)]), y.astype(float))
    return model


HELD = "pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0"


def score(docs: DataFrame, labels: DataFrame, spans: bool = True) -> DataFrame:
    """doc_id, held_out, n_words, best, evidence, score, predicted and the significant passages."""
    model = fit(docs, labels, F.expr(f"not ({HELD})"))
    out = scan(docs.select("doc_id", "text"), model, ["doc_id"], spans)
    out = out.withColumnsRenamed({c: c.removeprefix("tox_") for c in out.columns})
    return out.withColumn("held_out", F.coalesce(F.expr(HELD), F.lit(False))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the scan doesn't predict to be toxic, with all their columns."""
    rows, names = sheltered(docs, "text")
    return scan(rows, fit(docs, labels), names).filter("tox_score < 0.5").select(*names).toDF(*docs.columns)
