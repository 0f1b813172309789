"""Operators on documents against brute force, held-out rows and their SQL, and on odd inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessellar.llm import common, decontam, linededup, lm, mixing, neardup, quality, queries, runindex, toxicity
from tests.oracle import DATA, check

SF = str(DATA / "sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i // 7}" for i in range(30_000))
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\n\x0b ", "en", None, 6),
    (4, "one", None, "b", 3),
    (5, LONG, "en", "a", len(LONG)),
    (6, LONG, "en", "b", len(LONG)),
    (6, LONG, "en", "b", len(LONG)),
    (None, "no id here but some words to read", "en", "a", 1),
    (7, "tie tie tie tie\ntie tie tie tie tie\ntie tie tie tie tie", "en", "a", 1),
    (8, "été \U0001f600 \x00 nul and space " * 30, "fr", "\U0010ffff", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({"size": F.lit("x"), "score": F.lit(1), "line_removed": F.lit(2), "rid": F.lit(3)})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, 0), (6, 0, 1), (6, 1, 0), (None, 1, 1), (7, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")


def documents():
    import duckdb

    return duckdb.connect().execute(f"select doc_id, text from '{SF}/documents.parquet' order by 1").fetchall()


def tokens(t, n=None):
    w = (t or "").encode().lower().split()
    return w if n is None else [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [b" ".join(w)] if w else []


def test_words_and_shingles():
    texts = ["a b  c", None, "", "  x", "\xa0 y\x1cz", "one two three four five six", "Sp lit"]
    data, off = common.flat(pa.array(texts))
    s, e, first = common.words(data, off)
    raw = data.tobytes()
    for i, t in enumerate(texts):
        assert [raw[a:b] for a, b in zip(s[first[i] : first[i + 1]], e[first[i] : first[i + 1]])] == (t or "").encode().split()
    for whole in (texts, [t for t in texts for _ in range(3)]):
        seen = {}
        for k in (1, 3, 4):
            for _, _, d, o in common.slices(pa.array(whole), 10):
                h, f = common.word_hashes(d, o)
                g, b = common.shingles(h, f, k)
                assert len(g) == b[-1]
        for lo, hi, d, o in common.slices(pa.array(whole), 7):
            h, f = common.word_hashes(d, o)
            g, b = common.shingles(h, f, 3)
            for r in range(hi - lo):
                for x, y in zip(g[b[r] : b[r + 1]].tolist(), tokens(whole[lo + r], 3), strict=True):
                    assert seen.setdefault(y, x) == x
        assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    check(queries.QUERIES[name](spark, SF), queries.ORACLES[name], "sf0.001")


# ---- 1 ----


def test_mixing(spark, odd, none):
    out = mixing.mix(odd).collect()
    assert len(out) == len(ODD) and all(0 <= r.taken <= 2 * r.size for r in out)
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix(odd.repartition(3)).collect()))
    assert mixing.mix(none).count() == 0


def test_mixing_meets_targets_and_quotas(spark):
    rows = [(i, "w " * (50 + i % 90), None if i % 3 == 0 else f"s{i % 7}") for i in range(900)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), shard_tokens=2000).collect()
    by = collections.defaultdict(lambda: [0, 0.0])
    for r in out:
        by[r.source_size][0] += r.taken
        by[r.source_size][1] = r.target
    assert all(abs(t - want) < 64 + 0.01 * want for t, want in by.values())
    assert abs(sum(w for _, w in by.values()) - 1.5 * sum(r.size for r in out)) < 1


def test_apportionment_is_sainte_lague(spark):
    rng = np.random.default_rng(0)
    weights = [float(x) for x in rng.integers(1, 500, 12)]
    df = spark.createDataFrame([(0, i, w, 97, 1000) for i, w in enumerate(weights)], "one int, k int, w double, seats long, most long")
    got = {r.k: r.quota for r in mixing.apportion(df, ["one"], "k", "w", "seats", "most").collect()}
    won = collections.Counter()
    for _ in range(97):
        won[max(range(12), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))] += 1
    assert got == {i: won[i] for i in range(12)}


# ---- 2 ----


def later_lines(rows, least=1, percent=80):
    seen, gone = [], collections.defaultdict(set)
    for d, t in sorted(rows, key=lambda r: r[0]):
        for i, line in enumerate((t or "").split("\n")):
            w = line.encode().lower().split()
            if len(w) < least:
                continue
            s = frozenset(w)
            if any(100 * len(s & o) >= percent * len(s | o) for o in seen):
                gone[d].add(i)
            seen.append(s)
    return gone


def variants():
    rng = np.random.default_rng(1)
    base = [f"v{i}" for i in range(24)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(3):
            w = list(base)
            for j in rng.choice(24, rng.integers(0, 5), replace=False):
                w[j] = f"z{rng.integers(0, 9)}"
            lines.append(" ".join(w))
        rows.append((d, "\n".join([*lines, "the same short", "a line that is shared by all of them here"])))
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_line_dedup(spark, monkeypatch, hot):
    if hot:
        for k, v in (("HOT", 20), ("LIMIT", 200), ("BLOCK", 4)):
            monkeypatch.setattr(linededup, k, v)
    rows = variants()
    out = linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    gone = later_lines(rows)
    for r in out:
        assert r.line_removed == sorted(gone[r.doc_id])
        assert r.text == "\n".join(x for i, x in enumerate(dict(rows)[r.doc_id].split("\n")) if i not in gone[r.doc_id])


def test_line_dedup_documents(spark):
    rows = documents()
    gone = later_lines(rows)
    out = queries.op2_line_dedup(spark, SF).collect()
    assert {r.doc_id: r.line_removed for r in out} == {d: ",".join(map(str, sorted(gone[d]))) for d, _ in rows}


def test_line_dedup_odd(odd, none):
    out = linededup.dedup(odd)
    assert out.columns == [*odd.columns, "line_removed"]
    got = collections.Counter((r[0], r[1] == LONG, tuple(r[-1])) for r in out.collect())
    assert got[5, True, ()] == 1 and got[6, False, (0,)] == 2 and got[7, False, (1, 2)] == 1 and got[None, False, ()] == 1
    assert linededup.dedup(none).count() == 0


def groups(sets, maps, **options):
    """What ``whole_groups`` makes of lines, given as sets of words in order."""
    w = np.concatenate([np.array(sorted(x), np.uint64) for x in sets])
    begin = np.cumsum([0, *map(len, sets)])
    k = np.arange(len(sets))
    return linededup.whole_groups(linededup.in_order(linededup.entries(w, begin, k, k, k, 80, maps)), 80, options.pop("every_one", True), **options)


def similar(x, y):
    return 100 * len(x & y) >= 80 * len(x | y)


def test_line_dedup_needs_a_pair_only_under_its_first_shared_word():
    x, y = set(range(20)), set(range(25))
    assert similar(x, y)
    (w, *_), _ = groups([x, y], 1)
    assert len(w) == 1
    # a word that comes second in the shorter one isn't the first of an overlap of 20
    cols = [np.array(c) for c in ([7, 7], [0, 1], [0, 1], [20, 25], [1, 1], [0, 0], [0, 0])]
    pairs, (met, _) = linededup.whole_groups(cols, 80, True)
    assert not len(pairs[0]) and not len(met)


@pytest.mark.parametrize("maps", [1, 8])
def test_line_dedup_loses_no_pair(monkeypatch, maps):
    monkeypatch.setattr(linededup, "CHUNK", 50)
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 63, 90)
    base = [rng.choice(words, n, replace=False) for n in (3, 5, 12, 25, 60)]
    sets = [set(rng.choice(b, rng.integers(max(1, len(b) * 4 // 5 - 1), len(b) + 1), replace=False).tolist()) | set(rng.choice(words, rng.integers(0, 3)).tolist()) for b in base for _ in range(30)]
    want = {(j, i) for j in range(len(sets)) for i in range(j) if similar(sets[i], sets[j])}
    (_, a, b, _, _), _ = groups(sets, maps)
    assert len(want) > 300 and want <= set(zip(a.tolist(), b.tolist(), strict=True))
    # every line that has a partner has a likeliest one, and is told to have more
    (_, a, _, _, more), (_, met) = groups(sets, maps, every_one=False)
    assert {j for j, _ in want} <= set(a.tolist()) and {x for p in want for x in p} <= set(met.tolist())
    several = {j for j, n in collections.Counter(j for j, _ in want).items() if n > 1}
    assert several <= {j for j, m in zip(a.tolist(), more.tolist(), strict=True) if m} | {j for j, n in collections.Counter(a.tolist()).items() if n > 1}


def test_line_dedup_blocks_of_a_word():
    rng = np.random.default_rng(4)
    n = rng.integers(5, 30, 200)
    p = rng.integers(0, 3, 200)
    maps = [rng.integers(0, 4, 200)]
    one, side = np.zeros(200, np.int64), rng.integers(0, 2, 200)

    def pairs(at, side=None):
        x, y, *_ = linededup.linked(one[at], at, n[at], p[at], [m[at] for m in maps], 80, True, None, side)
        return collections.Counter(zip(at[x].tolist(), at[y].tolist(), strict=True))

    whole = pairs(np.arange(200))
    assert len(whole) > 100 and set(whole.values()) == {1}
    assert whole == pairs(np.flatnonzero(side == 0)) + pairs(np.flatnonzero(side == 1)) + pairs(np.arange(200), side)


def test_line_words_are_those_of_the_other_operators():
    rng = np.random.default_rng(5)
    letters = np.frombuffer("aAbBzZ09@[`{é \n\t\r\x0b\x0c\x00".encode(), np.uint8)
    for t in range(60):
        data = letters[rng.integers(0, len(letters) if t % 3 else 4, 400)]
        off = np.sort([0, 400, *rng.integers(0, 401, 5)])
        s, e, _ = common.words(data, off)
        s2, e2 = linededup.spans(data, off)
        assert s.tolist() == s2.tolist() and e.tolist() == e2.tolist()
        of = dict(zip((data[x:y].tobytes().lower() for x, y in zip(s, e, strict=True)), linededup.hashes(data, s, e).tolist(), strict=True))
        assert len(set(of.values())) == len(of)
        for x, h in of.items():
            alone = np.frombuffer(b" " + x.upper(), np.uint8)
            assert linededup.hashes(alone, np.array([1]), np.array([len(alone)])).tolist() == [h]


# ---- 3 ----


def test_lm_scoring(spark):
    rows = documents()
    t = {d: [*tokens(x), None] for d, x in rows}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in t}
    c = collections.Counter(w for d in t if not held[d] for w in t[d])
    n, v = sum(c.values()), len(c)
    out = queries.op3_lm_scoring(spark, SF).collect()
    assert len(out) == len(rows)
    for r in out:
        own = t[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(c[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
    assert sum(r.score for r in out if r.held_out) > sum(r.base_score for r in out if r.held_out)


def test_lm_is_a_distribution():
    rng = np.random.default_rng(0)
    known, c = np.array([3.0, 5.0]), None
    of = np.zeros(lm.BUCKETS, np.int64)
    of[1::2] = 1
    words = np.array([2, 4, 6, 1, 3, 5, 7, 9], np.uint64)
    c = np.array([5, 3, 2, 9, 4, 3, 2, 2])
    mass = np.array([10.0, 20.0])
    m = lm.Model(rng.normal(size=(lm.FEATURES, lm.ROWS, 2)).astype(np.float32), np.zeros(2, np.float32), of, mass, known, 30, 8)
    f = np.repeat(rng.integers(0, lm.ROWS, (1, lm.FEATURES)), 10, axis=0)
    t, n = np.append(words, [8, 11]).astype(np.uint64), np.append(c, [0, 0])
    assert math.isclose((10 ** m.log10(t, f, n)).sum(), 1, rel_tol=1e-5)


def test_lm_odd(spark, odd, none):
    out = {(r.doc_id, r.n_tokens) for r in lm.score(odd).collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 2), (None, 9)} <= out and lm.score(odd).count() == len(ODD)
    assert lm.score(none).count() == 0


# ---- 4 ----


def test_quality_odd(odd, none, labels):
    out = {(r.doc_id, r.n_words, r.n_dup_lines, r.n_repeat_words, r.kept) for r in quality.judge(odd, labels).collect()}
    assert {(1, 0, 0, 0, False), (2, 0, 0, 0, False), (3, 0, 0, 0, False), (7, 14, 1, 14, False)} <= out
    assert quality.judge(none, labels).count() == 0 and quality.judge(odd, labels.limit(0)).count() == len(ODD)


def test_exact_tail(spark):
    for n, k, p in [(100, 0, 0.05), (500, 3, 0.05), (2000, 19, 0.01), (50, 10, 0.1)]:
        want = 1.0 if k > n * p else sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality.tail(F.lit(n), F.lit(k), p)).first()[0]
        assert math.isclose(got, want, rel_tol=1e-9)


def test_cutoffs_bound_false_rejection(spark):
    rng = np.random.default_rng(3)
    rows = [(i, ("w " * 80) + "#! " * int(rng.exponential(2 if i % 4 else 60)), "en") for i in range(1600)]
    lab = [(i, int(i % 4 != 0)) for i in range(1600)]
    docs, labs = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(lab, "doc_id long, quality int")
    out = quality.judge(docs, labs, risk=0.05, min_words=1, max_repeat=1000).join(labs, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    kept = dict(map(tuple, out))
    assert kept[1] > 0.95 and kept[0] < kept[1] - 0.2


# ---- 5 ----


def removed(rows, length=200):
    raw = [(d, (t or "").encode()) for d, t in rows]
    c = collections.Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        cover = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if c[b[i : i + length]] > 1:
                cover[i : i + length] = True
        out.append((d, len(b), int(cover.sum()), hashlib.sha256(bytes(x for x, y in zip(b, cover) if not y)).hexdigest()))
    return sorted(out)


def repetitive():
    rng = np.random.default_rng(5)
    text = lambda n: "".join(rng.choice(list("abcdefgh é\n"), n))
    shared, other = text(420), text(260)
    rows = [(i, text(rng.integers(0, 300)) + shared[rng.integers(0, 99) :] + text(rng.integers(0, 300))) for i in range(30)]
    rows += [(100 + i, text(150) + other + text(50) + other[:230]) for i in range(3)]
    return rows + [(200, "x" * 700), (201, "ab" * 300), (202, text(199)), (203, ""), (204, None), (205, text(500)), (206, shared[:199])]


@pytest.mark.parametrize("limit", [65_536, 8])
def test_long_repeats(spark, limit):
    rows = repetitive()
    out = runindex.dedup(spark.createDataFrame(rows, "doc_id long, text string"), limit=limit, per_shard=16).collect()
    assert sorted((r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.removed), hashlib.sha256(r.kept).hexdigest()) for r in out) == removed(rows)


def test_statistics_equal_brute_force():
    rng = np.random.default_rng(6)
    m = rng.integers(1, 3, (40, 60)).astype(np.uint8)
    m[rng.random((40, 60)) < 0.02] = 0
    g = rng.integers(0, 3, 40)
    for col, stat in runindex.statistics(m, g):
        for i in range(40):
            best = 0
            for j in range(40):
                if i != j and g[i] == g[j]:
                    n = 0
                    while col + n < 60 and m[i, col + n] == m[j, col + n] != 0:
                        n += 1
                    best = max(best, n)
            assert stat[i] == best


def test_long_repeats_odd(odd, none):
    out = collections.Counter((r.doc_id, len(r.kept)) for r in runindex.dedup(odd).collect())
    assert out[5, 0] == 1 and out[6, 0] == 2 and out[1, 0] == 1 and runindex.dedup(none).count() == 0


# ---- 7 ----


def weighted(a, b):
    a, b = collections.Counter(a), collections.Counter(b)
    both = sum((a & b).values())
    return both / max(1, sum((a | b).values()))


def test_decontamination(spark):
    rng = np.random.default_rng(7)
    word = lambda: f"q{rng.integers(0, 5000)}"
    items = [(i, " ".join(word() for _ in range(rng.integers(15, 60)))) for i in range(30)] + [(90, "only three words"), (91, None), (92, "")]
    docs = []
    for d in range(80):
        w = [word() for _ in range(rng.integers(30, 200))]
        i = int(rng.integers(0, 30))
        own = items[i][1].split()
        if d % 3 == 0:
            if d % 2 and len(own) > 25:
                own[len(own) // 2] = "changed" if d % 4 else own[-1]
            w[10:10] = own
        if d % 9 == 1:
            w[5:5] = items[i][1].split()[: len(own) // 2]
        docs.append((d, " ".join(w)))
    docs.append((99, "Only THREE words"))
    out = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for (d, t), (i, x) in itertools.product(docs, items):
        k = min(5, len(tokens(x)))
        if not k or len(tokens(t)) < len(tokens(x)):
            continue
        a, b = tokens(x, k), tokens(t, k)
        s = max((weighted(a, b[j : j + len(a)]) for j in range(len(b) - len(a) + 1)), default=0) if set(a) & set(b) else 0
        if s >= 0.8:
            want[d, i] = s
    assert len(want) > 20 and out.keys() == want.keys() and all(math.isclose(out[p], want[p]) for p in want)


def test_hamming_blocks_miss_nothing():
    rng = np.random.default_rng(8)
    a = rng.integers(0, 256, (40, decontam.BITS // 8)).astype(np.uint8)
    near = a[rng.integers(0, 40, 400)].copy()
    for row in near:
        for bit in rng.choice(decontam.BITS, rng.integers(0, 110), replace=False):
            row[bit // 8] ^= 1 << (bit % 8)
    w, i = decontam.Lookup(np.arange(40), a).candidates(near, cells=1000)
    d = np.array([[np.unpackbits(x ^ y).sum() for y in a] for x in near])
    assert set(zip(w.tolist(), i.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(d <= decontam.RADIUS))))


def test_decontamination_of_the_table(spark):
    """The query's rows against every window of every document."""
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {}
    for d, t in documents():
        for i, x in items:
            k = min(5, len(tokens(x)))
            a, b = tokens(x, k), tokens(t, k) if k else []
            if k and set(a) & set(b) and len(b) >= 0.8 * len(a):
                s = max(weighted(a, b[j : j + len(a)]) for j in range(max(1, len(b) - len(a) + 1)))
                if s >= 0.8:
                    want[d, i] = s
    out = {(r.doc_id, r.item_id): r.similarity for r in queries.op7_decontamination(spark, SF).collect()}
    assert len(want) >= 3 and out.keys() == want.keys() and all(math.isclose(out[p], want[p]) for p in want)


def test_many_items_of_many_sizes(spark):
    """An index of thousands of items takes memory with their shingles, and finds each of them."""
    import pickle

    rng = np.random.default_rng(12)
    items = [(i, " ".join(f"m{x}" for x in rng.integers(0, 10**6, 8 + i % 60))) for i in range(3000)]
    (ix,) = decontam.indexes(items, 5)
    assert len(pickle.dumps(ix)) < 16 * 2**20
    docs = spark.createDataFrame([(i, f"before it {t} after it") for i, t in items[::50]], "doc_id long, text string")
    out = decontam.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=300_000)
    assert sorted((r.doc_id, r.item_id, r.similarity) for r in out.collect()) == [(i, i, 1.0) for i, _ in items[::50]]


def test_decontamination_odd(spark, odd, none):
    items = spark.createDataFrame([(1, "tie tie tie tie"), (2, LONG[:300]), (None, "x y z")], "item_id long, text string")
    out = decontam.keep_clean(odd, items)
    assert out.columns == odd.columns and {r.doc_id for r in out.collect()} == {1, 2, 3, 4, 8, None}
    assert decontam.keep_clean(none, items).count() == 0 and decontam.keep_clean(odd, items.limit(0)).count() == len(ODD)
    assert decontam.contaminated(odd, items.limit(0)).count() == 0


# ---- 8 ----


def all_segments(s):
    """Maximal scoring segments by their definition: the best one, then the same on either side of it."""
    if not len(s):
        return []
    best = max(((sum(s[i : j + 1]), -(j - i), -i) for i in range(len(s)) for j in range(i, len(s))), default=(0,))
    if best[0] <= 0:
        return []
    i = -best[2]
    j = i - best[1]
    return [*all_segments(s[:i]), (i, j, best[0]), *((a + j + 1, b + j + 1, c) for a, b, c in all_segments(s[j + 1 :]))]


def test_segments():
    rng = np.random.default_rng(9)
    for _ in range(200):
        s = rng.normal(-0.3, 1, rng.integers(0, 25))
        got = toxicity.segments(s)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in all_segments(s.tolist())]


def test_toxicity_held_out(spark):
    sf = str(DATA / "sf0.01")
    out = queries.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    hit = collections.Counter((r.toxic, r.predicted) for r in out)
    assert hit[1, 1] / max(1, hit[1, 0] + hit[1, 1]) > 0.5 and hit[0, 1] <= 0.05 * (hit[0, 0] + hit[0, 1])


def test_toxicity_passages(spark):
    rng = np.random.default_rng(10)
    words = lambda n, bad=(): " ".join("vile" if i in bad else f"c{rng.integers(0, 300)}" for i in range(n))
    rows = [(i, words(60, (20, 21, 23) if i % 5 == 0 else ())) for i in range(400)]
    labs = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    out = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), labs).collect()
    assert all(r.predicted == (r.doc_id % 5 == 0) for r in out)
    assert all(any(p.first_word == 20 and p.last_word == 23 for p in r.passages) for r in out if r.doc_id % 5 == 0)


def test_toxicity_odd(odd, none, labels):
    out = toxicity.score(odd, labels).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(none, labels).count() == 0 and toxicity.score(odd, labels.limit(0)).count() == len(ODD)
    kept = toxicity.keep_clean(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == len(ODD)


# ---- 9 ----


def linked(rows, k, percent=80):
    s = {d: set(tokens(t, k)) for d, t in rows}
    up = {d: d for d in s}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(s), 2):
        if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {d: (len(s[d]), top(d)) for d in s}


@pytest.mark.parametrize("block", [2048, 3])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = np.random.default_rng(11)
    rows = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(int(rng.integers(3, 90)))]
        for _ in range(int(rng.integers(1, 14))):
            w = list(base)
            for j in rng.choice(len(w), min(len(w), int(rng.integers(0, 4))), replace=False):
                w[j] = f"e{rng.integers(0, 9)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(500, ""), (501, None), (502, " ")]
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()}
    assert out == linked(rows, 4)


def test_near_duplicate_documents(spark):
    out = queries.op9_minhash(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == linked(documents(), 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_duplicates_odd(spark, odd, none):
    out = collections.Counter((r.doc_id, r.component_id, r.kept) for r in neardup.components(odd).collect())
    assert out[6, 5, False] == 2 and out[5, 5, True] == 1 and out[1, 1, True] == 1 and out[None, None, True] == 1
    kept = neardup.keep_first(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]
    assert neardup.components(none).count() == 0 and neardup.keep_first(none).count() == 0
