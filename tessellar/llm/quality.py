"""Quality rules with risk-controlled thresholds. DataFrame only.

Each rule is a statistic of the text, high for poor texts. On labelled rows that no other step has
learnt from, cutoffs of a fixed grid are tested from the mildest to the strictest: with ``n`` good
rows of a stratum (the language), ``k`` of them above the cutoff, the exact binomial tail
``P(Bin(n, risk / rules) <= k)`` is the p-value of "the rule rejects more than its share of ``risk`` of the good rows". A
cutoff holds while this and all milder ones have p-values of at most ``delta / (rules * strata)``:
fixed-sequence testing within a rule, Bonferroni across rules and strata. So with probability
``1 - delta`` the rules together reject no more than ``risk`` of any stratum's good documents. A stratum without enough
labels gets no cutoff for the rule and keeps its documents.

Calibration counts all labelled rows. Null or empty texts have no words and fail the base rule; a null
language is a stratum of its own; labels that are null, or repeated for an id, count as the ids' lowest label
that isn't null; repeated documents each get a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.llm.common import WORD, materialize

SYMBOLS = "#*$%&|<>"
#: rule -> statistic over the columns of ``statistics``
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "exclaims": "n_exclaims / greatest(n_words, 1)",
    "long_words": "word_chars / greatest(n_words, 1) / 40",
}
GRID = [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.16, 0.13, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.015, 0.01]


def without(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def repeated_words(w: Column) -> Column:
    """Words in 3-word windows that are found twice or more in the same text. Windows are compared by a
    64-bit hash; only texts with a repeat sort theirs."""
    n = F.size(w)
    keys = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(n >= 4, keys)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of each text."""
    t = docs.select("doc_id", F.col("lang").alias("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    t = t.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0))
    t = t.withColumn("keys", repeated_words(F.col("w")))
    again = F.size("keys") > F.size(F.array_distinct("keys"))
    pairs = F.when(again, F.array_sort(F.transform("keys", lambda k, i: F.struct(k.alias("k"), i.alias("i")))))
    t = t.select(
        "doc_id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        without(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.char_length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        without(F.col("text"), "!?").cast("long").alias("n_exclaims"),
        pairs.alias("pairs"),
    )
    same = lambda x, i: (F.get("pairs", i - 1)["k"] == x["k"]) | (F.get("pairs", i + 1)["k"] == x["k"])
    t = t.withColumn("at", F.array_sort(F.transform(F.filter("pairs", lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"])))
    # a window covers 3 words, or as many as there are before the next one begins
    covered = F.aggregate(F.transform("at", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("at", j + 1) - i, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    return t.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("pairs", "at")


def tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), for k <= n * p; 1 above that, where no cutoff can pass."""
    log_term = F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), F.lit(0.0), lambda a, i: a + F.when(i <= k, F.log((n - i + 1) / i)).otherwise(0.0)) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    step = lambda a, i: F.struct((a["t"] * i / (n - i + 1) * (1 - p) / p).alias("t"), (a["s"] + a["t"] * i / (n - i + 1) * (1 - p) / p).alias("s"))
    ratio = F.aggregate(F.sequence(F.greatest(k, F.lit(1)), F.lit(1)), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")), step, lambda a: a["s"])
    return F.when(k > n * p, 1.0).when(k == 0, F.exp(n * F.log(F.lit(1 - p)))).otherwise(F.exp(log_term) * ratio)


def cutoffs(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat: int = 50, risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """lang, rule, cutoff, n_good, n_rejected, p_value: what ``judge`` holds documents to."""
    return thresholds(based(docs, min_words, max_repeat), labels, risk, delta)


def based(docs: DataFrame, min_words: int, max_repeat: int) -> DataFrame:
    """The statistics and base_failed, written once for all that reads them."""
    return materialize(statistics(docs).withColumn("base_failed", F.expr(f"n_words < {min_words} or 100 * n_repeat_words > {max_repeat} * n_words")))


def thresholds(stats: DataFrame, labels: DataFrame, risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """lang, rule, cutoff, n_good, n_rejected, p_value: the strictest cutoff that holds for each rule, from a written table of statistics."""
    y = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = stats.join(y.filter("quality = 1").select("doc_id"), "doc_id").filter("not base_failed")
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.expr(x).cast("double").alias("v")) for r, x in RULES.items()]))
    grid = F.array(*[F.lit(g) for g in GRID])
    v = good.select("lang", values.alias("x")).select("lang", "x.rule", *[F.when(F.col("x.v") > g, 1).otherwise(0).alias(f"g{i}") for i, g in enumerate(GRID)])
    v = v.groupBy("lang", "rule").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f"g{i}") for i in range(len(GRID))]).alias("ks"))
    strata = good.select("lang").distinct().agg(F.count(F.lit(1)).alias("strata"))
    tested = v.crossJoin(F.broadcast(strata)).select("lang", "rule", "n", "strata", F.posexplode(F.arrays_zip(F.col("ks").alias("k"), grid.alias("g"))).alias("step", "z"))
    tested = tested.select("lang", "rule", "n", "step", F.col("z.k").alias("k"), F.col("z.g").alias("cutoff"), (F.lit(delta) / len(RULES) / F.col("strata")).alias("level"))
    tested = tested.withColumn("p_value", tail(F.col("n"), F.col("k"), risk / len(RULES)))
    failed = tested.filter("p_value > level").groupBy("lang", "rule").agg(F.min("step").alias("stop"))
    held = tested.join(failed.select(F.col("lang").alias("l2"), F.col("rule").alias("r2"), "stop"), F.col("lang").eqNullSafe(F.col("l2")) & (F.col("rule") == F.col("r2")), "left").filter("stop is null or step < stop")
    best = F.max_by(F.struct("cutoff", "n", "k", "p_value"), "step")
    return held.groupBy("lang", "rule").agg(best.alias("b")).select("lang", "rule", "b.cutoff", F.col("b.n").alias("n_good"), F.col("b.k").alias("n_rejected"), "b.p_value")


def judge(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat: int = 50, risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """The statistics of each document, base_failed, kept, and ``rejected_by``: the rules it breaks."""
    stats = based(docs, min_words, max_repeat)
    cut = thresholds(stats, labels, risk, delta).groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts")).withColumnRenamed("lang", "stratum")
    # a row for each language at most
    out = stats.join(cut, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    broken = F.array_compact(F.array(*[F.when(F.expr(x).cast("double") > F.col("cuts")[r], F.lit(r)) for r, x in RULES.items()]))
    return out.withColumn("rejected_by", F.coalesce(broken, F.array().cast("array<string>"))).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("stratum", "cuts")
