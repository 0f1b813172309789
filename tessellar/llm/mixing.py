"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks. DataFrame only.

Sources get weights in the order of their names and targets by water-filling under a ceiling. A
source's tokens are dealt by hash to shards. In a shard the documents lie in a seeded order on a ring
of tokens that is cut into blocks of equal length. Highest quotients ``weight / (2 s + 1)`` give each
source its blocks, and again each shard its integer quota of them. The quota's blocks are those from a
seeded place of the ring on, round it again where the quota is larger than the ring; since the order
of documents is seeded, that is a seeded choice of blocks, and what a document gives follows from the
place of its tokens alone, without a row for each block.

Null or empty texts have size 0 and give 0; the null source is a source of its own, last in order; rows
repeated, ids included, count as separate rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellar.llm.common import WORD, materialize


def number(text: Column) -> Column:
    """48 bits of a text's MD5 as a whole number."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def apportion(parties: DataFrame, by: list[str], key: str, weight: str, seats: str, ceiling: str) -> DataFrame:
    """Add ``quota``: ``seats`` dealt to each group's parties by highest quotients, none above its ceiling.

    Rounding by a divisor somewhat above and below the fair one brackets each party's seats; only the
    seats in between, about two a party, are ranked by their quotients.
    """
    w = Window.partitionBy(*by)
    share = lambda d: F.floor(F.when(F.col("_all") > 0, F.col(weight) * (F.col(seats) + d * F.col("_n") / 2) / F.col("_all")).otherwise(0.0) + 0.5 - 1e-9)
    p = parties.withColumns({"_all": F.sum(weight).over(w), "_n": F.count(F.lit(1)).over(w)})
    p = p.withColumns({"_lo": F.greatest(F.lit(0), F.least(F.col(ceiling), share(-1))), "_hi": F.least(F.col(ceiling), share(1) + 2)})
    p = p.withColumn("_left", F.col(seats) - F.sum("_lo").over(w))
    s = p.filter("_hi > _lo and _left > 0").select(*by, key, "_left", F.col(weight).alias("_w"), F.explode(F.sequence("_lo", F.col("_hi") - 1)).alias("_s"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy((F.col("_w") / (2 * F.col("_s") + 1)).desc(), key))
    won = s.withColumn("_r", rank).filter("_r <= _left").groupBy(*by, key).agg(F.count(F.lit(1)).alias("_won"))
    return p.join(won, [*by, key], "left").withColumn("quota", F.col("_lo") + F.coalesce("_won", F.lit(0))).drop("_all", "_n", "_lo", "_hi", "_left", "_won")


def targets(sources: DataFrame, weights: tuple[float, ...], scale: float, ceiling: float) -> DataFrame:
    """Add ``target`` to (sk, source_size): shares of ``scale`` times all sizes by weight, in order of
    ``sk``; what is above ``ceiling`` times a source's size goes to the others by weight."""
    everything = Window.partitionBy(F.lit(0))
    order = F.row_number().over(everything.orderBy(F.col("sk").asc_nulls_last()))
    s = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(order - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumns({"cap": F.col("source_size") * F.lit(float(ceiling)), "want": F.sum("source_size").over(everything) * F.lit(float(scale))})
    # filled in the order of cap / weight: those up to the last whose level is not above its own are full
    fill = everything.orderBy(F.col("cap") / F.col("weight"), F.col("sk").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level", (F.col("want") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    s = s.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    s = s.withColumn("level", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "sk", "level"))).over(everything)["level"])
    return s.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("level") * F.col("weight"))).select("sk", "source_size", "target")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    scale: float = 1.5,
    ceiling: int = 2,
    block: int = 16,
    shard_tokens: int = 65536,
    max_shards: int = 4096,
    seed: str = "mix",
) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the shard with its quota of blocks."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.concat(F.lit("="), F.col("source"))
    rows = materialize(docs.select("doc_id", key.alias("sk"), size.alias("size"), F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("h")))
    # nulls join as a key of their own, behind every other in order
    last = F.lit("\U0010ffff")
    rows = rows.withColumn("sk", F.coalesce("sk", last))
    sources = materialize(targets(rows.groupBy("sk").agg(F.sum("size").alias("source_size")), weights, scale, ceiling))
    blocks = sources.withColumns({"seats": F.floor(F.sum("target").over(Window.partitionBy(F.lit(0))) / block), "most": F.floor(F.col("source_size") * ceiling / block), "one": F.lit(0)})
    blocks = apportion(blocks, ["one"], "sk", "target", "seats", "most").select("sk", "source_size", "target", F.col("quota").alias("seats"), F.least(F.lit(max_shards), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_tokens))).alias("shards"))
    blocks = materialize(blocks)
    dealt = rows.join(blocks.select("sk", "shards"), "sk").withColumn("shard", F.pmod(F.conv(F.substring("h", 1, 12), 16, 10).cast("long"), "shards"))
    shards = dealt.groupBy("sk", "shard").agg(F.sum("size").alias("shard_size"))
    shards = shards.join(blocks, "sk").withColumns({"weight": F.col("shard_size").cast("double"), "most": F.floor(F.col("shard_size") * ceiling / block)})
    shards = apportion(shards, ["sk"], "shard", "weight", "seats", "most")
    shards = shards.select("sk", "shard", "shard_size", "quota", "source_size", "target", F.pmod(number(F.concat(F.lit(f"{seed}:"), F.col("sk"), F.lit(":"), F.col("shard").cast("string"))), F.greatest(F.lit(1), "shard_size")).alias("place"))
    order = Window.partitionBy("sk", "shard").orderBy("h", "size", "doc_id")
    dealt = dealt.withColumn("a", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    out = dealt.join(shards, ["sk", "shard"]).withColumn("tokens", F.col("quota") * block)
    whole, rest = F.floor(F.col("tokens") / F.greatest(F.lit(1), "shard_size")), F.col("tokens") % F.greatest(F.lit(1), F.col("shard_size"))
    b = F.col("a") + F.col("size")
    one = F.greatest(F.lit(0), F.least(b, F.col("place") + rest) - F.greatest("a", "place"))
    two = F.greatest(F.lit(0), F.least(b, F.col("place") + rest - F.col("shard_size")) - F.col("a"))
    return out.select("doc_id", "size", "source_size", "target", (whole * F.col("size") + one + two).cast("long").alias("taken"), F.col("shard").cast("long").alias("shard"), F.col("quota").cast("long").alias("quota_blocks"))
