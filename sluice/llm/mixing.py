"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, Workspace

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Tokens of a block.
BLOCK = 16
#: Tokens that a shard of a source holds, about; a source of any size is so many shards.
SHARD = 2_000_000
#: Passes that narrow the divisor down, and parts of its range that each pass looks at.
PASSES, CUTS = 2, 128


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, most: int = 2) -> DataFrame:
    """source, source_size, target from (source, source_size): shares of ``percent`` of all sizes by weight, none above ``most`` times its own size.

    What a capped source gives up goes to the others by weight until none is above. In order of cap per weight that is one pass:
    the capped sources are the first ones, up to where the level that the rest would get is below the next one's cap.
    Sources go by code point, null last. Works on one row per source.
    """
    order = W.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    n = (F.row_number().over(order) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), n.cast("int") + 1).cast("double"))
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_cap = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    before, after = by_cap.rowsBetween(W.unboundedPreceding, -1), by_cap.rowsBetween(0, W.unboundedFollowing)
    everything = F.sum("source_size").over(W.partitionBy()) * F.lit(percent / 100)
    rows = rows.withColumn("left", everything - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("rest", F.sum("weight").over(after))
    rows = rows.withColumn("above", F.col("left") * F.col("weight") / F.col("rest") >= F.col("cap"))
    # The first that is not above fixes the level; all after it have larger caps per weight.
    first = F.min(F.when(~F.col("above"), F.struct((F.col("cap") / F.col("weight")).alias("c"), F.col("source").isNull().alias("s"), F.encode(F.col("source"), "UTF-8").alias("b"), "left", "rest"))).over(W.partitionBy())
    rows = rows.withColumn("level", first)
    share = F.col("level.left") * F.col("weight") / F.col("level.rest")
    return rows.select("source", "source_size", F.when(F.col("level").isNull() | F.col("above"), F.col("cap")).otherwise(F.least(share, F.col("cap"))).alias("target"))


def same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def apportion(parties: DataFrame, by: list[str], party: list[str], weight: str, seats: str) -> DataFrame:
    """``parties`` with an integer ``quota``: the Sainte-Laguë method (highest quotients weight / (2k + 1)) within each group ``by``.

    A party has floor((weight / d + 1) / 2) quotients of d or more, so how many a group has is a sum, combined on the map side. The range of d that
    holds the last winning quotient follows from the sums of weights and parties; each pass looks at CUTS parts of it and keeps one.
    Quotients above the range that is left win; only those within it, some ten-thousandth of the parties, are ranked, beside ties at its very
    end, which go to the earlier party. Parties without weight (null, zero, negative) get none. ``parties`` is read once a pass: give a written table.
    """
    keys = [f"_by_{c}" for c in by] or ["_by"]
    group = [F.col(c).alias(k) for c, k in zip(by, keys, strict=False)] or [F.lit(1).alias("_by")]
    real = parties.where(F.col(weight) > 0).select(*group, *[F.col(c).alias(f"_party_{k}") for k, c in enumerate(party)], F.col(weight).cast("double").alias("_w"), F.col(seats).cast("long").alias("_s"))
    won = lambda d: F.floor((F.col("_w") / d + 1) / 2)

    def beside(rows: DataFrame, bounds: DataFrame, how: str = "inner") -> DataFrame:
        bounds = bounds.select(*[F.col(k).alias(f"{k}_") for k in keys], *[c for c in bounds.columns if c not in keys])
        on = same(keys[0], f"{keys[0]}_")
        for k in keys[1:]:
            on = on & same(k, f"{k}_")
        return rows.join(bounds, on, how).drop(*[f"{k}_" for k in keys])

    bounds = real.groupBy(*keys).agg(F.sum("_w").alias("t"), F.count("*").alias("n"), F.max("_w").alias("m"), F.max("_s").alias("_seats"))
    above = F.when(2 * F.col("_seats") > F.col("n"), F.least(2 * F.col("m"), F.col("t") / (2 * F.col("_seats") - F.col("n")) * (1 + 1e-9))).otherwise(2 * F.col("m"))
    bounds = bounds.select(*keys, "_seats", (F.col("t") / (2 * F.col("_seats") + F.col("n")) * (1 - 1e-9)).alias("_lo"), above.alias("_hi"))
    for _ in range(PASSES):
        parts = bounds.withColumn("_d", F.explode(F.transform(F.sequence(F.lit(1), F.lit(CUTS - 1)), lambda k: F.col("_lo") * F.pow(F.col("_hi") / F.col("_lo"), k / CUTS))))
        sums = beside(real, parts).groupBy(*keys, "_seats", "_lo", "_hi", "_d").agg(F.sum(won(F.col("_d"))).alias("_c"))
        low = F.greatest("_lo", F.max(F.when(F.col("_c") >= F.col("_seats"), F.col("_d"))))
        high = F.least("_hi", F.min(F.when(F.col("_c") <= F.col("_seats"), F.col("_d"))))
        bounds = sums.groupBy(*keys, "_seats", "_lo", "_hi").agg(low.alias("_low"), high.alias("_high")).select(*keys, "_seats", F.least("_low", "_high").alias("_lo"), F.col("_high").alias("_hi"))
    rows = beside(real, bounds).withColumn("_sure", won(F.col("_hi"))).withColumn("_may", won(F.col("_lo")))
    left = rows.groupBy(*keys).agg((F.max("_seats") - F.sum("_sure")).alias("_left"))
    names = [f"_party_{k}" for k in range(len(party))]
    bids = rows.where("_may > _sure").select(*keys, *names, "_w", F.explode(F.sequence(F.col("_sure"), F.col("_may") - 1)).alias("_k"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy((F.col("_w") / (2 * F.col("_k") + 1)).desc(), *names))
    more = beside(bids.withColumn("_rank", rank), left).where("_rank <= _left").groupBy(*keys, *names).agg(F.count("*").alias("_more"))
    sure = rows.select(*keys, *names, F.col("_sure").alias("_quota")).unionByName(more.withColumnRenamed("_more", "_quota")).groupBy(*keys, *names).agg(F.sum("_quota").alias("_quota"))
    on = F.lit(True)
    for c, k in (*zip(by, keys, strict=False), *zip(party, names, strict=True)):
        on = on & same(c, k)
    return parties.join(sure, on, "left").select(*parties.columns, F.coalesce("_quota", F.lit(0)).cast("long").alias("quota"))


def mix(docs: DataFrame, ws: Workspace, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, most: int = 2, block: int = BLOCK, shard: int = SHARD, seed: int = 7, id_col: str = "doc_id") -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs``.

    Each source's tokens lie on lines, one per shard, its documents in an order drawn by ``seed``; a line is cut into blocks of
    ``block`` tokens. Sources get blocks in proportion to their targets, and each source's shards get them in proportion to their
    tokens, by Sainte-Laguë both times. A shard takes its whole line as often as its quota holds it, and for the rest a
    run of blocks that starts at a drawn block and goes round. taken counts a document's tokens in those blocks, repeats included; no
    document is taken more than ``most`` times over.

    A document's place is drawn from its id and text, so null or equal ids are dealt to all shards.
    Null texts and texts of white space have size 0 and take nothing. Null sources are one source, the last. Rows with equal ids and
    texts are taken separately (their order is then the engine's). No rows give no rows.
    """
    source = F.col("source").cast("string").alias("source")
    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.col("text"))
    rows = docs.select(F.col(id_col).alias("doc_id"), source, words_in(F.col("text")).alias("size"), draw.alias("draw"))
    rows = ws.save(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes, weights, percent, most)
    seats = F.round(F.sum("target").over(W.partitionBy()) / block).cast("long")
    goals = ws.save(goals.withColumn("_seats", seats).withColumn("_null", F.col("source").isNull()), "targets")
    goals = ws.save(apportion(goals, [], ["_null", "source"], "target", "_seats").select("source", "source_size", "target", F.col("quota").alias("source_quota")), "goals")
    n_shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard)).cast("long")
    named = goals.withColumnRenamed("source", "g_source")
    dealt = rows.join(named, F.col("source").eqNullSafe(F.col("g_source"))).select("doc_id", "source", "size", "source_size", "target", "source_quota", F.pmod("draw", n_shards).alias("shard"), "draw")
    shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("line"), F.max("source_quota").alias("source_quota"))
    quotas = apportion(ws.save(shards, "shards"), ["source"], ["shard"], "line", "source_quota")
    blocks = F.ceil(F.col("line") / block).cast("long")
    quotas = quotas.withColumn("blocks", blocks).withColumn("quota", F.least("quota", F.col("blocks") * most))
    quotas = quotas.withColumn("times", F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(0).cast("long"))
    quotas = quotas.withColumn("run", (F.col("quota") - F.col("times") * F.col("blocks")) * block)
    quotas = quotas.withColumn("start", F.when(F.col("blocks") > 0, F.pmod(F.xxhash64(F.lit(seed), F.col("shard"), F.col("source")), F.col("blocks"))).otherwise(0) * block)
    quotas = ws.save(quotas.select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "line", "blocks", "times", "run", "start"), "quotas")
    line = W.partitionBy("source", "shard").orderBy("draw", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = dealt.withColumn("end", F.sum("size").over(line)).withColumn("begin", F.col("end") - F.col("size"))
    placed = placed.join(quotas, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")))
    overlap = lambda a, b: F.greatest(F.least(F.col("end"), b) - F.greatest(F.col("begin"), a), F.lit(0))
    stop, round_ = F.col("start") + F.col("run"), F.col("blocks") * block
    part = overlap(F.col("start"), stop) + overlap(F.lit(0), stop - round_)
    return placed.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), F.col("target").cast("double").alias("target"), (F.col("times") * F.col("size") + part).cast("long").alias("taken"))
