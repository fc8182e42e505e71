"""Interpolated percentiles of groups of any size, by selection over ranges.

Equal values of a group meet first, as one row with their number. Of each group, the ranks that the percentiles lie between are looked for in a range of
values, at first all of them. A range of more than SMALL values is cut into BINS equal bins whose counts say which bin holds the rank; that
bin, from its least to its largest value, is the next range. A rank in a small range is found by running counts. So no task holds the values of a group, and each
round reads what is left of the wanted ranges.

Null scores are not counted; NaN is the largest value, as Spark orders it; a group without scores has no row; null keys are a group of
their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import release, written

#: Values that a task sorts, bins of a round.
SMALL, BINS = 1 << 18, 4096


def _ranks(parts: list[float]):
    """Structs of a percentile, its lower and its upper rank from 0."""
    at = lambda p: (F.col("total") - 1) * F.lit(float(p))
    return F.array(*[F.struct(F.lit(i).alias("i"), F.floor(at(p)).alias("low"), F.ceil(at(p)).alias("high"), at(p).alias("at")) for i, p in enumerate(parts)])


def percentiles(df: DataFrame, score: str, parts: list[float], *keys: str, small: int = SMALL, bins: int = BINS) -> DataFrame:
    """(keys, p0, p1, ...): of each group the interpolated value at (n - 1) * p of its sorted scores, for each p of `parts`."""
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("k0"))
    values = written(df.where(F.col(score).isNotNull()).groupBy(key.alias("key"), F.col(score).cast("double").alias("v")).agg(F.count("*").alias("n")), "values")
    totals = written(values.groupBy("key").agg(F.sum("n").alias("total"), F.count("*").alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi")), "totals")
    spots = totals.select("key", F.explode(_ranks(parts)).alias("r")).select("key", "r.*")
    ranks = spots.select("key", F.explode(F.array("low", "high")).alias("rank")).distinct()
    # (key, rank, lo, hi, base, m): the rank is among the m values from lo to hi, before which there are `base` scores
    wanted = written(ranks.join(totals, "key").select("key", "rank", "lo", "hi", F.lit(0).cast("long").alias("base"), "m"), "ranges")
    while True:
        large = (F.col("m") > small) & (F.col("lo") < F.col("hi")) & ~F.isnan("hi") & (F.abs("lo") != float("inf")) & (F.abs("hi") != float("inf"))
        if wanted.where(large).isEmpty():
            break
        ranges = wanted.where(large).select("key", "lo", "hi", "base").distinct()
        inside = values.join(ranges, "key").where(F.col("v").between(F.col("lo"), F.col("hi")))
        bin_ = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * bins), F.lit(bins - 1))
        counts = inside.groupBy("key", "lo", "base", bin_.alias("bin")).agg(F.sum("n").alias("n"), F.count("*").alias("m"), F.min("v").alias("least"), F.max("v").alias("most"))
        start = F.col("base") + F.coalesce(F.sum("n").over(W.partitionBy("key", "lo").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        counts = counts.select("key", "lo", start.alias("start"), "n", "m", "least", "most")
        narrower = wanted.where(large).drop("m", "hi", "base").join(counts, ["key", "lo"]).where((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("n")))
        narrower = narrower.select("key", "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("start").alias("base"), "m")
        before, wanted = wanted, written(narrower.union(wanted.where(~large)), "ranges")
        release(before)
    ranges = wanted.select("key", "lo", "hi", "base").distinct()
    inside = values.join(ranges, "key").where(F.col("v").between(F.col("lo"), F.col("hi")))
    end = F.col("base") + F.sum("n").over(W.partitionBy("key", "lo").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    placed = inside.select("key", "lo", "v", "n", end.alias("end"))
    found = wanted.select("key", "lo", "rank").join(placed, ["key", "lo"]).where((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))).select("key", "rank", "v")
    at = lambda name: found.select("key", F.col("rank").alias(name), F.col("v").alias(f"{name}_v"))
    both = spots.join(at("low"), ["key", "low"]).join(at("high"), ["key", "high"])
    value = F.when(F.col("low") == F.col("high"), F.col("low_v")).otherwise((F.col("high") - F.col("at")) * F.col("low_v") + (F.col("at") - F.col("low")) * F.col("high_v"))
    row = both.groupBy("key").agg(*[F.max(F.when(F.col("i") == i, value)).alias(f"p{i}") for i in range(len(parts))])
    return row.select(*[F.col(f"key.k{i}").alias(k) for i, k in enumerate(keys)], *[f"p{i}" for i in range(len(parts))])
