"""Throughput and latency of calls, from sketches that can be merged: of tasks, batches and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, and the stated error: a quantile's rank is within 1 % of the number of calls; a sketch of this size has about 0.3 % with 99 % confidence.
K, RANK_ERROR = 1024, 0.01


def sketched(calls: DataFrame, seconds: str, *keys: str, failed: Column | None = None, k: int = K) -> DataFrame:
    """(keys, calls, failed, total_seconds, sketch): a row for each key, of a size that does not grow with the calls. Calls without a time are not counted."""
    bad = F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False)
    x = F.col(seconds).cast("double")
    parts = [F.count("*").alias("calls"), F.count_if(bad).alias("failed"), F.sum(x).alias("total_seconds"), F.call_function("kll_sketch_agg_double", x, F.lit(k)).alias("sketch")]
    rows = calls.where(x.isNotNull())
    return rows.groupBy(*keys).agg(*parts) if keys else rows.agg(*parts)


def merged(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sketches of several runs as one for each key."""
    pair = lambda a, b: F.call_function("kll_sketch_merge_double", a, b)
    folded = F.reduce(F.slice("held", F.lit(2), F.size("held")), F.get("held", F.lit(0)), pair)
    parts = [F.sum("calls").alias("calls"), F.sum("failed").alias("failed"), F.sum("total_seconds").alias("total_seconds"), F.collect_list("sketch").alias("held")]
    rows = sketches.where("calls > 0")
    return (rows.groupBy(*keys).agg(*parts) if keys else rows.agg(*parts).where("calls > 0")).withColumn("sketch", folded).drop("held")


def figures(sketches: DataFrame, wall_seconds: float | None = None) -> DataFrame:
    """The columns before the sketch, mean_seconds, p50, p99 and, with the run's duration, calls per second."""
    at = lambda q: F.call_function("kll_sketch_get_quantile_double", F.col("sketch"), F.lit(q))
    made = sketches.where("calls > 0").withColumn("mean_seconds", F.col("total_seconds") / F.col("calls")).withColumn("p50", at(0.5)).withColumn("p99", at(0.99))
    return (made.withColumn("calls_per_second", F.col("calls") / wall_seconds) if wall_seconds else made).drop("sketch")
