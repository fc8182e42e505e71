"""Statistics of scores, and mixes of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import written
from .percentiles import percentiles


def score_stats(df: DataFrame, score: str, *keys: str, digits: int = 6) -> DataFrame:
    """Count, extremes, mean and interpolated percentiles by key; zeros where there are no scores."""
    of = lambda c, name: F.round(F.coalesce(c, F.lit(0.0)), digits).alias(name)
    parts = [F.count(score).alias("count"), of(F.min(score), "min"), of(F.max(score), "max"), of(F.avg(score), "mean")]
    rows = written(df.select(*keys, score), "scores")
    plain = rows.groupBy(*keys).agg(*parts) if keys else rows.agg(*parts)
    found = percentiles(rows, score, [0.5, 0.9, 0.95], *keys)
    found = found.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(f"p{i}") for i in range(3)])
    near = F.lit(True)
    for k in keys:
        near = near & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return plain.join(found, near, "left").select(*keys, "count", "min", "max", "mean", *[of(F.col(f"p{i}"), f"p{p}") for i, p in enumerate((50, 90, 95))])


def share_of(count: Column, *partition: str) -> Column:
    return count / F.sum(count).over(W.partitionBy(*partition))


def mix(df: DataFrame, member: str, *partition: str, digits: int = 6) -> DataFrame:
    """Rows of each member and their share, in each partition or in all."""
    counted = df.groupBy(*partition, member).agg(F.count("*").alias("count"))
    return counted.withColumn("fraction", F.round(share_of(F.col("count"), *(partition or [F.lit(0)])), digits))


def top_k(df: DataFrame, k: int, score: str, tie: str) -> DataFrame:
    """The k best rows; all, where k is 0 or less."""
    ordered = df.orderBy(F.desc(score), tie)
    return ordered.limit(k) if k > 0 else ordered


def top_k_by(df: DataFrame, k: int, score: str, tie: str, *keys: str) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(score), tie))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def grouped_counts(df: DataFrame, file: str, dimensions: list[str]) -> DataFrame:
    """(file, dimension, value, n) of several dimensions, by file and over all files (file null), in one pass."""
    rows = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions]))
    long = df.select(file, rows.alias("r")).select(file, "r.dimension", "r.value").where("value <> ''")
    return long.groupingSets([[F.col(file), F.col("dimension"), F.col("value")], [F.col("dimension"), F.col("value")]], file, "dimension", "value").agg(F.count("*").alias("n"))
