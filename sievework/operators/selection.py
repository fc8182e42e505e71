"""Selection under quotas: loops over sorted lists in closed form, as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_of(df: DataFrame, key: list[str], *order: Column | str) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def soft_cap(df: DataFrame, k: int, family: str, tier: Column, score: str, tie: str, share: float = 0.35) -> DataFrame:
    """k rows: the families of a lower tier first; within a tier at most share * k rows of a family, before more of it fill up."""
    cap = max(1, int(k * share))
    own = W.partitionBy(family).orderBy(F.desc(score), tie)
    phased = df.withColumn("phase", 2 * tier + (F.row_number().over(own) > cap).cast("int"))
    # a row beyond the first k of its phase can never be among the first k of all
    near = F.row_number().over(W.partitionBy("phase").orderBy(F.desc(score), tie))
    return phased.withColumn("__n", near).where(F.col("__n") <= k).drop("__n").orderBy("phase", F.desc(score), tie).limit(k)


def best_per_id(df: DataFrame, key: str, score: str, *ties: str) -> DataFrame:
    """One row of each id: the best score, the first of equal ones."""
    return first_of(df, [key], F.desc(score), *ties)


def capped_top(df: DataFrame, k: int, family: str, capped: str, score: str, tie: str, share: float = 0.10) -> DataFrame:
    """The k best rows, with at most share * k of one family."""
    cap = max(1, int(k * share))
    rank = F.row_number().over(W.partitionBy(family).orderBy(F.desc(score), tie))
    return df.withColumn("__n", rank).where((F.col(family) != capped) | (F.col("__n") <= cap)).drop("__n").orderBy(F.desc(score), tie).limit(k)


def limited(df: DataFrame, source: str, per_source: int, *order: str) -> DataFrame:
    """The first rows of each source; all, where the limit is 0."""
    if per_source <= 0:
        return df
    return df.withColumn("__n", F.row_number().over(W.partitionBy(source).orderBy(*order))).where(F.col("__n") <= per_source).drop("__n")


def sources_in_turn(sources: list[DataFrame], key: Column | None, per_source: int | list[int], total: int, *order: str) -> DataFrame:
    """Union of sources in order, without texts that an earlier source has used up within its own limit; all texts, where there is no key. Limits of 0 are none."""
    accepted: DataFrame | None = None
    for n, df in enumerate(sources):
        rows = df.withColumn("__key", key if key is not None else F.lit(None).cast("string")).withColumn("__source", F.lit(n))
        if key is not None:
            if accepted is not None:
                rows = rows.join(accepted.select("__key").distinct(), "__key", "left_anti").select(*accepted.columns)
            rows = first_of(rows, ["__key"], *order)
        rows = limited(rows, "__source", per_source[n] if isinstance(per_source, list) else per_source, *order)
        accepted = rows if accepted is None else accepted.unionByName(rows)
    out = accepted.orderBy("__source", *order).limit(total) if total > 0 else accepted
    return out.drop("__key", "__source")


def until_dirty(df: DataFrame, dirty: Column, most: int, order: str, block: int = 100_000) -> DataFrame:
    """Rows up to the one that makes `most` dirty ones, in order of a whole number.

    The running count is made in two steps, over blocks of the order and within them, so that no task holds all rows."""
    rows = df.withColumn("__dirty", dirty.cast("long")).withColumn("__block", F.floor(F.col(order) / block))
    sums = rows.groupBy("__block").agg(F.sum("__dirty").alias("__sum"))
    running = F.sum("__sum").over(W.orderBy("__block").rowsBetween(W.unboundedPreceding, 0)) - F.col("__sum")
    open_blocks = sums.withColumn("__before", running).where(F.col("__before") < most).select("__block", "__before")
    own = F.sum("__dirty").over(W.partitionBy("__block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)) - F.col("__dirty")
    kept = rows.join(open_blocks, "__block").withColumn("__own", own).where(F.col("__before") + F.col("__own") < most)
    return kept.drop("__block", "__own", "__before", "__dirty")
