"""Gapless numbers by an order, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

#: Equal rows that one task may write.
RUN = 1 << 16


def numbered(rows: DataFrame, per: list[str], block: str, order: list[Column], name: str, run: int = RUN) -> DataFrame:
    """rows with a long `name`: 0, 1, 2, ... within equal `per`, by block and then by order.

    `per` and `block` hold no nulls; order settles all rows but equal ones, which are interchangeable: they meet before they are
    shuffled, as one row with its copies, and are written again by as many tasks as needed. A task sorts a block, so blocks must be bounded;
    where a block starts follows from sums over the blocks of each `per`, which are as many rows as there are blocks."""
    columns, spot = [f"`{c}`" for c in rows.columns], [*per, block]
    once = written(rows.groupBy(*columns).agg(F.count("*").alias("__n")), "once")
    totals = once.groupBy(*spot).agg(F.sum("__n").alias("__all"))
    ahead = F.sum("__all").over(W.partitionBy(*(per or [F.lit(0)])).orderBy(block).rowsBetween(W.unboundedPreceding, -1))
    starts = totals.select(*spot, F.coalesce(ahead, F.lit(0)).alias("__start"))
    inside = F.sum("__n").over(W.partitionBy(*spot).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")
    placed = once.withColumn("__inside", inside).join(starts, spot).withColumn("__from", F.col("__start") + F.col("__inside"))
    each = lambda df: df.select(*columns, F.explode(F.expr("sequence(`__from`, `__from` + `__n` - 1)")).alias(name))
    few, many = placed.where(F.col("__n") <= run), placed.where(F.col("__n") > run)
    cut = many.select(*columns, F.expr("`__from` + `__n`").alias("__to"), F.explode(F.expr(f"sequence(`__from`, `__from` + `__n` - 1, {run}L)")).alias("__from"))
    return each(few).union(each(cut.withColumn("__n", F.expr(f"least({run}L, `__to` - `__from`)")).repartition(F.col("__from"))))
