"""Resuming: what a former run has done is left out, and repeated ids are processed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .selection import first_of


def processed_ids(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """Ids of an output of JSON lines; broken lines and rows without an id are skipped."""
    rows = spark.read.schema(f"`{key}` string").option("mode", "PERMISSIVE").json(path)
    return rows.where(F.col(key).isNotNull() & (F.col(key) != "")).select(key).distinct()


def pending(items: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Items whose id, as text, is not among the done ones; those without an id go."""
    known = done.select(F.col(key).cast("string").alias("__done"))
    return items.where(F.col(key).isNotNull()).join(known, F.col(key).cast("string") == F.col("__done"), "left_anti")


def accepted(items: DataFrame, done: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each pending id: repeats are dropped before anything expensive is done with them."""
    return first_of(pending(items, done, key), [key], *order)


def resume_summary(items: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """One row: items, those without an id, those skipped as done, and those to do."""
    flag = items.join(done.select(F.col(key).cast("string").alias("__done")).distinct(), F.col(key).cast("string") == F.col("__done"), "left")
    return flag.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(key).isNull()).alias("invalid"),
        F.count_if(F.col("__done").isNotNull()).alias("skipped"),
        F.count_if(F.col(key).isNotNull() & F.col("__done").isNull()).alias("pending"),
    )
