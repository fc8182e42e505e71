"""Term frequencies and norms, and dot products, as columns; matching.py compares candidates with a whole benchmark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frequencies(df: DataFrame, key: str, terms: Column) -> DataFrame:
    """(key, term, tf) of each different term."""
    return df.select(key, F.explode(terms).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def norms(tf: DataFrame, key: str) -> DataFrame:
    return tf.groupBy(key).agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("norm"))


def dot_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
