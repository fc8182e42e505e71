"""Weak buckets of an evaluation: accuracy, comparison with a baseline, priority, difficulty, and a sampling plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import tables as T
from ..functions.text import slug


def accuracy(samples: DataFrame, *keys: str) -> DataFrame:
    wrong = F.count_if(F.col("score") < 1)
    return samples.groupBy(*keys).agg(F.count("*").alias("total_count"), wrong.alias("wrong_count"), F.round(100 * F.avg("score"), 2).alias("accuracy"))


def priorities(current: DataFrame, baseline: DataFrame, duration: str = "duration", task: str = "task_type") -> DataFrame:
    """Buckets by rank. Rounded figures go into the differences; a bucket without a baseline has no gap."""
    keys = [duration, task]
    base = accuracy(baseline, *keys).select(*keys, F.col("accuracy").alias("baseline_accuracy"))
    rows = accuracy(current, *keys).join(base, keys, "left")
    gap = F.when(F.col("baseline_accuracy").isNull(), F.lit(0.0)).otherwise(F.round(F.col("baseline_accuracy") - F.col("accuracy"), 2))
    rows = rows.withColumn("error_rate", F.round(100 - F.col("accuracy"), 2)).withColumn("baseline_gap_pp", gap)
    rows = rows.withColumn("priority_score", F.round(F.col("wrong_count") * (1 + F.greatest(F.lit(0.0), F.col("baseline_gap_pp")) / 10), 4))
    order = W.orderBy(F.desc("priority_score"), F.desc("wrong_count"), F.desc("error_rate"), *keys)
    tier = F.when(F.col("rank") <= 5, "critical").when(F.col("rank") <= 12, "hard").when(F.col("error_rate") >= 35, "medium").otherwise("easy")
    rows = rows.withColumn("rank", F.row_number().over(order)).withColumn("difficulty_tier", tier)
    return rows.withColumn("bucket_key", slug(F.concat_ws("_", *keys))).withColumn("baseline_accuracy", F.coalesce("baseline_accuracy", F.lit(0.0)))


def plan(buckets: DataFrame, mixes: DataFrame) -> DataFrame:
    """Weights of the selected buckets, and the shares of families in each: buckets(bucket_key, priority_score) with
    mixes(bucket_key, family, count)."""
    everything = W.partitionBy(F.lit(0))
    weighed = buckets.withColumn("bucket_weight", F.round(F.col("priority_score") / F.nullif(F.sum("priority_score").over(everything), F.lit(0.0)), 4))
    share = F.round(F.col("count") / F.sum("count").over(W.partitionBy("bucket_key")), 4)
    return weighed.join(mixes.withColumn("source_share", share), "bucket_key")


def duration_match(bucket: Column, hint: Column) -> Column:
    fits = (bucket == "long") & (hint == "long") | (bucket == "medium") & hint.isin("medium", "long") | (bucket == "short") & (hint == "short")
    return F.when(hint == "unknown", F.lit(0.5)).when(fits, F.lit(1.0)).otherwise(F.lit(0.0))


def looked_up(values: dict, *key: Column) -> Column:
    """The value of a key of strings, null if there is none: one look at the key, however many values there are."""
    entries = [F.lit(x) for k, v in values.items() for x in ("|".join(k) if isinstance(k, tuple) else k, v)]
    return F.try_element_at(F.create_map(*entries), F.concat_ws("|", *key))


def skill_priority(task: Column, skill: Column) -> Column:
    """Null where the skill does not serve the task."""
    return looked_up({(t, s): p for t, skills in T.BUCKET_SKILLS.items() for s, p in skills.items()}, task, skill)


def source_tier(duration: Column, task: Column, family: Column) -> Column:
    """0 for families of first choice, 1 for second, 2 for the rest."""
    ranks = {(d, t, f): n for (d, t), lists in T.BUCKET_SOURCES.items() for n, families in enumerate(lists) for f in families}
    return F.coalesce(looked_up(ranks, duration, task, family), F.lit(2))


def selection_score(similarity: Column, skill: Column, duration: Column) -> Column:
    return F.round(0.60 * similarity + 0.25 * skill + 0.15 * duration, 6)


def first_round(family: Column, skill: Column, category: Column) -> Column:
    """Candidates that take part at all."""
    return F.when(family == "capeval", F.lit(False)).when(family == "count_eval", category.isin(T.COUNTED_CATEGORIES)).otherwise(~((family == "askmodelanything") & (skill == "general")))
