"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix has a number of blocks of equally many tokens; sources get them one by one by the highest quotients target / (2 * seats + 1).
Documents of a source are dealt to shards by a hash, as many shards as its own documents need, and each shard's words, in order of doc_id, are cut into blocks of
BLOCK tokens, or of fewer where the source is small (the last one has the rest, half a block more or less). The shards within a source get its blocks by the same quotients of their sizes, up to MOST_TIMES times their blocks,
which gives an integer quota for each shard; a source with more than FAN shards does so in two levels, so that no group of quotas is large. A seeded permutation of a shard's blocks then says which are taken how often, so that a
document's share follows from the blocks that it overlaps and none is taken more than MOST_TIMES times.

The driver reads one row for each source (its words and documents), as the targets of all depend on each other; everything else stays in Spark, and a hot source is spread over tasks.

Edge cases: null and blank texts have size 0 and nothing is taken of them; the null source comes last; sources without words have
target 0; an empty table gives an empty result; a text of any length has one size, and its share is summed over its blocks. Repeated rows are documents of their own, equal ids in the order of a mark of
their texts. `mixed` adds size, source_size, target and taken, which replace columns of these names; other columns are kept, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, table, written

WEIGHTS, SHARE, MOST_TIMES = (3, 1, 2), 1.5, 2
#: Tokens of a block, blocks that a source has at least if it has so many words, documents of a shard, shards whose quotas are made together.
BLOCK, FINE, SHARD, FAN = 16, 64, 1024, 4096
SEED = 20
_STEP = 2654435761  # a prime


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST_TIMES) -> list[float]:
    """Parts of share * sum(sizes) by weight; none is above most * size, and what is cut off goes to the others by weight."""
    left, whole, out = share * sum(sizes), sum(weights), [0.0] * len(sizes)
    # those whose bound is the smallest for their weight reach it first
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    for k, i in enumerate(order):
        if left * weights[i] <= most * sizes[i] * whole:
            for j in order[k:]:
                out[j] = left * weights[j] / whole
            break
        out[i] = float(most * sizes[i])
        left, whole = left - out[i], whole - weights[i]
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray | None = None) -> np.ndarray:
    """Seats by the highest quotients votes / (2 * seats + 1); the first of equal quotients wins, and none gets over `most`.

    Most seats are given at once, by a divisor under which they are certainly not too many; the highest quotients get the rest."""
    votes = np.asarray(votes, float)
    given, n = np.zeros(len(votes), np.int64), len(votes)
    if not n or votes.sum() <= 0 or seats <= 0:
        return given
    if seats > n:
        given = np.floor(votes * (seats - n / 2 - 1) / votes.sum() + 0.5).astype(np.int64)
    most = np.full(n, seats, np.int64) if most is None else most
    given = np.minimum(given, most)
    heap = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes.tolist(), given.tolist(), strict=True)) if v > 0 and g < most[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(given.sum())):
        if not heap:
            break
        i = heap[0][1]
        given[i] += 1
        if given[i] < most[i]:
            heapq.heapreplace(heap, (-votes[i] / (2 * int(given[i]) + 1), i))
        else:
            heapq.heappop(heap)
    return given


def _quotas(members: pd.DataFrame) -> pd.DataFrame:
    """Blocks for each member of a group, by words; `seats` are those of the group and n a member's own blocks."""
    members = members.sort_values("member")
    members["quota"] = sainte_lague(members["words"].to_numpy(float), int(members["seats"].iloc[0]), MOST_TIMES * members["n"].to_numpy(np.int64))
    return members[["key", "member", "quota"]]


def apportioned(goals: list[float], block: int = BLOCK) -> list[tuple[int, int]]:
    """For each target, the tokens that sources get by the highest quotients of equal blocks. Blocks are smaller than `block` where the least target would have under FINE of them."""
    least = min((g for g in goals if g > 0), default=0)
    unit = max(1, min(block, int(least // FINE)))
    return [unit * int(s) for s in sainte_lague(np.array(goals), round(sum(goals) / unit))]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, key, source, size, mark): key stands for the source, null or not; mark for the text."""
    source = F.col("source").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key"),
        source.alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("mark"),
    )


def taken(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """rows of measured(), written before, with source_size, target and taken."""
    spark = rows.sparkSession
    sums = sorted(rows.groupBy("key", "source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect(), key=lambda r: (r.source is None, (r.source or "").encode()))
    sizes = [r.words for r in sums]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(sums))])
    known = []
    for r, goal, tokens in zip(sums, goals, apportioned(goals, block), strict=True):
        unit, shards = max(1, min(block, r.words // FINE)), max(1, -(-r.n // SHARD))
        known.append((r.key, r.words, goal, unit, round(tokens / unit), shards))
    sources = spark.createDataFrame(known, "key string, source_size long, target double, unit long, seats long, shards long")
    sources = F.broadcast(sources) if len(known) < 10_000 else written(sources, "sources")
    dealt = rows.join(sources.select("key", "unit", "shards"), "key").withColumn("shard", F.pmod(F.xxhash64("doc_id", "mark", F.lit("shard")), F.col("shards")))
    words = dealt.groupBy("key", "shard", "unit").agg(F.sum("size").alias("words")).withColumn("n", F.expr("greatest(1L, (words + unit div 2) div unit)"))
    words = written(words.withColumn("far", (F.col("shard") / FAN).cast("long")), "shards")
    # from sources to groups of shards, and from these to shards
    upper = words.groupBy("key", "far").agg(F.sum("words").alias("words"), F.sum("n").alias("n")).join(sources.select("key", "seats"), "key")
    quota = lambda df, *by: df.groupBy(*by).applyInPandas(_quotas, "key string, member long, quota long")
    upper = quota(upper.withColumnRenamed("far", "member"), "key").select("key", F.col("member").alias("far"), F.col("quota").alias("seats"))
    quotas = quota(words.withColumnRenamed("shard", "member").join(upper, ["key", "far"]), "key", "far").withColumnRenamed("member", "shard")
    quotas = words.select("key", "shard", "words", "n").join(quotas, ["key", "shard"])

    order = W.partitionBy("key", "shard").orderBy("doc_id", "mark", "size")
    end = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    placed = dealt.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).join(quotas, ["key", "shard"])
    placed = (
        placed.withColumn("times", F.expr("quota div n"))
        .withColumn("extra", F.col("quota") % F.col("n"))
        .withColumn("step", F.lit(_STEP) % F.col("n"))
        .withColumn("turn", F.pmod(F.xxhash64("key", "shard", F.lit(seed)), F.col("n")))
    )
    part = F.expr(
        "aggregate(sequence(least(start div unit, n - 1), least((end - 1) div unit, n - 1)), 0L, (s, b) -> s + if(pmod(step * b + turn, n) < extra,"
        " least(end, if(b = n - 1, words, (b + 1) * unit)) - greatest(start, b * unit), 0L))"
    )
    whole = F.when(F.col("size") > 0, F.col("times") * F.col("size") + part).otherwise(F.lit(0).cast("long"))
    return placed.withColumn("taken", whole).join(sources.select("key", "source_size", "target"), "key").select("doc_id", "mark", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of which the mix takes words: columns of docs with size, source_size, target and taken, which replace columns
    of these names."""
    found = taken(written(measured(docs), "sizes"))
    same = W.partitionBy("doc_id", "mark").orderBy("taken")
    counted = found.withColumn("copy", F.row_number().over(same))
    names = [f"`{c}`" for c in docs.columns]
    marked = docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("m"))
    marked = marked.withColumn("c", F.row_number().over(W.partitionBy("d", "m").orderBy("d")))
    near = (marked.d.eqNullSafe(counted.doc_id)) & (marked.m == counted.mark) & (marked.c == counted["copy"])
    added = ["size", "source_size", "target", "taken"]
    own = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in added]
    return marked.join(counted, near).where("taken > 0").select(*own, *added)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = taken(written(measured(table(spark, sf_dir, "documents")), "sizes"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op4_source_mix": op4_source_mix}
ORACLE: dict[str, str] = {}
