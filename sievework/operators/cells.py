"""Nearest vectors by coarse cells: k-means on a bounded sample, every row in its nearest cell, exact scores within the cells that matter.

`indexed` puts all rows into cells, however many they are; a cell of more than ROWS rows is cut into parts, so that a dense place is no hot
group. `nearest` looks for a query's rows in the `probes` cells nearest to it. With `exact`, it then looks in every other cell
that can hold a better row: no row of a cell scores more than query · centre + |query| * radius, where the radius is the largest distance of the
cell's rows from its centre.

Queries meet the rows of a part in one task, in blocks of both, as a product of matrices of which only the `n` best of each query leave the task.
The driver holds the centres, and of each cell its size and radius: `cells` rows, a parameter.

Edge cases: rows and queries without a vector, or of another length than the first centre, are in no result; a query is not its own
neighbour, by its key; keys should be unique, equal ones are left out as the query's own; ties go to the smaller key; no rows or no queries give an empty result."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .scoring import rounded
from .stats import top_k_by

#: Rows that k-means sees, most cells, rounds; rows and queries of a block.
SAMPLE, CELLS, ROUNDS = 20_000, 4096, 8
ROWS, QUERIES = 16_384, 4096


class Index:
    """rows: (cell, part, key, vector), written; centres; of each cell its parts and its radius."""

    def __init__(self, rows: DataFrame, centres: np.ndarray, parts: dict[int, int], radius: np.ndarray) -> None:
        self.rows, self.centres, self.parts, self.radius = rows, centres, parts, radius


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of this width as a matrix, and which rows have one."""
    held = column.to_pylist()
    good = np.array([x is not None and len(x) == width and None not in x for x in held], bool)
    at = np.nonzero(good & (width > 0))[0]
    return np.array([held[i] for i in at], float).reshape(len(at), width), at


def centres(rows: DataFrame, vector: str, cells: int | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """k-means of `sample` vectors, the first by a hash. Without `cells`, the square root of the number of rows."""
    known = rows.where(F.size(vector) > 0)
    number = known.count()
    seen = [r[0] for r in known.select(F.col(vector).cast("array<double>").alias("v")).orderBy(F.xxhash64("v")).limit(sample).collect() if None not in r[0]]
    x = np.array([v for v in seen if len(v) == len(seen[0])], float) if seen else np.zeros((0, 0))
    k = max(1, min(cells or math.isqrt(number), CELLS, len(np.unique(x, axis=0)))) if len(x) else 0
    found = np.unique(x, axis=0)[np.linspace(0, max(0, len(np.unique(x, axis=0)) - 1), k).astype(int)] if k else x
    for _ in range(rounds if k else 0):
        nearest = np.argmax(x @ found.T - (found**2).sum(axis=1) / 2, axis=1)
        sums, many = np.zeros_like(found), np.bincount(nearest, minlength=k)
        np.add.at(sums, nearest, x)
        found[many > 0] = sums[many > 0] / many[many > 0, None]
    return found


def indexed(rows: DataFrame, key: str, vector: str, cells: int | None = None, sample: int = SAMPLE, most: int = ROWS) -> Index:
    found = centres(rows, vector, cells, sample)
    width = found.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = _matrix(batch.column("vector"), width)
            if not len(at) or not width:
                continue
            cell = np.argmax(x @ found.T - (found**2).sum(axis=1) / 2, axis=1)
            far = np.sqrt(((x - found[cell]) ** 2).sum(axis=1))
            yield pa.record_batch([pa.array(cell, pa.int32()), *batch.take(pa.array(at)).columns, pa.array(far)], ["cell", "key", "vector", "far"])

    narrow = rows.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    placed = written(narrow.mapInArrow(run, "cell int, key long, vector array<double>, far double"), "cells")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
    parts, radius = {r.cell: -(-r.n // most) for r in sizes}, np.full(len(found), -1.0)
    for r in sizes:
        radius[r.cell] = r.far
    split = [c for c, n in parts.items() if n > 1]
    number = F.lit(0)
    if split:
        of = F.create_map(*[F.lit(x) for c in split for x in (c, parts[c])])
        number = F.coalesce(F.pmod(F.xxhash64("key", "vector"), F.try_element_at(of, F.col("cell"))), F.lit(0)).cast("int")
    return Index(placed.withColumn("part", number), found, parts, radius)


def _asked(index: Index, queries: DataFrame, probes: int, bounded: bool) -> DataFrame:
    """(query, vector, cell, part): the parts in which queries (query, vector[, least]) look."""
    found, radius, parts, width = index.centres, index.radius, index.parts, index.centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = _matrix(batch.column("vector"), width)
            if not len(at) or not width:
                continue
            near = x @ found.T
            order = np.argsort(-np.where(radius >= 0, near, -np.inf), axis=1, kind="stable")[:, :probes]
            wanted = np.zeros(near.shape, bool)
            np.put_along_axis(wanted, order, True, axis=1)
            if bounded:
                least = batch.column("least").to_numpy(zero_copy_only=False)[at]
                wanted = ~wanted & (near + np.linalg.norm(x, axis=1)[:, None] * radius >= least[:, None] - 2e-6)
            row, cell = np.nonzero(wanted & (radius >= 0))
            many = np.array([parts[c] for c in cell.tolist()], np.int64)
            part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            taken = batch.take(pa.array(at[np.repeat(row, many)]))
            yield pa.record_batch([taken.column("query"), taken.column("vector"), pa.array(np.repeat(cell, many), pa.int32()), pa.array(part, pa.int32())], ["query", "vector", "cell", "part"])

    return queries.mapInArrow(run, "query long, vector array<double>, cell int, part int")


def _scored(index: Index, asked: DataFrame, n: int, digits: int, most: int = QUERIES) -> DataFrame:
    """(query, key, score): the n best rows of each query in each part in which it looks."""
    width = index.centres.shape[1]

    def best(rows: pa.Table, some: pa.Table) -> pa.Table:
        x, at = _matrix(rows.column("vector"), width)
        q, of = _matrix(some.column("vector"), width)
        keys, own = rows.column("key").to_numpy()[at], some.column("query").to_numpy()[of]
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]]
        for i in range(0, len(own) if len(keys) else 0, 256):
            score = rounded(q[i : i + 256] @ x.T, digits)
            score[own[i : i + 256, None] == keys] = -np.inf
            order = np.lexsort((np.broadcast_to(keys, score.shape), -score), axis=1)[:, :n]
            values = np.take_along_axis(score, order, axis=1)
            real = np.isfinite(values)
            out.append([np.repeat(own[i : i + 256], order.shape[1])[real.ravel()], keys[order][real], values[real]])
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["query", "key", "score"])

    # the queries of a part go to blocks, and its rows to as many of them
    blocks = asked.groupBy("cell", "part").agg(F.ceil(F.count("*") / most).cast("int").alias("blocks"))
    left = index.rows.join(blocks, ["cell", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = asked.join(blocks, ["cell", "part"]).withColumn("block", F.pmod(F.xxhash64("query", "vector"), F.col("blocks")).cast("int"))
    groups = ["cell", "part", "block"]
    return left.select(*groups, "key", "vector").groupBy(*groups).cogroup(right.select(*groups, "query", "vector").groupBy(*groups)).applyInArrow(best, "query long, key long, score double")


def nearest(index: Index, queries: DataFrame, key: str, vector: str, n: int, probes: int = 8, exact: bool = True, digits: int = 6) -> DataFrame:
    """(query_id, rank, key, score): of each query its n best rows by dot product, in its `probes` nearest cells or, with `exact`, in all that can hold one."""
    asked = queries.select(F.col(key).cast("long").alias("query"), F.col(vector).cast("array<double>").alias("vector"))
    found = _scored(index, written(_asked(index, asked, probes, False), "asked"), n, digits)
    if exact:
        found = written(found, "probed")
        # the n-th best score of a query so far; none where it has fewer
        least = top_k_by(found, n, "score", "key", "query").where(F.col("rank") == n).select(F.col("query").alias("q"), F.col("score").alias("least"))
        again = asked.join(least, F.col("query") == F.col("q"), "left").select("query", "vector", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
        found = found.union(_scored(index, written(_asked(index, again, probes, True), "asked"), n, digits))
    return top_k_by(found, n, "score", "key", "query").select(F.col("query").alias("query_id"), "rank", F.col("key").alias(key), "score")
