"""Operators that work by ranges, cells or parts, against plain versions on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import cells
from sievework.operators.percentiles import percentiles

# -- percentiles ------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("small", "bins"), [(1 << 18, 4096), (3, 4), (1, 2)])
def test_percentiles_by_ranges(spark, small, bins):
    rnd = random.Random(2)
    groups = {"even": [float(i) for i in range(41)], "one": [3.5], "same": [2.0] * 30, "steep": [10.0**k for k in range(-20, 20)], "mixed": [round(rnd.gauss(0, 1), 2) for _ in range(90)], None: [1.0, 4.0]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("even", None), ("none", None)]
    parts = [0.0, 0.5, 0.9, 1.0]
    found = {r[0]: list(r)[1:] for r in percentiles(spark.createDataFrame(rows, "g string, x double").repartition(3), "x", parts, "g", small=small, bins=bins).collect()}
    assert set(found) == set(groups)
    for k, vs in groups.items():
        assert np.allclose(found[k], np.quantile(vs, parts), rtol=1e-12, atol=1e-15)


def test_percentiles_without_keys_or_rows(spark):
    rows = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert [tuple(r) for r in percentiles(rows, "x", [0.25, 0.5], small=10, bins=8).collect()] == [(250.0, 500.0)]
    assert percentiles(rows.limit(0), "x", [0.5]).count() == 0


# -- cells ------------------------------------------------------------------------------------------------------------------------


def vectors(n, width=8, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (6, width))[rng.integers(0, 6, n)] + rng.normal(0, 0.4, (n, width))
    return x / np.linalg.norm(x, axis=1)[:, None]


def brute(x, ids, n):
    out = {}
    for i in ids:
        scores = sorted((-round(float(x[i] @ v), 6), j) for j, v in enumerate(x) if j != i)
        out[i] = [j for _, j in scores[:n]]
    return out


def test_cells_find_what_all_rows_give(spark):
    x = vectors(600)
    x[300:500] = x[7]  # a dense place
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [1.0])], "id long, v array<double>")
    ask = rows.where("id % 50 = 0 and id < 800 or id in (900, 901)")
    index = cells.indexed(rows, "id", "v", cells=20, most=40)
    assert index.rows.count() == 600 and max(index.parts.values()) > 1
    expected = brute(x, range(0, 600, 50), 4)
    found = {}
    for r in cells.nearest(index, ask, "id", "v", 4, probes=1, exact=True).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.id)
    assert found == expected
    near = cells.nearest(index, ask, "id", "v", 4, probes=5, exact=False).collect()
    assert sum(r.id in expected[r.query_id] for r in near) >= 0.9 * 4 * len(expected)


def test_recall_of_cells_on_all_vectors(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    index, ask = cells.indexed(e, "vec_id", "embedding"), e.where("vec_id % 100 = 0")
    sets = [{(r.query_id, r.vec_id) for r in cells.nearest(index, ask, "vec_id", "embedding", 10, probes=p, exact=x).collect()} for p, x in ((30, False), (4, True))]
    assert len(sets[1]) == 200 and len(sets[0] & sets[1]) >= 0.9 * len(sets[1])
    assert len(index.centres) == 44 and index.rows.count() == e.count()


def test_cells_without_rows_or_queries(spark):
    none = spark.createDataFrame([], "id long, v array<double>")
    some = spark.createDataFrame([(1, [1.0, 0.0])], "id long, v array<double>")
    assert cells.nearest(cells.indexed(none, "id", "v"), some, "id", "v", 2, exact=True).count() == 0
    assert cells.nearest(cells.indexed(some, "id", "v"), none, "id", "v", 2, exact=True).count() == 0
