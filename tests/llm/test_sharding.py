import math
import zlib
from collections import Counter, defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from sievework.llm import sharding
from sievework.llm.numbering import numbered

from .helpers import HARD, docs, saved


def straw(name, key, weight):
    return math.log((int(md5(f"{name}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / weight


def brute(key, tree):
    """Level by level, over nested dictionaries."""
    regions = defaultdict(lambda: defaultdict(list))
    for x in tree:
        regions[x.region][x.rack].append(x)
    sums = {(r, k): sum(x.weight for x in xs) for r, ks in regions.items() for k, xs in ks.items()}
    region = max(regions, key=lambda r: straw(f"region {r}", key, sum(w for (q, _), w in sums.items() if q == r)))
    rack = max(regions[region], key=lambda k: straw(f"rack {region} {k}", key, sums[region, k]))
    return max(regions[region][rack], key=lambda x: straw(f"shard {x.shard}", key, x.weight)).shard


def placed(spark, keys, tree):
    return {r.k: r.s for r in spark.createDataFrame([(k,) for k in keys], "k string").select("k", sharding.shard_of(F.col("k"), tree).alias("s")).collect()}


def test_equals_brute_force(spark):
    tree = sharding.weighted(sharding.grid(14, planned=12, regions=3, racks=2), {3: 2.5, 8: 0.5})
    keys = [str(i) for i in range(600)] + ["", "x"]
    assert placed(spark, keys, tree) == {k: brute(k, tree) for k in keys}


def test_rows_follow_weights(spark):
    tree = sharding.weighted(sharding.grid(12, planned=12, regions=3, racks=2), {0: 3, 5: 0})
    found = Counter(placed(spark, map(str, range(14000)), tree).values())
    assert 5 not in found and all(abs(n / 14000 - (3 if s == 0 else 1) / 13) < 0.012 for s, n in found.items())


def test_one_more_takes_rows_only_into_itself(spark):
    keys = [str(i) for i in range(8000)]
    for n in (40, 41, 45):
        old, new = (placed(spark, keys, sharding.grid(x)) for x in (n, n + 1))
        moved = [k for k in keys if old[k] != new[k]]
        assert {new[k] for k in moved} == {n} and abs(len(moved) / 8000 - 1 / (n + 1)) < 0.01


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    base = sharding.grid(12, planned=12, regions=3, racks=2)
    heavier, keys = sharding.weighted(base, {5: 2}), [str(i) for i in range(4000)]
    old, new = placed(spark, keys, base), placed(spark, keys, heavier)
    at = {x.shard: (x.region, x.rack) for x in base}
    for k in keys:
        if old[k] != new[k]:  # the level where the ways part leads into what has grown
            assert at[new[k]] == at[5] or at[new[k]][0] == at[5][0]
            assert new[k] == 5 or at[old[k]] != at[5]
    assert any(old[k] != new[k] for k in keys)


def test_a_tree_needs_weight():
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit("a"), sharding.weighted(sharding.grid(2), {0: 0, 1: 0}))


def test_query_on_hard_rows(spark, tmp_path):
    rows = [*HARD, *[(50, "same") for _ in range(30)], (None, None), (None, "x"), (51, "a" * 200_000)]
    sf = saved(spark, tmp_path, documents=docs(spark, rows))
    found = sharding.op13_sharding(spark, sf).collect()
    expected = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert (r.law, r.shard, r.grown_shard) == ("key", brute(key, sharding.grid(40)), brute(key, sharding.grid(41)))
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_slots_do_not_depend_on_partitions(spark):
    table = docs(spark, [(i % 90, f"text {i % 7}") for i in range(400)])
    tree = sharding.grid(3, planned=3)
    found = [sorted(map(tuple, sharding.slots(table.repartition(n), tree, tree).collect())) for n in (1, 7)]
    assert found[0] == found[1]


def test_numbers_of_repeated_rows_over_blocks(spark):
    rows = spark.createDataFrame([("a", b, x) for b, x, n in [(0, 5, 1), (0, 2, 25), (1, 1, 3), (3, 0, 12)] for _ in range(n)] + [("b", 2, 9)], "p string, b long, x long")
    found = numbered(rows, ["p"], "b", [F.col("x")], "n", run=4).collect()
    assert sorted((r.p, r.n) for r in found) == [("a", i) for i in range(41)] + [("b", 0)]
    by_n = {r.n: (r.b, r.x) for r in found if r.p == "a"}
    assert [by_n[i] for i in range(41)] == sorted(by_n.values())


def test_empty_table(spark, tmp_path):
    sf = saved(spark, tmp_path, documents=docs(spark, []))
    found = sharding.op13_sharding(spark, sf)
    assert found.count() == 0 and found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_stored_folders_hold_all_rows_and_columns(spark, tmp_path):
    table = docs(spark, [(i, f"t{i}") for i in range(50)]).withColumn("row", F.lit(1)).withColumn("spot", F.lit("x"))
    tree = sharding.grid(4, planned=4, regions=2, racks=1)
    sharding.stored(table, tree, f"{tmp_path}/out", files=2, rows=10)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert set(back.columns) == {*table.columns, "shard"}
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(i, brute(str(i), tree)) for i in range(50)}
    assert sharding.slots(table, tree, tree).count() == 50
