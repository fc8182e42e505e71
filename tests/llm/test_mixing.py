import random
import time
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from sievework.llm import mixing

from .helpers import HARD, docs, saved


def test_highest_quotients():
    rnd = random.Random(2)
    for _ in range(150):
        votes = [rnd.choice([0, 1, 5, 7, 100, 1000, rnd.randrange(1, 5000)]) for _ in range(rnd.randrange(1, 9))]
        seats = rnd.randrange(0, 300)
        given = [0] * len(votes)
        if sum(votes):
            for _ in range(seats):
                best = max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * given[i] + 1), -i))
                given[best] += 1
        assert mixing.sainte_lague(np.array(votes), seats).tolist() == given


def test_no_more_than_most():
    rnd = random.Random(5)
    for _ in range(150):
        votes = np.array([rnd.randrange(0, 3000) for _ in range(rnd.randrange(1, 9))])
        most = 2 * np.maximum(1, (votes + 8) // 16)
        given = mixing.sainte_lague(votes, rnd.randrange(0, 2 * int(most.sum())), most)
        assert (given <= most).all() and (given[votes == 0] == 0).all()


def test_tiny_sources_stop_at_twice_their_size(spark, tmp_path):
    rows = [(k, "w " * (k % 40), "en", f"s{k % 7}") for k in range(60)] + [(100 + k, "v " * 500, "en", "t") for k in range(30)]
    got = mixing.op4_source_mix(spark, saved(spark, tmp_path, documents=docs(spark, rows))).collect()
    assert all(r.taken <= 2 * r.size for r in got)
    full = [r for r in got if r.target == 2 * r.source_size]
    assert full and sum(r.taken for r in full) >= 0.95 * sum(2 * r.size for r in full)


def test_targets_fill_up():
    assert mixing.targets([100, 100, 100], [3, 1, 2]) == [200.0, 250 / 3, 500 / 3]
    got = mixing.targets([10, 1000, 0, 50], [3, 1, 2, 3])
    assert got[0] == 20 and got[2] == 0 and got[3] == 100 and abs(sum(got) - 1590) < 1e-9


def check(spark, rows, tolerance):
    sizes, bound = {}, {}
    for r in rows:
        sizes.setdefault(r.target, r.source_size)
        bound[(r.target, r.source_size)] = bound.get((r.target, r.source_size), 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    for (target, _), got in bound.items():
        assert abs(got - target) <= tolerance(target)


def test_hard_rows(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(d, t, "en", None) for d, t in HARD]
    rows += [(100 + k, "w " * rnd.randrange(0, 300), "en", rnd.choice(["a", "b", "é", "hot", "hot", "hot"])) for k in range(400)]
    folder = saved(spark, tmp_path, documents=docs(spark, rows))
    found = mixing.op4_source_mix(spark, folder)
    got = found.collect()
    assert len(got) == len(rows)
    check(spark, got, lambda t: 16 + 0.01 * t)
    assert sorted(map(str, got)) == sorted(map(str, mixing.op4_source_mix(spark, folder).collect()))


def test_real_sources_and_document_columns(spark, data):
    got = mixing.op4_source_mix(spark, data).collect()
    check(spark, got, lambda t: 16 + 0.01 * t)
    d = spark.read.parquet(f"{data}/documents.parquet")
    kept = mixing.mixed(d)
    assert kept.columns[: len(d.columns)] == d.columns
    assert sorted((r.doc_id, r.taken) for r in kept.collect()) == sorted((r.doc_id, r.taken) for r in got if r.taken)


def test_empty(spark):
    assert mixing.mixed(docs(spark, HARD).limit(0)).count() == 0


def brute_taken(rows, sources):
    """taken of each row, from the quotas of shards, block by block. sources: key -> (unit, quotas by shard)."""
    out = {}
    for (key, shard), held in rows.items():
        unit, quota, n, turn = sources[key, shard]
        tokens = [i for i, r in enumerate(held) for _ in range(r.size)]
        block = [min(t // unit, n - 1) for t in range(len(tokens))]
        times = [quota // n + ((mixing._STEP % n * b + turn) % n < quota % n) for b in range(n)]
        for t, i in enumerate(tokens):
            out[key, shard, i] = out.get((key, shard, i), 0) + times[block[t]]
    return out


def test_taken_against_blocks_one_by_one(spark):
    rnd = random.Random(8)
    rows = [(k, "w " * rnd.choice([0, 1, 5, 17, 90, 700]), "en", rnd.choice(["a", "b", None])) for k in range(300)]
    d = docs(spark, rows + rows[:20])
    got = mixing.taken(mixing.measured(d))
    held, known = {}, {}
    for r in mixing.measured(d).withColumn("turn", F.xxhash64("key", F.lit(0).cast("long"), F.lit(mixing.SEED))).orderBy("doc_id", "mark", "size").collect():
        held.setdefault((r.key, 0), []).append(r)
    goals = {r.source_size: r.target for r in got.collect()}
    order = sorted(held, key=lambda k: (k[0] == "", k[0]))
    sizes = [sum(r.size for r in held[k]) for k in order]
    for k, words, tokens in zip(order, sizes, mixing.apportioned([goals[s] for s in sizes]), strict=True):
        unit = max(1, min(mixing.BLOCK, words // mixing.FINE))
        n = max(1, (words + unit // 2) // unit)
        known[k] = (unit, min(round(tokens / unit), 2 * n), n, held[k][0].turn % n)
    expected = brute_taken(held, known)
    found = sorted((r.doc_id, r.mark, r.size, r.taken) for r in got.collect())
    assert found == sorted((r.doc_id, r.mark, r.size, expected.get((*k, i), 0)) for k in order for i, r in enumerate(held[k]))


def test_a_tiny_source_beside_a_large_one(spark):
    rows = spark.range(150_000).selectExpr("id as doc_id", "if(id < 100, repeat('w ', 5), repeat('v ', 9)) as text", "if(id < 100, 'a', 'z') as source")
    got = mixing.taken(mixing.measured(rows)).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(got) == 2 and all(abs(r.taken - r.target) <= 16 + 0.01 * r.target for r in got)


def test_quotas_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 10)
    monkeypatch.setattr(mixing, "FAN", 4)
    rnd = random.Random(9)
    rows = [(k, "w " * rnd.randrange(0, 200), "en", rnd.choice("aaab")) for k in range(500)]
    got = mixing.taken(mixing.measured(docs(spark, rows))).collect()
    assert len(got) == 500
    check(spark, got, lambda t: 16 + 0.02 * t)


def test_empty_table_through_the_query_and_a_long_text(spark, tmp_path):
    folder = saved(spark, tmp_path, documents=docs(spark, HARD).limit(0))
    assert mixing.op4_source_mix(spark, folder).count() == 0
    folder = saved(spark, tmp_path, documents=docs(spark, [(1, "word " * 400_000), (2, "other " * 100, "en", "b"), (3, None, "en", None)]))
    got = {r.doc_id: r for r in mixing.op4_source_mix(spark, folder).collect()}
    assert got[1].size == 400_000 and abs(got[1].taken - got[1].target) < 40 and 196 <= got[2].taken <= 200 and got[3].taken == 0


def test_columns_of_any_name(spark):
    d = docs(spark, HARD).withColumnsRenamed({"lang": "shard", "n_chars": "size"})
    kept = mixing.mixed(d)
    assert kept.columns == ["doc_id", "text", "shard", "source", "size", "source_size", "target", "taken"]
    assert kept.count() > 0


def test_targets_of_a_million_sources_take_seconds():
    rnd, began = random.Random(1), time.monotonic()
    sizes = [int(10 ** rnd.uniform(0, 5)) for _ in range(1_000_000)]
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    assert time.monotonic() - began < 20
    assert abs(sum(got) / (1.5 * sum(sizes)) - 1) < 1e-9 and all(g <= 2 * s + 1e-6 for g, s in zip(got, sizes, strict=True))
    free = [g / w for g, w, s in zip(got, weights, sizes, strict=True) if g < 2 * s]
    assert max(free) - min(free) < 1e-6 * max(free)
