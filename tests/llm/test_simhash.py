import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sievework.llm import simhash

from .helpers import HARD, docs


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((str(d), f"{f:016x}", str(least.get(root(i)))) for i, ((d, _), f) in enumerate(zip(rows, fps, strict=True)))


def result(df):
    got = df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fp"), "component_id").collect()
    return sorted((str(r.doc_id), r.fp, str(r.component_id)) for r in got)


def test_hard_cases_and_near_copies(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = list(HARD)
    for g in range(6):
        base = [rnd.choice(words) for _ in range(400)]
        for k in range(12):
            own = list(base)
            for _ in range(k % 4):
                own[rnd.randrange(400)] = rnd.choice(words)
            rows.append((100 * (g + 1) + k, " ".join(own)))
    assert result(simhash.groups(docs(spark, [(a, b) for a, b in rows]))) == brute_components(rows)


def test_real_documents(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert result(simhash.groups(df)) == brute_components(rows)


def test_shared_shard_key_dealt_to_tasks(spark):
    rnd = random.Random(5)
    base = rnd.getrandbits(64)
    fps = {base}
    while len(fps) < 400:
        x = base
        for _ in range(rnd.randrange(1, 6)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(300)}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for most in (16, 10_000):
        roots = {r.node: r.root for r in simhash.components(simhash.links(df, len(signed), most=most)).collect()}
        label = {f: f for f in signed}

        def root(f, label=label):
            while label[f] != f:
                f = label[f]
            return f

        for i, a in enumerate(signed):
            for b in signed[:i]:
                if bin((a ^ b) & (2**64 - 1)).count("1") <= 4:
                    x, y = root(a), root(b)
                    label[max(x, y)] = min(x, y)
        assert {f: roots.get(f, f) for f in signed} == {f: root(f) for f in signed}


@pytest.mark.parametrize("n", [10, 10**8, 10**12])
def test_scheme_covers_every_pair_within_the_radius(n):
    keys = simhash.scheme(n)
    rnd = random.Random(n)
    for _ in range(2000):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), 4):
            b ^= 1 << bit
        assert any(all((a >> s) & ((1 << w) - 1) == (b >> s) & ((1 << w) - 1) for s, w in key) for key in keys)


def test_dedup_keeps_one_row_of_each_group(spark):
    df = docs(spark, HARD)
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    groups = {str(r.component_id) for r in simhash.groups(df).collect()}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(groups)


def test_dedup_tells_rows_apart_by_id_and_text(spark):
    long = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"]
    rows = [(None, long[0]), (None, long[1]), (1, long[2]), (1, long[3]), (2, long[4]), (None, long[4]), (0, long[5]), (2, long[5]), (None, long[0]), (1, long[3])]
    kept = simhash.deduplicated(docs(spark, rows)).collect()
    expected = [(None, long[0]), (None, long[1]), (1, long[2]), (1, long[3]), (2, long[4]), (0, long[5])]
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(d), t) for d, t in expected)


def test_empty_table(spark):
    df = docs(spark, HARD).limit(0)
    assert simhash.groups(df).count() == 0 and simhash.deduplicated(df).count() == 0


def test_a_very_long_text_and_columns_of_any_name(spark):
    text = "one two three four five six seven " * 150_000
    df = docs(spark, [(1, text), (2, text + "eight"), (3, "something else that is short enough"), (4, None)]).withColumnsRenamed({"lang": "fp", "source": "mark"})
    assert result(simhash.groups(df)) == brute_components([(r.doc_id, r.text) for r in df.collect()])
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
