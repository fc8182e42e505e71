import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.llm import resampling
from sievework.llm.common import Texts
from sievework.llm.resampling import Grams

from .helpers import HARD, docs, saved


def words(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(lower))


def features(text, longest):
    ws = words(text)
    return [" ".join(ws[i : i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]


def brute(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, longest))
    t = Counter(bucket(f) for x in target for f in features(x, longest))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for i, text in rows:
        fs = features(text, longest)
        weight = math.floor(sum(gain(bucket(f)) for f in fs) / len(fs)) if fs else 0
        u = (int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log(u))), None, len(words(text)) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def invented(n, seed=3):
    rng = random.Random(seed)
    pool = ["Alpha", "beta2", "été", "x", "日本", *(f"w{i}" for i in range(40))]
    return [(i, " ,".join(rng.choices(pool[i % 7 :], k=rng.choice([0, 5, 25, 60])))) for i in range(n)]


@pytest.mark.parametrize("longest", [1, 2, 3, 5])
def test_runs_are_all_grams(longest):
    texts = [t for _, t in invented(40)] + ["", "one", "a a a a a a", "end of one", "one"]
    grams = Grams(Texts(pa.array(texts)), longest)
    beginnings = [tuple(grams.ids[p : p + min(longest, grams.left[p])]) for p in grams.array]
    assert beginnings == sorted(beginnings)
    for n in range(1, longest + 1):
        members, length, bucket = grams.runs(n, 1 << 32)
        expected = Counter(" ".join(ws[i : i + n]) for ws in map(words, texts) for i in range(len(ws) - n + 1))
        assert sorted(zip(bucket.tolist(), length.tolist())) == sorted((zlib.crc32(g.encode()), k) for g, k in expected.items())
        back = np.full(len(grams.ids), -1, np.int64)
        back[members] = np.repeat(bucket, length)
        for i, t in enumerate(texts):
            ws, a = words(t), grams.first[i]
            assert back[a : a + max(0, len(ws) - n + 1)].tolist() == [zlib.crc32(" ".join(ws[j : j + n]).encode()) for j in range(len(ws) - n + 1)]


@pytest.mark.parametrize(("longest", "buckets"), [(1, 10_000), (3, 50)])
def test_equals_brute_force(spark, longest, buckets):
    rows, target = invented(300), ["alpha w1 w2 w3", "Alpha x x", None, "日本 été"]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    gain = resampling.gains(resampling.counts(table, longest, buckets), resampling.counts(spark.createDataFrame([(t,) for t in target], "text string"), longest, buckets))
    scores = resampling.weighed(table, gain, longest, texts_too=False).select("row.doc_id", "n_words", "n_features", "weight", "score")
    found = resampling.ranked(scores, most=3).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, target, longest, buckets))


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_query_on_hard_rows_and_ties(spark, tmp_path):
    long = " ".join(f"w{i % 9}" for i in range(60_000))
    rows = [*HARD, *[(70, "same words over and over again " * 5) for _ in range(60)], *[(None, "no id but many words in here " * 4) for _ in range(30)], (71, long), *invented(60)]
    table = docs(spark, rows).withColumn("row", F.lit(1)).withColumn("key", F.lit("x"))
    sf = saved(spark, tmp_path, documents=table, benchmark=spark.createDataFrame([(1, "same words"), (2, None)], "item_id long, text string"))
    found = resampling.op11_resampling(spark, sf)
    assert dict(found.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute([(r[0], r[1]) for r in rows], ["same words"]), key=key)


def test_drawn_documents_are_those_with_a_rank(spark):
    rows = [*invented(150), *[(900, "again and again the same old words " * 4) for _ in range(40)]]
    target = spark.createDataFrame([("again the same",)], "text string")
    table = spark.createDataFrame([(i, t, "kept", 7) for i, t in rows], "doc_id long, text string, row string, Weight int")
    found = resampling.drawn(table, target, percent=25)
    assert found.columns == ["doc_id", "text", "row", "weight", "score"]
    assert Counter((r.doc_id, r.weight, r.score) for r in found.collect()) == Counter((r[0], r[2], r[3]) for r in brute(rows, ["again the same"], percent=25) if r[4])


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "item_id long, text string")
    found = resampling.op11_resampling(spark, saved(spark, tmp_path, documents=docs(spark, []), benchmark=none))
    assert found.count() == 0 and found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert resampling.drawn(docs(spark, []), none).count() == 0
    rows = invented(30)
    found = resampling.op11_resampling(spark, saved(spark, tmp_path, documents=docs(spark, rows), benchmark=none))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(rows, []), key=key)
