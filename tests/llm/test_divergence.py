import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import divergence
from sievework.llm.divergence import audited, share, shares

from .helpers import HARD, docs, saved


def brute(rows, least=3, ranks=200):
    """rows: (text, lang, source)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(lower)), a or "", s or "") for t, a, s in rows]
    out = set()
    for lang in {a for _, a, _ in rows}:
        df = Counter(w for ws, a, _ in rows if a == lang for w in set(ws))
        kept = [w for w, n in df.items() if n >= least]
        n = defaultdict(Counter)
        for ws, a, s in rows:
            if a == lang:
                n[s].update(w for w in ws if df[w] >= least)
        total = sum(n.values(), Counter())

        def p(c, w):
            return 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        def f(a, b):
            return (a - b) ** 2 // b

        for s in n:
            pair = [(-sum(f(p(n[s], w), p(n[o], w)) for w in kept), o) for o in n if o != s]
            term = [(-f(p(n[s], w), p(total, w)), w) for w in kept if n[s][w] and p(n[s], w) > p(total, w)]
            for part, found, most in (("pair", pair, None), ("term", term, ranks)):
                order = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(order)}
    return out


def invented(n=160, seed=5):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma9delta", "été", "naïve", "x", "Rome", "straße", "日本"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(5)]
    return [(" ".join(rng.choices(words[i % 5 :], k=rng.randint(0, 30))), rng.choice(["en", "de"]), f"s{rng.choice([0, 0, 0, *range(9)])}") for i in range(n)]


@pytest.mark.parametrize(("block", "chunk", "span"), [(32, 4096, 16), (2, 3, 2), (1, 1, 1)])
def test_equals_brute_force(spark, block, chunk, span):
    rows = invented()
    table = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    found = audited(table, block=block, chunk=chunk, span=span, ranks=7).collect()
    assert len(found) == len(set(found)) and set(map(tuple, found)) == brute(rows, ranks=7)


def test_query_on_hard_rows(spark, tmp_path):
    rows = [*HARD, *[(20, "the same words here", "fr", f"s{i % 3}") for i in range(40)], (21, None, None, None), (22, "word " * 30_000, None, "s1"), (23, "1234", "zz", "a"), (24, "", "zz", None), (25, "!", "zz", "b")]
    sf = saved(spark, tmp_path, documents=docs(spark, rows).withColumn("term", F.lit("x")).withColumn("n", F.lit(1)))
    found = divergence.op12_source_divergence(spark, sf)
    full = [(r[1], *(r[2:] or ("en", "s0"))) for r in rows]
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert set(map(tuple, found.collect())) == brute(full)
    assert {(r.source, r.item, r.value) for r in found.where("lang = 'zz'").collect()} == {(a, b, 0) for a in ("", "a", "b") for b in ("", "a", "b") if a != b}


def test_empty_table(spark, tmp_path):
    assert divergence.op12_source_divergence(spark, saved(spark, tmp_path, documents=docs(spark, []))).count() == 0


def test_one_source_has_terms_but_no_pairs(spark):
    found = audited(spark.createDataFrame([("a b", "en", "s")] * 4, "text string, lang string, source string"))
    assert found.count() == 0  # its shares are those of the language


def test_shares_of_large_counts(spark):
    cases = [(0, 1), (0, 7), (6, 7), (10**12, 10**13 + 7), (8_999_999_999_999_998, 9 * 10**15 - 1), (5 * 10**9, 5 * 10**9 + 3)]
    expected = [1 + 10**9 * (n + 1) // w for n, w in cases]
    assert shares(np.array([n for n, _ in cases]), np.array([w for _, w in cases])).tolist() == expected
    table = spark.createDataFrame(cases, "n long, w long")
    assert [r.p for r in table.select(F.expr(share("n", "w")).alias("p")).collect()] == expected


def test_counts_are_written_before_they_are_many(spark):
    rows = invented(60)
    table = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    few, many = (sorted(map(tuple, divergence.counted(table, held=h).collect())) for h in (5, 1 << 18))
    assert few == many
