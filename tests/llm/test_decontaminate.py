import hashlib
import random
import re

from pyspark.sql import functions as F

from sievework.llm import decontaminate

from .helpers import HARD, docs, saved

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items):
    def words(t):
        return WORD.findall((t or "").encode().lower())

    windows = [(str(i), tuple(w[k : k + 13])) for i, t in items for w in [words(t)] if w for k in range(max(1, len(w) - 12))]
    out = []
    for d, t in rows:
        w, hit, names = words(t), set(), set()
        for name, x in windows:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit |= set(range(k, k + len(x)))
                    names.add(name)
        out.append((str(d), len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def got(spark, folder):
    df = decontaminate.op5_decontaminate(spark, folder)
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def cases():
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "a", "bb"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 12, 13, 14, 40])))) for i in range(25)]
    items += [(3, items[3][1]), (90, None), (91, ""), (92, "..."), (93, "ü"), (94, "The quick brown fox")]
    rows = list(HARD)
    for k in range(60):
        parts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 200)))]
        if k % 2:
            parts.append(rnd.choice(items)[1] or "")
        parts.append(", ".join(rnd.choice(vocabulary) for _ in range(30)).upper())
        rows.append((1000 + k, "-".join(parts)))
    return rows, items


def test_against_brute_force(spark, tmp_path):
    rows, items = cases()
    folder = saved(spark, tmp_path, documents=docs(spark, rows), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    assert got(spark, folder) == brute(rows, items)


def test_benchmark_in_slices(spark):
    rows, items = cases()
    d, b = docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    one = decontaminate.judged(d, b).select("doc_id", "__words", "__n_hit", "__items")
    many = decontaminate.judged(d, b, slice_bytes=1500).select("doc_id", "__words", "__n_hit", "__items")
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_empty_tables(spark):
    d, b = docs(spark, HARD), spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontaminate.clean(d.limit(0), b).count() == 0
    assert decontaminate.clean(d, b.limit(0)).count() == len(HARD)
    assert decontaminate.clean(d, b).columns == d.columns


def test_real_documents(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").limit(120).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    found = {r[0]: r for r in got(spark, data)}
    expected = brute(rows, items)
    assert [found[r[0]] for r in expected] == expected
    assert any(r[5] for r in found.values())


def test_very_long_words_and_items(spark, tmp_path):
    giant, long = "x" * 70_000, " ".join(f"v{i % 977}" for i in range(60_000))
    items = [(1, giant), (2, long), (3, "é" * 40_000 + " z")]
    rows = [(1, f"a {giant} b"), (2, f"{giant}x"), (3, long), (4, " ".join(f"v{i % 977}" for i in range(500))), (5, "é" * 40_000 + " Z!"), (6, None)]
    b = spark.createDataFrame(items, "item_id long, text string")
    folder = saved(spark, tmp_path, documents=docs(spark, rows), benchmark=b)
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.op5_decontaminate(spark, folder).collect()}
    assert found == {1: (3, 1, 1), 2: (1, 0, 0), 3: (60_000, 60_000, 1), 4: (500, 500, 1), 5: (2, 2, 1), 6: (0, 0, 0)}
    sliced = decontaminate.judged(docs(spark, rows), b, slice_bytes=150_000).select("doc_id", "__words", "__n_hit", F.size("__items"))
    assert {r[0]: tuple(r)[1:] for r in sliced.collect()} == found


def test_clean_keeps_columns_of_any_name(spark):
    d = docs(spark, HARD).withColumnsRenamed({"n_chars": "__hits", "lang": "mark"})
    b = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    for slice_bytes in (4 << 20, 10):
        kept = decontaminate.clean(d, b) if slice_bytes > 10 else decontaminate.clean(d, b.union(spark.createDataFrame([(2, "no such words " * 30)], b.schema)))
        assert kept.columns == d.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in HARD if r[1] != "one two three four")
