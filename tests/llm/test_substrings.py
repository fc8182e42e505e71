import hashlib
import random
from collections import defaultdict

import numpy as np

from sievework.llm import substrings, suffix

from .helpers import HARD, docs, saved


def test_suffix_array():
    rnd = random.Random(1)
    for _ in range(1500):
        s = [rnd.randrange(1, rnd.choice([2, 3, 6]) + 1) for _ in range(rnd.randrange(0, 40))] + [0]
        assert suffix.suffix_array(np.array(s)) == sorted(range(len(s)), key=lambda i: s[i:])


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - 199):
            seen[t[p : p + 200]].append((i, p))
    gone = [bytearray(len(t)) for t in texts]
    for held in seen.values():
        if len(held) > 1:
            for i, p in held:
                gone[i][p : p + 200] = b"\1" * 200
    out = []
    for (d, _), t, g in zip(rows, texts, gone, strict=True):
        spans = sum(1 for i in range(len(g)) if g[i] and (not i or not g[i - 1]))
        kept = bytes(b for b, x in zip(t, g, strict=True) if not x)
        out.append((str(d), len(t), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def cases(seed=6):
    rnd = random.Random(seed)
    words = [f"{rnd.choice('abcdefgh')}{i}é"[: rnd.randrange(2, 6)] for i in range(200)]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    shared = [prose(60) for _ in range(5)] + [prose(400)]
    rows = list(HARD)
    for k in range(50):
        parts = [prose(rnd.randrange(0, 80))]
        for _ in range(rnd.randrange(0, 3)):
            s = rnd.choice(shared)
            cut = rnd.randrange(0, 60)
            parts += [s[cut : len(s) - rnd.randrange(0, 60)], prose(rnd.randrange(0, 40))]
        rows.append((100 + k, "".join(parts)))
    base = prose(300)
    for k in range(8):
        own = base.split(" ")
        for _ in range(k):
            own[rnd.randrange(len(own))] = rnd.choice(words)
        rows.append((300 + k, " ".join(own)))
    rows += [(400, "ab" * 300), (401, "ab" * 101), (402, "xyz " * 49 + "xyz"), (403, prose(30) + "q" * 199), (404, "q" * 199 + prose(5)), (405, "r" * 200), (406, "s" * 201)]
    rows += [(500, base[:200]), (501, base[1:201]), (502, base[5:204]), (310, rows[-1][1]), (310, base), (310, base)]
    return rows


def test_against_brute_force(spark, tmp_path):
    rows = cases()
    folder = saved(spark, tmp_path, documents=docs(spark, rows).repartition(4))
    assert got(substrings.op2_suffix_dedup(spark, folder)) == brute(rows)


def test_cores_in_finer_cells(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(substrings, "MOST", 3)
    rows = cases(7)
    folder = saved(spark, tmp_path, documents=docs(spark, rows))
    assert got(substrings.op2_suffix_dedup(spark, folder)) == brute(rows)


def test_real_documents(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert got(substrings.op2_suffix_dedup(spark, data)) == brute(rows)


def test_cleaned_keeps_columns_and_characters(spark):
    text = "é" * 150 + "ü"
    df = docs(spark, [(1, "a" + text), (2, "b" + text), (3, "fine words stay"), (4, None), (5, "z" * 300), (6, "z" * 300)])
    kept = substrings.cleaned(df)
    assert kept.columns == df.columns
    found = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert found == {1: ("a", 1), 2: ("b", 1), 3: ("fine words stay", 15), 4: ("", 0)}


def test_empty(spark):
    assert substrings.cleaned(docs(spark, HARD).limit(0)).count() == 0


def test_a_long_text_whose_passage_lies_over_the_border_of_stretches(spark, tmp_path):
    rnd = random.Random(12)
    noise = lambda n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    shared = noise(400)
    for shift in (0, 37):
        head = noise(substrings.STRETCH - 200 - shift)
        rows = [(1, head + shared + noise(700_000)), (2, "x" + shared + "y"), (3, noise(3000))]
        folder = saved(spark, tmp_path, documents=docs(spark, rows))
        found = {r.doc_id: (r.n_removed, r.n_spans) for r in substrings.op2_suffix_dedup(spark, folder).collect()}
        assert found == {1: (400, 1), 2: (400, 1), 3: (0, 0)}


def test_equal_contexts_are_found_by_the_suffix_array():
    contexts = [(1, b"abc", b"xyz", 4, 2), (1, b"qbc", b"xyq", 4, 1), (2, b"abc", b"xyz", 4, 1)]
    # strings of 4 symbols: the first context repeats in whole, the second shares what lies inside both
    assert substrings.repeated(contexts) == [0b1111, 0b0110, 0]


def test_columns_of_any_name(spark):
    df = docs(spark, [(1, "a" * 300), (2, None)]).withColumnsRenamed({"lang": "row", "source": "first"})
    kept = substrings.cleaned(df.union(df))
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2"]


def test_empty_table_through_the_query(spark, tmp_path):
    assert substrings.op2_suffix_dedup(spark, saved(spark, tmp_path, documents=docs(spark, HARD).limit(0))).count() == 0
