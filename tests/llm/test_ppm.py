import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from sievework.llm import ppm

from .helpers import HARD, docs, saved, thue_morse

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows):
    """Plain PPM with sets of excluded bytes, and the unigram base."""
    texts = [(t or "").encode().lower() for _, t in rows]
    out = [d is not None and crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    tokens, contexts = Counter(), defaultdict(Counter)
    for t, o in zip(texts, out, strict=True):
        if not o:
            tokens.update([*WORD.findall(t), None])
            s = b"\xfe" * 4 + t + b"\xff"
            for i in range(4, len(s)):
                for k in range(5):
                    contexts[s[i - k : i]][s[i]] += 1
    n, v = sum(tokens.values()), len(tokens)
    found = []
    for (d, _), t, o in zip(rows, texts, out, strict=True):
        own = [*WORD.findall(t), None]
        base = sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        s, score = b"\xfe" * 4 + t + b"\xff", 0.0
        for i in range(4, len(s)):
            gone = set()
            for k in range(4, -1, -1):
                here = {b: c for b, c in contexts.get(s[i - k : i], {}).items() if b not in gone}
                if not here:
                    continue
                whole = sum(here.values()) + len(here)
                if s[i] in here:
                    score += math.log10(here[s[i]] / whole)
                    break
                score += math.log10(len(here) / whole)
                gone |= set(here)
            else:
                score -= math.log10(256 - len(gone))
        found.append((str(d), o, len(own), sum(tokens[w] > 0 for w in own), n, base, score))
    return sorted(found)


def compare(df, rows):
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect())
    expected = brute(rows)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9, abs=1e-6)


def test_hard_rows(spark, tmp_path):
    rows = [*HARD, *((20 + k, f"some words {k} and others again {k * 7}") for k in range(40))]
    folder = saved(spark, tmp_path, documents=docs(spark, rows).repartition(3))
    compare(ppm.op3_ppm_score(spark, folder), rows)


def test_real_documents_in_blocks(spark, tmp_path, data, monkeypatch):
    df = spark.read.parquet(f"{data}/documents.parquet").where("length(text) < 4000").limit(60)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    monkeypatch.setattr(ppm, "LEAST_BLOCK", 10_000)
    folder = saved(spark, tmp_path, documents=docs(spark, rows))
    compare(ppm.op3_ppm_score(spark, folder), rows)


def test_nothing_trained_and_empty(spark):
    from pyspark.sql import functions as F

    rows = docs(spark, [(1, "ab"), (2, None)])
    found = {r.doc_id: r for r in ppm.scores(rows, F.lit(True)).collect()}
    assert found[1].n_known == 0 and found[1].base_score == 0 and found[1].score == pytest.approx(-3 * math.log10(256))
    assert ppm.scores(rows.limit(0), F.lit(False)).count() == 0


def test_words_that_polynomials_confuse_and_a_long_text(spark, tmp_path):
    x, y = thue_morse()
    rows = [(1, f"{x} a {x}"), (2, f"{y} b"), (3, "c d " * 40_000), (9, y), *[(4, "same row") for _ in range(20)]]
    found = {r.doc_id: r for r in ppm.op3_ppm_score(spark, saved(spark, tmp_path, documents=docs(spark, rows))).collect()}
    expected = {e[0]: e for e in brute([(d, t if d != 3 else None) for d, t in rows])}
    out = {d: crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    tokens = Counter()
    for d, t in rows:
        if not out[d]:
            tokens.update([*t.lower().split(), None])
    for d, t in rows:
        own = [*t.lower().split(), None]
        n, v = sum(tokens.values()), len(tokens)
        base = sum(k * math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w, k in Counter(own).items())
        r = found[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(tokens[w] > 0 for w in own), n) and math.isclose(r.base_score, base, rel_tol=1e-9)
    assert len(expected) == len(found)
