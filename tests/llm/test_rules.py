import re

import numpy as np
from pyspark.sql import functions as F

from sievework.llm import rules

from .helpers import HARD, docs, saved, thue_morse

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i : i + 5]), []).append(i)
    repeated = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), failed


def test_counts_of_hard_and_real_texts(spark, data, tmp_path):
    real = [(r.doc_id + 10_000, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    rows = [*HARD, (50, "a b c d e\na b c d e\n\n \n x"), (51, "# | <b> $5 & %\n# | <b> $5 & %"), *real]
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (51, None, 0)], "doc_id long, quality int, toxic int")
    folder = saved(spark, tmp_path, documents=docs(spark, rows), labels=labels)
    found = rules.op8_quality_rules(spark, folder).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert got == sorted((str(d), *brute(t)) for d, t in rows)
    assert not any(r.kept and r.base_failed for r in found)


def test_labels_decide_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    learned = F.pmod(F.xxhash64("doc_id", F.lit("split")), F.lit(2)) == 0
    model = rules.fitted(d.where(learned), labels.where(learned))
    found = rules.judged(d.where(~learned), model).join(labels, "doc_id").collect()
    good = [r.kept for r in found if r.quality == 1 and r.toxic == 0 and not r.base_failed]
    bad = [r.kept for r in found if r.quality == 0]
    assert len(good) > 1000 and np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_partitions_do_not_change_verdicts(spark):
    sf = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = []
    for df in (d, d.repartition(7, "text"), d.orderBy(F.desc("doc_id")).coalesce(1)):
        rows = rules.judged(df, rules.fitted(df, labels.repartition(3), sample=300, labelled=200))
        found.append(sorted((r.doc_id, r.anomaly, r.kept) for r in rows.collect()))
    assert found[0] == found[1] == found[2]


def forest_score(forest, row):
    """Path lengths by walking each tree."""
    total = 0.0
    for column, cut, path in zip(forest.column, forest.cut, forest.path, strict=True):
        node = 0
        while np.isfinite(cut[node]):
            node = 2 * node + (2 if row[column[node]] > cut[node] else 1)
        total += path[node]
    return 2.0 ** (-total / len(forest.path) / rules.usual_path(forest.size))


def test_scores_are_those_of_path_lengths():
    rnd = np.random.default_rng(3)
    rows = np.concatenate((rnd.normal(0, 1, (500, 3)), [[9.0, 9, 9], [0, 0, 9]]))
    forest = rules.IsolationForest(rows)
    scores = forest.scores(rows)
    assert np.allclose(scores, [forest_score(forest, r) for r in rows])
    assert scores.argmax() == 500 and (scores > scores[501]).sum() < 25


def test_thresholds_keep_the_share_and_ties():
    scores, good = np.array([0.1, 0.2, 0.2, 0.5, 0.6, 0.7]), np.array([True, True, True, True, False, False])
    assert 0.5 <= rules.calibrated(scores, good, keep=1.0) < 0.6
    assert rules.calibrated(scores, np.ones(6, bool)) == rules.DEFAULT
    model = rules.Model([([0], type("F", (), {"scores": lambda self, x: np.full(len(x), 0.5)})(), 0.5)])
    counts = {k: np.array([20]) for k in rules.COUNTS} | {"n_repeat_words": np.array([0])}
    assert model.verdicts(counts)[2].tolist() == [True]  # a score on the threshold stays


def test_a_very_long_text_and_other_columns(spark, tmp_path):
    text = "many different words make up this text\n" * 100_000
    d = docs(spark, [*HARD, (99, text)]).withColumnsRenamed({"lang": "quality", "source": "part"})
    folder = saved(spark, tmp_path, documents=d, labels=spark.createDataFrame([(99, 0, 0)], "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in rules.op8_quality_rules(spark, folder).collect()}[99]
    assert (got.n_words, got.n_dup_lines, got.n_repeat_words, got.base_failed) == (700_000, 99_999, 700_000, True)


def test_empty_and_unlabelled(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    d = docs(spark, HARD)
    assert rules.judged(d, rules.fitted(d, labels)).count() == len(HARD)
    assert rules.judged(d.limit(0), rules.fitted(d.limit(0), labels)).count() == 0


def test_words_that_polynomials_confuse(spark, tmp_path):
    x, y = thue_morse()
    text = f"{x} one two three four {y} one two three four " + " ".join(f"w{i}" for i in range(20))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    [r] = rules.op8_quality_rules(spark, saved(spark, tmp_path, documents=docs(spark, [(1, text)]), labels=labels)).collect()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text) and r.n_repeat_words == 0


def test_models_come_from_all_rows(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, " ".join("x" * k + "#" * (i % 97 == 0) for k in rnd.integers(1, 9, rnd.integers(9, 30)))) for i in range(8000)]
    labels = spark.createDataFrame([(i, int(i % 97 > 0 or i % 2), 0) for i in range(8000)], "doc_id long, quality int, toxic int")
    d = docs(spark, rows).repartition(5)
    model = rules.fitted(d, labels)
    counts = rules._counts(d, ["doc_id"]).toPandas()
    c = {k: counts[k].to_numpy() for k in rules.COUNTS}
    passed = ~rules.base_failed(c)
    x, good = rules.features(c)[passed], np.array([i % 97 > 0 or i % 2 for i in counts["doc_id"]], bool)[passed]
    for columns, forest, threshold in model.parts:
        own = rules.IsolationForest(x[:, columns])
        scores = own.scores(x[:, columns])
        assert np.array_equal(forest.scores(x[:, columns]), scores)
        assert threshold == rules.calibrated(np.round(scores, rules.DIGITS), good)
