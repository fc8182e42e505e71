import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sievework.llm import classifier
from sievework.llm.common import Texts

from .helpers import HARD, docs, saved


def test_held_out_grades(spark):
    sf = "/root/testdata/sf0.1"
    found = classifier.op6_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r for r in found if r.quality == 1 and not r.toxic]
    low = [r for r in found if r.quality == 0 and not r.toxic]
    toxic = [r for r in found if r.toxic]
    assert np.mean([r.kept for r in good]) > 0.98
    assert np.mean([r.kept for r in low]) < 0.15 and np.mean([r.kept for r in toxic]) < 0.25
    means = [np.mean([r.expected_grade for r in x]) for x in (toxic, low, good)]
    assert means == sorted(means)


def test_gradient_raises_likelihood():
    texts = [f"word{i % 3} shared text" for i in range(60)]
    f, grades = classifier.Features(Texts(pa.array(texts))), np.arange(60) % 3
    model = classifier.Ordinal()
    model.fit(f, grades, epochs=60, lasso=0)
    above = model.above(model.scores(f))
    assert (np.round(above.sum(axis=1)) == grades).all() and model.cuts[0] <= model.cuts[1]


def test_hard_rows(spark, tmp_path):
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 1), (None, 1, 0), (8, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    folder = saved(spark, tmp_path, documents=docs(spark, HARD), labels=labels)
    found = classifier.op6_quality_classifier(spark, folder).collect()
    assert len(found) == len(HARD) and all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in found)


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    d = docs(spark, HARD)
    assert classifier.graded(d, classifier.fitted(d, labels)).count() == len(HARD)
    assert classifier.graded(d.limit(0), classifier.fitted(d.limit(0), labels)).count() == 0


def test_scores_and_tails_one_by_one():
    rnd = np.random.default_rng(2)
    texts = ["", "one", "one one two", "A LOUD text!! with 3 numbers", "é è " * 30]
    f, model = classifier.Features(Texts(pa.array(texts))), classifier.Ordinal()
    model.weights = rnd.normal(0, 1, len(model.weights))
    model.cuts = np.array([-0.5, 0.7])
    scores = model.scores(f)
    for i in range(len(texts)):
        own = range(f.bounds[i], f.bounds[i + 1])
        expected = sum(model.weights[f.buckets[k]] * f.values[k] for k in own)
        assert abs(scores[i] - expected) < 1e-9
        assert np.allclose(model.above(scores[i : i + 1])[0], 1 / (1 + np.exp(model.cuts - expected)))


def test_partitions_do_not_change_the_model_nor_a_long_text_break_it(spark):
    rows = [(k, f"plain words number {k} " * 10) for k in range(60)] + [(100 + k, f"junk ### {k} !!! " * 10) for k in range(60)] + [(999, "plain words " * 300_000), (5, None)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(60)] + [(100 + k, 0, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    d = docs(spark, rows).withColumnsRenamed({"lang": "tail", "source": "grade"})
    found = []
    for df, own in ((d, labels), (d.repartition(5, "text"), labels.repartition(3))):
        found.append(sorted(map(tuple, classifier.graded(df, classifier.fitted(df, own, rows=50)).collect()), key=str))
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_rows_of_one_id_do_not_exceed_the_bound(spark):
    table = spark.range(5_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("word"), F.col("id")).alias("text"))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    seen = []
    fit, classifier.Ordinal.fit = classifier.Ordinal.fit, lambda self, f, grades, **_: seen.append(len(grades))
    try:
        classifier.fitted(table, labels, rows=50)
    finally:
        classifier.Ordinal.fit = fit
    assert seen == [50]
