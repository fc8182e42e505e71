from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sievework.llm import langid
from sievework.llm.common import Texts

from .helpers import HARD, docs, saved


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf}/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in df.select("doc_id", "lang", "text").collect()}
    found = langid.op1_language_id(spark, sf).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in found if r.held_out]) > 0.97


def test_gradient():
    rnd = np.random.default_rng(0)
    net = langid.Network(["a", "b", "c"])
    x, y = rnd.integers(0, 256, (6, 20), dtype=np.uint8), rnd.integers(0, 3, 6)

    def loss():
        pooled = []
        for f in net.filters:
            length = x.shape[1] - len(f) + 1
            pooled.append(sum(net.embedding[x][:, j : j + length].astype(float) @ f[j] for j in range(len(f))).max(axis=1))
        p = langid.softmax(np.tanh(np.concatenate(pooled, axis=1)) @ net.out + net.bias)
        return -np.log(p[np.arange(6), y]).mean()

    gradients = net._gradients(x, y)
    for weights, gradient in zip(net._weights(), gradients, strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        old, step = weights[at], 1e-3
        weights[at] = old + step
        up = loss()
        weights[at] = old - step
        down = loss()
        weights[at] = old
        assert abs((up - down) / (2 * step) - gradient[at]) < 0.05 * abs(gradient[at]) + 1e-4


def test_hard_rows(spark, tmp_path):
    rows = [*((d, t) for d, t in HARD), (60, "12 34 !?"), (61, "日本語"), (62, "no language", None, None)]
    folder = saved(spark, tmp_path, documents=docs(spark, rows))
    found = {str(r.doc_id): r for r in langid.op1_language_id(spark, folder).collect()}
    assert {found[k].lang_pred for k in ("1", "2", "3", "60")} == {"und"}
    assert {found[k].lang_pred for k in ("4", "7", "61", "None")} == {"en"}


def test_nothing_to_learn_from(spark):
    df = docs(spark, [(1, "some text", None, None)])
    assert langid.trained(df) is None and langid.trained(df.limit(0)) is None
    assert langid.predicted(df, None).first()["__lang"] == "und"
    assert langid.accepted(df, None).columns == df.columns


def test_predictions_are_those_of_the_network_window_by_window():
    rnd = np.random.default_rng(1)
    net = langid.Network(["a", "b", "c"])
    net.out = rnd.normal(0, 1, net.out.shape)
    texts = ["", "x", "some words é " * 5, "y" * langid.WINDOW, "z " * 500]
    best, score = langid.Predictor(net).texts(Texts(pa.array(texts)))
    for i, text in enumerate(texts):
        data, total = text.encode(), np.zeros(3)
        for at in range(0, len(data), langid.WINDOW):
            piece = data[at : at + langid.WINDOW]
            x = np.frombuffer(piece.ljust(langid.WINDOW, b"\0"), np.uint8)[None]
            pooled = [sum(net.embedding[x][:, j : j + x.shape[1] - len(f) + 1].astype(float) @ f[j] for j in range(len(f))).max(axis=1) for f in net.filters]
            total += langid.softmax(np.tanh(np.concatenate(pooled, axis=1)) @ net.out + net.bias)[0] * len(piece)
        if data:
            assert best[i] == total.argmax() and abs(score[i] - total.max() / len(data)) < 1e-3


def test_least_score_nulls_names_and_a_long_text(spark, tmp_path):
    rows = [(k, "the house and the garden are very green today " * 5, "en", "s") for k in range(60)] + [(100 + k, "la maison et le jardin sont très verts " * 5, "fr", "s") for k in range(60)]
    rows += [(None, "the garden", "en", None), (1, None), (2, ""), (3, "12 !"), (500, "the house and the garden are very green " * 60_000, "en", "s"), (1, rows[0][1])]
    df = docs(spark, rows).withColumnsRenamed({"source": "__lang", "n_chars": "__score"})
    network = langid.trained(df)
    kept = langid.accepted(df, network, least=0.0)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3
    scores = langid.predicted(docs(spark, rows), network)
    sure = scores.where(f"__score >= {langid.LEAST_SCORE} and __lang <> 'und'").count()
    assert langid.accepted(df, network).count() == sure
    folder = saved(spark, tmp_path, documents=docs(spark, rows).limit(0))
    assert langid.op1_language_id(spark, folder).count() == 0


def test_rows_of_one_id_do_not_exceed_the_bound(spark):
    many = spark.range(20_000).select(F.lit(135).cast("long").alias("doc_id"), F.concat(F.lit("wort "), F.col("id")).alias("text"), F.lit("de").alias("lang"))
    same = spark.range(20_000).select(F.lit(136).cast("long").alias("doc_id"), F.lit("the same words").alias("text"), F.lit("en").alias("lang"))
    seen = []
    train, langid.Network.train = langid.Network.train, lambda self, windows, labels, **_: seen.append(labels)
    try:
        langid.trained(many.union(same), rows=100, windows=2)
    finally:
        langid.Network.train = train
    assert 20 <= len(seen[0]) <= 400 and set(seen[0].tolist()) == {0, 1}
