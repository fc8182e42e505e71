"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is a set of hashed words and a few hashed shapes of its tokens (all capitals, trailing marks, symbols, repeats of the token
before) with their share. One weight vector is shared by all grades; ordered thresholds cut its scale, so that
P(grade > k) = 1 / (1 + exp(threshold_k - score)). Expected grade and the probability of the upper grades select documents.

Grades of labelled rows: 0 toxic, 1 of low quality, 2 good. The regression is fitted in numpy on the driver (AdaGrad with soft
thresholding, so that most weights are zero) on the rows of `rows` labelled ids, the first in the order of a hash, and in the order of id and features, so
that partitions do not change it.

Edge cases: a null or empty text has no features and gets the score of the thresholds alone; labels with a null count as unlabelled;
rows with several labels take the lowest grade; without labels all thresholds are 0. Repeated rows get a row each; a tail equal to the bound selects. A text of any
length is scored whole: a task holds it with some 90 times its bytes. An empty table gives an empty result. Only doc_id and text are read, so other columns may
have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, joined, pieces, span_hashes, table, word_spans

ROWS, BITS, GRADES = 8000, 18, 3
SHAPES = 64  # buckets after the words' for shapes
#: The least probability of the best grade of a selected document.
LEAST_TAIL = 0.5

_ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_FOLD = np.array([32 if b < 128 and not chr(b).isalnum() else b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_UPPER = np.isin(np.arange(256), range(65, 91))
_LOWER = np.isin(np.arange(256), range(97, 123))


class Features:
    """Sparse rows: buckets[bounds[i]:bounds[i + 1]] with values; words have value 1."""

    def __init__(self, texts, bits: int = BITS) -> None:
        raw, starts_of = joined(texts)
        n = texts.n
        folded = _FOLD[raw]
        a, b = word_spans(folded)
        owner = np.searchsorted(starts_of, a, "right") - 1
        word = (span_hashes(folded, a, b) >> np.uint64(64 - bits)).astype(np.int64)
        pairs = np.unique(owner << bits | word)
        owners, buckets = pairs >> bits, pairs & ((1 << bits) - 1)

        a, b = word_spans(raw)
        token = np.searchsorted(starts_of, a, "right") - 1
        marks = np.concatenate(([0], np.cumsum(~_ALNUM[raw])))
        upper, lower = (np.concatenate(([0], np.cumsum(x[raw]))) for x in (_UPPER, _LOWER))
        hashes = span_hashes(raw, a, b)
        same = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (token[1:] == token[:-1]))) if len(a) else np.zeros(0, bool)
        shapes = [
            (upper[b] - upper[a] > 1) & (lower[b] == lower[a]),
            (marks[b] - marks[a] >= 2) & (marks[b] - marks[a] < b - a),
            marks[b] - marks[a] == b - a,
            same,
            b - a > 30,
        ]
        tokens = np.maximum(np.bincount(token, minlength=n), 1)
        share = [np.bincount(token, s, n) / tokens for s in shapes]
        extra = np.stack([np.ones(n), *(np.minimum(4.0, 8 * x) for x in share)], axis=1)
        owners = np.concatenate((owners, np.repeat(np.arange(n), extra.shape[1])))
        buckets = np.concatenate((buckets, np.tile((1 << bits) + np.arange(extra.shape[1]), n)))
        values = np.concatenate((np.ones(len(pairs)), extra.ravel()))
        order = np.argsort(owners, kind="stable")
        self.bounds = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=n))))
        self.buckets, self.values = buckets[order], values[order]


class Ordinal:
    def __init__(self, bits: int = BITS, grades: int = GRADES) -> None:
        self.weights = np.zeros((1 << bits) + SHAPES)
        self.cuts = np.zeros(grades - 1)

    def scores(self, f: Features) -> np.ndarray:
        # every row has a constant feature, so no part is empty
        return np.add.reduceat(self.weights[f.buckets] * f.values, f.bounds[:-1]) if len(f.bounds) > 1 else np.zeros(0)

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None] - scores[:, None], -50, 50)))

    def fit(self, f: Features, grades: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 0.2, lasso: float = 1e-3, seed: int = 3) -> None:
        rnd = np.random.default_rng(seed)
        common = np.bincount(grades, minlength=len(self.cuts) + 1)
        below = np.clip(np.cumsum(common)[:-1] / max(1, len(grades)), 1e-3, 1 - 1e-3)
        self.cuts = np.log(below / (1 - below))
        size, size_cuts = np.full(len(self.weights), 1e-3), np.full(len(self.cuts), 1e-3)
        for _ in range(epochs):
            order = rnd.permutation(len(grades))
            for i in range(0, len(order), batch):
                rows = order[i : i + batch]
                low, many = f.bounds[rows], f.bounds[rows + 1] - f.bounds[rows]
                at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                buckets, values = f.buckets[at], f.values[at]
                s = np.add.reduceat(self.weights[buckets] * values, np.cumsum(many) - many)
                # P(grade) = above[k - 1] - above[k]; its logarithm's slope in the score and in the cuts
                above = np.concatenate((np.ones((len(rows), 1)), self.above(s), np.zeros((len(rows), 1))), axis=1)
                slope, r = above * (1 - above), np.arange(len(rows))
                p = np.maximum(above[r, grades[rows]] - above[r, grades[rows] + 1], 1e-9)
                up, down = slope[r, grades[rows]] / p, slope[r, grades[rows] + 1] / p
                d_cuts = np.zeros((len(rows), len(self.cuts) + 2))
                d_cuts[r, grades[rows]], d_cuts[r, grades[rows] + 1] = -up, down
                g = np.bincount(buckets, np.repeat(up - down, many) * values, len(self.weights)) / len(rows)
                used = np.unique(buckets)
                size[used] += g[used] ** 2
                step = rate / np.sqrt(size[used])
                w = self.weights[used] + step * g[used]
                self.weights[used] = np.sign(w) * np.maximum(0, np.abs(w) - step * lasso)
                gc = d_cuts[:, 1:-1].mean(axis=0)
                size_cuts += gc**2
                self.cuts = np.sort(self.cuts + rate * gc / np.sqrt(size_cuts))


def fitted(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Ordinal:
    """The model of a bounded sample of labelled rows of docs (doc_id, text): of `rows` labelled ids, by a hash, at most so many different rows."""
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    graded = labels.where("doc_id is not null and quality is not null and toxic is not null").select("doc_id", grade.alias("grade"))
    graded = graded.groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id")
    known = {r.doc_id: r.grade for r in graded.limit(rows).collect()}
    small = docs.sparkSession.createDataFrame(sorted(known.items()), "doc_id long, grade int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 4 << 20):
            f = Features(texts)
            cut = [slice(a, b) for a, b in zip(f.bounds[:-1], f.bounds[1:], strict=True)]
            columns = [batch.column("doc_id"), batch.column("grade"), pa.array([f.buckets[c].astype(np.int32).tobytes() for c in cut]), pa.array([f.values[c].astype(np.float32).tobytes() for c in cut])]
            yield pa.record_batch(columns, ["doc_id", "grade", "buckets", "values"])

    labelled = docs.select("doc_id", "text").join(F.broadcast(small), "doc_id").mapInArrow(run, "doc_id long, grade int, buckets binary, values binary")
    labelled = labelled.distinct().orderBy(F.xxhash64("doc_id", "buckets", "values"), "doc_id", "buckets", "values").limit(rows)
    got = sorted((r.doc_id, r.grade, bytes(r.buckets), bytes(r["values"])) for r in labelled.collect())
    model = Ordinal()
    if got:
        f = Features.__new__(Features)
        f.buckets = np.concatenate([np.frombuffer(b, np.int32) for *_, b, _ in got]).astype(np.int64)
        f.values = np.concatenate([np.frombuffer(v, np.float32) for *_, v in got]).astype(np.float64)
        f.bounds = np.concatenate(([0], np.cumsum([len(b) // 4 for *_, b, _ in got])))
        model.fit(f, np.array([g for _, g, *_ in got]))
    return model


def graded(docs: DataFrame, model: Ordinal, least: float = LEAST_TAIL) -> DataFrame:
    """(doc_id, expected_grade, tail, selected): tail is the probability of the best grade."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 4 << 20):
            above = model.above(model.scores(Features(texts)))
            tail = above[:, -1]
            yield pa.record_batch([batch.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(tail), pa.array(tail >= least)], ["doc_id", "expected_grade", "tail", "selected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, expected_grade double, tail double, selected boolean")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    found = graded(docs, fitted(docs.where(~out), table(spark, sf_dir, "labels").where(~out)))
    return found.select("doc_id", out.alias("held_out"), "expected_grade", "tail", F.col("selected").alias("kept"))


QUERIES = {"op6_quality_classifier": op6_quality_classifier}
ORACLE: dict[str, str] = {}
