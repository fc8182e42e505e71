"""Language identification by a byte convolutional network.

Bytes are embedded; filters of several widths slide over a window of fixed length, each keeps its largest response, and a softmax
over these gives the probabilities of the languages. A text is cut into windows whole, the last one padded, and its probabilities
are the mean over its windows, weighted by their bytes. The network is trained in numpy on the driver, on windows of a bounded
sample of labelled rows, by a hash of id and text: about `per_language` rows of a language or `rows` in all, `windows` windows of each; equal windows
of a language count once, and never more than twice as many windows as that are taken. Prediction folds
embedding and filters into one table per filter width and pair of bytes, so a response is a sum of table rows.

Edge cases: a null text, or one without a letter, is `und` with score 0; so is any text if there is nothing to learn from. Rows
without a language are not learned from. Repeated rows get a row each. Equal probabilities: the language first in code point order; a score equal to the
bound is accepted. A text of any length is read whole: a task holds it with some 60 times its bytes. An empty table gives an empty result. `accepted` keeps all
columns of the documents, whatever their names; a null id is never held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, held_out, packed, pieces, sums, table, unpacked

WINDOW, WIDTHS, FILTERS, EMBEDDING = 128, (2, 3, 4), 16, 8
ROWS, PER_LANGUAGE, WINDOWS = 4000, 1200, 5
UNKNOWN = "und"
#: A document whose best language has a smaller score than this is rejected by `accepted`.
LEAST_SCORE = 0.3


class Network:
    def __init__(self, languages: list[str], seed: int = 11) -> None:
        rnd = np.random.default_rng(seed)
        self.languages = languages
        self.embedding = rnd.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.filters = [rnd.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rnd.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.out, self.bias]

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 4, batch: int = 128, rate: float = 0.01, seed: int = 12) -> None:
        rnd, weights = np.random.default_rng(seed), self._weights()
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(epochs):
            order = rnd.permutation(len(windows))
            for i in range(0, len(order), batch):
                step += 1
                for w, g, m, v in zip(weights, self._gradients(windows[order[i : i + batch]], labels[order[i : i + batch]]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        embedded, n = self.embedding[x], len(x)
        pooled, places = [], []
        for f in self.filters:
            length = x.shape[1] - len(f) + 1
            response = sum(embedded[:, j : j + length] @ f[j] for j in range(len(f)))
            places.append(response.argmax(axis=1))
            pooled.append(response.max(axis=1))
        hidden = np.tanh(np.concatenate(pooled, axis=1))
        error = softmax(hidden @ self.out + self.bias)
        error[np.arange(n), y] -= 1
        error /= n
        back = (error @ self.out.T) * (1 - hidden**2)
        d_embedding, d_filters = np.zeros_like(self.embedding), []
        for k, (f, place) in enumerate(zip(self.filters, places, strict=True)):
            own, d = back[:, k * FILTERS : (k + 1) * FILTERS], np.zeros_like(f)
            for j in range(len(f)):
                seen = x[np.arange(n)[:, None], place + j]  # only the byte that won moves a filter
                d[j] = np.einsum("bfe,bf->ef", self.embedding[seen], own)
                np.add.at(d_embedding, seen, own[:, :, None] * f[j].T[None])
            d_filters.append(d)
        return [d_embedding, *d_filters, hidden.T @ error, error.sum(axis=0)]

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width, (offset, table) to add up: tables of 65536 rows are for pairs of bytes, of 256 for single bytes."""
        out = []
        for f in self.filters:
            one = [self.embedding @ f[j] for j in range(len(f))]
            two = [(j, (one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS)) for j in range(0, len(f) - 1, 2)]
            out.append([*two, *([(len(f) - 1, one[-1])] if len(f) % 2 else [])])
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Predictor:
    #: Windows that are looked at at once.
    STEP = 1024

    def __init__(self, network: Network) -> None:
        self.network, self.tables = network, network.tables()

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """windows: (n, WINDOW) bytes."""
        n = len(windows)
        flat = np.concatenate((windows.ravel(), np.zeros(8, np.uint8)))
        pair = flat[:-1].astype(np.int64) << 8 | flat[1:]
        pooled = []
        for width, parts in zip(WIDTHS, self.tables, strict=True):
            response = None
            for offset, rows in parts:
                at = pair[offset : offset + n * WINDOW] if len(rows) == 65536 else flat[offset : offset + n * WINDOW]
                got = rows.take(at, axis=0)
                response = got if response is None else np.add(response, got, out=response)
            pooled.append(response.reshape(n, WINDOW, FILTERS)[:, : WINDOW - width + 1].max(axis=1))
        return softmax(np.tanh(np.concatenate(pooled, axis=1)) @ self.network.out + self.network.bias)

    def texts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """For each text the number of its best language and its mean probability."""
        sizes = texts.sizes()
        many = -(-sizes // WINDOW)
        bounds = np.concatenate(([0], np.cumsum(many)))
        padded = np.zeros(bounds[-1] * WINDOW, np.uint8)
        shift = np.repeat(bounds[:-1] * WINDOW - (texts.off[:-1] - texts.off[0]), sizes)
        padded[np.arange(sizes.sum()) + shift] = texts.buf[texts.off[0] : texts.off[-1]]
        windows = padded.reshape(-1, WINDOW)
        weight = np.full(len(windows), WINDOW, np.float64)
        held = many > 0
        weight[bounds[1:][held] - 1] = (sizes - (many - 1) * WINDOW)[held]
        got = np.concatenate([np.zeros((0, len(self.network.languages))), *(self.probabilities(windows[i : i + self.STEP]) for i in range(0, len(windows), self.STEP))])
        owner = np.repeat(np.arange(texts.n), many)
        mean = np.stack([np.bincount(owner, got[:, c] * weight, texts.n) for c in range(got.shape[1])], axis=1) / np.maximum(sizes, 1)[:, None]
        best = mean.argmax(axis=1)
        return best, np.clip(mean[np.arange(texts.n), best], 0.0, 1.0)


_ASCII_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])


def with_letter(texts: Texts) -> np.ndarray:
    """Whether each text has a letter of any script."""
    low = texts.off[0]
    found = sums(_ASCII_LETTER[texts.buf[low : texts.off[-1]]], texts.off - low) > 0
    for i in np.nonzero(~found)[0]:
        found[i] = any(c.isalpha() for c in texts[i].decode("utf-8", "replace"))
    return found


def _windows(most: int):
    """Up to `most` windows of each text with a letter, evenly spread over it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 4 << 20):
            languages, owned, cut = batch.column("lang").to_pylist(), [], []
            for i in np.nonzero(with_letter(texts))[0].tolist():
                text = texts[i]
                whole = -(-len(text) // WINDOW)
                for k in sorted({int(x) for x in np.linspace(0, whole - 1, min(most, whole))}):
                    owned.append(languages[i])
                    cut.append(text[k * WINDOW : (k + 1) * WINDOW])
            yield pa.record_batch([pa.array(owned, pa.string()), pa.array(cut, pa.binary())], ["lang", "window"])

    return run


def trained(docs: DataFrame, rows: int = ROWS, per_language: int = PER_LANGUAGE, windows: int = WINDOWS) -> Network | None:
    """A network that has learned from a bounded sample of the rows of docs (text, lang, doc_id) that have a language."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    # copies count once, so that a language of few texts, often repeated, keeps them
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("doc_id", "text"), 0.02).alias("n")).toLocalIterator()}
    if not counts:
        return None
    most = max(1, min(per_language, rows // len(counts)))
    share = docs.sparkSession.createDataFrame([(k, int(min(1.0, most / n) * (1 << 30))) for k, n in sorted(counts.items())], "lang string, share long")
    sample = docs.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id", "text", F.lit("lang")), F.lit(1 << 30)) < F.col("share"))
    cut = sample.select("lang", "text").mapInArrow(_windows(windows), "lang string, window binary").distinct()
    cut = cut.orderBy(F.xxhash64("window", "lang"), "window", "lang").limit(2 * rows * windows)
    got = sorted((r["lang"], bytes(r["window"])) for r in cut.collect())
    if not got:
        return None
    network = Network(sorted({k for k, _ in got}))
    number = {k: i for i, k in enumerate(network.languages)}
    network.train(np.frombuffer(b"".join(w.ljust(WINDOW, b"\0") for _, w in got), np.uint8).reshape(-1, WINDOW), np.array([number[k] for k, _ in got]))
    return network


def predicted(docs: DataFrame, network: Network | None) -> DataFrame:
    """docs with __lang and __score."""
    model = Predictor(network) if network else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 1 << 20):
            names, scores = np.full(texts.n, UNKNOWN, object), np.zeros(texts.n)
            if model:
                known = with_letter(texts)
                best, score = model.texts(texts)
                names[known], scores[known] = np.array(model.network.languages, object)[best[known]], score[known]
            yield pa.record_batch([*batch.columns, pa.array(names, pa.string()), pa.array(scores)], [*batch.schema.names, "__lang", "__score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())]))


def accepted(docs: DataFrame, network: Network | None, least: float = LEAST_SCORE) -> DataFrame:
    """The documents in a known language, by their score, with their own columns, whatever these are named."""
    sure = predicted(packed(docs), network).where((F.col("__lang") != UNKNOWN) & (F.col("__score") >= least))
    return unpacked(sure, docs.columns)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    network = trained(docs.where(~out))
    found = predicted(docs.select("doc_id", "text"), network)
    return found.select("doc_id", out.alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


QUERIES = {"op1_language_id": op1_language_id}
ORACLE: dict[str, str] = {}
