"""Quality rules judged by an isolation forest.

Rule statistics of whole texts are counted exactly. Isolation forests (random splits; a row that few splits isolate is an anomaly)
score the rows: one forest for each ratio of the statistics, so that spread in one does not hide anomalies in another, and one over
all of them. Each has a threshold calibrated from labelled rows: the one that best separates labels of quality 0 from labels of
quality 1 while it keeps `keep` of the latter. A row beyond any threshold goes.

Every tree is grown from all rows that pass the base rules, and the thresholds come from all labelled ones. Trees grow level by level: tasks find the extremes and the number of their
rows in each open node, Spark merges these, and the driver draws the next splits. A node of less than two `size`-ths of all rows is not split further, so a tree has few nodes
whatever the table holds. Extremes and numbers are the same in any order, so that the model does not depend on partitions. For thresholds, scores are
rounded to DIGITS digits, and the driver gets the number of good and bad rows of each. Words and 5-word windows are compared by 64-bit fingerprints.

Edge cases: a null, empty or blank text has zero counts and fails the base rules; repeated rows get a row each and are fitted as often; a row with a null id is fitted and has no label;
a score that equals its threshold is kept; without labelled rows of both kinds the threshold is `default`; without any rows the result is empty. A text is counted whole, whatever its length: a task holds one
batch and some 60 times the bytes of its longest text. Only doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import joined, mix, pieces, release, span_hashes, sums, table, word_spans, written

KEEP, DEFAULT, DIGITS = 0.999, 0.75, 4
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_marks", "n_lines")
MIN_WORDS, WINDOW, MOST_REPEATED, WIDTH = 10, 5, 20, 6

_TRAIL = np.arange(256) & 0xC0 == 0x80
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER, _LOWER = np.isin(np.arange(256), range(65, 91)), np.isin(np.arange(256), range(97, 123))
_MARK = np.isin(np.arange(256), list(b"!?;:()[]{}=+/\\@~^_\"'"))


def repeated_words(hashes: np.ndarray, owner: np.ndarray, n: int, window: int = WINDOW) -> np.ndarray:
    """For each of n texts, the words inside windows that are found twice or more in it. owner: the text of each word, ascending."""
    m = len(hashes) - window + 1
    if m <= 0:
        return np.zeros(n, np.int64)
    key = mix(owner[:m].astype(np.uint64))
    for i in range(window):
        key = mix(key + hashes[i : i + m])
    whole = owner[:m] == owner[window - 1 :]
    held = np.sort(key[whole])
    twice = np.unique(held[1:][held[1:] == held[:-1]])
    edge = np.zeros(len(hashes) + 1, np.int64)
    if len(twice):
        at = np.searchsorted(twice, key)
        hit = np.nonzero(whole & (twice[np.minimum(at, len(twice) - 1)] == key))[0]
        edge[:-1] += np.bincount(hit, minlength=len(hashes))
        edge -= np.bincount(hit + window, minlength=len(hashes) + 1)
    return np.bincount(owner[np.cumsum(edge)[:-1] > 0], minlength=n)


def _duplicate_lines(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines)), len(lines)


def counted(texts) -> dict[str, np.ndarray]:
    """The counts of each text of a Texts."""
    buf, bounds = joined(texts)
    starts, ends = word_spans(buf)
    owner = np.searchsorted(bounds, starts, "right") - 1
    lines = [_duplicate_lines(texts[i]) for i in range(texts.n)]
    return {
        "n_words": np.bincount(owner, minlength=texts.n),
        "word_chars": sums(~(_SPACE | _TRAIL)[buf], bounds),
        "n_symbols": sums(_SYMBOL[buf], bounds),
        "n_dup_lines": np.array([x for x, _ in lines], np.int64),
        "n_repeat_words": repeated_words(span_hashes(buf, starts, ends), owner, texts.n),
        "n_upper": sums(_UPPER[buf], bounds),
        "n_lower": sums(_LOWER[buf], bounds),
        "n_marks": sums(_MARK[buf], bounds),
        "n_lines": np.array([x for _, x in lines], np.int64),
    }


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Ratios that do not depend on a text's length."""
    w, ch = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    columns = [
        np.log(np.maximum(c["word_chars"] / w, 1)),
        np.sqrt(c["n_symbols"] / ch),
        np.sqrt(c["n_dup_lines"] / np.maximum(c["n_lines"], 1)),
        np.sqrt(c["n_repeat_words"] / w),
        np.sqrt(c["n_upper"] / np.maximum(c["n_upper"] + c["n_lower"], 1)),
        np.sqrt(c["n_marks"] / ch),
    ]
    return np.stack(columns, axis=1).astype(np.float64)


class IsolationForest:
    """Trees as arrays; the score is 2^(-mean path length / usual path length), nearer 1 for anomalies.

    A tree is grown from all rows: `spans` says what a part of them holds in each open node, and `split` takes that of all parts. Masses are counted in
    `size`-ths of all rows, or in rows where these are fewer: a node of less than 2 is a leaf, so that each level has at most size / 2 open nodes."""

    def __init__(self, rows: np.ndarray | None = None, width: int = 0, trees: int = 64, size: int = 64, seed: int = 7, depth: int = 8) -> None:
        self.rnd, self.size, self.depth, self.level = np.random.default_rng(seed), size, depth, 0
        self.width, nodes = rows.shape[1] if rows is not None else width, (1 << (depth + 1)) - 1
        self.column, self.cut = np.zeros((trees, nodes), np.int8), np.full((trees, nodes), np.inf)
        self.path = np.zeros((trees, nodes))
        # of each open node: its tree and number, and for trees of one column the values it takes, over `above` and up to `upto`
        self.tree, self.node = np.arange(trees), np.zeros(trees, np.int64)
        self.above, self.upto = np.full(trees, -np.inf), np.full(trees, np.inf)
        while rows is not None and len(self.tree):
            self.split(*self.spans(rows))

    def _reached(self, t: int, rows: np.ndarray, steps: int) -> np.ndarray:
        """The node of tree t that each row is in after some steps."""
        column, cut, flat = self.column[t], self.cut[t], np.ascontiguousarray(rows).ravel()
        node, first = np.zeros(len(rows), np.int64), np.arange(len(rows)) * self.width
        for _ in range(steps):
            here = cut[node]
            node = np.where(np.isfinite(here), 2 * node + 1 + (flat[first + column[node]] > here), node)
        return node

    def spans(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least and largest values by column, and the number, of the rows in each open node."""
        low, high = np.full((len(self.tree), self.width), np.inf), np.full((len(self.tree), self.width), -np.inf)
        count = np.zeros(len(self.tree), np.int64)
        if self.width == 1:  # a node is a range of the sorted values
            held = np.sort(rows[:, 0])
            start, end = np.searchsorted(held, self.above, "right"), np.searchsorted(held, self.upto, "right")
            some = end > start
            low[some, 0], high[some, 0], count = held[start[some]], held[end[some] - 1], end - start
            return low, high, count
        slot = np.full(self.cut.shape[1], -1, np.int64)
        for t in np.unique(self.tree):
            own = np.nonzero(self.tree == t)[0]
            slot[:] = -1
            slot[self.node[own]] = np.arange(len(own))
            at = slot[self._reached(t, rows, self.level)]
            order = np.argsort(at.astype(np.int16), kind="stable")[np.count_nonzero(at < 0) :]
            n = np.bincount(at[order], minlength=len(own))
            some = own[n > 0]
            if len(some):
                start = (np.cumsum(n) - n)[n > 0]
                low[some], high[some] = np.minimum.reduceat(rows[order], start), np.maximum.reduceat(rows[order], start)
            count[own] = n
        return low, high, count

    def split(self, low: np.ndarray, high: np.ndarray, count: np.ndarray) -> None:
        """Draws a split of each open node that has the mass and different values; the others are leaves."""
        if not self.level:
            self.unit, self.size = max(1.0, count[0] / self.size), int(min(self.size, count[0]))
        made = []
        for k, (t, node) in enumerate(zip(self.tree, self.node, strict=True)):
            open_columns = np.nonzero(high[k] > low[k])[0]
            if self.level == self.depth or count[k] < 2 * self.unit or not len(open_columns):
                self.path[t, node] = self.level + usual_path(count[k] / self.unit)
                continue
            j = self.rnd.choice(open_columns)
            cut = self.rnd.uniform(low[k, j], high[k, j])
            self.column[t, node], self.cut[t, node] = j, cut
            made += [(t, 2 * node + 1, self.above[k], cut), (t, 2 * node + 2, cut, self.upto[k])]
        self.level += 1
        self.tree, self.node = (np.array([x[i] for x in made], np.int64) for i in (0, 1))
        self.above, self.upto = (np.array([x[i] for x in made], float) for i in (2, 3))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for t, path in enumerate(self.path):
            total += path[self._reached(t, rows, self.depth)]
        return 2.0 ** (-total / len(self.path) / max(usual_path(self.size), 1e-9))


class Steps:
    """The scores of a forest of one column, which are the same between two neighbouring cuts."""

    def __init__(self, forest: IsolationForest) -> None:
        self.cuts = np.unique(forest.cut[np.isfinite(forest.cut)])
        self.held = forest.scores(np.append(self.cuts, np.inf)[:, None])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return self.held[np.searchsorted(self.cuts, rows[:, 0])]


def usual_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def calibrated(scores: np.ndarray, good: np.ndarray, keep: float = KEEP, default: float = DEFAULT, n: np.ndarray | None = None) -> float:
    """The score above which rows go: of the thresholds that keep this share of good rows, the one with the best balance. n: how many rows each score stands for."""
    if not good.any() or good.all():
        return default
    at, place = np.unique(scores, return_inverse=True)
    n = np.ones(len(scores)) if n is None else n
    fine, bad = (np.cumsum(np.bincount(place[k], n[k], len(at))) for k in (good, ~good))
    kept, caught = fine / fine[-1], 1 - bad / bad[-1]
    allowed = np.nonzero(kept >= keep)[0]
    best = allowed[np.argmax((kept + caught)[allowed])]
    return float((at[best] + at[min(best + 1, len(at) - 1)]) / 2)


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])


class Model:
    """Forests over column groups of the features, each with its threshold."""

    def __init__(self, parts: list[tuple[list[int], IsolationForest | Steps, float]]) -> None:
        self.parts = parts

    def verdicts(self, counts: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Base rules failed, the largest anomaly score relative to its threshold, kept."""
        failed, x = base_failed(counts), features(counts)
        worst = np.zeros(len(x))
        for columns, forest, threshold in self.parts:
            worst = np.maximum(worst, np.round(forest.scores(x[:, columns]), DIGITS) / threshold)
        return failed, worst, ~failed & (worst <= 1)


def _counts(docs: DataFrame, carried: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 4 << 20):
            c = counted(texts)
            yield pa.record_batch([*(batch.column(x) for x in carried), *(pa.array(c[x], pa.int64()) for x in COUNTS)], [*carried, *COUNTS])

    kinds = dict(docs.dtypes)
    return docs.select(*carried, "text").mapInArrow(run, ", ".join([*(f"{x} {kinds[x]}" for x in carried), *(f"{x} long" for x in COUNTS)]))


def _held(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {x: batch.column(x).to_numpy(zero_copy_only=False) for x in COUNTS}


def _spans(rows: DataFrame, forests: list[tuple[list[int], IsolationForest]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What all rows hold in the open nodes of each forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = [(np.full((len(f.tree), len(c)), np.inf), np.full((len(f.tree), len(c)), -np.inf), np.zeros(len(f.tree), np.int64)) for c, f in forests]
        for batch in batches:
            c = _held(batch)
            x = features(c)[~base_failed(c)]
            for k, (columns, forest) in enumerate(forests):
                (low, high, count), (a, b, n) = merged[k], forest.spans(x[:, columns])
                merged[k] = np.minimum(low, a), np.maximum(high, b), count + n
        for k, (low, high, count) in enumerate(merged):
            some, w = np.nonzero(count)[0], low.shape[1]
            place = [np.full(len(some) * w, k, np.int32), np.repeat(some, w).astype(np.int32), np.tile(np.arange(w, dtype=np.int32), len(some))]
            yield pa.record_batch([*map(pa.array, place), pa.array(low[some].ravel()), pa.array(high[some].ravel()), pa.array(np.repeat(count[some], w))], ["forest", "slot", "j", "low", "high", "n"])

    made = rows.mapInArrow(run, "forest int, slot int, j int, low double, high double, n long")
    held = made.groupBy("forest", "slot", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).toPandas()
    found = []
    for k, (columns, forest) in enumerate(forests):
        own, shape = held[held["forest"] == k], (len(forest.tree), len(columns))
        low, high, count = np.full(shape, np.inf), np.full(shape, -np.inf), np.zeros(shape[0], np.int64)
        slot, j = own["slot"].to_numpy(), own["j"].to_numpy()
        low[slot, j], high[slot, j], count[slot] = own["low"], own["high"], own["n"]
        found.append((low, high, count))
    return found


def _thresholds(rows: DataFrame, labels: DataFrame, forests: list[tuple[list[int], IsolationForest | Steps]]) -> list[float]:
    """Of each forest, from all labelled rows (doc_id, quality)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = _held(batch)
            passed = ~base_failed(c)
            x, good = features(c)[passed], batch.column("quality").to_numpy(zero_copy_only=False)[passed] > 0
            for k, (columns, forest) in enumerate(forests):
                score, n = np.unique(np.stack((np.round(forest.scores(x[:, columns]), DIGITS), good)), axis=1, return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(n), k, np.int32)), pa.array(score[0]), pa.array(score[1] > 0), pa.array(n.astype(np.int64))], ["forest", "score", "good", "n"])

    made = rows.join(labels, "doc_id").select(*COUNTS, "quality").mapInArrow(run, "forest int, score double, good boolean, n long")
    held = made.groupBy("forest", "score", "good").agg(F.sum("n").alias("n")).toPandas()
    own = [held[held["forest"] == k] for k in range(len(forests))]
    return [calibrated(x["score"].to_numpy(float), x["good"].to_numpy(bool), n=x["n"].to_numpy(float)) for x in own]


def _model(rows: DataFrame, labels: DataFrame, sample: int | None = None, labelled: int | None = None) -> Model:
    """rows: doc_id and the counts, as a written table."""
    graded = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    fit = rows
    if sample is not None:
        fit = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("forest")), F.lit(1 << 30)) < int(min(1.0, sample / max(rows.count(), 1)) * (1 << 30)))
    if labelled is not None:
        graded = graded.orderBy(F.xxhash64("doc_id", F.lit("labelled")), "doc_id").limit(labelled)
    groups = [*([i] for i in range(WIDTH)), list(range(WIDTH))]
    grown = [(columns, IsolationForest(width=len(columns))) for columns in groups]
    while growing := [g for g in grown if len(g[1].tree)]:
        spans = _spans(fit.select(*COUNTS), growing)
        if not spans[0][2].any():
            return Model([])
        for (_, forest), found in zip(growing, spans, strict=True):
            forest.split(*found)
    forests = [(columns, Steps(forest) if len(columns) == 1 else forest) for columns, forest in grown]
    return Model([(columns, forest, threshold) for (columns, forest), threshold in zip(forests, _thresholds(rows, graded, forests), strict=True)])


def fitted(docs: DataFrame, labels: DataFrame, sample: int | None = None, labelled: int | None = None) -> Model:
    """Forests of all docs, with thresholds from all labelled rows. A caller may ask for a model of about `sample` rows, chosen by a hash of the id, and of `labelled` labelled ids."""
    rows = written(_counts(docs, ["doc_id"]), "counts")
    model = _model(rows, labels, sample, labelled)
    release(rows)
    return model


def _verdicts(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed, score, kept = model.verdicts(_held(batch))
            yield pa.record_batch([*batch.columns, pa.array(failed), pa.array(score), pa.array(kept)], ["doc_id", *COUNTS, "base_failed", "anomaly", "kept"])

    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, {', '.join(f'{x} long' for x in COUNTS)}, base_failed boolean, anomaly double, kept boolean"
    return rows.select("doc_id", *COUNTS).mapInArrow(run, schema)


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, the counts, base_failed, anomaly score, kept."""
    return _verdicts(_counts(docs, ["doc_id"]), model)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(_counts(table(spark, sf_dir, "documents"), ["doc_id"]), "counts")  # texts are counted once
    found = _verdicts(rows, _model(rows, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLE: dict[str, str] = {}
