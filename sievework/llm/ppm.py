"""Language-model scoring by prediction by partial matching, with a unigram base.

The model is a trie of byte contexts of up to ORDER bytes. In a context that was seen T times with D different next bytes, a byte
seen n times there has probability n / (T + D) and the escape to the context without its first byte D / (T + D); bytes that a longer
context has seen are excluded from the shorter one. Below the empty context, bytes not seen are equally likely. The counts come from
training rows (pretrained); the code length of a text is summed over all its bytes and an end symbol.

The probability of a byte after a context depends on these ORDER + 1 bytes alone, so each different gram is worked out once. Texts
are dealt to blocks of bounded size. A block asks for its different grams and words; counts of all blocks are added up; tasks that
hold a share of the contexts grow the trie of that share and work out its grams (all contexts with the same last three bytes are
together; counts of shorter grams go to all tasks, 2^24 at most and in UTF-8 text far fewer); the answers go back to the blocks that asked. No task holds the whole
model and none is broadcast.

Words are compared by 63-bit fingerprints.

Edge cases: null texts are empty: an end token and an end symbol. Without training rows all counts are 0. Repeated rows get a row each
and count each in training; rows that are equal in id and text share a block. An empty table gives an empty result. A text of any length is scored whole, by one task, which holds it and some 100 times the bytes of a
piece of it. Only the id, the text and the column that tells training rows are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Texts, held_out, pieces, span_hashes, table, word_spans, written

ORDER = 4
#: Bytes of text of a block at most, about, and of one where there are few.
BLOCK, LEAST_BLOCK = 24 << 20, 1 << 20
PIECE = 512 << 10
#: Grams of a task that grows a trie, about.
SHARE = 1_000_000
_START, _END, _BYTES = 0xFE, 0xFF, 256  # neither is a byte of UTF-8
_END_TOKEN = -1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Symbols:
    """Grams of ORDER + 1 bytes at each byte and end of lower-cased texts, and the words; which text each belongs to."""

    def __init__(self, texts: Texts) -> None:
        sizes = texts.sizes()
        n, low = texts.n, texts.off[0]
        self.bounds = np.concatenate(([0], np.cumsum(sizes + 1)))  # of the grams of each text
        begin = self.bounds[:-1] + ORDER * np.arange(1, n + 1)
        buf = np.full(self.bounds[-1] + ORDER * n, _START, np.uint8)
        words = np.full(len(buf), 32, np.uint8)
        at = np.arange(sizes.sum()) + np.repeat(begin - (texts.off[:-1] - low), sizes)
        buf[at] = words[at] = _LOWER[texts.buf[low : texts.off[-1]]]
        buf[begin + sizes] = _END
        grams = np.zeros(len(buf) - ORDER if n else 0, np.int64)
        for j in range(ORDER + 1):
            grams <<= 8
            grams |= buf[j : len(buf) - ORDER + j]
        symbol = np.ones(len(buf), bool)
        symbol[(begin[:, None] - np.arange(1, ORDER + 1)).ravel()] = False
        self.grams = grams[symbol[ORDER:]]
        starts, ends = word_spans(words)
        self.words = ~(span_hashes(words, starts, ends) >> np.uint64(1)).view(np.int64)  # negative, grams are not
        self.owner = np.searchsorted(begin, starts, "right") - 1


def _counted(keys: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, and how often each is in training rows."""
    known, n = np.unique(keys[trained], return_counts=True)
    other = np.unique(keys[~trained])
    return np.concatenate((known, other)), np.concatenate((n, np.zeros(len(other), np.int64)))


def _merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0]
    return keys[first], np.add.reduceat(n[order], first)


_ASKED = "block int, key long, n long"


def _asked(batches: Iterator[pa.RecordBatch], most: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """The different grams and words of each block with their counts in training rows; a block's may come in several parts."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = lambda parts: sum(len(k) for k, _ in parts)
    whole = lambda parts: _merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    def out() -> Iterator[pa.RecordBatch]:
        for block, parts in sorted(held.items()):
            keys, n = whole(parts)
            yield pa.record_batch([pa.array(np.full(len(keys), block, np.int32)), pa.array(keys), pa.array(n)], ["block", "key", "n"])
        held.clear()

    for batch in batches:
        order = pa.compute.sort_indices(batch.column("block"))
        batch = batch.take(order)
        numbers = batch.column("block").to_numpy()
        cuts = np.concatenate((np.nonzero(np.diff(numbers, prepend=-1))[0], [len(numbers)]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            for part, texts in pieces(iter([batch.slice(a, b - a)]), "text", PIECE):
                found = Symbols(texts)
                train = ~part.column("out").to_numpy(zero_copy_only=False)
                grams = _counted(found.grams, np.repeat(train, np.diff(found.bounds)))
                words = _counted(found.words, train[found.owner])
                end = (np.array([_END_TOKEN]), np.array([int(train.sum())]))
                parts = held.setdefault(int(numbers[a]), [])
                parts += [grams, words, end]
                if size(parts) > max(most // 3, 2 * len(parts[0][0])):  # merged when they have doubled, so that each key is sorted a few times
                    parts[:] = [whole(parts)]
        if sum(map(size, held.values())) > most:
            held = {block: [whole(parts)] for block, parts in held.items()}
            if sum(map(size, held.values())) > most:
                yield from out()
    yield from out()


class Trie:
    """Byte contexts with the counts of their next bytes, one sorted level for each order. Grams are context bytes, oldest first,
    then the byte; a node of order j is the last j + 1 bytes, and its parent context the last j of the context."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, shorter: tuple[np.ndarray, np.ndarray]) -> None:
        """shorter: counts of all grams of three bytes, also of other shares."""
        seen = n > 0
        self.levels = []
        for order in range(ORDER + 1):
            keys, counts = (grams[seen], n[seen]) if order > 2 else shorter
            nodes, counts = _merged(keys & ((1 << 8 * (order + 1)) - 1), counts)
            contexts, distinct = _merged(nodes >> 8, np.ones(len(nodes), np.int64))
            _, totals = _merged(nodes >> 8, counts)
            self.levels.append([nodes, counts, contexts, totals, distinct, None])
        for order in range(ORDER):  # what the bytes of a longer context count for in the next shorter one
            nodes, _, contexts, *_ = self.levels[order + 1]
            weight = _find(self.levels[order][0], self.levels[order][1], nodes & ((1 << 8 * (order + 1)) - 1))
            self.levels[order + 1][5] = _merged(nodes >> 8, weight)[1] if len(nodes) else np.zeros(0, np.int64)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last byte of each gram."""
        result, open_ = np.zeros(len(grams)), np.ones(len(grams), bool)
        excluded, weight = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        for order in range(ORDER, -1, -1):
            nodes, counts, contexts, totals, distinct, below = self.levels[order]
            keys = grams & ((1 << 8 * (order + 1)) - 1)
            n, total, kinds = _find(nodes, counts, keys), _find(contexts, totals, keys >> 8), _find(contexts, distinct, keys >> 8)
            left, new = total - weight, kinds - excluded
            live = open_ & (left > 0)
            hit = live & (n > 0)
            miss = live & (n == 0)
            result[hit] += np.log10(n[hit] / (left + new)[hit])
            result[miss] += np.log10(new[miss] / (left + new)[miss])
            open_ &= ~hit
            known = total > 0
            excluded = np.where(known, kinds, 0)
            weight = np.where(known, _find(contexts, below, keys >> 8), 0) if order else weight
        result[open_] -= np.log10(_BYTES - excluded[open_])
        return result


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _worked_out(shorter: tuple[np.ndarray, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches]
        if not held:
            return
        keys, n = (np.concatenate([x[k] for x in held]) for k in range(2))
        trie = Trie(keys, n, shorter)
        for i in range(0, len(keys), 200_000):
            part = keys[i : i + 200_000]
            yield pa.record_batch([pa.array(part), pa.array(trie.log10(part))], ["key", "value"])

    return run


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(total: int, distinct: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys, values = answers.column("key").to_numpy(), answers.column("value").to_numpy()
        keys, first = np.unique(keys, return_index=True)
        values, split = values[first], np.searchsorted(keys, 0)
        words, counts, grams, logs = keys[:split], values[:split], keys[split:], values[split:]
        base = np.log10((counts + 0.5) / (total + 0.5 * (distinct + 1)))
        out: list[list] = [[] for _ in range(5)]
        for part, texts in pieces(iter(docs.combine_chunks().to_batches()), "text", PIECE):
            found = Symbols(texts)
            at = np.searchsorted(words, found.words)
            end = np.searchsorted(words, _END_TOKEN)
            n = np.bincount(found.owner, minlength=texts.n) + 1
            known = np.bincount(found.owner, counts[at] > 0, texts.n) + (counts[end] > 0)
            unigram = np.bincount(found.owner, base[at], texts.n) + base[end]
            score = np.add.reduceat(logs[np.searchsorted(grams, found.grams)], found.bounds[:-1])
            for column, value in zip(out, (part.column("doc_id").to_pylist(), n, known, unigram, score), strict=True):
                column.extend(value)
        ids, n, known, unigram, score = out
        columns = [
            pa.array(ids, pa.int64()), docs.column("out").combine_chunks(), pa.array(n, pa.int64()), pa.array([int(k) for k in known], pa.int64()),
            pa.array([total] * len(ids), pa.int64()), pa.array(unigram, pa.float64()), pa.array(score, pa.float64()),
        ]
        return pa.table(columns, names=[x.strip().split(" ")[0] for x in _SCORED.split(",")])

    return run


def scores(docs: DataFrame, out) -> DataFrame:
    """For each row of docs (doc_id, text) its tokens, base score and score; rows where the column `out` is false are learned from."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("out"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, min(width, -(-size // LEAST_BLOCK)), -(-size // BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    asked = written(rows.repartition(min(blocks, 4 * width), "block").mapInArrow(_asked, _ASKED), "asked")
    totals = written(asked.groupBy("key").agg(F.sum("n").alias("n")), "totals")
    tokens = totals.where("key < 0 and n > 0").agg(F.sum("n"), F.count("*")).first()
    known = totals.where("key >= 0 and n > 0").groupBy(F.col("key").bitwiseAND(F.lit(0xFFFFFF)).alias("key")).agg(F.sum("n").alias("n")).toArrow()
    shorter = (known.column("key").to_numpy(), known.column("n").to_numpy())
    grams = totals.where("key >= 0").withColumn("ends", F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFFFF)))
    # a task grows the trie of a few million grams, however many there are
    model = grams.repartition(max(width, -(-totals.count() // SHARE)), "ends").select("key", "n").mapInArrow(_worked_out(shorter), "key long, value double")
    values = model.union(totals.where("key < 0").select("key", F.col("n").cast("double").alias("value")))
    answers = asked.select("block", "key").join(values, "key").select("block", "key", "value")
    parts = min(blocks, 16 * width)
    return rows.repartition(parts, "block").groupBy("block").cogroup(answers.repartition(parts, "block").groupBy("block")).applyInArrow(_scored(tokens[0] or 0, tokens[1]), _SCORED)


def op3_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), held_out("doc_id", 5, 1))


QUERIES = {"op3_ppm_score": op3_ppm_score}
ORACLE: dict[str, str] = {}
