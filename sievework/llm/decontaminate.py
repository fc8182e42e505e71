"""Benchmark decontamination by Wu-Manber multi-pattern search.

Test strings are the windows of 13 consecutive words of each benchmark item (an item of fewer words is one window), as bytes with a
space before, between and after words; documents are normalized the same way, so a byte match is a word match. A search holds a
table of shifts by block of bytes: the block under the cursor tells how far the cursor can go without passing an occurrence. Where
the shift is zero, the block's hash selects a bucket of test strings, and direct comparison confirms them. Cursors of many segments
of a batch move together as arrays. Test strings of very different lengths are searched apart, so that a short one does not shorten
the shifts of the long ones.

The benchmark is read in slices of at most about `slice_bytes` of text, each broadcast with the search of a pass over the documents; a benchmark
that fits in one slice takes one pass, without a shuffle. Beyond that, items are cut into parts that share twelve words, so that a slice holds
them whatever their length; a pass writes no texts, but the marks (MD5) of texts that it hits and their hits, and these are joined to the
documents once, at the end. A search takes about 25 times the bytes of its slice, in each worker; it is no larger only where
13 words in a row alone exceed the slice.

Edge cases: null or wordless documents have no words, are not contaminated and hit nothing; null or wordless items are ignored;
repeated items count once; a null item_id is no item of its own but its windows still hit words; words and texts may have any length (a
task holds a document and some 40 times its bytes); an empty table of documents gives an empty result, an empty benchmark hits nothing;
repeated documents get a row each; `clean` keeps all columns of the documents, whatever they are named.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, packed, pieces, table, unpacked, written

WINDOW = 13
#: Largest part of the benchmark, in bytes of text, that is broadcast at once.
SLICE_BYTES = 4 << 20
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20

_KEEP = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def normal(text: bytes) -> bytes:
    """The words of a text, each with a space before it and after it; a space alone if there are none."""
    buf = np.frombuffer(b" " + text.translate(_KEEP) + b" ", np.uint8)
    space = buf == 32
    return buf[np.concatenate(([True], ~(space[1:] & space[:-1])))].tobytes()


class Search:
    """Wu-Manber search for byte strings of about the same length."""

    BLOCK, BITS, SEGMENT = 8, 20, 2048

    def __init__(self, patterns: list[bytes]) -> None:
        self.patterns = patterns
        self.least = least = min(map(len, patterns))
        self.block = block = min(self.BLOCK, least)
        heads = np.frombuffer(b"".join(p[:least] for p in patterns), np.uint8).reshape(-1, least)
        self.shift = np.full(1 << self.BITS, least - block + 1, np.uint8 if least < 255 else np.uint16 if least < 65_535 else np.uint32)
        for end in range(block, least + 1):
            padded = np.zeros((len(patterns), 8), np.uint8)
            padded[:, :block] = heads[:, end - block : end]
            hashed = self._hash(padded.view("<u8").ravel())
            np.minimum.at(self.shift, hashed, least - end)
        order = np.argsort(hashed, kind="stable")  # by the hash of the last block of the head
        self.bucket, self.member = hashed[order], order
        padded = np.zeros((len(patterns), 8), np.uint8)
        padded[:, : min(8, least)] = heads[:, : min(8, least)]
        self.start = padded.view("<u8").ravel()

    def _hash(self, block: np.ndarray) -> np.ndarray:
        return (block * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def occurrences(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Starts of occurrences in data and the numbers of their patterns."""
        n, none = len(data), np.zeros(0, np.int64)
        if n < self.least:
            return none, none
        eight = np.lib.stride_tricks.as_strided(np.frombuffer(data + bytes(8), "<u8", 1), (n,), (1,))
        low = np.uint64((1 << 8 * self.block) - 1)
        cursor = np.arange(self.least, n + 1, self.SEGMENT)  # ends of heads; a cursor stops where the next one started
        stop = np.append(cursor[1:], n + 1)
        starts, found = [none], [none]
        while len(cursor):
            hashed = self._hash(eight[cursor - self.block] & low)
            shift = self.shift[hashed]
            stand = np.nonzero(shift == 0)[0]
            if len(stand):
                at, h = cursor[stand] - self.least, hashed[stand]
                first, last = np.searchsorted(self.bucket, h, "left"), np.searchsorted(self.bucket, h, "right")
                many = last - first
                candidate = self.member[np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())]
                at = np.repeat(at, many)
                head = np.uint64((1 << 8 * min(8, self.least)) - 1)
                same = (eight[at] & head) == self.start[candidate]
                at, candidate = at[same], candidate[same]
                sure = np.fromiter((data.startswith(self.patterns[p], a) for a, p in zip(at.tolist(), candidate.tolist(), strict=True)), bool, len(at))
                starts.append(at[sure])
                found.append(candidate[sure])
            cursor = cursor + np.maximum(shift, 1).astype(np.int64)
            going = cursor < stop
            cursor, stop = cursor[going], stop[going]
        return np.concatenate(starts), np.concatenate(found)


class Index:
    """The test strings of items, in searches by length, with the words of each and the items it comes from."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW) -> None:
        owners: dict[bytes, tuple[str | None, ...]] = {}
        for name, text in items:
            got, one = words(text), (name,)
            for i in range(max(1, len(got) - window + 1) if got else 0):
                p = b" " + b" ".join(got[i : i + window]) + b" "
                had = owners.setdefault(p, one)
                if name not in had:
                    owners[p] = (*had, name)
        by_length: dict[int, list[bytes]] = defaultdict(list)
        for p in owners:
            by_length[min(6, len(p).bit_length())].append(p)
        self.parts = [(Search(ps), np.array([p.count(b" ") - 1 for p in ps]), [owners[p] for p in ps]) for ps in by_length.values()]

    def hits(self, texts: Texts) -> list[tuple[int, list[int], set[str | None]]]:
        """For each text: its number of words, the hit words as a flat list of from, to, ..., and the items."""
        rows = [normal(texts[i]) for i in range(texts.n)]
        data = b"\0".join(rows)
        bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) + 1)))
        spaces = np.nonzero(np.frombuffer(data, np.uint8) == 32)[0]
        edge, items = np.zeros(len(spaces) + 1, np.int64), [set() for _ in rows]
        for search, length, owners in self.parts:
            start, found = search.occurrences(data)
            first = np.searchsorted(spaces, start)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + length[found], -1)
            document = np.searchsorted(bounds, start, "right") - 1
            for d, p in set(zip(document.tolist(), found.tolist(), strict=True)):
                items[d].update(owners[p])
        hit = np.concatenate(([0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]))
        turn = np.diff(hit)
        begin, end = np.nonzero(turn == 1)[0], np.nonzero(turn == -1)[0]
        owner = np.searchsorted(bounds, spaces[begin], "right") - 1
        base = np.searchsorted(spaces, bounds[:-1])
        flat: list[list[int]] = [[] for _ in rows]
        for d, a, b in zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True):
            flat[d] += [a - int(base[d]), b - int(base[d])]
        return [(row.count(b" ") - 1, f, s) for row, f, s in zip(rows, flat, items, strict=True)]


def _merged(flat: list[int]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(zip(flat[::2], flat[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _parts(most: int, window: int):
    """Items in parts of about `most` bytes; neighbours share window - 1 words, so that each window is in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
                got, i = words(text.encode()), 0
                ends = np.cumsum([len(w) + 1 for w in got])
                while i < len(got):
                    start = int(ends[i - 1]) if i else 0
                    j = min(len(got), max(i + window, int(np.searchsorted(ends, start + most, "right"))))
                    yield pa.record_batch([pa.array([name], pa.string()), pa.array([b" ".join(got[i:j]).decode()])], ["name", "text"])
                    i = j - window + 1 if j < len(got) else j

    return run


def _slices(items: DataFrame, size: int, window: int, slice_bytes: int) -> Iterator[DataFrame]:
    """The items in slices of about slice_bytes."""
    if size <= slice_bytes:
        yield items
        return
    parts = written(items.mapInArrow(_parts(max(1, slice_bytes // 16), window), "name string, text string"), "parts")
    n, number = -(-size * 5 // (4 * slice_bytes)), lambda n: F.pmod(F.xxhash64("name", "text"), F.lit(n))
    weight = F.octet_length("text") + 64
    most = max(slice_bytes * 3 // 2, 2 * (parts.agg(F.max(weight)).first()[0] or 0))
    while (parts.groupBy(number(n)).agg(F.sum(weight).alias("w")).agg(F.max("w")).first()[0] or 0) > most:
        n = n * 3 // 2 + 1
    for k in range(n):
        yield parts.where(number(n) == k)


_MORE = {"__words": T.LongType(), "__hits": T.ArrayType(T.IntegerType()), "__items": T.ArrayType(T.StringType())}


def _extended(batch: pa.RecordBatch, got: list[tuple[int, list[int], list[str]]], keep: int) -> pa.RecordBatch:
    """The first `keep` columns of a batch with words, hits and items."""
    more = [pa.array([w for w, _, _ in got], pa.int64()), pa.array([f for _, f, _ in got], pa.list_(pa.int32())), pa.array([s for _, _, s in got], pa.list_(pa.string()))]
    return pa.record_batch([*batch.columns[:keep], *more], [*batch.schema.names[:keep], *_MORE])


def _named(items: set[str | None]) -> list[str]:
    return sorted(x for x in items if x is not None)


def annotated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """docs with __words (number), __hits (hit words as a flat list of from, to, ...) and __items (sorted ids as strings)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    schema, width = T.StructType([*docs.schema.fields, *(T.StructField(k, kind) for k, kind in _MORE.items())]), len(docs.columns)
    own = [F.col(f"`{c}`") for c in docs.columns]
    found: DataFrame | None = None

    def looked_up(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in pieces(batches, text, 1 << 20):
                yield _extended(batch, [(w, f, _named(s)) for w, f, s in index.hits(texts)], width)

        return run

    def marked(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in pieces(batches, "text", 1 << 20):
                got = [(m, f, _named(s)) for m, (_, f, s) in zip(batch.column("mark").to_pylist(), index.hits(texts), strict=True) if f]
                yield pa.record_batch([pa.array([m for m, _, _ in got], pa.string()), pa.array([f for _, f, _ in got], pa.list_(pa.int32())), pa.array([s for _, _, s in got], pa.list_(pa.string()))], ["mark", "hits", "items"])

        return run

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, text, 4 << 20):
            hits, names = batch.column("__a").to_pylist(), batch.column("__b").to_pylist()
            yield _extended(batch, [(normal(texts[i]).count(b" ") - 1, _merged(hits[i] or []), sorted(set(names[i] or []))) for i in range(texts.n)], width)

    for part in _slices(items, size, window, slice_bytes):
        index = Index([(r.name, r.text.encode()) for r in part.toLocalIterator()], window)
        if size <= slice_bytes:
            return docs.mapInArrow(looked_up(index), schema)
        texts = docs.select(F.md5(F.col(f"`{text}`").cast("string")).alias("mark"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
        once = texts.mapInArrow(marked(index), "mark string, hits array<int>, items array<string>").groupBy("mark").agg(F.first("hits").alias("hits"), F.first("items").alias("items"))
        hit = written(once, "hits")
        found = hit if found is None else found.union(hit)
    found = found.groupBy("mark").agg(F.flatten(F.collect_list("hits")).alias("__a"), F.flatten(F.collect_list("items")).alias("__b")).withColumnRenamed("mark", "__mark")
    both = docs.join(found, F.md5(F.col(f"`{text}`").cast("string")) == F.col("__mark"), "left").select(*own, "__a", "__b")
    return both.mapInArrow(merged, schema)


def judged(docs: DataFrame, benchmark: DataFrame, one_in: int = ONE_IN, **options) -> DataFrame:
    """docs with n_words, n_hit, item_ids and contaminated under names that start with two underscores."""
    hit = F.expr("aggregate(sequence(0, cast(size(__hits) / 2 as int) - 1), 0L, (s, i) -> s + __hits[2 * i + 1] - __hits[2 * i])")
    n_hit = F.when(F.size("__hits") == 0, F.lit(0).cast("long")).otherwise(hit)
    return annotated(docs, benchmark, **options).withColumn("__n_hit", n_hit).withColumn("__contaminated", (F.col("__n_hit") > 0) & (one_in * F.col("__n_hit") >= F.col("__words")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns, whatever these are named."""
    return unpacked(judged(packed(docs), benchmark).where("not __contaminated"), docs.columns)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        F.col("__words").alias("n_words"),
        F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "__items"), 256).alias("items_sha256"),
        F.col("__contaminated").alias("contaminated"),
    )


QUERIES = {"op5_decontaminate": op5_decontaminate}
ORACLE: dict[str, str] = {}
