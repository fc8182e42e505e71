"""SimHash near-duplicates over BK-trees.

A fingerprint has 64 bits, one per majority vote of the XXH64 hashes of the text's word shingles. Fingerprints at a Hamming
distance of at most `radius` are linked, and a component is what links reach.

Equal fingerprints are merged before anything is compared. The 64 bits are cut into bands; two fingerprints within the radius agree
on at least `bands - radius` whole bands, so each combination of that many bands is a shard key and no link is lost. All rows of a
shard key meet in one task, which grows a BK-tree from them (children keyed by their integer distance to the parent) and searches
it along the edges within the radius. Trees of all shard keys of a task are grown and searched together, level by level, as arrays.
The trees are shuffled, not broadcast: a broadcast passes through the driver, and fingerprints of all documents may not. The rows of a shard key with more than `most` of them
get finer keys: the bits that are not in the key are cut into bands too, and rows within the radius agree on one of these. Where even such a key has more, it is
dealt to several tasks, each with the tree of the key and its own share of the searches. A task emits a spanning forest of
the links it found, never the pairs, and the components come from alternating star contractions over written tables.

A text is hashed whole, whatever its length: a task holds it with some 40 times its bytes. An empty table gives an empty result. Only the
id and the text are read; `deduplicated` keeps all columns, whatever their names.

Edge cases: null and empty texts have fingerprint zero and are linked like any other; a text of fewer words than the shingle size
is one shingle; repeated rows each get a result row; a null id is never the smallest id of its component unless all are null. A row
is told apart by its id and a mark of its text, so of each component one row stays, whatever ids are null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Texts, release, table, written

WIDTH, RADIUS, SEED = 4, 4, 42
#: A shard key with more rows than this is searched by several tasks.
MOST = 8192
#: Mean rows of a shard key, above which one more band is used.
DENSE = 2048


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    words = text.lower().split()  # bytes: only A-Z change, and only ASCII white space separates
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[: n - width] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    on = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes), bitorder="little")
    return int(on.view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, mark, fp): the fingerprint of every row as a signed long; mark stands for the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts(batch.column(2))
            fps = np.fromiter((fingerprint(texts[i], width) for i in range(texts.n)), np.uint64, texts.n)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "mark", "fp"])

    own = F.col(text).cast("string")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(own).alias("mark"), own.alias("text"))
    return source.mapInArrow(run, "doc_id long, mark long, fp long")


# -- BK-trees ---------------------------------------------------------------------------------------------------------------------


class Forest:
    """BK-trees of all keys at once. Node i has the fingerprint fp[i]; its children are first[i] to first[i] + many[i] in `order`."""

    def __init__(self, key: np.ndarray, fp: np.ndarray) -> None:
        n = len(fp)
        self.fp, self.edge, parent = fp, np.zeros(n, np.int16), np.full(n, -1, np.int64)
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        self.root = first[group]  # the root of each row's own tree
        top, rest = self.root, np.arange(n)
        while len(rest):
            below = rest != top
            rest, top = rest[below], top[below]
            if not len(rest):
                break
            distance = np.bitwise_count(fp[rest] ^ fp[top]).astype(np.int64)
            _, first, group = np.unique(top * 65 + distance, return_index=True, return_inverse=True)
            chosen = rest[first]
            parent[chosen], self.edge[chosen] = top[first], distance[first]
            top = chosen[group]
        self.order = np.lexsort((self.edge, parent))
        held = parent[self.order]
        self.first = np.searchsorted(held, np.arange(n), "left")
        self.many = np.searchsorted(held, np.arange(n), "right") - self.first

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within the radius, found along the edges within the radius only."""
        query, node = queries, self.root[queries]
        while len(query):
            distance = np.bitwise_count(self.fp[query] ^ self.fp[node]).astype(np.int16)
            near = (distance <= radius) & (query != node)
            yield query[near], node[near]
            many = self.many[node]
            at = np.repeat(self.first[node] - np.cumsum(many) + many, many) + np.arange(many.sum())
            child = self.order[at]
            inside = np.abs(self.edge[child] - np.repeat(distance, many)) <= radius
            query, node = np.repeat(query, many)[inside], child[inside]


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index that each of n nodes reaches over the pairs."""
    label = np.arange(n)
    for a, b in pairs:
        while len(a):
            a, b = label[a], label[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                break
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (up := label[label]).tobytes() != label.tobytes():
                label = up
    return label


def _found(key: np.ndarray, fp: np.ndarray, asks: np.ndarray, radius: int) -> pa.RecordBatch:
    order = np.argsort(fp.astype(np.uint64), kind="stable")
    key, fp, asks = key[order], fp[order].view(np.uint64), asks[order]
    forest, queries = Forest(key, fp), np.nonzero(asks)[0]
    # the number of searches at a time follows the largest tree, so that a level has a few million steps at most
    _, sizes = np.unique(key, return_counts=True)
    step = max(64, 4_000_000 // int(sizes.max()))
    label = spanning(len(fp), (pair for i in range(0, len(queries), step) for pair in forest.search(queries[i : i + step], radius)))
    joined = np.nonzero(label != np.arange(len(fp)))[0]
    return pa.record_batch([pa.array(fp[joined].view(np.int64)), pa.array(fp[label[joined]].view(np.int64))], ["a", "b"])


def _search(radius: int, rows: int = 400_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.zeros(0, np.int64)] * 3

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            kept = [np.concatenate((a, b.astype(a.dtype))) for a, b in zip(kept, new, strict=True)]
            if len(kept[0]) >= rows and kept[0][0] != kept[0][-1]:
                cut = int(np.nonzero(kept[0] != kept[0][-1])[0][-1]) + 1  # rows come sorted by key: the last key may go on
                yield _found(kept[0][:cut], kept[1][:cut], kept[2][:cut], radius)
                kept = [x[cut:] for x in kept]
        if len(kept[0]):
            yield _found(*kept, radius)

    return run


def scheme(n: int, radius: int = RADIUS) -> list[list[tuple[int, int]]]:
    """Shard keys for n distinct fingerprints: lists of (shift, bits) of bands on which two of them may agree."""
    bands = radius + 1
    while True:
        cut = [round(64 * i / bands) for i in range(bands + 1)]
        spans = [(cut[i], cut[i + 1] - cut[i]) for i in range(bands)]
        keys = [list(x) for x in combinations(spans, bands - radius)]
        if n >> min(sum(bits for _, bits in key) for key in keys) <= DENSE or bands == 2 * radius + 2:
            return keys
        bands += 1


def links(distinct: DataFrame, n: int, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """(a, b): for distinct fingerprints fp, links that span each component of those within the radius."""
    def part(x: Column, shift: int, bits: int) -> Column:
        return F.shiftrightunsigned(x, shift).bitwiseAND(F.lit((1 << bits) - 1))

    def packed(number: int, spans: list[tuple[int, int]]) -> Column:
        key = F.lit(number).cast("long")
        for shift, bits in spans:
            key = F.shiftleft(key, bits).bitwiseOR(part(F.col("fp"), shift, bits))
        return key

    chosen = scheme(n, radius)
    every = sorted({x for spans in chosen for x in spans})
    finer = []
    for spans in chosen:
        rest = [x for x in every if x not in spans]
        wide = sum(bits for _, bits in rest)
        cut = [round(wide * j / (radius + 1)) for j in range(radius + 2)]
        finer.append(F.array(*[F.xxhash64(F.lit(j), part(packed(0, rest), cut[j], cut[j + 1] - cut[j])) for j in range(radius + 1)]))
    spread = distinct.select("fp", F.posexplode(F.array(*[packed(i, spans) for i, spans in enumerate(chosen)])).alias("number", "key"))
    dense = spread.groupBy("key").count().where(F.col("count") > most).select("key", F.lit(True).alias("dense"))
    own = F.get(F.array(*finer), F.col("number"))
    rows = spread.join(dense, "key", "left").select("fp", "key", F.explode(F.when(F.col("dense"), own).otherwise(F.array(F.lit(0).cast("long")))).alias("fine"))
    rows = rows.select("fp", F.xxhash64("key", "fine").alias("key"))
    hot = rows.groupBy("key").count().where(F.col("count") > most).select("key", F.ceil(F.col("count") / most).cast("int").alias("ways"))
    ways = F.coalesce(F.col("ways"), F.lit(1))
    dealt = (
        rows.join(hot, "key", "left")
        .withColumn("way", F.explode(F.sequence(F.lit(0), ways - 1)))
        .select(F.xxhash64("key", "way").alias("deal"), "fp", (F.pmod(F.xxhash64("fp"), ways) == F.col("way")).cast("long").alias("asks"))
    )
    width = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(width, "deal").sortWithinPartitions("deal").mapInArrow(_search(radius), "a long, b long")


# -- components -------------------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node reaches over the edges (a, b), by alternating large and small stars."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        held = both.join(least, "a")
        if large:
            return held.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        hung = held.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return hung.where("a <> b").distinct()

    def sign(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = written(down, "links")
    before = sign(pairs)
    while before[0]:
        older, pairs = pairs, written(star(star(pairs, True), False), "stars")
        release(older)
        after = sign(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _rooted(rows: DataFrame, least: Column, radius: int) -> DataFrame:
    """(fp, least, root): each different fingerprint with `least` over its rows and the fingerprint that its component is named by."""
    first = written(rows.groupBy("fp").agg(least.alias("least")), "distinct")
    roots = components(links(first.select("fp"), first.count(), radius))
    return first.join(roots, first.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): every row's fingerprint and the smallest id in its component."""
    rows = written(fingerprints(docs, doc_id, text, width).select("doc_id", "fp"), "fingerprints")
    rooted = _rooted(rows, F.min("doc_id"), radius)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row of each component: one with the smallest id, nulls last. Columns are those of docs."""
    from pyspark.sql import Window as W

    rows = written(fingerprints(docs, width=width), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "mark")
    stays = _rooted(rows, F.min(row), radius).groupBy("root").agg(F.min("least").alias("least"))
    stays = stays.select(F.col("least.doc_id").alias("__stays"), F.col("least.mark").alias("__mark"))
    own, mark = docs.doc_id.cast("long"), F.xxhash64(docs.text.cast("string"))
    kept = docs.join(stays, own.eqNullSafe(stays["__stays"]) & (mark == stays["__mark"]), "left_semi")
    # repeated rows of one id and text: any one of them stays, chosen by content
    order = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
    number = "__n"
    while number in docs.columns:
        number += "n"
    same = W.partitionBy(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))).orderBy(order)
    return kept.withColumn(number, F.row_number().over(same)).where(F.col(number) == 1).drop(number)


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op10_simhash_dedup": op10_simhash_dedup}
ORACLE: dict[str, str] = {}
