"""Source divergence audit by two-dimensional tiling of groups.

Groups are the sources of a language. Tasks count the terms of whole texts; terms in at least LEAST documents of their language are
kept and dealt to vocabulary chunks of about CHUNK terms. The counts of BLOCK groups over a chunk are packed into one row. These rows
are replicated to the tiles, group block by group block, that need them; a task reads the rows of a tile chunk by chunk, holds two
blocks of counts over one chunk and the sums of its submatrix in both directions, and writes these sums. A tile of many chunks is
cut into spans, whose sums are added.

With N kept occurrences in a group and V kept terms, a term that occurs n times has p = 1 + floor(10^9 (n + 1) / (N + V)). The
divergence of a group from another, or from its whole language, sums floor((p - q)^2 / q). All of it is in integers: quotients come
digit by digit in base 1000, so N + V may reach 9 * 10^15.

A hot source or language is spread over tasks: its counts are sums of partial ones and its chunks go to different tasks. Only the pairs of
groups of a language are quadratic, and they are the result.

Edge cases: null text, language and source count as ''; groups without terms have no counts but pairs with all others; where a
language keeps no term, pairs have value 0; texts may have any length (a task holds one and some ten times its bytes); repeated rows
are documents of their own; an empty table gives an empty result; other columns, whatever they are named, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import pieces, table, written

#: Documents of a language that must hold a term; ranks of terms that are returned.
LEAST, RANKS = 3, 200
#: Groups of a block, terms of a chunk, chunks of a span; terms that a task counts before it writes them.
BLOCK, CHUNK, SPAN, HELD = 32, 4096, 16, 1 << 19
#: Languages that are broadcast at most, with two numbers each.
FEW = 100_000

#: Letters, with A-Z in lower case, and all bytes above ASCII stay; the rest separates.
_LETTERS = bytes(b if 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def counted(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, df) of documents; a row with an empty term stands for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], dict[bytes, int]] = {}  # of each term the occurrences, times 2^32, and the documents
        size = 0

        def out() -> pa.RecordBatch:
            names = [x for g, c in groups.items() for x in [g] * (len(c) + 1)]
            keys = [t.decode() for c in groups.values() for t in (b"", *c)]
            both = np.array([x for c in groups.values() for x in (0, *c.values())], np.int64)
            columns = [pa.array([x for x, _ in names], pa.string()), pa.array([x for _, x in names], pa.string()), pa.array(keys, pa.string()), pa.array(both >> 32), pa.array(both & 0xFFFFFFFF)]
            return pa.record_batch(columns, ["lang", "source", "term", "n", "df"])

        for batch, texts in pieces(batches, "text", 1 << 20):
            for i, group in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)):
                found = groups.setdefault(group, {})
                size -= len(found)
                known = found.get
                for term, n in Counter(terms(texts[i])).items():
                    found[term] = known(term, 0) + (n << 32) + 1
                size += len(found)
                if size > held:
                    yield out()
                    groups, size = {}, 0
        yield out()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    partial = docs.select(*named).mapInArrow(run, "lang string, source string, term string, n long, df long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(n: str, whole: str) -> str:
    """SQL of 1 + floor(10^9 (n + 1) / whole), for n < whole."""
    value, rest = "0L", f"({n} + 1L)"
    for _ in range(3):
        value, rest = f"({value} * 1000L + ({rest} * 1000L) div {whole})", f"(({rest} * 1000L) % {whole})"
    return f"(1L + {value})"


def shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The same of arrays."""
    value, rest = np.zeros(n.shape, np.int64), n + 1
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        value = value * 1000 + more
    return value + 1


def packed_counts(row: np.ndarray, at: np.ndarray, n: np.ndarray) -> bytes:
    """Counts n of groups `row` and terms `at` as bytes: places, then counts."""
    return np.concatenate([row.astype(np.int64) << 32 | at, n]).astype(np.int64).tobytes()


def unpacked_counts(data: bytes | None, groups: int, width: int) -> np.ndarray:
    """A table of groups by terms; None is a table of zeros."""
    out = np.zeros((groups, width), np.int64)
    if data is not None:
        place, n = np.frombuffer(data, np.int64).reshape(2, -1)
        out[place >> 32, place & 0xFFFFFFFF] = n
    return out


def submatrix(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sums over terms of floor((p - q)^2 / q), for each row of p with each row of q."""
    out = np.empty((len(p), len(q)), np.int64)
    for i, own in enumerate(p):
        gap = own - q
        out[i] = (gap * gap // q).sum(axis=1)
    return out


def _pack(part: pa.Table) -> pa.Table:
    counts = packed_counts(*(part.column(c).to_numpy() for c in ("row", "at", "n")))
    return pa.table([*(part.column(c)[:1] for c in ("lang", "block", "chunk")), pa.array([counts], pa.binary())], ["lang", "block", "chunk", "counts"])


def _tiles(block: int):
    """Rows (lang, low, high, span, chunk, side, width, wholes, counts) in this order to sums (lang, a, b, value) of each tile and span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, chunk, sides, sums = None, None, {}, None

        def added() -> None:
            nonlocal sums
            if sides:
                low, high = sides[0], sides.get(1, sides[0])
                new = [submatrix(low, high), *([submatrix(high, low)] if 1 in sides else [])]
                sums = new if sums is None else [a + b for a, b in zip(sums, new, strict=True)]

        def out() -> Iterator[pa.RecordBatch]:
            for (first, second), matrix in zip((tile[1:3], tile[2:0:-1]), sums or [], strict=False):
                a, b = np.indices(matrix.shape).reshape(2, -1)
                yield pa.record_batch([pa.array([tile[0]] * matrix.size, pa.string()), *map(pa.array, (first * block + a, second * block + b, matrix.ravel()))], ["lang", "a", "b", "value"])

        for batch in batches:
            for i in range(batch.num_rows):
                lang, low, high, span, number, side, width, wholes, counts = (batch.column(k)[i].as_py() for k in range(9))
                new = (lang, low, high, span)
                if new != tile or number != chunk:
                    added()
                    sides, chunk = {}, number
                if new != tile:
                    if tile is not None:
                        yield from out()
                    tile, sums = new, None
                sides[side] = shares(unpacked_counts(counts, len(wholes), width), np.array(wholes, np.int64)[:, None])
        added()
        if tile is not None:
            yield from out()

    return run


def audited(docs: DataFrame, least: int = LEAST, ranks: int = RANKS, block: int = BLOCK, chunk: int = CHUNK, span: int = SPAN) -> DataFrame:
    """(lang, source, part, item, value, rank): of each group its divergence from the others (part `pair`, all ranks), and the `ranks` terms that set
    it most apart from its language (part `term`)."""
    counts = written(counted(docs), "counts")
    found = counts.where("term <> ''")
    kept = found.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n_lang")).where(F.col("df") >= least)
    kept = written(kept, "kept")
    vocabulary = written(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("all_lang")), "vocabulary")
    if vocabulary.count() <= FEW:  # else a join would deal all terms of a language to one task
        vocabulary = F.broadcast(vocabulary)
    chunked = kept.join(vocabulary, "lang").withColumn("chunk", F.expr(f"pmod(xxhash64(term), (v + {chunk - 1}L) div {chunk}L)"))
    at = F.row_number().over(W.partitionBy("lang", "chunk").orderBy("term")) - 1
    own = found.select("lang", "source", "term", "n").join(chunked.withColumn("at", at).select("lang", "term", "n_lang", "chunk", "at"), ["lang", "term"])
    own = written(own, "own")
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("kept"))
    groups = counts.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(vocabulary, "lang", "left")
    number = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    groups = groups.select("lang", "source", number.alias("g"), (F.coalesce("kept", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("whole"), F.coalesce("v", F.lit(0)).alias("v"), (F.col("all_lang") + F.col("v")).alias("whole_lang"))
    groups = written(groups, "groups")

    # counts of a block of groups over a chunk, as one row
    numbered = own.join(groups.select("lang", "source", "g"), ["lang", "source"]).select("lang", F.expr(f"g div {block}").alias("block"), "chunk", (F.col("g") % block).alias("row"), "at", "n")
    packs = numbered.groupBy("lang", "block", "chunk").applyInArrow(_pack, "lang string, block long, chunk long, counts binary")
    # tiles of two blocks by chunks, each with what it needs
    rows = groups.where("v > 0").groupBy("lang", F.expr(f"g div {block}").alias("block"))
    blocks = rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("g", "whole"))), lambda x: x["whole"]).alias("wholes"))
    widths = chunked.groupBy("lang", "chunk").agg(F.count("*").cast("int").alias("width"))
    last = blocks.groupBy("lang").agg(F.max("block").alias("last"))
    need = last.select("lang", F.explode(F.expr("sequence(0L, last)")).alias("low"), "last").select("lang", "low", F.explode(F.expr("sequence(low, last)")).alias("high"))
    sides = F.when(F.col("low") == F.col("high"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    need = need.join(widths, "lang").withColumn("side", F.explode(sides)).withColumn("block", F.when(F.col("side") == 0, F.col("low")).otherwise(F.col("high")))
    need = need.join(blocks, ["lang", "block"]).join(packs, ["lang", "block", "chunk"], "left").withColumn("span", F.expr(f"chunk div {span}"))
    tiles = need.select("lang", "low", "high", "span", "chunk", "side", "width", "wholes", "counts").repartition("lang", "low", "high", "span").sortWithinPartitions("lang", "low", "high", "span", "chunk", "side")
    matrix = tiles.mapInArrow(_tiles(block), "lang string, a long, b long, value long").where("a <> b").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    name = lambda g, s: groups.select("lang", F.col("g").cast("long").alias(g), F.col("source").alias(s))
    pairs = matrix.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"]).select("lang", "source", "item", "value")
    none = groups.where("v = 0").select("lang", "source")
    pairs = pairs.union(none.join(none.withColumnRenamed("source", "item"), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long")))

    shared = own.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), F.expr(share("n", "whole")).alias("p"), F.expr(share("n_lang", "whole_lang")).alias("q"))
    apart = shared.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").union(ranked(apart, "term").where(F.col("rank") <= ranks))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def _share_sql(n: str, whole: str) -> str:
    return f"(1 + (1000000000::HUGEINT * ({n} + 1)) // ({whole}))"


DIVERGENCE = rf"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n_lang FROM t GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST}),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n_lang)::HUGEINT AS all_lang FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
w AS (SELECT lang, source, sum(n)::HUGEINT AS n_all FROM c GROUP BY ALL),
g AS (SELECT s.lang, s.source, coalesce(n_all, 0) + coalesce(v, 0) AS whole, all_lang + v AS whole_lang FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN w USING (lang, source) LEFT JOIN v ON v.lang = s.lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_share_sql('coalesce(c.n, 0)', 'whole')} AS p, {_share_sql('n_lang', 'whole_lang')} AS q
 FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
 UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM x QUALIFY part = 'pair' OR rank <= {RANKS}"""

QUERIES = {"op12_source_divergence": op12_source_divergence}
ORACLE = {"op12_source_divergence": DIVERGENCE}
