"""Exact substring deduplication over suffix arrays.

A byte goes if it is covered by a string of `LENGTH` bytes that starts anywhere else too, in the same document or another. Sorting all
suffixes of a corpus in one place is impossible, so strings that may be equal are brought together first, without losing one:

1. Each string of LENGTH bytes has one anchor, the place of the smallest hash among its GRAM-byte grams (the first of equal ones).
   Equal strings have the same gram as anchor, at the same offset. Anchors whose gram occurs once are done.
2. Anchors with the same bytes around them, as far as any of their strings reaches, repeat in whole. One of them goes on for all.
3. Where a gram has anchors of several kinds, strings whose offsets lie in the same cell of CELL offsets share a core of LENGTH - CELL + 1 bytes. A core
   and up to CELL - 1 bytes on either side make a context; equal contexts are merged with their number.
4. Contexts with the same core meet in a task. There each is a string of symbols, its bytes around one symbol for the core, and twice where it stands for
   several equal ones; a suffix array over all of them (linear grouping construction) puts equal strings of LENGTH bytes, which are CELL symbols here,
   side by side. Cores with more than MOST contexts are first split into finer cells, whose contexts have few bytes beside the
   core, and then into cells of one offset, whose contexts are their cores and so merge into one, whatever the number of documents.

Grams, cores and texts are compared by 64-bit fingerprints (those of cores together with the bytes on both sides). Step 2 decides by these alone, as
a dictionary of phrases does before their order is sought; suffix arrays decide what neither repeats in whole nor is alone.

Edge cases: null texts are empty; texts shorter than LENGTH lose nothing; repeated rows lose everything if they are long enough; rows
with equal ids and texts get a row each; an empty table gives an empty result. A text may have any length: it is searched in stretches of STRETCH bytes, and a task holds a text
and some 10 times its bytes besides. `cleaned` keeps all columns, whatever their names, and counts n_chars anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _BYTE, _FACTOR, _INVERSE, Texts, mix, pieces, powers, release, table, written
from .suffix import suffix_array

LENGTH, GRAM, CELL, FINE, MOST = 200, 40, 16, 4, 4096
#: Symbols that are sorted at once.
SORTED = 40_000
#: Starts of strings that are hashed at once, and the bits that hold a place among them.
STRETCH, _PLACE = 1 << 22, 24


class Hashes:
    """64-bit fingerprints of any part of a text."""

    def __init__(self, buf: np.ndarray) -> None:
        self.n = len(buf)
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * powers(_FACTOR, self.n))))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * powers(_INVERSE, self.n + 1)[starts] + (ends - starts).astype(np.uint64) * _BYTE[0])


def window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def anchors(text: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Of a text, by stretches: first and last start of the strings of each anchor, its place, gram, and the bytes around it, as
    fingerprints. An anchor whose strings lie in two stretches is given twice."""
    for begin in range(0, max(0, len(text) - length + 1), STRETCH):
        buf = text[begin : begin + STRETCH + length - 1]
        hashes = Hashes(buf)
        at = np.arange(len(buf) - gram + 1)
        grams = hashes.of(at, at + gram)
        low = np.uint64((1 << _PLACE) - 1)
        least = window_minimum(grams & ~low | at.astype(np.uint64), length - gram + 1)
        place = (least & low).astype(np.int64)
        turn = np.nonzero(np.concatenate(([True], place[1:] != place[:-1])))[0]
        last = np.concatenate((turn[1:], [len(place)])) - 1
        place = place[turn]
        around = mix(hashes.of(turn, last + length) + (place - turn).astype(np.uint64) * _BYTE[1])
        yield turn + begin, last + begin, place + begin, grams[place], around


_ANCHORS = "doc_id long, mark long, place long, gram long, around long"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "mark", "place", "gram", "around"]
    for batch, texts in pieces(batches, "text", 1 << 20):
        found = [(i, x) for i in range(texts.n) for x in anchors(texts.buf[texts.off[i] : texts.off[i + 1]])]
        row = pa.array(np.repeat([i for i, _ in found], [len(x[0]) for _, x in found]).astype(np.int64))
        first, last, place, gram, around = (np.concatenate([x[k] for _, x in found]) for k in range(5))
        packed = first << 16 | (place - first) << 8 | (last - first)
        columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(packed), pa.array(gram.view(np.int64)), pa.array(around.view(np.int64))]
        yield pa.record_batch(columns, names)


def cells(text: bytes, places: list[int], length: int = LENGTH, cell: int = CELL) -> Iterator[tuple[int, bytes, bytes, int]]:
    """Core, bytes before, bytes after and start of the earliest string of each cell of these anchors."""
    n, made, size = len(text), set(), length - cell + 1
    for packed in places:
        first, high, more = packed >> 16, packed >> 8 & 255, packed & 255
        for k in range((high - more) // cell, high // cell + 1):
            made.add(first + high - cell * k)  # where the core begins, the latest start of the cell
    begins = np.array(sorted(b for b in made if 0 <= b <= n - size), np.int64)
    for held in np.split(begins, np.nonzero(np.diff(begins // STRETCH))[0] + 1) if len(begins) else []:
        low = int(held[0])
        cores = Hashes(np.frombuffer(text, np.uint8)[low : int(held[-1]) + size]).of(held - low, held - low + size).view(np.int64)
        for core, b in zip(cores.tolist(), held.tolist(), strict=True):
            e = b + size
            yield core, text[max(0, b - cell + 1) : b], text[e : e + cell - 1], b - cell + 1


_CELLS = "core long, before binary, after binary, cell int, doc_id long, mark long, base long"


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.strip().split(" ") for x in schema.split(",")]
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in pieces(batches, "text", 1 << 20):
        out: list[list] = [[] for _ in range(7)]
        for doc_id, mark, i, places in zip(batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(), range(texts.n), batch.column("places").to_pylist(), strict=True):
            for core, before, after, base in cells(texts[i], places):
                for column, value in zip(out, (core, before, after, CELL, doc_id, mark, base), strict=True):
                    column.append(value)
        yield _batch(out, _CELLS)


def _finer(old: int, new: int):
    """The same strings in cells of `new` offsets instead of `old`."""

    def digest(*parts: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"|".join(parts), digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for core, before, after, _, doc_id, mark, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # a context at the edge of its text has fewer bytes: base is where its earliest string would start
                start = base + old - 1 - len(before)
                for t in range(old // new):
                    inner, outer = new * t, old - new * (t + 1)  # bytes before and after the old core that belong to the new one
                    if len(before) < inner or len(after) < outer:
                        continue
                    b = len(before) - inner
                    finer = digest(core.to_bytes(8, "little", signed=True), before[b:], after[:outer])
                    row = (finer, before[max(0, b - new + 1) : b], after[outer : outer + new - 1], new, doc_id, mark, start + b - new + 1)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield _batch(out, _CELLS)

    return run


def repeated(contexts: list[tuple[int, bytes, bytes, int, int]]) -> list[int]:
    """For contexts (core, before, after, cell, number), all of a core together: a bit for each offset of the cell whose string repeats.

    Bit k stands for the string that starts k bytes after the cell's earliest start."""
    # symbols: 0 ends a context, bytes are 1 to 256, cores follow
    symbols, starts, number, core_of = [], [], 0, None
    for core, before, after, cell, n in contexts:
        if (core, cell) != core_of:
            number, core_of = number + 1, (core, cell)
        starts.append(len(symbols))
        one = [*(b + 1 for b in before), 256 + number, *(b + 1 for b in after), 0]
        symbols += one if n == 1 else one + one  # equal contexts are there twice
    text = np.array(symbols, np.int64) + 1
    text = np.append(text, 0)  # the least symbol ends all
    order = np.array(suffix_array(text))
    lengths = {c[3] for c in contexts}
    equal = {}
    for cell in lengths:
        a, b = order[:-1], order[1:]
        same = np.ones(len(a), bool)
        for k in range(cell):
            same &= text[np.minimum(a + k, len(text) - 1)] == text[np.minimum(b + k, len(text) - 1)]
        hit = np.zeros(len(text), bool)
        hit[a[same]] = hit[b[same]] = True
        equal[cell] = hit
    masks = []
    for (_, before, after, cell, _), start in zip(contexts, starts, strict=True):
        mask = 0
        for k in range(len(before) + 1):
            own = len(before) - k  # bytes of the string before the core
            if own < cell and cell - 1 - own <= len(after) and equal[cell][start + k]:
                mask |= 1 << (cell - 1 - own)
        masks.append(mask)
    return masks


_MASKS = "context long, mask int"


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by core; cores are sorted together as far as SORTED symbols go."""
    held: list[tuple] = []
    group: list[tuple] = []
    size = 0

    def done() -> pa.RecordBatch:
        masks = repeated([x[:5] for x in held])
        hit = [(x[5], m) for x, m in zip(held, masks, strict=True) if m]
        return _batch([[c for c, _ in hit], [m for _, m in hit]], _MASKS)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if group and (group[0][0], group[0][3]) != (row[0], row[3]):
                if len(group) > 1 or group[0][4] > 1:
                    held += group
                    size += sum(len(x[1]) + len(x[2]) + 2 for x in group)
                    if size >= SORTED:
                        yield done()
                        held, size = [], 0
                group = []
            group.append(row)
    if group and (len(group) > 1 or group[0][4] > 1):
        held += group
    if held:
        yield done()


def starts(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, first, last): ranges of starts of repeated strings; docs has doc_id, mark and text."""
    spark = docs.sparkSession
    found = written(docs.where(F.octet_length("text") >= LENGTH).mapInArrow(_anchors, _ANCHORS), "anchors")
    # what is counted is written before it is joined: Spark splits a hot gram only between two plain shuffles
    twice = written(found.groupBy("gram").count().where("count > 1").select("gram"), "grams")
    shared = written(found.join(twice, "gram", "left_semi"), "shared")
    release(found, twice)

    one = F.min(F.struct("doc_id", "mark", "place")).alias("one")
    groups = written(shared.groupBy("gram", "around").agg(F.count("*").alias("n"), one).select("gram", "around", "n", "one.*"), "groups")
    whole = groups.where("n > 1").select("gram", "around")
    whole = written(shared.join(whole, ["gram", "around"], "left_semi").select("doc_id", "mark", "place"), "whole")
    release(shared)

    # one anchor of each kind stands for its equals; a gram with one kind needs no more than the above
    varied = written(groups.groupBy("gram").count().where("count > 1").select("gram"), "varied")
    rest = groups.join(varied, "gram", "left_semi").groupBy("doc_id", "mark").agg(F.collect_list("place").alias("places"))
    near = docs.join(rest, docs.doc_id.eqNullSafe(rest.doc_id) & (docs.mark == rest.mark)).select(docs.doc_id, docs.mark, "text", "places")
    coarse = written(near.mapInArrow(_cells, _CELLS), "cells")
    release(groups, varied)
    both = coarse
    for old, new in ((CELL, FINE), (FINE, 1)):
        kinds = both.where(F.col("cell") == old).groupBy("core").agg(F.count("*").alias("count"))
        hot = written(kinds.where(F.col("count") > MOST).select("core"), "hot")
        wide = (F.col("cell") == old) & F.col("dense").isNotNull()
        flagged = both.join(hot.withColumn("dense", F.lit(True)), "core", "left").select(*coarse.columns, "dense")
        fine = flagged.where(wide).select(*coarse.columns).mapInArrow(_finer(old, new), _CELLS)
        both = flagged.where(~wide).select(*coarse.columns).union(fine)
    both = written(both.withColumn("context", F.xxhash64("core", "before", "after", "cell")), "contexts")
    release(coarse)

    merged = both.groupBy("core", "before", "after", "cell", "context").agg(F.count("*").alias("n")).select("core", "before", "after", "cell", "n", "context")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    masks = merged.repartition(width, "core").sortWithinPartitions("core", "cell").mapInArrow(_masks, _MASKS)
    bits = both.join(masks, "context").select("doc_id", "mark", "base", F.explode(F.sequence(F.lit(0), F.lit(CELL - 1))).alias("k"), "mask")
    single = bits.where(F.expr("shiftright(mask, k) & 1 = 1")).select("doc_id", "mark", (F.col("base") + F.col("k")).alias("first"))
    first = F.shiftright("place", 16)
    ranges = whole.select("doc_id", "mark", first.alias("first"), (first + F.col("place").bitwiseAND(F.lit(255))).alias("last"))
    result = written(single.select("doc_id", "mark", "first", F.col("first").alias("last")).union(ranges), "starts")
    release(both, whole)
    return result


def covered(first: np.ndarray, last: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the strings with these starts cover."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    low, high = first[order], np.maximum.accumulate(last[order] + length)
    new = np.concatenate(([True], low[1:] > high[:-1]))
    begin = np.nonzero(new)[0]
    return list(zip(low[begin].tolist(), high[np.concatenate((begin[1:] - 1, [len(low) - 1]))].tolist(), strict=True))


def without(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def at_characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs shortened so that no character is cut."""
    out = []
    for a, b in runs:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _marked(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def with_runs(docs: DataFrame) -> DataFrame:
    """docs, whole, as a struct `row`, with text (null: empty) and flat lists of first and last starts of repeated strings."""
    found = starts(_marked(docs)).groupBy("doc_id", "mark").agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))
    found = found.withColumnsRenamed({"doc_id": "__d", "mark": "__m"})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), F.col("doc_id").cast("long").alias("__doc"), text.alias("text"))
    return whole.join(found, F.col("__doc").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__m")), "left").select("row", "text", "first", "last")


def _runs(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int]]]:
    for first, last in zip(batch.column("first"), batch.column("last"), strict=True):
        yield covered(*(x.values.to_numpy(zero_copy_only=False).astype(np.int64) for x in (first, last))) if first.is_valid else []


def cleaned(docs: DataFrame) -> DataFrame:
    """docs without the repeated bytes (whole characters of them), with n_chars counted anew; texts without a word left go."""
    rows = with_runs(docs)
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 4 << 20):
            kept = [without(t, at_characters(t, r)).decode() for t, r in zip((texts[i] for i in range(texts.n)), _runs(batch), strict=True)]
            yield pa.record_batch([batch.column("row"), pa.array(kept, pa.string()), pa.array([bool(r) for r in _runs(batch)])], ["row", "text", "cut"])

    done = rows.mapInArrow(run, f"row {kind}, text string, cut boolean").where("not cut or text rlike '[^ \\\\x09-\\\\x0D]'")
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("text"))
        elif c == "n_chars":
            out.append(F.when(F.col("cut"), F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col("row.n_chars")).alias(c))
        else:
            out.append(F.col(f"row.`{c}`").alias(c))
    return done.select(*out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in pieces(batches, "text", 4 << 20):
        runs = list(_runs(batch))
        sizes = texts.sizes()
        removed = [sum(b - a for a, b in r) for r in runs]
        shas = [hashlib.sha256(without(texts[i], r)).hexdigest() for i, r in enumerate(runs)]
        ids = batch.column("row").field("doc_id")
        yield pa.record_batch([ids, pa.array(sizes), pa.array(removed, pa.int64()), pa.array([len(r) for r in runs], pa.int64()), pa.array(shas)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_runs(docs).mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLE: dict[str, str] = {}
