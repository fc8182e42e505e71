"""Comparison of candidates with all benchmark examples: the nearest ones of each candidate and its best score by benchmark source.

Candidates stay where they are read: there is no shuffle and no pair of rows. The benchmark is an inverted index of terms with the
largest weight of each, or a matrix of vectors, and goes to the tasks in slices of a checked size. A task scores a candidate's heaviest
terms by postings; what the others can add is bounded by their largest weights and by their length, and only items that can still be
among the `n` best, or the best of their source, are scored in full (`scored` says how many). Where profiles are blended in, the bounds hold for the
blend, and parts of the match are worked out once for each different profile.

With several slices, candidates are written once, as numbered rows of terms, and each slice makes a pass over them whose few matches are
written before the next slice is made; matches are merged by row number, so candidates may have equal or null keys. Terms are weighed by their
frequencies in all slices, and the candidates' norms come from passes over parts of the vocabulary.

A candidate with a null or empty text has similarity 0 to all examples, so that its best are the first by key; an empty benchmark
leaves no matches. Scores are rounded before they are ranked, and ties go to the smaller key; keys of examples should be unique."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as K

from ..functions import tables as T
from ..functions.text import tokens
from ..sources.scratch import release, written
from .scoring import PARTS, Postings, Profiles, Slice, Terms, Vectors, coded, rounded

#: Bytes of an index or matrix that tasks get at once, about; grams of a part of the vocabulary; cells of a table of scores that a task holds.
SLICE, GRAMS, CELLS = 64 << 20, 2_000_000, 1 << 20
#: Bytes of a term of an item in an index, its strings included.
_TERM = 40
BACKENDS = ("token_overlap", "tfidf", "embedding")


def backend_of(columns: list[str], wanted: str = "auto", vector: str = "embedding") -> str:
    """The backend that can run: vectors where there are some, else TF-IDF; a backend may be asked for by name."""
    if wanted == "auto":
        return "embedding" if vector in columns else "tfidf"
    if wanted not in BACKENDS:
        raise ValueError(f"no similarity backend {wanted!r}")
    if wanted == "embedding" and vector not in columns:
        raise ValueError(f"there is no column {vector!r} of vectors")
    return wanted


def _grams(rows: DataFrame) -> DataFrame:
    """(gram) of each different word and pair of neighbouring words of each row of column value; a pair is two words."""
    two = F.expr("transform(sequence(0, size(value) - 2), i -> array(value[i], value[i + 1]))")
    every = F.concat(F.transform("value", lambda w: F.array(w)), F.when(F.size("value") > 1, two).otherwise(F.array().cast("array<array<string>>")))
    return rows.select(F.explode(F.array_distinct(every)).alias("gram"))


def _terms(held: pa.Table, total: int) -> Terms:
    """Grams (gram, df) with the inverse document frequency of each among `total` examples."""
    grams = held.column("gram").combine_chunks()
    size = pc.list_value_length(grams).to_numpy(zero_copy_only=False)
    flat = grams.flatten()
    words = pc.unique(flat)
    code = pc.index_in(flat, words).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.cumsum(size) - size
    pair = size == 2
    keys = code[at[pair]] * len(words) + code[at[pair] + 1]
    order = np.argsort(keys)
    idf = np.log((1 + total) / (1 + held.column("df").to_numpy())) + 1
    of_words = np.zeros(len(words))  # words of pairs that are no grams here weigh nothing
    of_words[code[at[~pair]]] = idf[~pair]
    return Terms(words, keys[order], np.concatenate((of_words, idf[pair][order])))


def _fitted(lists: pa.ListArray) -> Terms:
    """All grams of lists, weighed by their frequency in these."""
    words, pairs = coded(lists, True)
    terms = Terms(words, pairs)
    _, term, _ = terms.counted(lists)
    terms.idf = np.log((1 + len(lists)) / (1 + np.bincount(term, minlength=terms.size))) + 1
    return terms


def _table(df: DataFrame) -> pa.Table:
    return df.toArrow()


def _with_squares(rows: DataFrame, counts: DataFrame, total: int, grams: int) -> DataFrame:
    """rows with the squared norm of each candidate's weighed terms, part by part of the vocabulary (gram, df)."""
    parts, found = max(1, -(-counts.count() // grams)), None
    for k in range(parts):
        sent = rows.sparkSession.sparkContext.broadcast(_terms(_table(counts.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == k)), total))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.record_batch([batch.column("row"), pa.array(sent.value.squares(batch.column("value")))], ["row", "square"])

        one = written(rows.select("row", "value").mapInArrow(run, "row long, square double"), "squares")
        sent.destroy()
        found = one if found is None else found.union(one)
    return rows.join(found.groupBy("row").agg(F.sum("square").alias("square")), "row")


def compared(
    candidates: DataFrame, bench: DataFrame, c: str, b: str, n: int = 3, backend: str = "token_overlap", text: str = "text", vector: str = "embedding", source: str | None = None,
    profile: tuple[str, str] | None = None, weights: dict[str, float] | None = None, slice_bytes: int = SLICE, grams: int = GRAMS, digits: tuple[int, int] = (6, 9), keep_profile: bool = False,
) -> DataFrame:
    """(c, matches, best, best_semantic, max_similarity, scored) of each candidate.

    matches: structs of b, semantic and, where both sides have a profile (names of struct columns), adjusted, profile_only and the parts;
    best and best_semantic: maps from benchmark source (a column of bench) to the best score, 0 at least; scored: examples that were scored in full.
    With keep_profile the candidate's profile comes too, so that it need not be made again."""
    backend, weighed = backend_of(candidates.columns, backend, vector), backend == "tfidf"
    dense = backend == "embedding"
    value = F.col(vector) if dense else F.coalesce(tokens(F.col(text)), F.array().cast("array<string>"))
    whole = bench.select(F.col(b).alias("key"), value.alias("value"), (F.col(source).cast("string") if source else F.lit("")).alias("source"), F.col(profile[1] if profile else b).alias("profile"))
    terms = F.greatest(F.size("value"), F.lit(0)).cast("long")
    counted = whole.agg(F.sum(terms).alias("terms"), F.count("*").alias("n"), *([F.sort_array(F.collect_set(F.nullif("source", F.lit("")))).alias("names")] if source else [])).first()
    total, names = counted.n, list(counted.names) if source else []
    slices = max(1, -(-((counted.terms or 0) * (8 if dense else _TERM * (2 if weighed else 1)) + 64 * total) // slice_bytes))
    used, kind = T.WEIGHTS | (weights or {}), whole.schema["key"].dataType
    key_kind = pa.string() if isinstance(kind, K.StringType) else pa.int32() if isinstance(kind, K.IntegerType) else pa.int64()
    columns = [F.col(c).alias("c"), value.alias("value"), *([F.col(profile[0]).alias("profile")] if profile else [])]
    asked = candidates.select(*columns)
    parts = ["semantic", *(["adjusted", "profile_only", *PARTS] if profile else [])]
    made = f"matches array<struct<key {kind.simpleString()}, {', '.join(f'{x} double' for x in parts)}>>, best array<double>, best_semantic array<double>, max_similarity double, scored long"
    several, counts = slices > 1, None
    if several:  # a number for each candidate, and terms made once
        asked = written(asked.select(F.monotonically_increasing_id().alias("row"), "*"), "candidates")
        whole = written(whole, "examples")
        if weighed:
            counts = written(_grams(whole).groupBy("gram").agg(F.count("*").alias("df")), "grams")
            asked = written(_with_squares(asked, counts, total, grams), "weighed")
    kept = ["profile"] if keep_profile else []
    carried = ["row", "c", *kept] if several else ["c", *kept]
    schema = K.StructType([*(asked.schema[x] for x in carried), *K._parse_datatype_string(made).fields]) if several else ", ".join([*(f"{x} {dict(asked.dtypes)[x]}" for x in carried), made])

    def one(part: DataFrame) -> tuple[DataFrame, object]:
        held = _table(part.orderBy(F.asc_nulls_first("key")))
        lists = held.column("value").combine_chunks()
        if dense:
            index: Postings | Vectors = Vectors(lists)
        else:
            if weighed and several:
                own = _grams(part).distinct().join(counts, "gram").select("gram", "df")
                known = _terms(_table(own), total)
            else:
                known = _fitted(lists) if weighed else Terms(coded(lists, False)[0])
            index = Postings(known, lists)
        at = {x: i for i, x in enumerate(names)}
        numbers = np.array([at.get(x, -1) for x in held.column("source").to_pylist()] if names else [-1] * len(lists), np.int64)
        profiles = Profiles(held.column("profile").combine_chunks()) if profile else None
        sent = candidates.sparkSession.sparkContext.broadcast(Slice(held.column("key").combine_chunks().cast(key_kind), index, numbers, len(names), profiles, used, n, digits))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for whole_batch in batches:
                for i in range(0, whole_batch.num_rows, 256):
                    batch = whole_batch.slice(i, 256)
                    lists = batch.column("value")
                    squares = None if dense else batch.column("square").to_numpy() if weighed and several else own.index.terms.squares(lists)
                    found = own.rows(lists, squares, batch.column("profile") if profile else None)
                    yield pa.record_batch([*(batch.column(x) for x in carried), *found.columns], [*carried, *found.schema.names])

        return asked.mapInArrow(run, schema), sent

    if not several:
        found, _ = one(whole)
    else:
        every, slots = None, F.pmod(F.xxhash64("key", "value"), F.lit(slices))
        for k in range(slices):
            rows, sent = one(whole.where(slots == k))
            rows = written(rows, "matches")
            sent.destroy()
            every = rows if every is None else every.union(rows)
        by = "adjusted" if profile else "semantic"
        ranked = F.array_sort(F.flatten(F.collect_list("matches")), lambda x, y: F.when(x[by] != y[by], F.when(x[by] > y[by], -1).otherwise(1)).otherwise(F.when(x["key"] < y["key"], -1).when(x["key"] > y["key"], 1).otherwise(0)))
        most = lambda name: F.array(*[F.max(F.get(name, F.lit(i))) for i in range(len(names))]).cast("array<double>").alias(name)
        found = every.groupBy("row").agg(*[F.first(x).alias(x) for x in ("c", *kept)], F.slice(ranked, 1, n).alias("matches"), most("best"), most("best_semantic"), F.max("max_similarity").alias("max_similarity"), F.sum("scored").alias("scored"))
    sources = F.array(*map(F.lit, names)).cast("array<string>")
    renamed = F.transform("matches", lambda m: F.struct(m["key"].alias(b), *[m[x].alias(x) for x in parts]))
    return found.select(F.col("c").alias(c), renamed.alias("matches"), F.map_from_arrays(sources, "best").alias("best"), F.map_from_arrays(sources, "best_semantic").alias("best_semantic"), "max_similarity", "scored", *[F.col(x).alias(profile[0]) for x in kept])


def ranked(found: DataFrame, c: str, *more: str) -> DataFrame:
    """A row for each match: c, rank from 1, and the match's fields."""
    return found.select(c, *more, F.posexplode("matches").alias("rank", "m")).select(c, *more, (F.col("rank") + 1).alias("rank"), "m.*")


def summarized(found: DataFrame, c: str, weights: dict[str, float] | None = None, threshold: float = 0.45, score: str = "adjusted", digits: int = 6, more: tuple[str, ...] = ()) -> DataFrame:
    """For each candidate: largest and mean scores of its matches, balanced score and coverage over all weighted sources (1 where none is given), the best source (ties: the
    first by name), and the selection score 0.85 balanced + 0.15 coverage; and `more` columns of found.

    Scores have nine digits at most and weights six. Sums, means and their rounding, half up, are in integers, so that no order of adding changes a digit."""
    entries, unit = F.map_entries("best"), 10 ** (9 - digits)
    nine = lambda x: F.round(x * 1e9).cast("long")
    long = lambda x: F.lit(x).cast("long")
    given = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, round(float(w) * 1e6))]) if weights else None
    weight = lambda k: F.coalesce(F.try_element_at(given, k), F.lit(1_000_000)).cast("long") if weights else long(1_000_000)
    added = lambda rows, f: F.aggregate(rows, long(0), lambda s, x: s + f(x))
    half_up = lambda top, bottom: F.coalesce(F.try_divide(F.call_function("div", 2 * top + bottom, F.greatest(2 * bottom, long(1))), F.when(bottom > 0, 10.0**digits)), F.lit(0.0))
    mean = lambda k: half_up(added("matches", lambda m: nine(m[k])), F.size("matches").cast("long") * unit)
    whole = added(entries, lambda e: weight(e["key"]))
    above = added(entries, lambda e: F.when(e["value"] >= threshold, weight(e["key"])).otherwise(long(0)))
    first = F.array_min(F.transform(entries, lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("name"))))
    made = found.select(
        c,
        *more,
        F.col("max_similarity"),
        F.coalesce(F.get("matches", F.lit(0))[score], F.lit(0.0)).alias("max_adjusted_similarity"),
        mean("semantic").alias("mean_topk_similarity"),
        mean(score).alias("mean_topk_adjusted_similarity"),
        half_up(added(entries, lambda e: weight(e["key"]) * nine(e["value"])), whole * unit).alias("balanced_score"),
        half_up(above * 10**digits, whole).alias("coverage"),
        F.coalesce(first["name"], F.lit("")).alias("best_source"),
    )
    whole_digits = lambda k: F.round(F.col(k) * 10.0**digits).cast("long")
    return made.withColumn("selection_score", (85 * whole_digits("balanced_score") + 15 * whole_digits("coverage")) / (100 * 10.0**digits))


def nearest_rows(rows: DataFrame, queries: DataFrame, key: str, vector: str, n: int, slice_bytes: int = SLICE, digits: int = 6) -> DataFrame:
    """(query_id, key, score): for each query (key, vector) its n nearest other rows by dot product, exactly.

    Queries go to the tasks in slices; a task multiplies blocks of rows with them and keeps the n best of each query, so that only these are shuffled."""
    size = queries.agg(F.sum(F.size(vector) * 8)).first()[0] or 0
    slices = max(1, -(-size // slice_bytes))
    found: DataFrame | None = None
    for k in range(slices):
        held = queries.where(F.pmod(F.xxhash64(key), F.lit(slices)) == k).where(F.col(vector).isNotNull()).select(key, vector).collect()
        if not held:
            continue
        ids, matrix = np.array([r[0] for r in held], np.int64), np.array([r[1] for r in held], float).reshape(len(held), -1)

        def run(batches: Iterator[pa.RecordBatch], ids=ids, matrix=matrix) -> Iterator[pa.RecordBatch]:
            score, best = np.full((len(ids), 0), 0.0), np.zeros((len(ids), 0), np.int64)
            for batch in batches:
                for a in range(0, batch.num_rows, max(1, CELLS // len(ids))):
                    part = batch.slice(a, max(1, CELLS // len(ids)))
                    own = part.column(0).to_numpy(zero_copy_only=False)
                    vectors = np.stack(part.column(1).to_numpy(zero_copy_only=False)).astype(float)
                    new = np.where(ids[:, None] == own, -np.inf, rounded(matrix @ vectors.T, digits))
                    score, best = np.concatenate((score, new), 1), np.concatenate((best, np.broadcast_to(own, new.shape)), 1)
                    order = np.lexsort((best, -score), axis=1)[:, :n]
                    score, best = np.take_along_axis(score, order, 1), np.take_along_axis(best, order, 1)
            real = np.isfinite(score)
            yield pa.record_batch([pa.array(np.repeat(ids, score.shape[1])[real.ravel()]), pa.array(best[real]), pa.array(score[real])], ["query_id", "id", "score"])

        part = rows.where(F.col(vector).isNotNull()).select(F.col(key).cast("long"), vector).mapInArrow(run, "query_id long, id long, score double")
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "query_id long, id long, score double")
    return found.withColumnRenamed("id", key)

