"""Similarity, statistics of scores, mixes, buckets and plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import profiles as P
from ..operators import buckets, cells, matching, similarity, stats
from . import base
from .base import table
from .profile_queries import _COSINE

SOURCES, SOURCE_WEIGHTS = base.BENCHMARKS, [1.0, 1.0, 1.0]


def _compared(spark, sf, n, backend="token_overlap"):
    b = table(spark, sf, "benchmark").select("item_id", "text", base.pick(SOURCES, F.col("item_id")).alias("benchmark_source"))
    return matching.compared(base.spread(table(spark, sf, "documents").select("doc_id", "text")), b, "doc_id", "item_id", n, backend, source="benchmark_source")


def similarity_top_matches(spark, sf):
    """Flagship: the three nearest benchmark items of each document."""
    return matching.ranked(_compared(spark, sf, 3), "doc_id").select("doc_id", "rank", "item_id", F.col("semantic").alias("similarity"))


_PAIRS = f"WITH {_COSINE}"
TOP_MATCHES = f"""{_PAIRS}, best AS (SELECT d.doc_id, b.item_id, coalesce(p.similarity, 0.0) AS similarity FROM documents d CROSS JOIN benchmark b LEFT JOIN pairs p ON p.doc_id = d.doc_id AND p.item_id = b.item_id)
SELECT doc_id, CAST(rank AS INT) AS rank, item_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, item_id) AS rank FROM best) WHERE rank <= 3"""


def token_frequency(spark, sf):
    from ..functions.text import tokens

    return similarity.frequencies(table(spark, sf, "benchmark"), "item_id", tokens("text"))


def token_norm(spark, sf):
    from ..functions.text import tokens

    found = similarity.norms(similarity.frequencies(table(spark, sf, "documents"), "doc_id", tokens("text")), "doc_id")
    return found.select("doc_id", F.round("norm", 6).alias("norm"))


def similarity_source_scores(spark, sf):
    found = matching.summarized(_compared(spark, sf, 1), "doc_id", dict(zip(SOURCES, SOURCE_WEIGHTS, strict=True)), score="semantic")
    return found.select("doc_id", "balanced_score", "coverage", "best_source", "selection_score")


SOURCE_SCORES = f"""{_PAIRS}, w AS (SELECT unnest({base.sql_list(SOURCES)}) AS source, 1.0::DOUBLE AS weight),
s AS (SELECT doc_id, {base.sql_pick(SOURCES, 'item_id')} AS source, greatest(0.0, max(similarity)) AS best FROM pairs GROUP BY ALL),
f AS (SELECT d.doc_id, w.source, w.weight, coalesce(s.best, 0.0) AS best FROM documents d CROSS JOIN w LEFT JOIN s ON s.doc_id = d.doc_id AND s.source = w.source),
a AS (SELECT doc_id, {base.sql_half_up('sum(CAST(round(best * 1e9) AS HUGEINT))', 'count(*) * 1000')} AS balanced, {base.sql_half_up('count(*) FILTER (best >= 0.45) * 1000000', 'count(*)')} AS cov FROM f GROUP BY doc_id),
t AS (SELECT doc_id, source FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY best DESC, source) = 1)
SELECT doc_id, balanced / 1e6 AS balanced_score, cov / 1e6 AS coverage, t.source AS best_source, (85 * balanced + 15 * cov) / 1e8 AS selection_score FROM a JOIN t USING (doc_id)"""


def tfidf_similarity(spark, sf):
    return matching.ranked(_compared(spark, sf, 3, "tfidf"), "doc_id").select("doc_id", "rank", "item_id", F.col("semantic").alias("similarity"))


def _grams(source: str, key: str) -> str:
    return f"""SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) AS term
 FROM (SELECT {key}, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM {source})) GROUP BY ALL"""


TFIDF = f"""WITH bt AS ({_grams('benchmark', 'item_id')}), dt AS ({_grams('documents', 'doc_id')}),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM benchmark)) / (1 + count(*))) + 1 AS idf FROM bt GROUP BY term),
bw AS (SELECT item_id, term, tf * idf AS w FROM bt JOIN idf USING (term)), dw AS (SELECT doc_id, term, tf * idf AS w FROM dt JOIN idf USING (term)),
bn AS (SELECT item_id, sqrt(sum(w * w)) AS n FROM bw GROUP BY item_id), dn AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM dw GROUP BY doc_id),
dots AS (SELECT doc_id, item_id, sum(dw.w * bw.w) AS dot FROM dw JOIN bw USING (term) GROUP BY ALL),
p AS (SELECT doc_id, item_id, round(dot / (dn.n * bn.n), 6) AS similarity FROM dots JOIN dn USING (doc_id) JOIN bn USING (item_id)),
best AS (SELECT d.doc_id, b.item_id, coalesce(p.similarity, 0.0) AS similarity FROM documents d CROSS JOIN benchmark b LEFT JOIN p ON p.doc_id = d.doc_id AND p.item_id = b.item_id)
SELECT doc_id, CAST(rank AS INT) AS rank, item_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, item_id) AS rank FROM best) WHERE rank <= 3"""


def embedding_similarity_topk(spark, sf):
    """Nearest of all vectors for those whose id is divisible by 100: a stated query set."""
    e = table(spark, sf, "embeddings")
    near = matching.nearest_rows(e, e.where("vec_id % 100 = 0"), "vec_id", "embedding", 3)
    return stats.top_k_by(near, 3, "score", "vec_id", "query_id").select("query_id", "rank", "vec_id", "score")


def embedding_cells_topk(spark, sf):
    """The same through cells: those of the nearest centres, then those that can hold a nearer row."""
    e = table(spark, sf, "embeddings")
    return cells.nearest(cells.indexed(e, "vec_id", "embedding"), e.where("vec_id % 100 = 0"), "vec_id", "embedding", 3, probes=2, exact=True)


EMBEDDING = """WITH p AS (SELECT q.vec_id AS query_id, e.vec_id, round(list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM embeddings e JOIN embeddings q
 ON q.vec_id % 100 = 0 AND e.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 3"""

# -- statistics of the best score ------------------------------------------------------------------------------------------------------


def _best(spark, sf):
    """Each document with its nearest item, the item's source, and a family made from its source."""
    d = base.spread(table(spark, sf, "documents").select("doc_id", "text", "source"))
    b = table(spark, sf, "benchmark").select("item_id", "text")
    # the source goes with the key, so that documents are read once
    keyed = d.select(F.struct("doc_id", "source").alias("key"), "text")
    best = matching.ranked(matching.compared(keyed, b, "key", "item_id", 1), "key")
    family = P.source_family(base.pick(base.NAMES, F.col("key.doc_id")))
    picked = [base.pick(SOURCES, F.col("item_id")).alias("best_benchmark"), base.pick(["counting", "summary"], F.col("item_id")).alias("skill")]
    return best.select("key.doc_id", "key.source", family.alias("family"), F.col("semantic").alias("similarity"), *picked)


_BEST = f"""{_PAIRS}, every AS (SELECT d.doc_id, d.source, b.item_id, coalesce(p.similarity, 0.0) AS similarity, {base.sql_pick(base.NAMES, 'd.doc_id')} AS name
 FROM documents d CROSS JOIN benchmark b LEFT JOIN pairs p ON p.doc_id = d.doc_id AND p.item_id = b.item_id),
one AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, item_id) = 1),
best AS (SELECT doc_id, source, {base.FAMILY} AS family, similarity, {base.sql_pick(SOURCES, 'item_id')} AS best_benchmark, {base.sql_pick(['counting', 'summary'], 'item_id')} AS skill FROM one)"""


def _stats(*keys):
    def query(spark, sf):
        return stats.score_stats(_best(spark, sf), "similarity", *keys)

    figures = "count(similarity) AS count, round(min(similarity), 6) AS min, round(max(similarity), 6) AS max, round(avg(similarity), 6) AS mean"
    figures += "".join(f", round(quantile_cont(similarity, {p}), 6) AS p{round(100 * p)}" for p in (0.5, 0.9, 0.95))
    names = ", ".join(keys)
    return query, f"{_BEST} SELECT {names + ', ' if keys else ''}{figures} FROM best{f' GROUP BY {names}' if keys else ''}"


def source_mix_topk(spark, sf):
    return stats.mix(stats.top_k(_best(spark, sf), 100, "similarity", "doc_id"), "family")


SOURCE_MIX = f"""{_BEST}, t AS (SELECT * FROM best ORDER BY similarity DESC, doc_id LIMIT 100)
SELECT family, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS fraction FROM t GROUP BY family"""


def _mix_by(*keys):
    def query(spark, sf):
        return stats.mix(stats.top_k_by(_best(spark, sf), 20, "similarity", "doc_id", *keys), "family", *keys)

    names = ", ".join(keys)
    return query, f"""{_BEST}, t AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY {names} ORDER BY similarity DESC, doc_id) <= 20)
SELECT {names}, family, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY {names}), 6) AS fraction FROM t GROUP BY {names}, family"""


# -- weak buckets ----------------------------------------------------------------------------------------------------------------------


def _samples(spark, sf, parity):
    e = table(spark, sf, "events").where(F.col("event_id") % 2 == parity)
    return e.select(F.col("event_type").alias("duration"), F.concat(F.lit("task "), F.col("user_id") % 4).alias("task_type"), F.when(F.col("value") > 20 + 20 * parity, 1.0).otherwise(0.0).alias("score"))


def priority_buckets(spark, sf):
    return buckets.priorities(_samples(spark, sf, 0), _samples(spark, sf, 1))


_BUCKETS = r"""WITH e AS (SELECT event_id % 2 AS parity, event_type AS duration, 'task ' || (user_id % 4) AS task_type, CASE WHEN value > 20 + 20 * (event_id % 2) THEN 1.0 ELSE 0.0 END AS score FROM events),
c AS (SELECT duration, task_type, count(*) AS total_count, count(*) FILTER (score < 1) AS wrong_count, round(100 * avg(score), 2) AS accuracy FROM e WHERE parity = 0 GROUP BY ALL),
b AS (SELECT duration, task_type, round(100 * avg(score), 2) AS base FROM e WHERE parity = 1 GROUP BY ALL),
g AS (SELECT c.*, base, round(100 - accuracy, 2) AS error_rate, CASE WHEN base IS NULL THEN 0.0 ELSE round(base - accuracy, 2) END AS baseline_gap_pp FROM c LEFT JOIN b USING (duration, task_type)),
p AS (SELECT *, round(wrong_count * (1 + greatest(0.0, baseline_gap_pp) / 10), 4) AS priority_score FROM g),
r AS (SELECT *, row_number() OVER (ORDER BY priority_score DESC, wrong_count DESC, error_rate DESC, duration, task_type) AS rank FROM p),
buckets AS (SELECT duration, task_type, total_count, wrong_count, accuracy, error_rate, baseline_gap_pp, priority_score, CAST(rank AS INT) AS rank, coalesce(base, 0.0) AS baseline_accuracy,
 CASE WHEN rank <= 5 THEN 'critical' WHEN rank <= 12 THEN 'hard' WHEN error_rate >= 35 THEN 'medium' ELSE 'easy' END AS difficulty_tier,
 regexp_replace(lower(duration || '_' || task_type), '[^a-z0-9]+', '_', 'g') AS bucket_key FROM r)"""
PRIORITY = f"{_BUCKETS} SELECT * FROM buckets"


def bucket_sampling_plan(spark, sf):
    chosen = priority_buckets(spark, sf).where("rank <= 6").select("bucket_key", "priority_score")
    e = table(spark, sf, "events")
    key = buckets.slug(F.concat_ws("_", "event_type", F.concat(F.lit("task "), F.col("user_id") % 4)))
    mixes = e.groupBy(key.alias("bucket_key"), base.pick(base.NAMES, F.col("user_id")).alias("family")).agg(F.count("*").alias("count"))
    return buckets.plan(chosen, mixes).select("bucket_key", "priority_score", "bucket_weight", "family", "count", "source_share")


PLAN = f"""{_BUCKETS}, chosen AS (SELECT bucket_key, priority_score, round(priority_score / sum(priority_score) OVER (), 4) AS bucket_weight FROM buckets WHERE rank <= 6),
m AS (SELECT regexp_replace(lower(event_type || '_task ' || (user_id % 4)), '[^a-z0-9]+', '_', 'g') AS bucket_key, {base.sql_pick(base.NAMES, 'user_id')} AS family, count(*) AS count FROM events GROUP BY ALL)
SELECT bucket_key, priority_score, bucket_weight, family, count, round(count / sum(count) OVER (PARTITION BY bucket_key), 4) AS source_share FROM chosen JOIN m USING (bucket_key)"""

_ALL = {
    "similarity_top_matches": (similarity_top_matches, TOP_MATCHES),
    "token_frequency": (token_frequency, "SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM benchmark) GROUP BY ALL"),
    "token_norm": (token_norm, f"WITH {_COSINE} SELECT doc_id, round(norm, 6) AS norm FROM dn"),
    "similarity_source_scores": (similarity_source_scores, SOURCE_SCORES),
    "tfidf_similarity": (tfidf_similarity, TFIDF),
    "embedding_similarity_topk": (embedding_similarity_topk, EMBEDDING),
    "embedding_cells_topk": (embedding_cells_topk, EMBEDDING),
    "score_stats_overall": _stats(),
    "score_stats_by_source": _stats("source"),
    "score_stats_by_family": _stats("family"),
    "source_mix_topk": (source_mix_topk, SOURCE_MIX),
    "mix_by_benchmark": _mix_by("best_benchmark"),
    "mix_by_benchmark_skill": _mix_by("best_benchmark", "skill"),
    "priority_buckets": (priority_buckets, PRIORITY),
    "bucket_sampling_plan": (bucket_sampling_plan, PLAN),
}
QUERIES = {k: q for k, (q, _) in _ALL.items()}
ORACLE = {k: s for k, (_, s) in _ALL.items()}
