"""Profiles, matches and classification over stand-in records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import profiles as P
from ..functions import tables as T
from ..functions.text import normalized, similarity_text
from ..operators import buckets, matching
from ..operators.selection import best_per_id, capped_top, soft_cap
from . import base
from .base import BENCHES, CANDIDATES, table

TAGS = ("domain_tags", "skill_tags", "reasoning_tags", "modality_tags", "locality_tags")


def example_text_projection(spark, sf):
    d = table(spark, sf, "documents")
    n = F.col("doc_id")
    return d.select("doc_id", similarity_text(F.col("text"), F.col("lang"), most=200).alias("similarity_text"), F.length(normalized("text")).cast("long").alias("normalized_length"), (n % 2).alias("parity"))


EXAMPLE_TEXT = r"""WITH t AS (SELECT doc_id, 'Question: ' || trim(text, E' \t\n\r\f\x0b') || E'\nAnswer: ' || lang AS s, text FROM documents)
SELECT doc_id, CASE WHEN length(s) > 200 THEN rtrim(left(s, 188), E' \t\n\r\f\x0b') || ' [truncated]' ELSE s END AS similarity_text,
 length(trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS normalized_length, doc_id % 2 AS parity FROM t"""


def example_item_id(spark, sf):
    c = table(spark, sf, "conversations")
    own = F.concat(F.lit("row_"), F.left(F.md5("text"), F.lit(10)), F.lit("#e"), "turn")
    return c.select("conv_id", "turn", F.concat_ws(":", F.lit("chat"), F.lit("conversations"), own).alias("item_id"))


EXAMPLE_ITEM_ID = "SELECT conv_id, turn, 'chat:conversations:row_' || left(md5(text), 10) || '#e' || turn AS item_id FROM conversations"


def _profiled(spark, sf, only=()):
    return P.with_profile(base.spread(table(spark, sf, "documents").select("doc_id", "text")), base.candidate(), "p", only=only)


def _benches(spark, sf):
    bench = table(spark, sf, "benchmark").select("item_id", "text", base.pick(base.BENCHMARKS, F.col("item_id")).alias("benchmark_source"))
    return P.with_profile(bench, base.bench(), "b")


def _tag_query(*names):
    def query(spark, sf):
        return _profiled(spark, sf).select("doc_id", *[F.concat_ws(",", f"p.{n}").alias(n) for n in names])

    return query, f"WITH {CANDIDATES} SELECT doc_id, {', '.join(names)} FROM cand"


def _field_query(*names):
    def query(spark, sf):
        return _profiled(spark, sf).select("doc_id", *[F.col(f"p.{n}").alias(n) for n in names])

    return query, f"WITH {CANDIDATES} SELECT doc_id, {', '.join(n if n != 'source_family' else 'family AS source_family' for n in names)} FROM cand"


def profile_benchmark(spark, sf):
    return _benches(spark, sf).select("item_id", "b.benchmark_name", "b.skill_bucket", "b.duration_bucket", *[F.concat_ws(",", f"b.{n}").alias(n) for n in TAGS])


PROFILE_BENCHMARK = f"WITH {BENCHES} SELECT item_id, bench AS benchmark_name, skill_bucket, duration_bucket, {', '.join(TAGS)} FROM bch"


def source_family_from_url(spark, sf):
    from ..functions.text import base_name, stem

    p = table(spark, sf, "pages")
    name = F.concat(base.pick(base.NAMES, F.col("page_id")), F.lit("/"), base_name("url"))
    return p.select("page_id", P.source_family(name).alias("source_family"), base_name("url").alias("base_name"), stem("url").alias("stem"))


SOURCE_FAMILY = f"""WITH t AS (SELECT page_id, regexp_extract(url, '[^/]*$') AS base_name, lower({base.sql_pick(base.NAMES, 'page_id')} || '/' || regexp_extract(url, '[^/]*$')) AS name FROM pages)
SELECT page_id, {base.FAMILY} AS source_family, base_name, CASE WHEN regexp_matches(base_name, '^.+\\.[^.]*$') THEN regexp_extract(base_name, '^(.+)\\.[^.]*$', 1) ELSE base_name END AS stem FROM t"""

# -- matches: every document against every item ------------------------------------------------------------------------------------

PARTS = matching.PARTS
_PROFILED = ("source_family", "duration_bucket", "answer_type", *TAGS)


def _matched(spark, sf, more=(), keep_profile=False):
    return matching.compared(_profiled(spark, sf, (*_PROFILED, *more)), _benches(spark, sf), "doc_id", "item_id", 3, source="benchmark_source", profile=("p", "b"), keep_profile=keep_profile)


def profile_match_components(spark, sf):
    """The parts of the three best matches of each document."""
    return matching.ranked(_matched(spark, sf), "doc_id").select("doc_id", "rank", "item_id", *[F.round(k, 6).alias(k) for k in PARTS])


def blended_match_score(spark, sf):
    return matching.ranked(_matched(spark, sf), "doc_id").select("doc_id", "rank", "item_id", "semantic", "adjusted", "profile_only")


def similarity_summary(spark, sf):
    """What a comparison says about each document, over all items."""
    return matching.summarized(_matched(spark, sf), "doc_id", {"lvbench": 2.0})


def _sql_overlap(a: str, b: str) -> str:
    return f"CASE WHEN len(list_intersect({a}, {b})) = 0 THEN 0.0 ELSE 2.0 * len(list_intersect({a}, {b})) / (len({a}) + len({b})) END"


_LISTS = ", ".join(f"CASE WHEN {n} = '' THEN [] ELSE string_split({n}, ',') END AS {n[:-5]}" for n in TAGS)
_PRIOR = "CASE " + " ".join(f"WHEN b.bench = '{n}' AND c.family = '{f}' THEN {p}" for n, ps in T.PRIORS.items() for f, p in ps.items()) + f" ELSE {T.OTHER_PRIOR} END"
_ORDER = "CASE {0} WHEN 'short' THEN 0 WHEN 'medium' THEN 1 WHEN 'long' THEN 2 WHEN 'very_long' THEN 3 END"
_COSINE = """dt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents) GROUP BY ALL),
bt AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM benchmark) GROUP BY ALL),
dn AS (SELECT doc_id, sqrt(sum(tf * tf)) AS norm FROM dt GROUP BY doc_id), bn AS (SELECT item_id, sqrt(sum(tf * tf)) AS norm FROM bt GROUP BY item_id),
dots AS (SELECT doc_id, item_id, sum(dt.tf * bt.tf) AS dot FROM dt JOIN bt USING (term) GROUP BY doc_id, item_id),
pairs AS (SELECT doc_id, item_id, round(dot / (dn.norm * bn.norm), 6) AS similarity FROM dots JOIN dn USING (doc_id) JOIN bn USING (item_id))"""
_MATCH = f"""WITH {CANDIDATES}, {BENCHES}, {_COSINE},
cl AS (SELECT doc_id, family, duration_bucket, answer_type, {_LISTS} FROM cand), bl AS (SELECT item_id, bench, duration_bucket, answer_type, {_LISTS} FROM bch),
parts AS (SELECT c.doc_id, b.item_id, coalesce(p.similarity, 0.0) AS similarity, {_sql_overlap('b.skill', 'c.skill')} AS skill, {_sql_overlap('b.domain', 'c.domain')} AS domain, {_sql_overlap('b.reasoning', 'c.reasoning')} AS reasoning,
 CASE WHEN len(b.modality) = 0 THEN 0.5 ELSE len(list_intersect(b.modality, c.modality)) / len(b.modality) END AS modality,
 CASE WHEN len(b.locality) = 0 THEN 0.5 WHEN list_contains(b.locality, 'global') AND (list_contains(c.locality, 'global') OR list_contains(c.locality, 'multi_segment')) THEN 1.0
  WHEN list_contains(b.locality, 'local') AND list_contains(c.locality, 'local') THEN 1.0 ELSE {_sql_overlap('b.locality', 'c.locality')} END AS locality,
 CASE WHEN b.duration_bucket = 'unknown' OR c.duration_bucket = 'unknown' THEN 0.5 WHEN b.duration_bucket = c.duration_bucket THEN 1.0
  ELSE CASE abs(({_ORDER.format('b.duration_bucket')}) - ({_ORDER.format('c.duration_bucket')})) WHEN 1 THEN 0.65 WHEN 2 THEN 0.25 ELSE 0.0 END END AS duration,
 CASE WHEN b.answer_type = 'unknown' OR c.answer_type = 'unknown' THEN 0.5 WHEN b.answer_type = c.answer_type THEN 1.0
  WHEN b.answer_type IN ('short_phrase', 'sentence') AND c.answer_type IN ('short_phrase', 'sentence') THEN 0.75 ELSE 0.0 END AS answer_type,
 greatest(0.0, least(1.0, CAST({_PRIOR} AS DOUBLE) + CASE WHEN list_contains(b.skill, 'counting') AND c.family = 'count_eval' THEN 0.18 ELSE 0.0 END
  + CASE WHEN list_contains(b.modality, 'subtitle') AND c.family = 'subtitleqa' THEN 0.18 ELSE 0.0 END
  + CASE WHEN list_contains(b.skill, 'summary') AND c.family IN ('longcapqa', 'caption') THEN 0.12 ELSE 0.0 END
  + CASE WHEN list_contains(b.locality, 'global') AND c.family = 'longcapqa' THEN 0.10 ELSE 0.0 END
  + CASE WHEN list_contains(b.skill, 'grounding') AND c.family IN ('count_eval', 'point_grounding', 'tracking') THEN 0.12 ELSE 0.0 END)) AS source_prior
 FROM cl c CROSS JOIN bl b LEFT JOIN pairs p ON p.doc_id = c.doc_id AND p.item_id = b.item_id)"""


def _sql_blend(weights: dict[str, float]) -> str:
    names = {"semantic": "similarity"}
    used = {k: w for k, w in weights.items() if w > 0}
    return f"({' + '.join(f'CAST({w} AS DOUBLE) * CAST({names.get(k, k)} AS DOUBLE)' for k, w in used.items())}) / CAST({sum(used.values())} AS DOUBLE)"


_RANKED = f"""{_MATCH}, scored AS (SELECT *, round({_sql_blend(T.WEIGHTS)}, 9) AS adjusted, round({_sql_blend({k: w for k, w in T.WEIGHTS.items() if k != 'semantic'})}, 9) AS profile_only FROM parts),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY adjusted DESC, item_id) AS INT) AS rank FROM scored)"""
MATCH_COMPONENTS = f"{_RANKED} SELECT doc_id, rank, item_id, {', '.join(f'round(CAST({k} AS DOUBLE), 6) AS {k}' for k in PARTS)} FROM ranked WHERE rank <= 3"
BLENDED = f"{_RANKED} SELECT doc_id, rank, item_id, similarity AS semantic, adjusted, profile_only FROM ranked WHERE rank <= 3"
SUMMARY = f"""{_RANKED}, w AS (SELECT doc_id, {base.sql_pick(base.BENCHMARKS, 'item_id')} AS source, greatest(0.0, max(adjusted)) AS best FROM ranked GROUP BY ALL),
a AS (SELECT doc_id, {base.sql_half_up('sum(CAST(round(best * 1e9) AS HUGEINT) * weight)', 'sum(weight) * 1000')} AS balanced, {base.sql_half_up('coalesce(sum(weight) FILTER (best >= 0.45), 0) * 1000000', 'sum(weight)')} AS cov
 FROM (SELECT *, CASE source WHEN 'lvbench' THEN 2 ELSE 1 END AS weight FROM w) GROUP BY doc_id),
t AS (SELECT doc_id, source AS best_source FROM w QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY best DESC, source) = 1),
m AS (SELECT doc_id, max(similarity) AS max_similarity, max(adjusted) AS max_adjusted_similarity, {base.sql_half_up('sum(CAST(round(similarity * 1e9) AS HUGEINT)) FILTER (rank <= 3)', 'count(*) FILTER (rank <= 3) * 1000')} / 1e6 AS mean_topk_similarity,
 {base.sql_half_up('sum(CAST(round(adjusted * 1e9) AS HUGEINT)) FILTER (rank <= 3)', 'count(*) FILTER (rank <= 3) * 1000')} / 1e6 AS mean_topk_adjusted_similarity FROM ranked GROUP BY doc_id)
SELECT m.*, balanced / 1e6 AS balanced_score, cov / 1e6 AS coverage, best_source, (85 * balanced + 15 * cov) / 1e8 AS selection_score FROM m JOIN a USING (doc_id) JOIN t USING (doc_id)"""

# -- selection ---------------------------------------------------------------------------------------------------------------------

DURATION, TASK, K = "long", "Temporal Reasoning", 40


def _scored(spark, sf):
    """Candidates of one bucket, with a similarity made from their id."""
    rows = _profiled(spark, sf, ("source_family", "skill_bucket", "duration_hint"))
    # exploding an array of one struct keeps filters behind the rules: the optimizer would otherwise copy them into each
    rows = rows.select("doc_id", F.explode(F.array("p")).alias("p")).select("doc_id", "p.*").withColumn("similarity", F.round(F.pmod(F.col("doc_id") * 7919, F.lit(1000)) / 1000.0, 3))
    skill = buckets.skill_priority(F.lit(TASK), F.col("skill_bucket"))
    match = buckets.duration_match(F.lit(DURATION), F.col("duration_hint"))
    rows = rows.where(skill.isNotNull() & buckets.first_round(F.col("source_family"), F.col("skill_bucket"), normalized(base.pick(base.CATEGORIES, F.col("doc_id") * 7))))
    tier = buckets.source_tier(F.lit(DURATION), F.lit(TASK), F.col("source_family"))
    return rows.select("doc_id", "source_family", "skill_bucket", buckets.selection_score(F.col("similarity"), skill, match).alias("selection_score"), tier.alias("tier"))


def bucket_selection_soft_cap(spark, sf):
    return soft_cap(_scored(spark, sf), K, "source_family", F.col("tier"), "selection_score", "doc_id").select("doc_id", "source_family", "selection_score", "phase")


_SKILL = "CASE skill_bucket " + " ".join(f"WHEN '{s}' THEN CAST({p} AS DOUBLE)" for s, p in T.BUCKET_SKILLS[TASK].items()) + " END"
_FIRST, _SECOND = T.BUCKET_SOURCES[(DURATION, TASK)]
_SCORED = f"""WITH {CANDIDATES}, hinted AS (SELECT *, CASE WHEN duration_bucket <> 'unknown' THEN duration_bucket WHEN family = 'longcapqa' THEN 'long' ELSE 'unknown' END AS hint FROM cand),
scored AS (SELECT doc_id, family AS source_family, round(0.60::DOUBLE * round(((doc_id * 7919) % 1000) / 1000.0, 3) + 0.25::DOUBLE * {_SKILL}
  + 0.15::DOUBLE * CASE WHEN hint = 'unknown' THEN 0.5::DOUBLE WHEN hint = 'long' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, 6) AS selection_score,
  CASE WHEN {base.sql_in('family', _FIRST)} THEN 0 WHEN {base.sql_in('family', _SECOND)} THEN 1 ELSE 2 END AS tier
 FROM hinted WHERE {_SKILL} IS NOT NULL AND family <> 'capeval' AND (family <> 'count_eval' OR {base.sql_in('category', T.COUNTED_CATEGORIES)}) AND NOT (family = 'askmodelanything' AND skill_bucket = 'general'))"""
SOFT_CAP = f"""{_SCORED}, phased AS (SELECT *, 2 * tier + CAST(row_number() OVER (PARTITION BY source_family ORDER BY selection_score DESC, doc_id) > {max(1, int(K * 0.35))} AS INT) AS phase FROM scored)
SELECT doc_id, source_family, selection_score, phase FROM phased ORDER BY phase, selection_score DESC, doc_id LIMIT {K}"""


def family_capped_topk(spark, sf):
    rows = _profiled(spark, sf).select("doc_id", "p.source_family").withColumn("score", F.pmod(F.col("doc_id") * 7919, F.lit(1000)) / 1000.0)
    return capped_top(rows, 100, "source_family", "count_eval", "score", "doc_id")


CAPPED = f"""WITH {CANDIDATES}, r AS (SELECT doc_id, family AS source_family, ((doc_id * 7919) % 1000) / 1000.0 AS score FROM cand),
n AS (SELECT *, row_number() OVER (PARTITION BY source_family ORDER BY score DESC, doc_id) AS k FROM r)
SELECT doc_id, source_family, score FROM n WHERE source_family <> 'count_eval' OR k <= 10 ORDER BY score DESC, doc_id LIMIT 100"""


def merge_best_per_id(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.round("value", 1).alias("score"))
    return best_per_id(e, "user_id", "score", "event_id")


MERGE = "SELECT user_id, event_id, score FROM (SELECT user_id, event_id, round(value, 1) AS score FROM events) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_id) = 1"

_tags, _tags_sql = _tag_query("domain_tags", "skill_tags")
_more, _more_sql = _tag_query("reasoning_tags", "modality_tags", "locality_tags")
_answer, _answer_sql = _field_query("answer_type")
_duration, _duration_sql = _field_query("duration_bucket", "source_family")
_bucket, _bucket_sql = _field_query("skill_bucket")

_ALL = {
    "example_text_projection": (example_text_projection, EXAMPLE_TEXT),
    "example_item_id": (example_item_id, EXAMPLE_ITEM_ID),
    "profile_domain_skill_tags": (_tags, _tags_sql),
    "profile_reasoning_modality_locality": (_more, _more_sql),
    "profile_answer_type": (_answer, _answer_sql),
    "profile_duration_bucket": (_duration, _duration_sql),
    "profile_skill_bucket": (_bucket, _bucket_sql),
    "profile_benchmark": (profile_benchmark, PROFILE_BENCHMARK),
    "source_family_from_url": (source_family_from_url, SOURCE_FAMILY),
    "profile_match_components": (profile_match_components, MATCH_COMPONENTS),
    "blended_match_score": (blended_match_score, BLENDED),
    "similarity_summary": (similarity_summary, SUMMARY),
    "bucket_selection_soft_cap": (bucket_selection_soft_cap, SOFT_CAP),
    "family_capped_topk": (family_capped_topk, CAPPED),
    "merge_best_per_id": (merge_best_per_id, MERGE),
}
QUERIES = {k: q for k, (q, _) in _ALL.items()}
ORACLE = {k: s for k, (_, s) in _ALL.items()}
