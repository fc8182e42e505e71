"""Whole runs: results of a comparison and of tagging are projected, ranked, and written with their summaries."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables as T
from ..functions.text import normalized, once, similarity_text, slug, squeezed
from . import buckets, sft, stats
from .selection import best_per_id

# Sentences of an evaluation's prompt, which are no part of the question.
BOILERPLATE = [
    "Select the best answer to the following multiple-choice question based on the video and the subtitles. Respond with only the letter (A, B, C, or D) of the correct option.",
    "Answer with the option's letter from the given choices directly.",
]


# -- comparisons ---------------------------------------------------------------------------------------------------------------------


def scored(examples: DataFrame, found: DataFrame, summary: DataFrame, backend: str, ranking: str = "selection_score", save_text: bool = False, save_context: bool = False) -> DataFrame:
    """One row for each candidate: the example's fields, the summary of its comparison, its matches, and the score that ranks it."""
    return projected(examples.join(summary, "id").join(found.select("id", "matches", "best", "best_semantic"), "id"), backend, ranking, save_text, save_context)


def projected(rows: DataFrame, backend: str, ranking: str = "selection_score", save_text: bool = False, save_context: bool = False) -> DataFrame:
    """The rows of `scored`, of candidates that have all of these columns already."""
    more = [c for c, wanted in (("similarity_text", save_text), ("context", save_context)) if wanted]
    return rows.select(
        "id", "source_name", "source_path", "source_record_id", "question", "answer", "metadata", F.lit(backend).alias("similarity_backend"), F.lit(ranking).alias("ranking_score_field"),
        F.coalesce(F.col(ranking), F.lit(0.0)).alias("ranking_score"), "profile.source_family", "profile.skill_bucket", "profile.duration_hint", "max_similarity", "max_adjusted_similarity",
        "mean_topk_similarity", "mean_topk_adjusted_similarity", "balanced_score", F.col("coverage").alias("coverage_score"), "selection_score", F.col("best_source").alias("best_benchmark_source"),
        F.col("best").alias("benchmark_source_scores"), F.col("best_semantic").alias("benchmark_source_semantic_scores"), F.col("matches").alias("top_matches"), "profile", *more,
    )


def primary_skill(bucket: Column, tags: Column) -> Column:
    """The bucket, else the tag that comes first in the order of preference, else the first tag."""
    liked = F.get(F.filter(F.array(*map(F.lit, T.PREFERRED_SKILLS)), lambda t: F.array_contains(tags, t)), F.lit(0))
    return F.coalesce(F.nullif(F.trim(bucket), F.lit("")), liked, F.get(F.filter(tags, lambda t: F.trim(t) != ""), F.lit(0)), F.lit(""))


def finalized(results: DataFrame, folder: str, top_k: int = 1000, per_benchmark: int = 0, score: str = "ranking_score") -> DataFrame:
    """Writes the best results, the best of each benchmark (in a folder for each) and a summary; returns the summary's lines.

    results is a written table: it is read for each of them. The lines are (part, name, member, count, value)."""
    rows = results.withColumn("family", F.coalesce(F.nullif(F.col("source_family"), F.lit("")), F.col("source_name"), F.lit("")))
    top = stats.top_k(rows, top_k, score, "id")
    top.drop("family").write.mode("overwrite").json(f"{folder}/topk")
    known = rows.where("best_benchmark_source <> ''")
    best = stats.top_k_by(known, per_benchmark, score, "id", "best_benchmark_source") if per_benchmark > 0 else known
    if per_benchmark > 0:
        best.drop("family", "rank").write.mode("overwrite").partitionBy("best_benchmark_source").json(f"{folder}/topk_by_benchmark")
    first = F.get("top_matches", F.lit(0))
    skill = F.concat_ws(":", "best_benchmark_source", "skill_bucket")
    skilled = known.where((F.col("skill_bucket") != "") & first.isNotNull()).withColumn("key", skill)
    skilled = stats.top_k_by(skilled, per_benchmark, score, "id", "key") if per_benchmark > 0 else skilled
    line = lambda df, part, name, member, count, value: df.select(F.lit(part).alias("part"), name.alias("name"), member.alias("member"), count.cast("long").alias("count"), value.cast("double").alias("value"))
    none, text = F.lit(None).cast("long"), F.lit("")

    def figures(part: str, *keys: str) -> DataFrame:
        held = stats.score_stats(rows, score, *keys)
        name = F.coalesce(F.col(keys[0]), text) if keys else F.lit("all")
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("member"), F.col(k).alias("value")) for k in ("min", "max", "mean", "p50", "p90", "p95")]))
        held = held.select(name.alias("name"), "count", each.alias("x"))
        return line(held, part, F.col("name"), F.col("x.member"), F.col("count"), F.col("x.value"))

    parts = [figures("score_stats"), figures("source_stats", "source_name"), figures("source_family_stats", "family")]
    parts.append(line(known.groupBy("best_benchmark_source").count(), "best_benchmark_source_counts", F.col("best_benchmark_source"), text, F.col("count"), none))
    for part, df, keys in (("recommended_source_mix", top, []), ("recommended_source_mix_by_benchmark", best, ["best_benchmark_source"]), ("recommended_source_mix_by_benchmark_skill", skilled, ["key"])):
        parts.append(line(stats.mix(df, "family", *keys), part, F.col(keys[0]) if keys else F.lit("all"), F.col("family"), F.col("count"), F.col("fraction")))
    summary = parts[0]
    for p in parts[1:]:
        summary = summary.union(p)
    summary.write.mode("overwrite").json(f"{folder}/summary")
    return results.sparkSession.read.schema("part string, name string, member string, count long, value double").json(f"{folder}/summary")


# -- weak buckets ---------------------------------------------------------------------------------------------------------------------


def plain_question(question: Column) -> Column:
    """A question without the sentences of the prompt and with single spaces."""
    for sentence in BOILERPLATE:
        question = F.replace(question, F.lit(sentence), F.lit(""))
    return squeezed(question)


def bucket_examples(samples: DataFrame, most_chars: int = 1200) -> DataFrame:
    """Examples made of wrongly answered samples, one source for each bucket: id, bucket_key, source_name, question, similarity_text, metadata."""
    key = slug(F.concat_ws("_", "duration", "task_type"))
    rows = samples.where("score < 1").withColumn("question", plain_question(F.col("question"))).withColumn("bucket_key", key)
    own = F.coalesce(F.nullif(F.col("question_id"), F.lit("")), F.col("doc_id").cast("string"), F.lit(""))
    text = similarity_text(F.col("question"), F.lit(""), None, "question_only", most_chars)
    fields = [x for c in ("duration", "task_type", "category", "sub_category") for x in (F.lit(c), F.col(c))]
    return rows.select(own.alias("id"), "bucket_key", F.concat(F.lit("videomme_"), "bucket_key").alias("source_name"), "duration", "task_type", "question", text.alias("similarity_text"), F.create_map(*fields).alias("metadata"))


def counted(df: DataFrame, *fields: str) -> DataFrame:
    """(field, value, count) of several fields, in one pass; nulls count as empty."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("value")) for f in fields])).alias("r"))
    return long.groupBy("r.field", "r.value").agg(F.count("*").alias("count"))


def selector_outputs(selected: DataFrame, priorities: DataFrame, folder: str, merged_k: int = 200, family: str = "source_family") -> DataFrame:
    """Writes the rows selected for each bucket, the merged best ones, the plan, and returns the plan. selected has id, bucket_key, selection_score and the family."""
    selected.write.mode("overwrite").partitionBy("bucket_key").json(f"{folder}/buckets")
    merged = stats.top_k(best_per_id(selected, "id", "selection_score", "bucket_key"), merged_k, "selection_score", "id")
    merged.write.mode("overwrite").json(f"{folder}/merged")
    mixes = selected.groupBy("bucket_key", F.col(family).alias("family")).agg(F.count("*").alias("count"))
    plan = buckets.plan(priorities.join(mixes.select("bucket_key").distinct(), "bucket_key", "left_semi"), mixes)
    plan.write.mode("overwrite").json(f"{folder}/plan")
    return plan


# -- fine-tuning rows -----------------------------------------------------------------------------------------------------------------


def tuning_tags(path: Column, questions: Column, input_name: Column) -> Column:
    """The twelve tags of a fine-tuning row: where it comes from, what it asks, whether it stays and why, and what it trains."""

    def tags(family: Column, skills: Column) -> Column:
        return once(F.struct(sft.dominant_skill(skills, family).alias("skill"), F.array_sort(F.array_distinct(skills)).alias("kinds")), lambda x: judged(family, skills, x["skill"], x["kinds"]))

    def judged(family: Column, skills: Column, skill: Column, kinds: Column) -> Column:
        counts = F.map_from_entries(F.transform(kinds, lambda s: F.struct(s, F.size(F.filter(skills, lambda x: x == s)))))
        name = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in T.SOURCE_NAMES.items() for x in pair]), family), F.lit(""))
        duration = sft.duration_of_file(input_name)
        whole = lambda d: F.struct(
            input_name.alias("input_name"), path.alias("source_path"), family.alias("source_family"), name.alias("source_name"), duration.alias("duration_bucket"), F.size(skills).alias("question_count"),
            counts.alias("question_skill_counts"), skill.alias("skill_bucket"), d["keep"].alias("keep"), d["keep_reason"].alias("keep_reason"), d["drop_reason"].alias("drop_reason"),
            F.when(d["keep"], sft.target_buckets(duration, skill)).otherwise(F.array().cast("array<string>")).alias("target_buckets"),
        )
        return once(sft.keep_decision(family, skill, skills), whole)

    skills = lambda family: F.transform(questions, lambda q: once(normalized(q), lambda text: sft.question_skill(text, family)))
    return once(sft.family_of_path(path), lambda family: once(skills(family), lambda found: tags(family, found)))


def tuning_outputs(tagged: DataFrame, folder: str) -> DataFrame:
    """Writes the tags and the kept rows by file, and the counts; returns the counts. tagged is a written table with `tags` beside the row."""
    named = tagged.withColumn("file", F.col("tags.input_name"))
    named.select("file", "id", "tags").write.mode("overwrite").partitionBy("file").json(f"{folder}/tags")
    named.where("tags.keep").drop("tags").write.mode("overwrite").partitionBy("file").json(f"{folder}/filtered")
    fields = {"family": "source_family", "duration": "duration_bucket", "skill": "skill_bucket", "keep_reason": "keep_reason", "drop_reason": "drop_reason"}
    counts = stats.grouped_counts(named.select("file", *[F.col(f"tags.{v}").alias(k) for k, v in fields.items()]), "file", list(fields))
    counts.write.mode("overwrite").json(f"{folder}/summary")
    return counts


def summary_text(lines: DataFrame) -> str:
    """A small summary as one JSON document."""
    return json.dumps([r.asDict(recursive=True) for r in lines.collect()], ensure_ascii=False, indent=2)
