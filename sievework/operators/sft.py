"""Fine-tuning rows: skill of each question, dominant skill, the decision to keep, and what a row trains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import tables as T
from ..functions.text import contains_any


def family_of_path(path: Column) -> Column:
    """By parts of the path, case as given, in a fixed order."""
    out = F.lit("unknown")
    for part, family in reversed(T.PATH_FAMILIES):
        out = F.when(path.contains(part), family).otherwise(out)
    return out


def duration_of_file(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(low.contains("0_60s"), "short")
        .when(low.contains("60_180s"), "medium")
        .when(low.contains("180_600s") | low.contains("more_600s"), "long")
        .otherwise("unknown")
    )


def question_skill(text: Column, family: Column) -> Column:
    """text is normalized."""
    has = lambda phrases: contains_any(text, phrases)
    return (
        F.when(text == "", "general")
        .when((family == "count_eval") & has(T.COUNT_QUESTION), "counting")
        .when((family == "count_eval") & text.startswith("find "), "general")
        .when(has(T.OCR_QUESTION), "ocr_text")
        .when(has(T.COUNT_QUESTION), "counting")
        .when((family == "subtitleqa") & has(T.SPEECH_QUESTION), "subtitle_alignment")
        .when(has(T.SEQUENCE_QUESTION), "temporal_sequence")
        .when(has(T.TOPIC_QUESTION), "summary")
        .when(has(T.CAUSE_QUESTION), "action_reasoning")
        .when(has(T.OBJECT_QUESTION), "object_reasoning")
        .when(family == "caption", "summary")
        .otherwise("general")
    )


def dominant_skill(skills: Column, family: Column) -> Column:
    """The most frequent skill, the first in priority of equal ones; without questions by family."""
    order = F.array(*map(F.lit, T.SKILL_PRIORITY))
    ranked = F.transform(order, lambda s, i: F.struct((-F.size(F.filter(skills, lambda x: x == s))).alias("n"), i.alias("i"), s.alias("s")))
    return F.when(F.size(skills) == 0, F.when(family == "caption", "summary").otherwise("general")).otherwise(F.array_min(ranked)["s"])


def keep_decision(family: Column, skill: Column, skills: Column) -> Column:
    """(keep, keep_reason, drop_reason)."""
    pure = (F.size(skills) > 0) & F.forall(skills, lambda s: s == "counting")
    drop = (
        F.when(~family.isin(T.SFT_FAMILIES), "unknown_source")
        .when((family == "count_eval") & ~pure, "count_eval_non_pure_counting")
        .when((family == "askmodelanything") & (skill == "general"), "askmodelanything_general")
        .when(~family.isin("count_eval", "askmodelanything") & (skill == "general"), "general_skill")
        .otherwise("")
    )
    reason = F.when(family == "count_eval", "count_eval_pure_counting").when(family == "askmodelanything", "askmodelanything_targeted").otherwise(F.concat_ws("_", family, skill))
    return F.struct((drop == "").alias("keep"), F.when(drop == "", reason).otherwise("").alias("keep_reason"), drop.alias("drop_reason"))


def target_buckets(duration: Column, skill: Column) -> Column:
    return F.array_compact(F.array(*[F.when((skill == s) & duration.isin(ds), F.concat(duration, F.lit(f"_{name}"))) for s, ds, name in T.TARGETS]))
