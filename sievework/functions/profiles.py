"""Profiles of examples: what a record is about, for which skill, how long and in which form. How well two profiles match is worked out in
operators/scoring.py, where candidates meet the benchmark.

All are Columns. A record is given as columns of question, answer, context and source name, and a dict of metadata columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables as T
from .phrases import Phrases
from .text import any_of, contains_any, filled, has_word, normalized

UNKNOWN = "unknown"
#: What rules look for in a record or in its question. Rules take the numbers that `found` gives, so that each text is read once.
PHRASES = Phrases(
    [
        *(p for ps in (*T.DOMAINS.values(), *T.SKILLS.values()) for p in ps), *T.ORDER_WORDS, *T.TEMPORAL_QUESTION, "how many", "reason",
        "relation", "reasoning", "perception", "summary", "synopsis", "grounding", "l2-relation", "subtitle", "dialogue", "transcript", "ocr", "text recognition",
        "text location", "temporal grounding", "location", "point",
    ]
)
#: What raises a source's prior: a tag of the benchmark, the candidate's families, and by how much.
BOOSTS = [
    ("skill_tags", "counting", ("count_eval",), 0.18),
    ("modality_tags", "subtitle", ("subtitleqa",), 0.18),
    ("skill_tags", "summary", ("longcapqa", "caption"), 0.12),
    ("locality_tags", "global", ("longcapqa",), 0.10),
    ("skill_tags", "grounding", ("count_eval", "point_grounding", "tracking"), 0.12),
]
#: Metadata that identifies a record and says nothing about it.
IDENTITY = ("video_id", "id", "question_id")


def _text(x: Column | Number | None) -> Column:
    return F.coalesce(_column(x).cast("string"), F.lit("")) if x is not None else F.lit("")


def tag_array(conditions: dict[str, Column]) -> Column:
    """The tags whose condition holds, sorted."""
    held = [F.when(conditions[tag], F.lit(tag)) for tag in sorted(conditions)]
    return F.array_compact(F.array(*held)) if held else F.array().cast("array<string>")


def source_family(name: Column) -> Column:
    s = F.lower(name)
    return (
        F.when(s.contains("askmodelanything"), "askmodelanything")
        .when(s.contains("longcapqa"), "longcapqa")
        .when(s.contains("subtitle"), "subtitleqa")
        .when(s.contains("count"), "count_eval")
        .when(s.contains("point") & ~s.contains("track"), "point_grounding")
        .when(s.contains("track"), "tracking")
        .when(s.contains("capeval"), "capeval")
        .when(s.contains("capqa"), "capqa")
        .when(s.contains("cap"), "caption")
        .otherwise(F.coalesce(filled(s), F.lit(UNKNOWN)))
    )


def benchmark_name(text: Column) -> Column:
    s = F.lower(text)
    return (
        F.when(s.contains("videomme"), "videomme")
        .when(s.contains("lvbench") & ~s.contains("longvideo"), "lvbench")
        .when(s.contains("longvideobench") | s.contains("lvb"), "longvideobench")
        .otherwise("")
    )


@dataclass(frozen=True)
class Number:
    """A metadata column of numbers: fractions count in its durations, but not in those of text."""

    column: Column


def _column(x: Column | Number) -> Column:
    return x.column if isinstance(x, Number) else x


def duration_bucket(value: Column | Number) -> Column:
    """A duration in words, digits or seconds as short, medium, long, very_long or unknown. Four limits belong to the bucket above
    when given exactly."""
    text = normalized(_column(value).cast("string"))
    numeric = value.column.try_cast("double") if isinstance(value, Number) else F.when(text.rlike(r"^\d+$"), text.try_cast("double"))
    return (
        F.when(text.isin("short", "medium", "long", "very_long"), text)
        .when(numeric.isNull(), UNKNOWN)
        .when((numeric == 60) | (numeric > 60) & (numeric < 600), "medium")
        .when(numeric < 60, "short")
        .when(numeric <= 1800, "long")
        .otherwise("very_long")
    )


def number_like(x: Column) -> Column:
    return x.rlike(r"^-?\d+(\.\d+)?$")


def answer_type(answer: Column) -> Column:
    text = normalized(answer)
    return (
        F.when(text == "", UNKNOWN)
        .when(text.isin("yes", "no"), "binary")
        .when(number_like(text), "number")
        .when(F.size(F.split(text, " ")) <= 3, "short_phrase")
        .otherwise("sentence")
    )


def domain_tags(found: Column) -> Column:
    return tag_array({tag: PHRASES.any(found, phrases) for tag, phrases in T.DOMAINS.items()})


def skill_tags(found: Column, asked: Column, question: Column, family: Column) -> Column:
    """found and asked: phrases of the record and of its question."""
    held = {tag: PHRASES.any(found, phrases) for tag, phrases in T.SKILLS.items()}
    extra = {
        "counting": PHRASES.any(asked, ["how many"]),
        "temporal_reasoning": PHRASES.any(asked, T.ORDER_WORDS),
        "causal": has_word(question, "why"),
        "spatial_perception": has_word(question, "where"),
        "summary": question.startswith("summarize") | has_word(question, "summary"),
    }
    for tag in held:
        families = [f for f, tags in T.FAMILY_SKILLS.items() if tag in tags]
        held[tag] = any_of([held[tag], *([extra[tag]] if tag in extra else []), *([family.isin(families)] if families else [])])
    for general in ("temporal", "spatial", "object", "action"):
        held[general] = any_of(c for tag, c in list(held.items()) if tag.startswith(f"{general}_"))
    return tag_array(held | {"text": held["dialogue"] | held["ocr"], "global": held["summary"]})


def reasoning_tags(found: Column, skills: Column, level: Column) -> Column:
    has = lambda *tags: any_of(F.array_contains(skills, t) for t in tags)
    return tag_array(
        {
            "reasoning": PHRASES.any(found, ["relation", "reasoning"]) | F.exists(skills, lambda t: t.endswith("_reasoning")),
            "perception": PHRASES.any(found, ["perception"]) | level.contains("perception"),
            "summary": PHRASES.any(found, ["summary", "synopsis"]) | has("summary"),
            "grounding": PHRASES.any(found, ["grounding"]) | has("grounding", "tracking", "temporal_grounding"),
            "relation": PHRASES.any(found, ["l2-relation"]) | level.contains("relation"),
        }
    )


def modality_tags(found: Column, family: Column, context: Column, alignment: Column) -> Column:
    return tag_array(
        {
            "visual": F.lit(True),
            "subtitle": PHRASES.any(found, ["subtitle", "dialogue", "transcript"]) | (family == "subtitleqa"),
            "ocr": PHRASES.any(found, ["ocr", "text recognition", "text location"]),
            "cross_modal": (family == "subtitleqa") | (family == "caption") & (context != "") | contains_any(alignment, ["alignment", "cross-modal"]),
        }
    )


def locality_tags(found: Column, text: Column, family: Column, kind: Column) -> Column:
    broad = family.isin("longcapqa", "caption")
    return tag_array(
        {
            "local": has_word(text, "local") | PHRASES.any(found, ["temporal grounding", "location", "point"]) | family.isin("count_eval", "point_grounding", "tracking") | (kind == "local"),
            "global": has_word(text, "global") | PHRASES.any(found, ["summary", "synopsis"]) | broad | (kind == "global"),
            "multi_segment": broad,
        }
    )


def temporal_question(asked: Column) -> Column:
    return PHRASES.any(asked, T.TEMPORAL_QUESTION)


def skill_bucket(family: Column, asked: Column, question: Column, answer: Column, category: Column, alignment: Column, benchmark: Column) -> Column:
    """asked: phrases of the question; question, answer, category and alignment are normalized."""
    many, order = PHRASES.any(asked, ["how many"]), temporal_question(asked)
    task = F.lit(None).cast("string")
    for name, bucket in T.TASK_BUCKETS.items():
        task = F.when(category == name, bucket).otherwise(task)
    why = has_word(question, "why") | PHRASES.any(asked, ["reason"])
    captions = (
        F.when(category.isin(T.SUMMARY_CATEGORIES), "summary")
        .when(category.isin(T.TEMPORAL_CATEGORIES), "temporal_sequence")
        .when(category.isin(T.OBJECT_CATEGORIES), "object_reasoning")
        .when(category.isin(T.ACTION_CATEGORIES), "action_reasoning")
        .when(category.isin(T.COUNTING_CATEGORIES), "counting")
        .otherwise("general")
    )
    subtitles = (
        F.when(category.isin(T.TEXT_CATEGORIES), "ocr_text")
        .when(contains_any(alignment, T.ALIGNMENTS), "subtitle_alignment")
        .when(category.isin(T.TEMPORAL_CATEGORIES), "temporal_sequence")
        .when(category == "object reasoning", "object_reasoning")
        .when(category == "action reasoning", "action_reasoning")
        .otherwise("general")
    )
    asked = F.when(many, "counting").when(order, "temporal_sequence").when(why, "action_reasoning").otherwise("general")
    other = F.when(many | number_like(answer), "counting").when(order, "temporal_sequence").otherwise("general")
    return (
        F.when((benchmark == "videomme") & task.isNotNull(), task)
        .when(family.isin("capqa", "longcapqa"), captions)
        .when(family == "subtitleqa", subtitles)
        .when(family == "caption", F.when(order, "temporal_sequence").otherwise("summary"))
        .when(family == "askmodelanything", asked)
        .when(family == "count_eval", F.when(category.isin(T.COUNTED_CATEGORIES), "counting").otherwise("general"))
        .otherwise(other)
    )


@dataclass
class Record:
    """Columns of an example. metadata maps a name to a column, or to a Number."""

    question: Column
    answer: Column
    source: Column
    context: Column | None = None
    metadata: dict[str, Column | Number] = field(default_factory=dict)
    benchmark: bool = False


def with_profile(df: DataFrame, r: Record, name: str = "profile", overrides: dict[str, Column] | None = None, only: tuple[str, ...] = ()) -> DataFrame:
    """df with the profile, or `only` these fields of it, as a struct; overrides replace fields.

    Normalized texts become columns of their own before rules read them, so that each is made once a row; their names start with two
    underscores and `profile`."""
    own = df.columns
    m = r.metadata
    told = [_text(c) for k, c in m.items() if k not in IDENTITY]
    first = lambda *names: normalized(F.coalesce(*[filled(_text(m[n])) for n in names if n in m], F.lit("")))
    known = lambda *names: [F.nullif(duration_bucket(m[n]), F.lit(UNKNOWN)) for n in names if n in m]
    none = F.lit(None).cast("string")
    df = df.withColumns(
        {
            "__profile_name": normalized(r.source),
            "__profile_question": normalized(r.question),
            "__profile_answer": normalized(r.answer),
            "__profile_context": _text(r.context),
            "__profile_rest": F.concat_ws(" | ", *[filled(_text(c)) for c in (r.answer, r.context) if c is not None], *[filled(c) for c in told]),
            "__profile_empty": filled(_text(r.question)).isNull(),
            "__profile_told": F.concat_ws(" ", *told) if told else F.lit(""),
            "__profile_category": first("Category", "category", "task_type", "question_type"),
            "__profile_alignment": first("AlignmentType"),
            "__profile_level": first("level"),
            "__profile_type": first("type"),
            "__profile_given": F.coalesce(*known("duration", "duration_group", "video_duration"), none),
            "__profile_video": F.coalesce(*known("video_duration", "duration", "video_length"), F.lit("short")),
        }
    )
    # the whole record is the question, a bar and the rest: no phrase holds a bar, so each part is read once
    df = df.withColumns({"__profile_rest": normalized("__profile_rest"), "__profile_asked": PHRASES.found(F.col("__profile_question"))})
    both = F.trim(F.concat("__profile_question", F.lit(" | "), "__profile_rest"))
    df = df.withColumns(
        {
            "__profile_text": F.when(F.col("__profile_empty"), F.col("__profile_rest")).when(F.col("__profile_rest") == "", F.col("__profile_question")).otherwise(both),
            "__profile_found": F.array_union("__profile_asked", PHRASES.found(F.col("__profile_rest"))),
        }
    )
    c = {k: F.col(f"__profile_{k}") for k in ("name", "question", "answer", "context", "text", "category", "alignment", "level", "type", "given", "video", "found", "asked", "family", "bench", "bucket", "skills")}
    bench = benchmark_name(F.concat_ws(" ", "__profile_name", "__profile_told")) if r.benchmark else F.lit("")
    df = df.withColumns({"__profile_family": source_family(c["name"]), "__profile_bench": bench})
    by_family = (
        F.when(F.lit(r.benchmark) & (c["bench"] == "lvbench"), "very_long")
        .when(c["family"] == "longcapqa", "long")
        .when(c["family"].isin("count_eval", "point_grounding", "tracking"), "short")
        .when(c["family"].isin("subtitleqa", "caption"), "medium")
        .when(c["name"].contains("long"), "long")
        .otherwise(UNKNOWN)
    )
    df = df.withColumns({"__profile_bucket": F.coalesce(c["given"], by_family), "__profile_skills": skill_tags(c["found"], c["asked"], c["question"], c["family"])})
    hint = F.when(c["bucket"] != UNKNOWN, c["bucket"]).when(c["family"] == "longcapqa", "long").when(c["family"] == "count_eval", c["video"]).otherwise(c["bucket"])
    parts = {
        "role": F.lit("benchmark" if r.benchmark else "candidate"),
        "benchmark_name": c["bench"],
        "source_family": c["family"],
        "duration_bucket": c["bucket"],
        "duration_hint": hint,
        "skill_bucket": skill_bucket(c["family"], c["asked"], c["question"], c["answer"], c["category"], c["alignment"], c["bench"]),
        "answer_type": answer_type(c["answer"]),
        "domain_tags": domain_tags(c["found"]),
        "skill_tags": c["skills"],
        "reasoning_tags": reasoning_tags(c["found"], c["skills"], c["level"]),
        "modality_tags": modality_tags(c["found"], c["family"], c["context"], c["alignment"]),
        "locality_tags": locality_tags(c["found"], c["text"], c["family"], c["type"]),
    }
    fields = {k: x for k, x in (parts | (overrides or {})).items() if not only or k in only}
    return df.withColumn(name, F.struct(*[x.alias(k) for k, x in fields.items()])).select(*[f"`{x}`" for x in own if x != name], name)
