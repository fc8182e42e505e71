"""Structured captions: sections, timed events, prompts, and the question-answer lists of replies."""

from __future__ import annotations

from functools import reduce
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tables as T
from .text import squeezed, stem, stripped
from .verdict import outermost_object, unfenced

_RANGE = r"(?is)\*\*\s*(\d+(?:\.\d+)?)\s*[–-]\s*(\d+(?:\.\d+)?)\s*seconds?\s*\*\*\s*:\s*(.+?)(?=\n-\s*\*\*|\z)"
_POINT = r"(?is)\*\*\s*At approximately\s*(\d+(?:\.\d+)?)\s*seconds?\s*\*\*\s*:\s*(.+?)(?=\n-\s*\*\*|\z)"
_ITEM = "query string, question string, answer string, start_sec string, end_sec string, category string"


def section_key(title: Column) -> Column:
    low = F.lower(title)
    out = F.lit(None).cast("string")
    for words, key, _ in reversed(T.SECTIONS):
        out = F.when(reduce(lambda a, b: a & b, (low.contains(w) for w in words)), key).otherwise(out)
    return out


def sections(text: Column) -> Column:
    """Map of section keys to texts. Headers are lines `### n. title`; a title that is not known swallows its lines, and of
    repeated titles the last with lines wins."""
    marked = F.regexp_replace(text, r"(?mU)^\s*###\s*\d+\.\s*(?=\S)", "\u0001")
    parts = F.slice(F.split(marked, "\u0001"), 2, 1_000_000)
    entry = lambda p: F.struct(section_key(F.substring_index(p, "\n", 1)).alias("key"), F.when(p.contains("\n"), stripped(F.regexp_replace(p, r"^[^\n]*\n", ""))).alias("value"))
    known = F.filter(F.transform(parts, entry), lambda e: e["key"].isNotNull() & e["value"].isNotNull())
    last = F.filter(known, lambda e, i: ~F.exists(F.slice(known, i + 2, F.size(known)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def structured(section_map: Column) -> Column:
    blocks = [F.when(F.coalesce(section_map[key], F.lit("")) != "", F.concat(F.lit(f"{heading}\n"), section_map[key])) for _, key, heading in T.SECTIONS]
    return F.concat_ws("\n\n", *blocks)


def events(motion: Column, highlights: Column) -> Column:
    """Ranges of the motion section and points of the highlights, by start; a point comes after a range of the same start."""
    take = lambda text, pattern, group: F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(group))
    number = lambda x: x.try_cast("double")

    def event(start: Column, end: Column, text: Column, source: str, kind: str) -> Column:
        return F.struct(number(start).alias("start_sec"), end.alias("end_sec"), squeezed(text).alias("description"), F.lit(source).alias("source"), F.lit(kind).alias("type"))

    ranges = F.arrays_zip(take(motion, _RANGE, 1).alias("a"), take(motion, _RANGE, 2).alias("b"), take(motion, _RANGE, 3).alias("c"))
    ranges = F.transform(ranges, lambda z: event(z["a"], number(z["b"]), z["c"], "motion_detail_description", "range"))
    points = F.arrays_zip(take(highlights, _POINT, 1).alias("a"), take(highlights, _POINT, 2).alias("b"))
    points = F.transform(points, lambda z: event(z["a"], F.lit(None).cast("double"), z["b"], "highlight_moments", "point"))
    both = F.concat(F.filter(ranges, lambda e: e["end_sec"] > e["start_sec"]), points)
    # a stable order: by start, ranges first, then as found
    keyed = F.transform(both, lambda e, i: F.struct(e["start_sec"].alias("s"), e["end_sec"].isNull().alias("p"), i.alias("i"), e.alias("e")))
    return F.transform(F.array_sort(keyed), lambda k: k["e"])


def duration(video_id: Column, file_name: Column, default: float = 180.0) -> Column:
    """Seconds: `_d180.5_` in the id, else `180s.jsonl` or `180s_20w.jsonl` in the file name, else the default."""
    number = lambda x, pattern: F.nullif(F.regexp_extract(x, pattern, 1), F.lit("")).try_cast("double")
    return F.coalesce(number(video_id, r"_d(\d+(?:\.\d+)?)(?:_|$)"), number(file_name, r"(?i)(\d+)s(?:_\d+w)?\.jsonl"), F.lit(default))


def video_id(images_source: Column, record_id: Column) -> Column:
    first = stripped(F.coalesce(F.get(images_source, F.lit(0)), F.lit("")))
    return F.when(first != "", stem(first)).otherwise(stripped(F.coalesce(record_id, F.lit(""))))


#: What a request says; the caller may give a text of its own with the same fields.
TEMPLATE = """A video is described below. Write question-answer pairs about it.

video: {video}
length: {seconds} s

Moments:
{segments}

Description:
{caption}

Answer with one JSON object that has three lists. The elements of "temporal_grounding" and "segment_qa" have the fields query, answer, start_sec and end_sec;
those of "understanding_qa", of which there are {questions} at most, have query, answer and category."""


def prompt(video: Column, seconds: Column, segments: Column, caption: Column, most_segments: int = 15, most_questions: int = 5, template: str = TEMPLATE) -> Column:
    """The request for questions about a video: numbered segments of 250 characters, 3000 characters of the caption, put into a template."""

    def line(s: Column, i: Column) -> Column:
        text = F.left(s["description"], F.lit(250))
        at = F.when(s["end_sec"].isNull(), F.concat(F.lit("[point ~"), s["start_sec"], F.lit("s] "))).otherwise(F.concat(F.lit("[range "), s["start_sec"], F.lit("-"), s["end_sec"], F.lit("s] ")))
        return F.concat((i + 1).cast("string"), F.lit(". "), at, text)

    lines = F.array_join(F.transform(F.slice(segments, 1, most_segments), line), "\n")
    values = {"video": video, "seconds": seconds.cast("string"), "segments": lines, "caption": F.left(caption, F.lit(3000)), "questions": F.lit(str(most_questions))}
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        parts += [F.lit(literal), *([values[name]] if name else [])]
    return F.concat(*parts)


def reply_lists(reply: Column) -> Column:
    """temporal_grounding, segment_qa and understanding_qa of a reply, and error where it holds no JSON object."""
    body = outermost_object(unfenced(stripped(F.coalesce(reply, F.lit("")))))
    text_or_null = lambda x: F.when(F.coalesce(x, F.lit("")) != "", x)

    def listed(name: str, kind: str, timed: bool) -> Column:
        # elements of other kinds are left out one by one: they would make the whole list unreadable
        texts = F.filter(F.from_json(F.get_json_object(body, f"$.{name}"), "array<string>"), lambda x: x.startswith("{"))
        raw = F.transform(texts, lambda x: F.from_json(x, _ITEM))
        asked = F.transform(raw, lambda x: F.struct(F.coalesce(text_or_null(x["query"]), x["question"]).alias("query"), x.alias("x")))
        whole = F.filter(asked, lambda a: a["query"].isNotNull() & a["x"]["answer"].isNotNull())
        more = (lambda x: [x["start_sec"].try_cast("double").alias("start_sec"), x["end_sec"].try_cast("double").alias("end_sec")]) if timed else (lambda x: [F.coalesce(x["category"], F.lit("")).alias("category")])
        made = F.transform(whole, lambda a: F.struct(a["query"].alias("query"), a["x"]["answer"].alias("answer"), *more(a["x"]), F.lit(kind).alias("answer_type")))
        return F.coalesce(made, F.array().cast(_kind(timed)))

    error = F.when(body.isNull(), F.concat(F.lit("Failed to parse JSON object from model output: "), F.left(F.coalesce(reply, F.lit("")), F.lit(300))))
    return F.struct(
        listed("temporal_grounding", "temporal_span", True).alias("temporal_grounding"),
        listed("segment_qa", "caption", True).alias("segment_qa"),
        listed("understanding_qa", "open_ended", False).alias("understanding_qa"),
        error.alias("error"),
    )


def _kind(timed: bool) -> str:
    more = "start_sec double, end_sec double" if timed else "category string"
    return f"array<struct<query string, answer string, {more}, answer_type string>>"
