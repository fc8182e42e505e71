"""Stand-in records over the driver's tables, as DataFrames and as SQL, and helpers to say the same rules in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import profiles as P
from ..functions import tables as T
from ..sources.scratch import new_folder

NAMES = ["askmodelanything", "longcapqa", "videosubtitleqa", "videocounteval", "pointing", "pointtrack", "capeval", "videocapqa", "videocap", "longweb"]
CATEGORIES = [*T.TEMPORAL_CATEGORIES, *T.SUMMARY_CATEGORIES, *T.OBJECT_CATEGORIES, *T.ACTION_CATEGORIES, *T.COUNTING_CATEGORIES, *T.TEXT_CATEGORIES, *T.COUNTED_CATEGORIES, "Other things"]
ALIGNMENTS = [*T.ALIGNMENTS, "none", ""]
LEVELS, KINDS = ["L1-Perception", "L2-Relation", ""], ["local", "global", "other"]
ANSWERS = ["yes", "No", "12", "-3.5", "a red ball", "the man walks to the door", "", "12 apples"]
BENCHMARKS = ["videomme", "lvbench", "longvideobench"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table that has fewer partitions than there are cores, dealt to all of these, for queries that work long on each row; others as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch(spark: SparkSession) -> str:
    """A folder of a run's own in the one that the cluster names in spark.checkpoint.dir."""
    return new_folder(spark, "records")


def pick(values: list[str], number: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.pmod(number, F.lit(len(values))).cast("int"))


def candidate(key: str = "doc_id", text: str = "text") -> P.Record:
    n = F.col(key)
    return P.Record(
        question=F.col(text),
        answer=pick(ANSWERS, n),
        source=pick(NAMES, n),
        metadata={"category": pick(CATEGORIES, n * 7), "AlignmentType": pick(ALIGNMENTS, n * 3), "level": pick(LEVELS, n), "type": pick(KINDS, n * 5), "video_duration": P.Number(F.pmod(n * 37, F.lit(4000)).cast("double"))},
    )


def bench(key: str = "item_id", text: str = "text") -> P.Record:
    n = F.col(key)
    tasks = list(T.TASK_BUCKETS)
    return P.Record(
        question=F.col(text), answer=pick(ANSWERS, n * 3), source=pick(BENCHMARKS, n), benchmark=True,
        metadata={"task_type": pick(tasks, n), "type": pick(KINDS, n), "level": pick(LEVELS, n * 2), "duration": pick(["short", "medium", "long", "60", "x"], n)},
    )


# -- the same in SQL --------------------------------------------------------------------------------------------------------------


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sql_half_up(top: str, bottom: str) -> str:
    """top / bottom to the next integer, halves up, in integers."""
    return f"CAST((2 * ({top}) + ({bottom})) // (2 * ({bottom})) AS BIGINT)"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


def sql_in(x: str, values: list[str]) -> str:
    return f"{x} IN ({', '.join(map(quoted, values))})"


def sql_pick(values: list[str], number: str) -> str:
    return f"{sql_list(values)}[({number}) % {len(values)} + 1]"


def sql_norm(x: str) -> str:
    return rf"trim(regexp_replace(lower(coalesce({x}, '')), '\s+', ' ', 'g'))"


def sql_any(x: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {quoted(p)})" for p in phrases) + ")"


def sql_word(x: str, word: str) -> str:
    return f"contains(' ' || {x} || ' ', ' {word} ')"


def sql_tags(conditions: dict[str, str]) -> str:
    """The tags whose condition holds, sorted and joined by commas."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {conditions[t]} THEN {quoted(t)} END" for t in sorted(conditions)) + ")"


FAMILY = """CASE WHEN contains(name, 'askmodelanything') THEN 'askmodelanything' WHEN contains(name, 'longcapqa') THEN 'longcapqa'
 WHEN contains(name, 'subtitle') THEN 'subtitleqa' WHEN contains(name, 'count') THEN 'count_eval'
 WHEN contains(name, 'point') AND NOT contains(name, 'track') THEN 'point_grounding' WHEN contains(name, 'track') THEN 'tracking'
 WHEN contains(name, 'capeval') THEN 'capeval' WHEN contains(name, 'capqa') THEN 'capqa' WHEN contains(name, 'cap') THEN 'caption'
 WHEN name = '' THEN 'unknown' ELSE name END"""


def sql_duration(x: str, words: bool) -> str:
    n = f"CASE WHEN regexp_matches({x}, '^[0-9]+$') THEN TRY_CAST({x} AS DOUBLE) END" if words else x
    known = f"WHEN {x} IN ('short', 'medium', 'long', 'very_long') THEN {x} " if words else ""
    return f"""CASE {known}WHEN ({n}) IS NULL THEN 'unknown' WHEN ({n}) = 15 THEN 'short' WHEN ({n}) = 60 THEN 'medium' WHEN ({n}) = 600 THEN 'long'
 WHEN ({n}) = 3600 THEN 'very_long' WHEN ({n}) <= 60 THEN 'short' WHEN ({n}) <= 600 THEN 'medium' WHEN ({n}) <= 1800 THEN 'long' ELSE 'very_long' END"""


def skill_conditions(family: str) -> dict[str, str]:
    held = {t: sql_any("blob", p) for t, p in T.SKILLS.items()}
    extra = {
        "counting": "contains(q, 'how many')",
        "temporal_reasoning": sql_any("q", T.ORDER_WORDS),
        "causal": sql_word("q", "why"),
        "spatial_perception": sql_word("q", "where"),
        "summary": f"(starts_with(q, 'summarize') OR {sql_word('q', 'summary')})",
    }
    for t in held:
        parts = [held[t], *([extra[t]] if t in extra else [])]
        families = [f for f, tags in T.FAMILY_SKILLS.items() if t in tags]
        held[t] = "(" + " OR ".join([*parts, *([sql_in(family, families)] if families else [])]) + ")"
    for general in ("temporal", "spatial", "object", "action"):
        held[general] = "(" + " OR ".join(c for t, c in list(held.items()) if t.startswith(f"{general}_")) + ")"
    return held | {"text": f"({held['dialogue']} OR {held['ocr']})", "global": held["summary"]}


def _tag_columns() -> str:
    broad = "family IN ('longcapqa', 'caption')"
    skills = "(',' || skill_tags || ',')"
    return f"""SELECT *,
 {sql_tags({t: sql_any('blob', p) for t, p in T.DOMAINS.items()})} AS domain_tags,
 {sql_tags({
        'reasoning': f"({sql_any('blob', ['relation', 'reasoning'])} OR contains({skills}, '_reasoning,'))",
        'perception': "(contains(blob, 'perception') OR contains(level, 'perception'))",
        'summary': f"({sql_any('blob', ['summary', 'synopsis'])} OR contains({skills}, ',summary,'))",
        'grounding': f"(contains(blob, 'grounding') OR contains({skills}, ',grounding,') OR contains({skills}, ',tracking,') OR contains({skills}, ',temporal_grounding,'))",
        'relation': "(contains(blob, 'l2-relation') OR contains(level, 'relation'))",
    })} AS reasoning_tags,
 {sql_tags({
        'visual': 'TRUE',
        'subtitle': f"({sql_any('blob', ['subtitle', 'dialogue', 'transcript'])} OR family = 'subtitleqa')",
        'ocr': sql_any('blob', ['ocr', 'text recognition', 'text location']),
        'cross_modal': f"(family = 'subtitleqa' OR {sql_any('alignment', ['alignment', 'cross-modal'])})",
    })} AS modality_tags,
 {sql_tags({
        'local': f"({sql_word('blob', 'local')} OR {sql_any('blob', ['temporal grounding', 'location', 'point'])} OR family IN ('count_eval', 'point_grounding', 'tracking') OR kind = 'local')",
        'global': f"({sql_word('blob', 'global')} OR {sql_any('blob', ['summary', 'synopsis'])} OR {broad} OR kind = 'global')",
        'multi_segment': broad,
    })} AS locality_tags,
 CASE WHEN a = '' THEN 'unknown' WHEN a IN ('yes', 'no') THEN 'binary' WHEN regexp_matches(a, '^-?[0-9]+(\\.[0-9]+)?$') THEN 'number'
  WHEN len(string_split(a, ' ')) <= 3 THEN 'short_phrase' ELSE 'sentence' END AS answer_type"""


TEMPORAL = sql_any("q", T.TEMPORAL_QUESTION)
WHY = f"({sql_word('q', 'why')} OR contains(q, 'reason'))"
_TASK = "CASE " + " ".join(f"WHEN category = {quoted(k)} THEN {quoted(v)}" for k, v in T.TASK_BUCKETS.items()) + " END"
BUCKET = f"""CASE WHEN bench = 'videomme' AND {_TASK} IS NOT NULL THEN {_TASK}
 WHEN family IN ('capqa', 'longcapqa') THEN CASE WHEN {sql_in('category', T.SUMMARY_CATEGORIES)} THEN 'summary' WHEN {sql_in('category', T.TEMPORAL_CATEGORIES)} THEN 'temporal_sequence'
  WHEN {sql_in('category', T.OBJECT_CATEGORIES)} THEN 'object_reasoning' WHEN {sql_in('category', T.ACTION_CATEGORIES)} THEN 'action_reasoning'
  WHEN {sql_in('category', T.COUNTING_CATEGORIES)} THEN 'counting' ELSE 'general' END
 WHEN family = 'subtitleqa' THEN CASE WHEN {sql_in('category', T.TEXT_CATEGORIES)} THEN 'ocr_text' WHEN {sql_any('alignment', T.ALIGNMENTS)} THEN 'subtitle_alignment'
  WHEN {sql_in('category', T.TEMPORAL_CATEGORIES)} THEN 'temporal_sequence' WHEN category = 'object reasoning' THEN 'object_reasoning'
  WHEN category = 'action reasoning' THEN 'action_reasoning' ELSE 'general' END
 WHEN family = 'caption' THEN CASE WHEN {TEMPORAL} THEN 'temporal_sequence' ELSE 'summary' END
 WHEN family = 'askmodelanything' THEN CASE WHEN contains(q, 'how many') THEN 'counting' WHEN {TEMPORAL} THEN 'temporal_sequence' WHEN {WHY} THEN 'action_reasoning' ELSE 'general' END
 WHEN family = 'count_eval' THEN CASE WHEN {sql_in('category', T.COUNTED_CATEGORIES)} THEN 'counting' ELSE 'general' END
 WHEN contains(q, 'how many') OR regexp_matches(a, '^-?[0-9]+(\\.[0-9]+)?$') THEN 'counting' WHEN {TEMPORAL} THEN 'temporal_sequence' ELSE 'general' END"""

_CAND_BLOB = "concat_ws(' | ', nullif(text, ''), nullif(ans, ''), category0, nullif(alignment0, ''), nullif(level0, ''), kind0, secs::VARCHAR)"
CANDIDATES = f"""cand0 AS (SELECT doc_id, text, {sql_pick(ANSWERS, 'doc_id')} AS ans, {sql_pick(NAMES, 'doc_id')} AS name, {sql_pick(CATEGORIES, 'doc_id * 7')} AS category0,
 {sql_pick(ALIGNMENTS, 'doc_id * 3')} AS alignment0, {sql_pick(LEVELS, 'doc_id')} AS level0, {sql_pick(KINDS, 'doc_id * 5')} AS kind0, CAST((doc_id * 37) % 4000 AS DOUBLE) AS secs FROM documents),
cand1 AS (SELECT doc_id, name, secs, '' AS bench, {FAMILY} AS family, {sql_norm('text')} AS q, {sql_norm('ans')} AS a, lower(category0) AS category, lower(alignment0) AS alignment,
 lower(level0) AS level, kind0 AS kind, {sql_norm(_CAND_BLOB)} AS blob FROM cand0),
cand2 AS (SELECT *, {sql_tags(skill_conditions('family'))} AS skill_tags FROM cand1),
cand AS ({_tag_columns()}, {BUCKET} AS skill_bucket, {sql_duration('secs', False)} AS duration_bucket FROM cand2)"""

_BENCH_BLOB = "concat_ws(' | ', nullif(text, ''), nullif(ans, ''), task, kind0, nullif(level0, ''), dur)"
BENCHES = f"""bench0 AS (SELECT item_id, text, {sql_pick(ANSWERS, 'item_id * 3')} AS ans, {sql_pick(BENCHMARKS, 'item_id')} AS name, {sql_pick(list(T.TASK_BUCKETS), 'item_id')} AS task,
 {sql_pick(KINDS, 'item_id')} AS kind0, {sql_pick(LEVELS, 'item_id * 2')} AS level0, {sql_pick(['short', 'medium', 'long', '60', 'x'], 'item_id')} AS dur FROM benchmark),
bench1 AS (SELECT item_id, name, name AS bench, {FAMILY} AS family, {sql_norm('text')} AS q, {sql_norm('ans')} AS a, task AS category, '' AS alignment, lower(level0) AS level, kind0 AS kind, dur,
 {sql_norm(_BENCH_BLOB)} AS blob FROM bench0),
bench2 AS (SELECT *, {sql_tags(skill_conditions('family'))} AS skill_tags FROM bench1),
bch AS ({_tag_columns()}, {BUCKET} AS skill_bucket, CASE WHEN ({sql_duration('dur', True)}) <> 'unknown' THEN ({sql_duration('dur', True)}) WHEN name = 'lvbench' THEN 'very_long'
 WHEN contains(name, 'long') THEN 'long' ELSE 'unknown' END AS duration_bucket FROM bench2)"""
