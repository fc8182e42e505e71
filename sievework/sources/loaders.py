"""Loaders of known kinds of records, and of lists of files with what is said about them.

Each returns a DataFrame whose plan reads the files; only lists of paths and small rule files pass through the driver. JSON lines that
are broken are skipped, or end the job where a loader is strict; lines that are no objects and blank lines are skipped."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import caption, messages, profiles
from ..functions.text import base_name, normalized, squeezed, stripped
from ..operators.files import head
from ..operators.selection import sources_in_turn
from . import readers

MESSAGES = "messages array<struct<role string, content string>>"
_EVALUATION = """doc_id long, target string, filtered_resps array<string>, input string, videomme_perception_score
 struct<question_id string, duration string, category string, sub_category string, task_category string, pred_answer string, answer string, score double, videoID string>"""


def json_lines(spark: SparkSession, paths: list[str], schema: str | T.StructType, strict: bool = False, missing: bool = False) -> DataFrame:
    """Objects of JSON lines with the path of their file and their position in it, which orders the lines of a file."""
    held = [p for p in paths if readers.exists(spark, p)]
    if not held or len(held) < len(paths) and not missing:
        raise FileNotFoundError(", ".join(p for p in paths if p not in held) or "no paths")
    found = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # lines keep the order of their file by the block of the file and a running number in it
    lines = spark.read.text(held).select("value", F.col("_metadata.file_path").alias("path"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("position"))
    lines = lines.where(stripped(F.col("value")) != "")
    if not strict:
        lines = lines.where(F.try_parse_json("value").isNotNull() & stripped(F.col("value")).startswith("{"))
    parsed = F.from_json("value", found, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    return lines.select(parsed.alias("r"), "path", "position").select("r.*", "path", "position")


def caption_items(spark: SparkSession, paths: list[str], id_field: str = "id", most: int = 0, default_seconds: float = 180.0) -> DataFrame:
    """Captions of videos as items: id, video_id, duration_sec, sections, structured_caption, segments, images_source. A broken line is an error; records
    without an id or a caption go, and `most` counts those that stay."""
    rows = json_lines(spark, paths, f"`{id_field}` string, {MESSAGES}, images_source array<string>", strict=True)
    images = F.filter(F.coalesce("images_source", F.array().cast("array<string>")), lambda x: stripped(F.coalesce(x, F.lit(""))) != "")
    rows = rows.select("position", "path", images.alias("images_source"), caption.video_id(F.col("images_source"), F.col(f"`{id_field}`")).alias("video_id"), messages.first_content(F.col("messages")).alias("text"))
    rows = rows.where("video_id <> '' and text is not null").withColumn("sections", caption.sections(F.col("text")))
    s = F.col("sections")
    items = rows.select(
        "path", "position", F.col("video_id").alias(id_field), "video_id",
        caption.duration(F.col("video_id"), base_name("path"), default_seconds).alias("duration_sec"),
        "sections", caption.structured(s).alias("structured_caption"),
        caption.events(s["motion_detail_description"], s["highlight_moments"]).alias("segments"), "images_source",
    )
    return _first(items, most)


def qa_items(spark: SparkSession, paths: list[str], id_field: str = "id", most: int = 0, image_root: str = "") -> DataFrame:
    """Question-answer items of records: id `{record}#qa{index}`, source_id, qa_index, question, answer, image_path. `most` counts items."""
    schema = f"`{id_field}` string, video_id string, question string, answer string, qas array<struct<question string, answer string>>, {MESSAGES}, image string, images array<string>, images_source array<string>"
    rows = json_lines(spark, paths, schema)
    own = F.coalesce(F.nullif(stripped(F.col(f"`{id_field}`")), F.lit("")), F.nullif(stripped(F.col("video_id")), F.lit("")), F.md5(F.to_json(F.struct("question", "answer", "qas", "messages"))))
    pairs = messages.pairs(F.col("qas"), F.col("question"), F.col("answer"), F.col("messages"))
    image = messages.image_path(F.col("image"), F.coalesce("images", F.array().cast("array<string>")), F.coalesce("images_source", F.array().cast("array<string>")), image_root)
    items = rows.select("path", "position", own.alias("source_id"), image.alias("image_path"), F.posexplode(pairs).alias("qa_index", "pair"))
    items = items.select("path", "position", F.concat("source_id", F.lit("#qa"), "qa_index").alias("id"), "source_id", "qa_index", "pair.question", "pair.answer", "image_path")
    return _first(items, most, "qa_index")


def _first(rows: DataFrame, most: int, *more: str) -> DataFrame:
    """The first rows in the order of files and lines, without these two."""
    held = rows.orderBy("path", "position", *more).limit(most) if most > 0 else rows
    return held.drop("path", "position")


def evaluation_samples(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Answers of an evaluation, flat: doc_id, question, target, pred, score, question_id, video_id, duration, category, sub_category, task_type."""
    rows, m = json_lines(spark, paths, _EVALUATION, strict=True), "videomme_perception_score"
    text = lambda name: F.coalesce(F.col(f"{m}.{name}"), F.lit(""))
    pred = F.coalesce(F.get("filtered_resps", F.lit(0)), F.lit(""))
    return rows.select(
        "doc_id", F.coalesce("input", F.lit("")).alias("question"), F.coalesce("target", F.lit("")).alias("target"), pred.alias("pred"), F.coalesce(f"{m}.score", F.lit(0.0)).alias("score"),
        text("question_id").alias("question_id"), text("videoID").alias("video_id"), F.coalesce(F.nullif(text("duration"), F.lit("")), F.lit("unknown")).alias("duration"),
        text("category").alias("category"), text("sub_category").alias("sub_category"), text("task_category").alias("task_type"),
    )


def tuning_rows(spark: SparkSession, pattern: str) -> DataFrame:
    """Fine-tuning records of all files that match: input_name, line_number (from 1, blank lines counted), id, images_source, messages. No file at all is an error."""
    if not readers.exists(spark, pattern):
        raise FileNotFoundError(pattern)
    lines = readers.numbered_lines(spark, [pattern]).where(F.try_parse_json("value").isNotNull() & stripped(F.col("value")).startswith("{"))
    parsed = F.from_json("value", T.StructType.fromDDL(f"id string, images_source array<string>, {MESSAGES}"))
    return lines.select(base_name("path").alias("input_name"), "line_number", parsed.alias("r")).select("input_name", "line_number", "r.id", "r.images_source", "r.messages")


def heads(spark: SparkSession, paths: list[str], most: int, filled: bool) -> DataFrame:
    """(file, question) of the first `most` lines of each file, or the first `most` that have a question where `filled`; the question is that of the first user message."""
    rows = json_lines(spark, paths, MESSAGES)
    first = F.get(F.filter("messages", lambda m: m["role"] == "user"), F.lit(0))["content"]
    rows = rows.select(base_name("path").alias("file"), "position", squeezed(F.coalesce(first, F.lit(""))).alias("question"))
    return head(rows.where("question <> ''") if filled else rows, most, "file", "position").select("file", "question")


def judged_rows(spark: SparkSession, folder: str, schema: str | T.StructType, most: int = 0) -> DataFrame:
    """Records of a folder's judged files (`*_judged*.jsonl`): their fields, with file and line_number; `most` keeps the first ones by file and line."""
    pattern = f"{folder.rstrip('/')}/*_judged*.jsonl"
    if not readers.exists(spark, pattern):
        raise FileNotFoundError(pattern)
    found = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = readers.numbered_lines(spark, [pattern]).where(F.try_parse_json("value").isNotNull() & stripped(F.col("value")).startswith("{"))
    rows = lines.select(base_name("path").alias("file"), "line_number", F.from_json("value", found).alias("r")).select("r.*", "file", "line_number")
    return rows.orderBy("file", "line_number").limit(most) if most > 0 else rows


def sourced(
    spark: SparkSession, specs: list[readers.SourceSpec], role: str = "candidate", most: int = 0, include_context: bool = False, most_chars: int = 0, once: bool = True, skip_missing: bool = False,
    overrides: dict[str, dict[str, Column]] | None = None,
) -> DataFrame:
    """Examples of several sources with their profiles, under a role (candidate or benchmark), in the order of the sources and of ids.

    Each source stops at its own limit and all together at `most`; `once` keeps the first of examples with equal texts, where only texts that were taken count. Sources without files are skipped
    or an error; so is a result without examples. overrides: fields of profiles by the source's name."""
    if role not in ("candidate", "benchmark"):
        raise ValueError(f"no role {role!r}")
    held = [s for s in specs if not skip_missing or any(readers.exists(spark, p) for p in s.paths)]
    if not held:
        raise FileNotFoundError(", ".join(p for s in specs for p in s.paths) or "no sources")
    parts = []
    for spec in held:
        rows = readers.examples(spark, spec, include_context, most_chars, skip_missing, values=True)
        record = profiles.Record(F.col("question"), F.col("answer"), F.col("source_name"), F.col("context"), {k: F.col("metadata_values")[k] for k in spec.metadata}, role == "benchmark")
        parts.append(profiles.with_profile(rows, record, overrides=(overrides or {}).get(spec.name)).drop("metadata_values"))
    found = sources_in_turn(parts, normalized("similarity_text") if once else None, [s.limit for s in held], most, "id")
    if found.isEmpty():
        raise ValueError(f"no {role} examples in {', '.join(s.name for s in held)}")
    return found


# -- lists of files -----------------------------------------------------------------------------------------------------------------


def listed(spark: SparkSession, folder: str, suffix: str = ".jsonl") -> DataFrame:
    """(file, bytes) of a folder's own files with this suffix."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    rows = [(s.getPath().getName(), s.getLen()) for s in found if s.isFile() and s.getPath().getName().endswith(suffix)]
    return spark.createDataFrame(rows, "file string, bytes long")


def to_clean(files: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """Files of a folder that wait to be cleaned, small ones first: without outputs of earlier runs."""
    name = F.regexp_replace("file", r"\.[^.]*$", "")
    rows = files.where(~name.startswith("other_") & ~name.endswith("_clean") & ~name.endswith("_dirty"))
    return (rows.where(F.col("file").isin(allowed)) if allowed else rows).orderBy("bytes", "file")


def manifest_files(spark: SparkSession, path: str) -> DataFrame:
    """The different files of a CSV manifest that it calls related to mathematics or to the examination; only `true`, in any case, counts."""
    rows = readers.read_records(spark, [path])
    true = lambda c: F.lower(stripped(F.coalesce(F.col(c), F.lit("")))) == "true"
    return rows.where(true("math_related") | true("mmmu_related")).select(stripped(F.col("file")).alias("file")).where("file <> ''").distinct()


def present(candidates: DataFrame, existing: DataFrame, prefixes: list[str], variants: bool = False) -> DataFrame:
    """The different candidates that exist, without files of these prefixes and, unless `variants`, without cleaned and dirty ones."""
    name = F.regexp_replace("file", r"(?<=.)\.[^.]*$", "")
    bad = F.lit(False)
    for p in prefixes:
        bad = bad | name.startswith(p)
    if not variants:
        bad = bad | name.endswith("_clean") | name.endswith("_dirty")
    return candidates.select("file").distinct().where(~bad).join(existing.select("file"), "file", "left_semi")


def with_cleaned(files: DataFrame, clean: DataFrame) -> DataFrame:
    """files with `cleaned`: whether the set of cleaned files has them."""
    done = clean.select("file").distinct().withColumn("cleaned", F.lit(True))
    return files.join(done, "file", "left").withColumn("cleaned", F.coalesce("cleaned", F.lit(False)))


def counts_compared(local: DataFrame, remote: DataFrame) -> DataFrame:
    """(name, local, remote, status) of two counts by name; a name that the other side lacks counts 0 there."""
    both = local.select("name", F.col("n").alias("local")).join(remote.select("name", F.col("n").alias("remote")), "name", "left")
    there = F.coalesce("remote", F.lit(0).cast("long"))
    status = F.when(there == F.col("local"), "OK").when(there < F.col("local"), "INCOMPLETE").otherwise("EXTRA?")
    return both.select("name", "local", there.alias("remote"), status.alias("status"))


def rules(text: str) -> dict:
    """File rules of a JSON document: exact names, keywords of the content and prefixes, each with its domains."""
    raw = json.loads(text) or {}
    lists = lambda d: {str(k): [str(x) for x in (v if isinstance(v, list) else [v])] for k, v in (d or {}).items()}
    return {"exact": lists(raw.get("exact")), "hints": lists(raw.get("hints")), "prefixes": [str(x) for x in raw.get("prefixes") or []]}


def images(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, data, mime): files of images in base64, as they are; nothing here scales them."""
    rows = spark.read.format("binaryFile").load(paths)
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    mime: Column = F.when(suffix == "png", "image/png").when(suffix == "webp", "image/webp").when(suffix == "gif", "image/gif").otherwise("image/jpeg")
    return rows.select("path", F.base64("content").alias("data"), mime.alias("mime"))


# -- known sources -------------------------------------------------------------------------------------------------------------------

# Names, places and fields of seven datasets of questions about videos.
_KNOWN = [
    ("molmo2_askmodelanything", "Molmo2-AskModelAnything/data/HumanQA-00000-of-00001.parquet", ["question"], ["answer"], [], ["video_id"], {}),
    ("molmo2_videocapqa", "Molmo2-VideoCapQA/data/CapQA-00000-of-00001.parquet", ["Question"], ["Answer"], ["Category"], ["video_id", "Category"], {}),
    ("molmo2_longcapqa", "Molmo2-VideoCapQA/data/LongCapQA-00000-of-00001.parquet", ["Question"], ["Answer"], ["Category"], ["video_id", "Category"], {"explode": "qa_list"}),
    ("molmo2_cap", "Molmo2-Cap/data/*.parquet", [], ["video_frame_merged_caption"], ["video_transcript", "merged_caption"], ["video_id", "annotation_score"], {"text_mode": "answer_only"}),
    ("molmo2_videosubtitleqa", "Molmo2-VideoSubtitleQA/data/*.parquet", ["Question"], ["Answer"], ["Category"], ["video_id", "Category", "AlignmentType"], {}),
    ("molmo2_videocounteval", "Molmo2-VideoCountEval/data/*.parquet", ["question"], ["label"], ["category"], ["video_id", "category", "video_duration", "video_source"], {}),
    ("molmo2_videopoint", "Molmo2-VideoPoint/data/train-00000-of-00001.parquet", ["question"], ["label"], ["category"], ["video_id", "category", "video_duration", "video_source"], {}),
]


def known_sources(root: str, limit: int = 0) -> list[readers.SourceSpec]:
    return [readers.SourceSpec(name, [f"{root.rstrip('/')}/{path}"], ["video_id"], q, a, c, m, limit=limit, **more) for name, path, q, a, c, m, more in _KNOWN]
