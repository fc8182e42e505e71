"""Readers: files of records become DataFrames of examples."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from ..functions.text import similarity_text, stem, stripped


@dataclass
class SourceSpec:
    """Where a source is and which of its fields make an example. Fields may be dotted; the first that a record has counts."""

    name: str
    paths: list[str]
    ids: list[str] = field(default_factory=lambda: ["id"])
    questions: list[str] = field(default_factory=lambda: ["question"])
    answers: list[str] = field(default_factory=lambda: ["answer"])
    contexts: list[str] = field(default_factory=list)
    metadata: list[str] = field(default_factory=list)
    explode: str | None = None
    record_field: str | None = None
    text_mode: str = "qa_concat"
    limit: int = 0
    schema: str | T.StructType | None = None


def format_of(path: str) -> str:
    low = path.lower().rstrip("/*")
    for suffixes, name in (((".jsonl", ".jl"), "jsonl"), ((".json",), "json"), ((".parquet",), "parquet"), ((".csv",), "csv")):
        if low.endswith(suffixes):
            return name
    raise ValueError(f"no reader for {path}")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return len(found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found) or []) > 0


def folders(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that are folders, as Spark names them: tables of several part files."""
    jvm = spark.sparkContext._jvm
    found = []
    for path in map(jvm.org.apache.hadoop.fs.Path, paths):
        found += [s.getPath().toString() for s in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or [] if s.isDirectory()]
    return found


def read_records(spark: SparkSession, paths: list[str], schema: str | T.StructType | None = None, record_field: str | None = None, skip_missing: bool = False, strict: bool = False) -> DataFrame:
    """Records of JSON lines, JSON documents (a list, a list in a field, or one object), Parquet or CSV with a header.

    Broken JSON lines are skipped; where `strict`, they end the job."""
    held = [p for p in paths if exists(spark, p)]
    if not skip_missing and len(held) < len(paths) or not held:
        raise FileNotFoundError(", ".join(p for p in paths if p not in held) or "no paths")
    kinds = {format_of(p) for p in held}
    if len(kinds) > 1:
        raise ValueError(f"one source has files of several kinds: {sorted(kinds)}")
    kind = kinds.pop()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == "parquet":
        return reader.parquet(*held)
    if kind == "csv":
        return reader.option("header", True).csv(held)
    df = reader.option("multiLine", kind == "json").option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(held)
    if record_field and record_field in df.columns:
        inner = df.schema[record_field].dataType
        df = df.select(F.explode(record_field).alias("r")) if isinstance(inner, T.ArrayType) else df.select(F.col(record_field).alias("r"))
        df = df.select("r.*")
    return df


def field_column(schema: T.StructType, name: str, root: str = "") -> Column | None:
    """The column of a dotted field, if the schema has it."""
    kind: T.DataType = schema
    for part in name.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            return None
        kind = kind[part].dataType
    return F.col(f"{root}{name}")


def _truth(column: Column) -> Column:
    return F.when(column, "True").when(~column, "False")


def text_of(column: Column, kind: T.DataType, most: int = 20) -> Column:
    """Any value as text: a string without white space at its ends, the `text` of a struct that has one and the JSON of others with sorted fields, the
    first `most` elements of a list, without empty ones, joined by ` | `; null for null."""
    if isinstance(kind, T.StringType):
        return stripped(column)
    if isinstance(kind, T.BooleanType):
        return _truth(column)
    if isinstance(kind, T.ArrayType):
        held = F.transform(F.slice(column, 1, most), lambda x: text_of(x, kind.elementType))
        return F.concat_ws(" | ", F.filter(held, lambda x: x != ""))
    if isinstance(kind, T.StructType):
        if "text" in kind.fieldNames():
            return text_of(column["text"], kind["text"].dataType)
        return F.when(column.isNotNull(), F.to_json(F.struct(*[column[n].alias(n) for n in sorted(kind.fieldNames())])))
    return F.to_json(column) if isinstance(kind, T.MapType) else column.cast("string")


def values_of(column: Column, kind: T.DataType) -> Column:
    """All that a value holds, however deep, as texts: elements of lists, fields of structs and values of maps, without nulls."""
    none = F.array().cast("array<string>")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        inner, of = (column, kind.elementType) if isinstance(kind, T.ArrayType) else (F.map_values(column), kind.valueType)
        return F.coalesce(F.flatten(F.transform(inner, lambda x: values_of(x, of))), none)
    if isinstance(kind, T.StructType):
        return F.concat(none, *[values_of(column[f.name], f.dataType) for f in kind.fields])
    return F.array_compact(F.array(_truth(column) if isinstance(kind, T.BooleanType) else column.cast("string")))


def kind_of(schema: T.StructType, name: str) -> T.DataType:
    kind: T.DataType = schema
    for part in name.split("."):
        kind = kind[part].dataType
    return kind


def first_field(df: DataFrame, names: list[str], child: T.StructType | None = None) -> Column:
    """The first non-empty of these fields, in the exploded element before the record."""
    found = []
    for name in names:
        if child is not None and (c := field_column(child, name, "element.")) is not None:
            found.append(F.nullif(text_of(c, kind_of(child, name)), F.lit("")))
        if (c := field_column(df.schema, name)) is not None:
            found.append(F.nullif(text_of(c, kind_of(df.schema, name)), F.lit("")))
    return F.coalesce(*found, F.lit(None).cast("string")) if found else F.lit(None).cast("string")


def first_values(df: DataFrame, name: str, child: T.StructType | None = None) -> Column:
    """All values of a field, in the exploded element before the record, joined by ` | `; null if there are none."""
    found = []
    if child is not None and (c := field_column(child, name, "element.")) is not None:
        found.append(F.nullif(F.array_join(values_of(c, kind_of(child, name)), " | "), F.lit("")))
    if (c := field_column(df.schema, name)) is not None:
        found.append(F.nullif(F.array_join(values_of(c, kind_of(df.schema, name)), " | "), F.lit("")))
    return F.coalesce(*found, F.lit(None).cast("string"))


def examples(spark: SparkSession, spec: SourceSpec, include_context: bool = False, most_chars: int = 0, skip_missing: bool = False, values: bool = False) -> DataFrame:
    """Examples of a source: id, source_name, source_path, source_record_id, question, answer, context, similarity_text, metadata and, with `values`,
    metadata_values: the texts that each field of the metadata holds, however deep.

    Elements of an exploded list keep their index in it; a record without elements stays one example. Rows without text go. A folder is one source path,
    so that ids and their order do not depend on its part files."""
    df = read_records(spark, spec.paths, spec.schema, spec.record_field, skip_missing)
    file = F.col("_metadata.file_path")
    place = F.coalesce(*[F.when(file.startswith(f"{x}/"), F.lit(x)) for x in folders(spark, spec.paths)], file)
    df = df.withColumn("__path", place) if "_metadata" not in df.columns and not spec.record_field else df.withColumn("__path", F.lit(spec.paths[0]))
    child = None
    if spec.explode and (lists := field_column(df.schema, spec.explode)) is not None:
        kind = kind_of(df.schema, spec.explode)
        child = kind.elementType if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) else None
        df = df.select("*", F.posexplode_outer(lists).alias("__e", "element"))
    else:
        df = df.withColumn("__e", F.lit(None).cast("int"))
    own = F.coalesce(first_field(df, spec.ids, child), F.concat(F.lit("row_"), F.left(F.md5(F.to_json(F.struct(*[c for c in df.columns if c not in ("__path", "__e")]))), F.lit(10))))
    record = F.concat(own, F.coalesce(F.concat(F.lit("#e"), F.col("__e")), F.lit("")))
    question, answer, context = (first_field(df, names, child) for names in (spec.questions, spec.answers, spec.contexts))
    meta = [x for name in spec.metadata for x in (F.lit(name), first_field(df, [name], child))]
    filled = F.map_filter(F.create_map(*meta), lambda _, v: v.isNotNull()) if meta else F.create_map().cast("map<string,string>")
    deep = [x for name in spec.metadata for x in (F.lit(name), first_values(df, name, child))] if values else []
    more = [F.map_filter(F.create_map(*deep), lambda _, v: v.isNotNull()) if deep else F.create_map().cast("map<string,string>")] if values else []
    out = df.select(
        F.concat_ws(":", F.lit(spec.name), stem("__path"), record).alias("id"),
        F.lit(spec.name).alias("source_name"),
        F.col("__path").alias("source_path"),
        record.alias("source_record_id"),
        question.alias("question"),
        answer.alias("answer"),
        context.alias("context"),
        similarity_text(question, answer, context if include_context else None, spec.text_mode, most_chars).alias("similarity_text"),
        filled.alias("metadata"),
        *[x.alias("metadata_values") for x in more],
    )
    return out.where("similarity_text <> ''")


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, line_number, value) of all lines of text files, numbered from 1 in each file, blank lines counted too.

    Files are read in blocks by many tasks: a first pass counts the lines of each block, sums over a file's blocks say where each begins, and a
    second pass numbers. Only one row for each block is shuffled."""
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(paths).select(*place, "value", F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("path", "block", "first", before.alias("before"))
    # as many rows as there are blocks: some millions at most, below which they are sent to all tasks
    return lines.join(F.broadcast(starts), ["path", "block"]).select("path", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_number"), "value")


def line_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, total_lines, filled_lines): all lines, and those that are not blank."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_name").alias("file"), "value")
    return lines.groupBy("file").agg(F.count("*").alias("total_lines"), F.count_if(F.trim("value") != "").alias("filled_lines"))


def dirty_count(spark: SparkSession, path: str) -> int:
    """Rows of an output that were judged not to be kept."""
    return spark.read.schema("_clean_keep boolean").json(path).where("_clean_keep = false").count()
