"""Writers. Each write is one job, committed as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.resume import accepted

AUDIT = ("_clean_verdict", "_clean_keep")


def append_results(results: DataFrame, path: str, done: DataFrame, key: str = "id") -> None:
    """Appends rows of new ids as JSON lines; of equal ids the first row by its text counts."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in results.columns]))
    accepted(results.withColumn("__whole", whole), done, key, key, "__whole").drop("__whole").write.mode("append").json(path)


def truthy(df: DataFrame, name: str) -> Column:
    """Whether a column holds something: true, a number other than 0, a text, list, map or struct that is not empty."""
    kind, x = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.BooleanType):
        held = x
    elif isinstance(kind, T.NumericType):
        held = x != 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        held = F.size(x) > 0
    elif isinstance(kind, T.StringType):
        held = x != ""
    else:
        held = x.isNotNull()
    return F.coalesce(held, F.lit(False))


def split_clean_dirty(judged: DataFrame, clean: str, dirty: str, keep: Column | None = None) -> tuple[int, int]:
    """Kept rows without the audit columns, the others with them; returns both counts. judged should be a written table."""
    stays = F.coalesce(keep, F.lit(False)) if keep is not None else truthy(judged, "_clean_keep")
    counts = []
    for part, path, dropped in ((judged.where(stays), clean, AUDIT), (judged.where(~stays), dirty, ())):
        seen = Observation()
        part.drop(*dropped).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(path)
        counts.append(seen.get["rows"])
    return counts[0], counts[1]


def write_buckets(selected: DataFrame, path: str, bucket: str = "bucket_key") -> None:
    selected.write.mode("overwrite").partitionBy(bucket).json(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """CSV with the domains of a file joined by semicolons."""
    manifest.withColumn("domains", F.concat_ws(";", "domains")).write.mode("overwrite").option("header", True).csv(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """CSV with six decimals."""
    formatted = [F.format_string("%.6f", F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in scores.schema]
    scores.select(*formatted).write.mode("overwrite").option("header", True).csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """One JSON document of a summary of few rows."""
    summary.agg(F.to_json(F.collect_list(F.struct(*summary.columns))).alias("value")).write.mode("overwrite").text(path)
