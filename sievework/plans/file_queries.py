"""Files of records that are written from the driver's tables and read back: lines, lists of files, batches, versions, calls and their times."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import verdict
from ..operators import calls, filebatch, latency, tasks
from ..sources import loaders, readers, sinks
from ..sources.scratch import written
from . import base
from .base import scratch, table


def _lines(spark, sf, folder: str) -> str:
    """Events in order of their ids as lines of one file, every seventh followed by a blank one."""
    e = table(spark, sf, "events").orderBy("event_id")
    blank = F.when(F.col("event_id") % 7 == 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    text = F.explode(F.concat(F.array(F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.array(F.struct(F.lit("user").alias("role"), F.col("event_type").alias("content"))).alias("messages")))), blank))
    e.coalesce(1).sortWithinPartitions("event_id").select(text.alias("value")).write.text(folder)
    return f"{folder}/*.txt"


def tuning_line_numbers(spark, sf):
    """Numbers of lines of a file that several tasks read."""
    rows = loaders.tuning_rows(spark, _lines(spark, sf, f"{scratch(spark)}/lines"))
    return rows.select(F.col("id").cast("long").alias("event_id"), "line_number", F.get("messages", F.lit(0))["content"].alias("content"))


LINES = """SELECT event_id, row_number() OVER (ORDER BY event_id) + coalesce(sum(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line_number,
 event_type AS content FROM events"""


def line_totals(spark, sf):
    found = readers.line_counts(spark, [_lines(spark, sf, f"{scratch(spark)}/lines")])
    return found.select("total_lines", "filled_lines")


LINE_TOTALS = "SELECT count(*) + count(*) FILTER (event_id % 7 = 0) AS total_lines, count(*) AS filled_lines FROM events"


def _judged(spark, sf, folder: str):
    """Judged rows in files by language, and one file that is not judged."""
    d = table(spark, sf, "documents")
    made = F.struct((F.col("doc_id") % 5 + 1).cast("string").alias("relevance_score"), F.lit("irrelevant").alias("relevance"))
    rows = d.select("doc_id", "lang", made.alias("_clean_verdict"))
    for name, part in (("en_judged_1", "lang = 'en'"), ("fr_judged", "lang = 'fr'"), ("x_judged", "lang is null or lang not in ('en', 'fr')"), ("other", "true")):
        rows.where(part).drop("lang").orderBy("doc_id").coalesce(1).write.json(f"{folder}/{name}-raw")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}-raw")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}-raw/*.json")):
            files.rename(status.getPath(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.jsonl"))
    return loaders.judged_rows(spark, folder, "doc_id long, _clean_verdict struct<relevance_score string, relevance string>")


def rejudged_rewrite(spark, sf):
    """Judged files are read, their necessity is judged again, and the output is replaced as a whole."""
    folder = scratch(spark)
    rows = _judged(spark, sf, f"{folder}/in")
    stays = verdict.rejudged(F.col("_clean_verdict.relevance_score"), F.col("_clean_verdict.relevance"), base.pick(["5", "x", "4"], F.col("doc_id")))
    output = filebatch.Versions(spark, f"{folder}/out")
    output.rewrite(rows.select("doc_id", "file", F.lit(False).alias("_clean_keep")), "file")
    output.rewrite(rows.select("doc_id", "file", stays.alias("_clean_keep")), "file")
    return output.read("doc_id long, _clean_keep boolean, file string").select("file", "doc_id", F.col("_clean_keep").alias("keep"))


REJUDGED = """SELECT CASE lang WHEN 'en' THEN 'en_judged_1.jsonl' WHEN 'fr' THEN 'fr_judged.jsonl' ELSE 'x_judged.jsonl' END AS file, doc_id, doc_id % 5 + 1 >= 4 AND doc_id % 3 <> 1 AS keep FROM documents"""


def batch_of_files(spark, sf):
    """All sources as files, in two runs, of which the second finds half of them done."""
    folder, names = scratch(spark), [f"src{i}" for i in range(20)]
    d = table(spark, sf, "documents").where(F.col("source").isNotNull())
    read = lambda files: d.where(F.col("source").isin(files)).select(F.col("source").alias("file"), "doc_id", "text")
    count = lambda rows: rows.groupBy("file").agg(F.count("*").alias("n"), F.max(F.length("text")).alias("longest"))
    filebatch.run_files(spark, names[:10], read, count, folder, 4)
    filebatch.run_files(spark, names, read, count, folder, 4)
    return spark.read.schema("n long, longest int, file string").parquet(f"{folder}/rows")


BATCH = "SELECT source AS file, count(*) AS n, max(length(text))::INT AS longest FROM documents GROUP BY source"


def endpoint_latency(spark, sf):
    """Whether medians and 99th percentiles of merged sketches have a rank within the stated error of the exact one."""
    e = table(spark, sf, "events").select("event_type", "event_id", F.col("value").alias("seconds"))
    halves = [latency.sketched(e.where(F.col("event_id") % 2 == k), "seconds", "event_type") for k in (0, 1)]
    found = latency.figures(latency.merged(halves[0].union(halves[1]), "event_type")).select("event_type", "calls", "p50", "p99")
    below = lambda c: F.count_if(F.col("seconds") < F.col(c)) / F.count("*")
    upto = lambda c: F.count_if(F.col("seconds") <= F.col(c)) / F.count("*")
    near = lambda c, q: (below(c) <= q + latency.RANK_ERROR) & (upto(c) >= q - latency.RANK_ERROR)
    ranks = e.join(F.broadcast(found), "event_type").groupBy("event_type", "calls").agg(near("p50", 0.5).alias("p50_near"), near("p99", 0.99).alias("p99_near"))
    return ranks


LATENCY = "SELECT event_type, count(*) AS calls, TRUE AS p50_near, TRUE AS p99_near FROM events GROUP BY event_type"


def _stub(endpoint: str, payload: str) -> tuple[int, str]:
    """Answers by the payload: every fifth number is not there for endpoint `a`, every eleventh never."""
    n = int(payload)
    if n % 11 == 0:
        return 404, "none"
    return (503, "busy") if endpoint == "a" and n % 5 == 0 else (200, f"{n * n}")


def limited_calls(spark, sf):
    """Calls to two endpoints of which one takes a request at a time and the other two, with retries at the other one."""
    o = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_custkey").cast("string").alias("payload"))
    answers = calls.called_in_lanes(o, ["a", "b"], [1, 2], _stub, calls.Retries(2, 0.0))
    return answers.select(F.col("id").cast("long").alias("id"), F.col("response").cast("long").alias("response"), F.coalesce("stage", F.lit("")).alias("stage"), "attempts")


LIMITED = f"""WITH r AS (SELECT c_custkey AS id, list_reduce(list_prepend(0::hugeint, [('0x' || substr(md5(c_custkey::VARCHAR), i * 8 + 1, 8))::hugeint for i in range(4)]), lambda a, c: (a * 4294967296 + c) % 2) AS first FROM customer)
SELECT id::BIGINT AS id, CASE WHEN id % 11 > 0 THEN (id * id)::BIGINT END AS response, CASE WHEN id % 11 = 0 THEN 'llm_request' ELSE '' END AS stage, CASE WHEN id % 11 > 0 AND id % 5 = 0 AND first = 0 THEN 2 ELSE 1 END AS attempts FROM r"""


def head_questions(spark, sf):
    """The first two questions that are not blank of each chat file."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("c"), F.col("conv_id") % 3).alias("name"), "role", "text")
    folder, found = scratch(spark), None
    for k in range(3):
        made = F.array(F.struct("role", F.when(F.col("conv_id") % 4 > 0, F.col("text")).otherwise("  ").alias("content"))).alias("messages")
        c.where(f"name = 'c{k}'").coalesce(1).sortWithinPartitions("conv_id", "turn").select(made).write.json(f"{folder}/c{k}")
        part = loaders.heads(spark, [f"{folder}/c{k}/*.json"], 2, True).select(F.lit(f"c{k}").alias("file"), "question")
        found = part if found is None else found.union(part)
    return found


HEADS = r"""SELECT 'c' || (conv_id % 3) AS file, trim(regexp_replace(text, '\s+', ' ', 'g')) AS question FROM conversations WHERE role = 'user' AND conv_id % 4 > 0 AND trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''
 QUALIFY row_number() OVER (PARTITION BY conv_id % 3 ORDER BY conv_id, turn) <= 2"""


def records_of_all_kinds(spark, sf):
    """The same records from JSON lines, Parquet and CSV, read by the ending of their files."""
    d, folder = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("vid"), F.col("s_name").alias("Q"), F.lit("yes").alias("A")), scratch(spark)
    d.write.json(f"{folder}/json")
    d.write.parquet(f"{folder}/parquet")
    d.write.option("header", True).csv(f"{folder}/csv")
    found = None
    for name, path in (("j", f"{folder}/json/*.json"), ("p", f"{folder}/parquet/*.parquet"), ("c", f"{folder}/csv/*.csv")):
        spec = readers.SourceSpec(name, [path], ids=["vid"], questions=["Q"], answers=["A"], schema="vid string, Q string, A string" if name == "j" else None)
        if name == "j":  # lines, not one document
            rows = loaders.json_lines(spark, [path], "vid string, Q string, A string").select(F.lit(name).alias("source_name"), F.col("vid").alias("source_record_id"), F.col("Q").alias("question"))
        else:
            rows = readers.examples(spark, spec).select("source_name", "source_record_id", "question")
        found = rows if found is None else found.union(rows)
    return found


KINDS = "SELECT n AS source_name, s_suppkey::VARCHAR AS source_record_id, s_name AS question FROM supplier, (VALUES ('j'), ('p'), ('c')) v(n)"


def examples_of_sources(spark, sf):
    """Two sources with limits of their own, of which the second brings what the first has not taken."""
    spec = lambda name, limit: readers.SourceSpec(name, [f"{sf}/documents.parquet"], ids=["doc_id"], questions=["text"], answers=["lang"], metadata=["source"], limit=limit)
    found = loaders.sourced(spark, [spec("videocapqa", 300), spec("longcapqa", 0)], "candidate")
    return found.select("source_name", F.col("source_record_id").cast("long").alias("doc_id"), "profile.source_family", "profile.duration_bucket", "profile.role", F.element_at("metadata", "source").alias("source"))


_TEXT_KEY = r"lower(regexp_replace(trim('Question: ' || trim(text, E' \t\n\r\f\x0b') || CASE WHEN coalesce(lang, '') <> '' THEN E'\nAnswer: ' || lang ELSE '' END), '\s+', ' ', 'g'))"
SOURCED = f"""WITH d AS (SELECT doc_id, doc_id::VARCHAR AS id, source, {_TEXT_KEY} AS k FROM documents), o AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY k ORDER BY id) = 1),
a AS (SELECT * FROM o ORDER BY id LIMIT 300), b AS (SELECT * FROM d WHERE k NOT IN (SELECT k FROM a) QUALIFY row_number() OVER (PARTITION BY k ORDER BY id) = 1)
SELECT 'videocapqa' AS source_name, doc_id, 'capqa' AS source_family, 'unknown' AS duration_bucket, 'candidate' AS role, source FROM a UNION ALL SELECT 'longcapqa', doc_id, 'longcapqa', 'long', 'candidate', source FROM b"""


def truthy_split(spark, sf):
    """Rows split by a column that is no boolean: 0, null and the empty text drop a row."""
    folder = scratch(spark)
    rows = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 3).alias("_clean_keep"), F.lit("v").alias("_clean_verdict"))
    counts = sinks.split_clean_dirty(written(rows, "judged"), f"{folder}/clean", f"{folder}/dirty")
    clean = spark.read.schema("event_id long, _clean_keep string").json(f"{folder}/clean")
    return clean.select("event_id", F.coalesce("_clean_keep", F.lit("-")).alias("left"), F.lit(counts[0]).cast("long").alias("n_clean"), F.lit(counts[1]).cast("long").alias("n_dirty"))


TRUTHY = """WITH k AS (SELECT event_id, event_id % 4 > 0 AND event_id % 3 > 0 AS keep FROM events)
SELECT event_id, '-' AS left, (SELECT count(*) FROM k WHERE keep) AS n_clean, (SELECT count(*) FROM k WHERE NOT keep) AS n_dirty FROM k WHERE keep"""


def task_run(spark, sf):
    """A task in two runs: the second leaves out what the first has done; rows without a payload are errors, some answers are local."""
    folder = scratch(spark)
    o = table(spark, sf, "customer")
    for part in (F.col("c_custkey") % 2 == 0, F.lit(True)):
        load = lambda s, part=part: o.where(part).select(F.col("c_custkey").cast("string").alias("id"), "c_custkey")
        requests = lambda items: items.select("id", F.when(F.col("c_custkey") % 13 > 0, F.col("id")).alias("payload"), F.when(F.col("c_custkey") % 17 == 0, "0").alias("local"))
        what = tasks.Task("squares", load, requests, lambda rows: rows.select("id", F.col("response").cast("long").alias("square")))
        tasks.run(spark, what, f"{folder}/out", f"{folder}/errors", ["a", "b"], _stub, calls.Retries(2, 0.0))
    return spark.read.schema("id string, square long").json(f"{folder}/out").select(F.col("id").cast("long").alias("id"), "square")


TASK = """SELECT c_custkey::BIGINT AS id, CASE WHEN c_custkey % 17 = 0 THEN 0 ELSE c_custkey * c_custkey END::BIGINT AS square FROM customer
 WHERE c_custkey % 17 = 0 OR c_custkey % 13 > 0 AND c_custkey % 11 > 0"""

_ALL = {
    "tuning_line_numbers": (tuning_line_numbers, LINES),
    "line_totals": (line_totals, LINE_TOTALS),
    "rejudged_rewrite": (rejudged_rewrite, REJUDGED),
    "batch_of_files": (batch_of_files, BATCH),
    "endpoint_latency": (endpoint_latency, LATENCY),
    "limited_calls": (limited_calls, LIMITED),
    "head_questions": (head_questions, HEADS),
    "records_of_all_kinds": (records_of_all_kinds, KINDS),
    "truthy_split": (truthy_split, TRUTHY),
    "examples_of_sources": (examples_of_sources, SOURCED),
    "task_run": (task_run, TASK),
}
QUERIES = {k: q for k, (q, _) in _ALL.items()}
ORACLE = {k: s for k, (_, s) in _ALL.items()}
