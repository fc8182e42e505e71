"""Runs over records that are first written from the driver's tables: sources of several layouts, resumed outputs, reports, sinks, streams and calls.
What a run writes is read back, so that the contents of its files are compared."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .. import config
from ..functions import messages, verdict
from ..operators import calls, files, resume, runs, selection
from ..sources import loaders, readers, sinks
from ..sources.scratch import written
from ..streaming import committed, incremental
from . import chat_queries as chat
from .base import pick, scratch, sql_pick, table

_STRIP = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"


def _whole(spark, folder: str, text: str) -> str:
    """A small text that is written to the shared folder and read from there, as a file of rules would be."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    return spark.read.text(folder, wholetext=True).first().value


# -- sources -----------------------------------------------------------------------------------------------------------------------------


def known_source_examples(spark, sf):
    """Seven known layouts as Parquet, each with the documents of one remainder and a column that no example needs."""
    root, d, n = scratch(spark), table(spark, sf, "documents"), F.col("doc_id")
    specs = loaders.known_sources(root)
    for k, spec in enumerate(specs):
        values = dict.fromkeys(spec.questions, F.col("text")) | dict.fromkeys(spec.answers, F.col("lang"))
        values |= {c: F.col("source") if i == 0 else F.lit("later") for i, c in enumerate(spec.contexts)}
        values |= {m: F.concat(F.lit("m"), n % 5) for m in spec.metadata if m not in values and m != "video_id"}
        made = [v.alias(c) for c, v in values.items()]
        if spec.explode:
            inner = F.transform(F.sequence(F.lit(1), n % 3), lambda i: F.struct(*made, i.alias("part")))
            made = [F.when(n % 3 > 0, inner).alias(spec.explode)]
        rows = d.where(n % 7 == k).select(F.concat(F.lit("v"), n).alias("video_id"), *made, F.lit("unused").alias("frames"))
        rows.write.parquet(spec.paths[0].replace("*", "part-0"))
    found = loaders.sourced(spark, specs, "candidate", include_context=True, once=False, overrides={"molmo2_videopoint": {"skill_bucket": F.lit("pointing")}})
    over = F.when(F.col("source_name") == "molmo2_videopoint", F.col("profile.skill_bucket"))
    return found.select("source_name", "source_record_id", "question", "answer", "context", F.md5("similarity_text").alias("text_mark"), F.element_at("metadata", "video_id").alias("video_id"), over.alias("skill"))


# Of the layouts one has no context, one a caption and no question, and one lists of questions.
KNOWN = f"""WITH d AS (SELECT doc_id, doc_id % 7 AS k, 'v' || doc_id AS v, text, lang, source FROM documents),
r AS (SELECT k, v, v AS record, CASE WHEN k <> 3 THEN text END AS question, lang AS answer, CASE WHEN k <> 0 THEN source END AS context FROM d WHERE k <> 2
 UNION ALL SELECT k, v, v || '#e' || i, text, lang, source FROM (SELECT *, unnest(range(0, doc_id % 3)) AS i FROM d WHERE k = 2))
SELECT ['molmo2_askmodelanything', 'molmo2_videocapqa', 'molmo2_longcapqa', 'molmo2_cap', 'molmo2_videosubtitleqa', 'molmo2_videocounteval', 'molmo2_videopoint'][k + 1] AS source_name, record AS source_record_id,
 question, answer, context, md5(concat_ws(E'\\n', 'Question: ' || {_STRIP.format('question')}, 'Answer: ' || answer, 'Context: ' || context)) AS text_mark, v AS video_id,
 CASE WHEN k = 6 THEN 'pointing' END AS skill FROM r"""


def json_documents(spark, sf):
    """Documents of JSON with a list in a field: dotted fields, lists as text, records with and without an id and with lists of their own."""
    d, folder, n = table(spark, sf, "documents"), scratch(spark), F.col("doc_id")
    parts = F.when(n % 3 > 0, F.transform(F.sequence(F.lit(1), n % 3), lambda i: F.struct(F.when(i == 1, F.concat(F.lit("q"), n)).alias("q"))))
    record = F.struct(
        F.when(n % 4 > 0, n.cast("string")).alias("id"), n.alias("number"), F.struct(F.col("text").alias("title")).alias("ask"), F.array("lang", "source").alias("labels"),
        F.struct(F.array(F.struct(F.col("source").alias("of"), (n % 2 == 0).alias("even"))).alias("deep"), F.col("lang").alias("name")).alias("kind"), F.struct(F.lit("x").alias("y"), F.concat(F.lit(" t"), n).alias("text")).alias("told"), parts.alias("parts"),
    )
    # a document holds a bounded number of records
    d.groupBy(F.floor(n / 200).alias("block")).agg(F.collect_list(record).alias("data")).write.partitionBy("block").json(folder)
    schema = "data array<struct<id string, number long, ask struct<title string>, labels array<string>, kind struct<deep array<struct<of string, even boolean>>, name string>, told struct<y string, text string>, parts array<struct<q string>>>>"
    spec = readers.SourceSpec("docs", [f"{folder}/block=*/*.json"], questions=["q", "ask.title"], answers=["labels"], metadata=["kind", "number", "told"], explode="parts", record_field="data", schema=schema)
    rows = readers.examples(spark, spec, values=True)
    known = F.regexp_replace("source_record_id", "^row_[0-9a-f]{10}", "row_")
    return rows.select(F.element_at("metadata", "number").cast("long").alias("doc_id"), known.alias("record"), "question", "answer", F.element_at("metadata", "told").alias("told"), F.element_at("metadata_values", "kind").alias("kind"))


JSON_DOCUMENTS = """WITH e AS (SELECT *, unnest(CASE WHEN doc_id % 3 > 0 THEN range(0, doc_id % 3) ELSE [-1] END) AS i FROM documents)
SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN doc_id::VARCHAR ELSE 'row_' END || CASE WHEN i >= 0 THEN '#e' || i ELSE '' END AS record, CASE WHEN i = 0 THEN 'q' || doc_id ELSE text END AS question,
 concat_ws(' | ', lang, source) AS answer, 't' || doc_id AS told, concat_ws(' | ', source, CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END, lang) AS kind FROM e"""


def sources_limited(spark, sf):
    """Three sources in turn, each with a limit, and a limit of all."""
    d = table(spark, sf, "documents").withColumn("key", F.concat_ws(":", "lang", F.col("doc_id") % 50))
    parts = [d.where(F.col("doc_id") % 3 == k).select("doc_id", "key", F.lit(k).alias("turn")) for k in range(3)]
    return selection.sources_in_turn(parts, F.col("key"), 40, 100, "doc_id")


_TURN = "SELECT * FROM (SELECT * FROM d WHERE turn = {k}{more} QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1) ORDER BY doc_id LIMIT 40"
LIMITED_SOURCES = f"""WITH d AS (SELECT doc_id, concat_ws(':', lang, doc_id % 50) AS key, (doc_id % 3)::INT AS turn FROM documents), a AS ({_TURN.format(k=0, more='')}),
b AS ({_TURN.format(k=1, more=' AND key NOT IN (SELECT key FROM a)')}), c AS ({_TURN.format(k=2, more=' AND key NOT IN (SELECT key FROM a UNION ALL SELECT key FROM b)')})
SELECT doc_id, key, turn FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) ORDER BY turn, doc_id LIMIT 100"""


def first_items(spark, sf):
    """The first items of a file of records, in its order; a record has two."""
    d, n, folder = table(spark, sf, "documents"), F.col("doc_id"), scratch(spark)
    pair = lambda i: F.struct(F.concat(F.lit(i), n).alias("question"), F.col("lang").alias("answer"))
    rows = d.repartitionByRange(1, "doc_id").sortWithinPartitions("doc_id").select(n.cast("string").alias("id"), F.array(pair("a"), pair("b")).alias("qas"))
    rows.write.json(folder)
    return loaders.qa_items(spark, [f"{folder}/*.json"], most=301).select("id", "qa_index", "question", "answer")


FIRST_ITEMS = """SELECT doc_id || '#qa' || i AS id, i::INT AS qa_index, CASE i WHEN 0 THEN 'a' ELSE 'b' END || doc_id AS question, lang AS answer
 FROM (SELECT *, unnest([0, 1]) AS i FROM documents) ORDER BY doc_id, i LIMIT 301"""

# -- lists of files ------------------------------------------------------------------------------------------------------------------------


def files_to_clean(spark, sf):
    """Files of a folder that wait to be cleaned, with their sizes; a source is a file, some of which are outputs of earlier runs."""
    d, folder = table(spark, sf, "documents").where("source is not null"), scratch(spark)
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    name = F.concat(pick(["", "other_", "", ""], number), "source", pick(["", "", "_clean", "_dirty", ""], number), F.lit(".jsonl"))
    d.select(name.alias("file"), F.col("doc_id").cast("string").alias("value")).repartition("file").write.partitionBy("file").text(f"{folder}/raw")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    place = path(f"{folder}/raw/file=*/*.txt")
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(f"{folder}/files"))
    for status in system.globStatus(place):
        system.rename(status.getPath(), path(f"{folder}/files/{status.getPath().getParent().getName()[5:]}"))
    return loaders.to_clean(loaders.listed(spark, f"{folder}/files"))


_NUMBER = r"regexp_extract(source, '(\d+)', 1)::INT"
TO_CLEAN = f"""SELECT source || '.jsonl' AS file, sum(length(doc_id::VARCHAR) + 1)::BIGINT AS bytes FROM documents
 WHERE source IS NOT NULL AND {_NUMBER} % 4 <> 1 AND {_NUMBER} % 5 NOT IN (2, 3) GROUP BY source"""


def rules_manifest(spark, sf):
    """Domains by a file of rules, written as a manifest and read from it."""
    folder = scratch(spark)
    text = json.dumps({"exact": chat._EXACT | {"src1.jsonl": "art"}, "hints": chat._CONTENT, "prefixes": chat._PREFIXES})
    rules = loaders.rules(_whole(spark, f"{folder}/rules", text))
    d = table(spark, sf, "documents").select("doc_id", F.concat("source", F.lit(".jsonl")).alias("file"), "text")
    heads = files.head(d, 5, "file", "doc_id").groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda x: x["text"]), " ").alias("content"))
    domains = files.file_domains(F.col("file"), F.col("content"), rules["exact"], rules["hints"], rules["prefixes"])
    sinks.write_manifest(heads.select("file", domains.alias("domains")), f"{folder}/manifest")
    return spark.read.schema("file string, domains string").option("header", True).csv(f"{folder}/manifest")


RULES_MANIFEST = f"{chat._MANIFEST} SELECT file, array_to_string(list_sort(domains), ';') AS domains FROM d"


def score_file(spark, sf):
    """Scores of files with a bank of keywords from a file, written with six decimals and read as text."""
    folder = scratch(spark)
    text = json.dumps({"subjects": ["Music", "art", "ART "], "subfields": ["mechanics"], "visual_cues": ["map", "table"], "question_cues": ["Most_likely", "determine"], "negative_cues": ["the"]})
    bank = files.keyword_bank(_whole(spark, f"{folder}/bank", text))
    scores = files.file_scores(files.file_ratios(chat._questions(spark, sf)[0], "file", "question", bank))
    kept = scores.select("file", "sample_n", *[F.round(c, 9).alias(c) for c in ("topic_ratio", "mcq_ratio", "avg_q_len", "score_math", "score_mmmu", "combined_score")])
    sinks.write_scores(kept, f"{folder}/scores")
    return spark.read.option("header", True).schema(", ".join(f"{c} string" for c in kept.columns)).csv(f"{folder}/scores")


_SIX = ", ".join(f"format('{{:.6f}}', round({c}, 9)) AS {c}" for c in ("topic_ratio", "mcq_ratio", "avg_q_len", "score_math", "score_mmmu", "combined_score"))
SCORE_FILE = f"{chat._sql_signals()} SELECT file, sample_n::VARCHAR AS sample_n, {_SIX} FROM scores"

# -- outputs -------------------------------------------------------------------------------------------------------------------------------


def resumed_output(spark, sf):
    """An output with broken lines, blank ones and rows without an id is resumed and appended to; its ids and what was counted in it."""
    e, n, folder = table(spark, sf, "events"), F.col("event_id"), scratch(spark)
    line = F.when(n % 10 == 0, F.concat(F.lit('{"id": "'), n, F.lit('", '))).when(n % 10 == 1, '{"x": 1, "_clean_keep": false}').when(n % 10 == 2, " ")
    line = line.otherwise(F.concat(F.lit('{"id": "'), n, F.lit('", "_clean_keep": '), pick(["true", "false", "null"], n), F.lit("}")))
    output = f"{folder}/out"
    e.where(n % 2 == 0).select(line.alias("value")).union(e.where(n % 10 == 1).select(line.alias("value"))).write.text(output)
    dirty, done = readers.dirty_count(spark, output), written(resume.processed_ids(spark, output), "done")
    counts = readers.line_counts(spark, [output]).agg(F.sum("total_lines").alias("lines"), F.sum("filled_lines").alias("filled"))
    counts = counts.first().asDict()
    items = e.select(n.cast("string").alias("id"), "event_type")
    sinks.append_results(items.union(items.select("id", F.lit("zz"))), output, done)
    rows = spark.read.schema("id string, event_type string").json(output).where("id is not null")
    return rows.select(F.col("id").cast("long").alias("event_id"), F.coalesce("event_type", F.lit("old")).alias("event_type"), F.lit(dirty).cast("long").alias("dirty"), *[F.lit(x).cast("long").alias(k) for k, x in counts.items()])


RESUMED = """WITH o AS (SELECT event_id, event_id % 2 = 0 AND event_id % 10 NOT IN (0, 2) AS old FROM events)
SELECT event_id, CASE WHEN old THEN 'old' ELSE event_type END AS event_type, (SELECT count(*) FROM events WHERE event_id % 10 = 1 OR event_id % 2 = 0 AND event_id % 10 NOT IN (0, 2) AND event_id % 3 = 1) AS dirty,
 (SELECT count(*) FROM events WHERE event_id % 2 = 0 OR event_id % 10 = 1) AS lines, (SELECT count(*) FROM events WHERE event_id % 2 = 0 AND event_id % 10 <> 2 OR event_id % 10 = 1) AS filled FROM events JOIN o USING (event_id)"""


def selector_files(spark, sf):
    """Rows selected for buckets, and the merged best ones, as they are in their files."""
    d, n, folder = table(spark, sf, "documents"), F.col("doc_id"), scratch(spark)
    bucket = F.explode(F.array(pick(["x", "y", "z"], n), pick(["z", "z", "w"], n)))
    rows = d.select(n.cast("string").alias("id"), bucket.alias("bucket_key"), F.col("lang").alias("source_family"))
    rows = rows.withColumn("selection_score", (F.pmod(F.col("id").cast("long") * 37 + F.ascii("bucket_key"), F.lit(101)) / 128).cast("double")).distinct()
    selected = written(rows, "selected")
    runs.selector_outputs(selected, selected.groupBy("bucket_key").agg(F.count("*").cast("double").alias("priority_score")), folder, 200)
    fields = "id string, source_family string, selection_score double, bucket_key string"
    read = lambda part: spark.read.schema(fields).json(f"{folder}/{part}").select(F.lit(part).alias("part"), "bucket_key", "id", "source_family", "selection_score")
    return read("buckets").union(read("merged"))


SELECTOR = f"""WITH b AS (SELECT DISTINCT doc_id, unnest([{sql_pick(['x', 'y', 'z'], 'doc_id')}, {sql_pick(['z', 'z', 'w'], 'doc_id')}]) AS bucket_key, lang FROM documents),
s AS (SELECT doc_id::VARCHAR AS id, bucket_key, lang AS source_family, ((doc_id * 37 + ascii(bucket_key)) % 101) / 128.0::DOUBLE AS selection_score FROM b),
m AS (SELECT * FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY selection_score DESC, bucket_key) = 1) ORDER BY selection_score DESC, id LIMIT 200)
SELECT 'buckets' AS part, bucket_key, id, source_family, selection_score FROM s UNION ALL SELECT 'merged', bucket_key, id, source_family, selection_score FROM m"""


def tuning_files(spark, sf):
    """Tags and kept rows of fine-tuning files and their counts, as they are in their files."""
    asked = F.transform(messages.questions(F.col("messages")), lambda x, i: F.concat(pick(chat._HINTS, F.col("conv_id") * 3 + i), x))
    tags = runs.tuning_tags(pick(chat._PATHS, F.col("conv_id")), asked, pick(chat._FILES, F.col("conv_id")))
    folder = scratch(spark)
    runs.tuning_outputs(written(chat._chats(spark, sf).select(F.col("conv_id").cast("string").alias("id"), tags.alias("tags")), "tagged"), folder)
    none = F.lit(None).cast("string")
    tagged = spark.read.schema("id string, tags struct<keep_reason string, drop_reason string>, file string").json(f"{folder}/tags")
    tagged = tagged.select(F.lit("tags").alias("part"), "file", "id", F.col("tags.keep_reason").alias("a"), F.col("tags.drop_reason").alias("b"), F.lit(1).cast("long").alias("n"))
    kept = spark.read.schema("id string, file string").json(f"{folder}/filtered").select(F.lit("filtered"), "file", "id", none, none, F.lit(1).cast("long"))
    counts = spark.read.schema("file string, dimension string, value string, n long").json(f"{folder}/summary").select(F.lit("summary"), "file", none, "dimension", "value", "n")
    return tagged.union(kept).union(counts)


TUNING = f"""{chat._SFT}, x AS ({chat._DIMENSIONS}), w AS (SELECT file, dimension, value FROM x WHERE value <> '' UNION ALL SELECT NULL, dimension, value FROM x WHERE value <> '')
SELECT 'tags' AS part, {sql_pick(chat._FILES, 'conv_id')} AS file, conv_id::VARCHAR AS id, keep_reason AS a, drop_reason AS b, 1::BIGINT AS n FROM kept
UNION ALL SELECT 'filtered', {sql_pick(chat._FILES, 'conv_id')}, conv_id::VARCHAR, NULL, NULL, 1 FROM kept WHERE keep
UNION ALL SELECT 'summary', file, NULL, dimension, value, count(*) FROM w GROUP BY file, dimension, value"""

# -- streams -------------------------------------------------------------------------------------------------------------------------------


def _arrivals(df, folder: str, parts) -> None:
    """Files that arrive one after the other."""
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(folder)


def stopped_stream(spark, sf):
    """Files in turn until so many dirty rows were written, and on from there with a larger number."""
    e, folder = table(spark, sf, "events").select("event_id", (F.col("value") < 20).alias("dirty")), scratch(spark)
    _arrivals(e, f"{folder}/in", [F.col("event_id") % 4 == k for k in range(4)])
    total = e.where("dirty").count()
    source = lambda: incremental.stream_of(spark, f"{folder}/in", "event_id long, dirty boolean", files=1)
    first = incremental.run_until_dirty(source(), f"{folder}/out", f"{folder}/check", "dirty", total // 8 + 1)
    incremental.run_until_dirty(source(), f"{folder}/out", f"{folder}/check", "dirty", total // 2 + 1)
    rows = spark.read.schema("event_id long, dirty boolean").parquet(f"{folder}/out")
    return rows.select("event_id", "dirty", F.lit(first).cast("long").alias("dirty_at_first"))


STOPPED = """WITH e AS (SELECT event_id, event_id % 4 AS k, coalesce(value < 20, FALSE) AS dirty FROM events), b AS (SELECT k, count(*) FILTER (dirty) AS n FROM e GROUP BY k),
r AS (SELECT k, n, sum(n) OVER (ORDER BY k) AS upto, sum(n) OVER () AS total FROM b)
SELECT event_id, value < 20 AS dirty, (SELECT sum(n)::BIGINT FROM r WHERE upto - n < total // 8 + 1) AS dirty_at_first FROM events WHERE event_id % 4 IN (SELECT k FROM r WHERE upto - n < total // 2 + 1)"""


def stream_reports(spark, sf):
    """What each batch of a run has read and written; later files bring ids again that were there before."""
    e, folder, seen = table(spark, sf, "events").select(F.col("event_id").alias("id")), scratch(spark), []
    _arrivals(e, f"{folder}/in", [(F.col("id") % 3 == k) | (F.col("id") % 6 == 0) for k in range(3)])
    incremental.run_available(incremental.stream_of(spark, f"{folder}/in", "id long", files=1), f"{folder}/out", f"{folder}/check", progress=seen.append)
    return spark.createDataFrame([(p["batch"], p["rows"], p["written"]) for p in seen], "batch long, n_read long, n_written long")


REPORTS = """SELECT k::BIGINT AS batch, count(*) FILTER (event_id % 3 = k OR event_id % 6 = 0) AS n_read, count(*) FILTER (event_id % 3 = k) AS n_written FROM events, range(3) r(k) GROUP BY k"""


def flushed_sink(spark, sf):
    """Rows that arrive in three parts go to a sink of results and errors, whenever a thousandth of a part waits and at the end; a batch that is repeated adds nothing."""
    c, folder = table(spark, sf, "customer").select("c_custkey", "c_acctbal"), scratch(spark)
    sink, parts = committed.Sink(spark, f"{folder}/sink"), [F.col("c_custkey") % 3 == k for k in range(3)]
    there = [0]

    def going() -> bool:
        if not parts:
            return False
        part = parts.pop()
        _arrivals(c, f"{folder}/in", [part])
        there[0] += c.where(part).count()
        return True

    source = lambda: incremental.stream_of(spark, f"{folder}/in", c.schema)
    flush = committed.Flush(max(1, c.count() // 3000), 3600.0)
    read = committed.run_flushed(source, lambda had: there[0] - had, sink, f"{folder}/check", lambda df: df, F.col("c_acctbal") < 0, flush, going, 0.0)
    sink.commit(c, min(sink.commits()), F.lit(False))
    errors = sum(x["errors"] for x in sink.commits().values())
    part = lambda name: sink.read(name, c.schema).select(F.lit(name).alias("part"), "c_custkey")
    return part("results").union(part("errors")).select("*", F.lit(read).cast("long").alias("n_read"), F.lit(errors).cast("long").alias("n_errors"))


FLUSHED = """SELECT CASE WHEN coalesce(c_acctbal < 0, FALSE) THEN 'errors' ELSE 'results' END AS part, c_custkey, (SELECT count(*) FROM customer) AS n_read, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS n_errors FROM customer"""

# -- calls ---------------------------------------------------------------------------------------------------------------------------------


def _judge(endpoint: str, payload: str) -> tuple[int, str]:
    """Numbers are judged; some requests are too long, some are answered elsewhere, never, or with what is no number."""
    if payload.startswith("long:"):
        return 400, "prompt too long"
    if payload.startswith("more:"):
        return (200, payload[5:]) if int(payload[5:]) % 4 == 0 else (500, "")
    n = int(payload)
    if n % 13 == 0:
        return 404, "none"
    if n % 5 == 0 and endpoint == "a":
        return 503, "busy"
    return 200, "odd" if n % 11 == 0 else str(n % 5 + 1)


def judged_by_calls(spark, sf):
    """Records judged by calls: without a question there is an answer at once, long requests are shortened, a second request may follow, and errors keep their stage."""
    d, n = table(spark, sf, "documents"), F.col("doc_id")
    number = n.cast("string")
    requests = d.select(number.alias("id"), F.when(n % 17 > 0, F.when(n % 9 == 0, F.concat(F.lit("long:"), number)).otherwise(number)).alias("payload"), F.when(n % 7 == 0, "0").alias("local"), F.when(n % 2 == 0, F.concat(F.lit("more:"), number)).alias("second"))
    answers = calls.called(requests, ["a", "b"], _judge, calls.Retries(2, 0.0), pool=calls.Pool(4, limits=(2, 1)), shorten=lambda payload, k: payload[5:], parse=lambda body: str(int(body)))
    answers = written(answers, "answers").select(F.col("id").cast("long").alias("doc_id"), "response", "second", "stage", "attempts")
    rows = d.select("doc_id", F.struct("doc_id", "lang", "source").alias("record")).join(answers, "doc_id")
    score = F.col("response").cast("double")
    return rows.select(*verdict.judged("record", score, F.coalesce(score >= 4, F.lit(False))), "second", "stage", "attempts").withColumnsRenamed({"_clean_verdict": "score", "_clean_keep": "keep"})


JUDGED = """WITH r AS (SELECT doc_id AS n, lang, source, doc_id % 7 = 0 AS local, doc_id % 17 = 0 AS invalid, doc_id % 13 = 0 AS gone, doc_id % 11 = 0 AS odd, ('0x' || right(md5(doc_id::VARCHAR), 1))::INT % 2 = 0 AS first FROM documents),
a AS (SELECT *, CASE WHEN local THEN NULL WHEN invalid THEN 'validate' WHEN gone THEN 'llm_request' WHEN odd THEN 'parse_response' END AS stage FROM r)
SELECT n AS doc_id, lang, source, CASE WHEN local THEN 0 WHEN stage IS NULL THEN n % 5 + 1 END::DOUBLE AS score, NOT local AND stage IS NULL AND n % 5 + 1 >= 4 AS keep, CASE WHEN NOT local AND stage IS NULL AND n % 4 = 0 THEN n::VARCHAR END AS second,
 stage, CASE WHEN local OR invalid THEN 0 WHEN n % 5 = 0 AND first AND NOT gone THEN 2 ELSE 1 END AS attempts FROM a"""


def rejudged_verdicts(spark, sf):
    """Verdicts of judged records with a new necessity, the rest as it was; some records have no question, some replies no score."""
    d, n = table(spark, sf, "documents"), F.col("doc_id")
    fields = ["relevance_score", "relevance", "necessity_score", "necessity", "reason", "reason_necessity"]
    old = F.struct(pick(["5", "3", "x"], n), pick(["Relevant", "irrelevant"], n), F.lit(2.0), F.lit("unnecessary"), F.col("lang"), F.when(n % 3 == 0, F.lit("old")))
    old = F.when(n % 19 > 0, old.cast("struct<relevance_score string, relevance string, necessity_score double, necessity string, reason string, reason_necessity string>"))
    said = F.to_json(F.struct(F.when(n % 4 > 0, n % 5 + 1.25).alias("necessity_score"), F.when(n % 2 == 0, F.col("source")).alias("reason")))
    reply = F.to_json(F.struct(F.array(F.struct(F.struct(said.alias("content")).alias("message"))).alias("choices")))
    rows = d.select("doc_id", old.alias("old"), verdict.single_score(reply, "necessity_score").alias("new"))
    made = rows.select("doc_id", verdict.rejudged_verdict(F.col("old"), fields, F.col("new"), F.col("doc_id") % 7 > 0).alias("v"))
    return made.select("doc_id", "v.verdict.*", "v.keep")


REJUDGED_VERDICTS = f"""WITH r AS (SELECT doc_id AS n, doc_id % 19 > 0 AS had, doc_id % 7 > 0 AS asked, CASE WHEN doc_id % 4 > 0 THEN least(doc_id % 5 + 1.25, 5) ELSE 1 END::DOUBLE AS s, lang, source FROM documents)
SELECT n AS doc_id, CASE WHEN had THEN {sql_pick(['5', '3', 'x'], 'n')} END AS relevance_score, CASE WHEN had THEN {sql_pick(['Relevant', 'irrelevant'], 'n')} END AS relevance,
 CASE WHEN asked THEN CASE WHEN s = floor(s) THEN s ELSE floor(s) + 0.2::DOUBLE END END AS necessity_score, CASE WHEN NOT asked THEN 'unknown' WHEN s >= 4 THEN 'necessary' ELSE 'unnecessary' END AS necessity,
 CASE WHEN had THEN lang END AS reason, CASE WHEN had AND n % 3 = 0 THEN 'old' WHEN asked AND n % 2 = 0 THEN nullif(source, '') END AS reason_necessity,
 coalesce(asked AND had AND (n % 3 = 0 OR n % 3 = 2 AND n % 2 = 0) AND s >= 4, FALSE) AS keep FROM r"""


def _echo(endpoint: str, payload: str) -> tuple[int, str]:
    return 200, endpoint


_GROUPS = {"groups": {"pair": {"endpoints": [
    {"name": "one", "url": "http://one.example/", "provider": "azure_openai", "auth_type": "api_key", "api_key": "k", "deployment": "d"},
    {"name": "two", "url": "http://two.example/v1/chat/completions", "model": "m"},
]}}}


def endpoint_requests(spark, sf):
    """Where requests go: endpoints come from settings that name those of a group, and each has the URL of its provider."""
    folder = scratch(spark)
    group = config.group(_whole(spark, f"{folder}/endpoints", json.dumps(_GROUPS)), "pair")
    given = {"SIEVEWORK_ENDPOINTS": json.dumps([vars(x) for x in group]), "SIEVEWORK_RETRIES": "1", "SIEVEWORK_BACKOFF": "0.0", "SIEVEWORK_RESUME": "no"}
    settings = config.Settings.read(None, given)
    made = [x.prepared({"n": 1}) for x in settings.resolved()]
    o = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    answers = calls.called(o.withColumn("payload", F.lit("p")).withColumn("local", F.lit(None).cast("string")), [url for url, _, _ in made], _echo, calls.Retries(settings.retries, settings.backoff), pool=calls.Pool(2, settings.route_strategy))
    names = F.create_map(*[F.lit(x) for url, payload, headers in made for x in (url, ",".join([*payload, *headers]))])
    return answers.select(F.col("id").cast("long").alias("id"), F.col("response").alias("url"), F.element_at(names, F.col("response")).alias("fields"))


REQUESTS = f"""SELECT c_custkey AS id, CASE WHEN first THEN 'http://one.example/openai/deployments/d/chat/completions?api-version={config.API_VERSION}' ELSE 'http://two.example/v1/chat/completions' END AS url,
 CASE WHEN first THEN 'n,api-key' ELSE 'model,n' END AS fields FROM (SELECT c_custkey, ('0x' || right(md5(c_custkey::VARCHAR), 1))::INT % 2 = 0 AS first FROM customer)"""

_ALL = {
    "known_source_examples": (known_source_examples, KNOWN),
    "json_documents": (json_documents, JSON_DOCUMENTS),
    "sources_limited": (sources_limited, LIMITED_SOURCES),
    "first_items": (first_items, FIRST_ITEMS),
    "files_to_clean": (files_to_clean, TO_CLEAN),
    "rules_manifest": (rules_manifest, RULES_MANIFEST),
    "score_file": (score_file, SCORE_FILE),
    "resumed_output": (resumed_output, RESUMED),
    "selector_files": (selector_files, SELECTOR),
    "tuning_files": (tuning_files, TUNING),
    "stopped_stream": (stopped_stream, STOPPED),
    "stream_reports": (stream_reports, REPORTS),
    "flushed_sink": (flushed_sink, FLUSHED),
    "judged_by_calls": (judged_by_calls, JUDGED),
    "rejudged_verdicts": (rejudged_verdicts, REJUDGED_VERDICTS),
    "endpoint_requests": (endpoint_requests, REQUESTS),
}
QUERIES = {k: q for k, (q, _) in _ALL.items()}
ORACLE = {k: s for k, (_, s) in _ALL.items()}
