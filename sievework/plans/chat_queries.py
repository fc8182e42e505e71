"""Conversations, verdicts, fine-tuning rows, files, resuming, routing and captions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import caption, messages, verdict
from ..functions import tables as T
from ..functions.text import md5_modulo, normalized
from ..operators import calls, files, resume, sft, stats
from ..operators.selection import first_of, until_dirty
from . import base
from .base import pick, sql_any, sql_in, sql_list, sql_pick, table

# -- messages --------------------------------------------------------------------------------------------------------------------------


def _chats(spark, sf):
    """One row of each conversation with its messages in order."""
    c = table(spark, sf, "conversations")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return c.groupBy("conv_id").agg(turns.alias("messages"))


def first_user_question(spark, sf):
    m = F.col("messages")
    return _chats(spark, sf).select("conv_id", messages.question(m).alias("question"), messages.strict_question(m).alias("strict_question"), F.size(messages.questions(m)).alias("questions"))


_STRIP = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"
_M = f"""WITH m AS (SELECT conv_id, turn, role, {_STRIP.format('text')} AS content, {_STRIP.format("replace(text, '<image>', '')")} AS bare FROM conversations)"""
FIRST_USER = f"""{_M} SELECT conv_id, coalesce(min_by(bare, turn) FILTER (role = 'user' AND bare <> ''), '') AS question, coalesce(min_by(bare, turn) FILTER (role = 'user'), '') AS strict_question,
 CAST(count(*) FILTER (role = 'user' AND content <> '') AS INT) AS questions FROM m GROUP BY conv_id"""


def first_assistant_answer(spark, sf):
    m = F.col("messages")
    return _chats(spark, sf).select("conv_id", messages.answer(m).alias("answer"), messages.first_content(m).alias("first_content"))


FIRST_ANSWER = f"""{_M} SELECT conv_id, min_by(content, turn) FILTER (role = 'assistant' AND content <> '') AS answer, min_by(content, turn) FILTER (content <> '') AS first_content FROM m GROUP BY conv_id"""


def qa_pairs_explode(spark, sf):
    """Each user message with the assistant message after it as listed pairs; records without any get one from their messages."""
    m = F.col("messages")
    asked = F.filter(F.transform(m, lambda x, i: F.struct(x["role"].alias("role"), x["content"].alias("question"), F.get(m, i + 1)["content"].alias("answer"))), lambda x: x["role"] == "user")
    none = F.lit(None).cast("string")
    rows = _chats(spark, sf).withColumn("pairs", messages.pairs(asked, none, none, m))
    return rows.select("conv_id", F.posexplode("pairs").alias("k", "pair")).select(F.concat("conv_id", F.lit("#qa"), "k").alias("id"), "pair.question", "pair.answer")


QA_PAIRS = f"""{_M}, n AS (SELECT conv_id, turn, role, content, lead(content) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM m),
l AS (SELECT conv_id, content AS question, answer, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM n WHERE role = 'user' AND content <> ''),
o AS (SELECT conv_id, coalesce(min_by(bare, turn) FILTER (role = 'user' AND bare <> ''), '') AS question, min_by(content, turn) FILTER (role = 'assistant' AND content <> '') AS answer, 0 AS k FROM m GROUP BY conv_id)
SELECT conv_id || '#qa' || k AS id, question, answer FROM (SELECT * FROM l UNION ALL SELECT * FROM o WHERE conv_id NOT IN (SELECT conv_id FROM l))"""

# -- verdicts --------------------------------------------------------------------------------------------------------------------------


def _judged(spark, sf):
    labels = table(spark, sf, "labels")
    rel = F.when(F.col("doc_id") % 7 != 0, (F.col("quality") * 3 + F.col("doc_id") % 3).cast("double"))
    nec = F.when(F.col("doc_id") % 7 != 0, (5 - F.col("toxic") * 3 - F.col("doc_id") % 2).cast("double"))
    relevance = F.when(F.col("quality") == 1, "relevant").otherwise("irrelevant")
    necessity = F.when(F.col("toxic") == 0, "necessary").otherwise("unnecessary")
    ppl = F.when(F.col("doc_id") % 5 != 0, (F.col("doc_id") % 40) / 4.0)
    return labels.select("doc_id", rel.alias("rel"), nec.alias("nec"), relevance.alias("relevance"), necessity.alias("necessity"), ppl.alias("ppl"))


def _keep(**options):
    return verdict.keep(F.col("rel"), F.col("nec"), F.col("relevance"), F.col("necessity"), **options)


_JUDGED = """WITH j AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN quality * 3 + doc_id % 3 END AS rel, CASE WHEN doc_id % 7 <> 0 THEN 5 - toxic * 3 - doc_id % 2 END AS nec,
 quality = 1 AS fine, toxic = 0 AS needed, CASE WHEN doc_id % 5 <> 0 THEN (doc_id % 40) / 4.0 END AS ppl FROM labels)"""


def verdict_keep_and(spark, sf):
    return _judged(spark, sf).select("doc_id", _keep(relevance_least=0, ppl=F.col("ppl"), ppl_most=8.0).alias("keep"))


KEEP_AND = f"{_JUDGED} SELECT doc_id, CASE WHEN rel IS NOT NULL THEN rel >= 4 AND nec >= 4 ELSE fine AND needed END AND (ppl IS NULL OR ppl <= 8) AS keep FROM j"


def verdict_keep_relevance_only(spark, sf):
    return _judged(spark, sf).select("doc_id", _keep(strategy="relevance_only", relevance_least=3, necessity_least=3).alias("keep"))


def verdict_keep_necessity_only(spark, sf):
    return _judged(spark, sf).select("doc_id", _keep(strategy="necessity_only").alias("keep"))


def clean_dirty_split_counts(spark, sf):
    return _judged(spark, sf).select(_keep().alias("keep")).groupBy("keep").agg(F.count("*").alias("n"))


def rejudge_necessity(spark, sf):
    return _judged(spark, sf).select("doc_id", verdict.rejudged(F.col("rel").cast("string"), F.col("relevance"), pick(["5", "x", "2.5", ""], F.col("doc_id"))).alias("keep"))


REJUDGE = f"{_JUDGED} SELECT doc_id, CASE WHEN rel IS NOT NULL THEN rel >= 4 ELSE fine END AND doc_id % 4 = 0 AS keep FROM j"

_REPLIES = [
    '{"relevance_score": 5, "necessity_score": 2, "reason": "r"}', '```json\n{"relevance_score": "4.5", "necessity_score": 9}\n```', 'So: {"relevance": "Relevant", "necessity": "unnecessary", "reason": "x"} .',
    '{"relevance_score": 3, "necessity_score": 4, "reason": "a "quote" here"}', '{"relevance": "irrelevant", "necessity": "necessary", "reason": "cut', "no json", "", '{"a": ', '{"relevance_score": null, "necessity": "necessary"}',
]
_VERDICTS = [  # relevance_score, necessity_score, relevance, necessity of each reply
    (5.0, 2.0, "relevant", "unnecessary"), (4.5, 5.0, "relevant", "necessary"), (5.0, 1.0, "relevant", "unnecessary"), (3.0, 4.0, "irrelevant", "necessary"), (1.0, 5.0, "irrelevant", "necessary"),
    (None, None, "unknown", "unknown"), (None, None, "unknown", "unknown"), (None, None, "unknown", "unknown"), (1.0, 5.0, "irrelevant", "necessary"),
]


def _responses(spark, sf):
    message = F.struct(F.struct(pick(_REPLIES, F.col("doc_id")).alias("content")).alias("message"))
    return table(spark, sf, "labels").select("doc_id", F.to_json(F.struct(F.array(message).alias("choices"))).alias("response"))


def verdict_json_parse(spark, sf):
    v = verdict.parsed(F.col("response"))
    rows = _responses(spark, sf).select("doc_id", v.alias("v"))
    return rows.select("doc_id", *[F.col(f"v.{k}") for k in ("relevance_score", "necessity_score", "relevance", "necessity")])


def _sql_verdict(k: int) -> str:
    values = [("NULL" if v[k] is None else base.quoted(v[k]) if isinstance(v[k], str) else f"{v[k]}::DOUBLE") for v in _VERDICTS]
    return f"[{', '.join(values)}][doc_id % {len(values)} + 1]"


VERDICT_PARSE = f"SELECT doc_id, {', '.join(f'{_sql_verdict(k)} AS {n}' for k, n in enumerate(('relevance_score', 'necessity_score', 'relevance', 'necessity')))} FROM labels"


def json_path_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), F.try_parse_json("props").isNotNull().alias("valid"))


def perplexity(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.round(verdict.perplexity_of(-F.col("value") / 100), 3).alias("ppl"))


# -- fine-tuning rows ------------------------------------------------------------------------------------------------------------------

_PATHS = [f"/data/{p}/clip.mp4" for p, _ in T.PATH_FAMILIES] + ["/data/other/clip.mp4"]
_PATH_FAMILY = ["longcapqa", "askmodelanything", "subtitleqa", "count_eval", "caption", "capqa", "unknown"]
_FILES = ["a_0_60s.jsonl", "b_60_180s.jsonl", "c_180_600s.jsonl", "d_more_600s.jsonl", "e.jsonl"]
_HINTS = ["how many of ", "what text ", "she said ", "what happens after ", "summarize ", "why is ", "which object ", "find ", "tell "]


def _tagged(spark, sf):
    q = F.transform(messages.questions(F.col("messages")), lambda x, i: normalized(F.concat(pick(_HINTS, F.col("conv_id") * 3 + i), x)))
    rows = _chats(spark, sf).select("conv_id", sft.family_of_path(pick(_PATHS, F.col("conv_id"))).alias("family"), sft.duration_of_file(pick(_FILES, F.col("conv_id"))).alias("duration"), q.alias("q"))
    rows = rows.withColumn("skills", F.transform("q", lambda x: sft.question_skill(x, F.col("family"))))
    rows = rows.withColumn("skill", sft.dominant_skill(F.col("skills"), F.col("family")))
    return rows.withColumn("decision", sft.keep_decision(F.col("family"), F.col("skill"), F.col("skills")))


_CLASS = f"""CASE WHEN q = '' THEN 'general' WHEN family = 'count_eval' AND {sql_any('q', T.COUNT_QUESTION)} THEN 'counting' WHEN family = 'count_eval' AND starts_with(q, 'find ') THEN 'general'
 WHEN {sql_any('q', T.OCR_QUESTION)} THEN 'ocr_text' WHEN {sql_any('q', T.COUNT_QUESTION)} THEN 'counting' WHEN family = 'subtitleqa' AND {sql_any('q', T.SPEECH_QUESTION)} THEN 'subtitle_alignment'
 WHEN {sql_any('q', T.SEQUENCE_QUESTION)} THEN 'temporal_sequence' WHEN {sql_any('q', T.TOPIC_QUESTION)} THEN 'summary' WHEN {sql_any('q', T.CAUSE_QUESTION)} THEN 'action_reasoning'
 WHEN {sql_any('q', T.OBJECT_QUESTION)} THEN 'object_reasoning' WHEN family = 'caption' THEN 'summary' ELSE 'general' END"""
_SFT = f"""{_M}, u AS (SELECT conv_id, content, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM m WHERE role = 'user' AND content <> ''),
f AS (SELECT DISTINCT conv_id, {sql_pick(_PATH_FAMILY, 'conv_id')} AS family, {sql_pick(['short', 'medium', 'long', 'long', 'unknown'], 'conv_id')} AS duration FROM m),
qs AS (SELECT conv_id, i, family, {base.sql_norm(f"{sql_pick(_HINTS, 'conv_id * 3 + i')} || content")} AS q FROM u JOIN f USING (conv_id)),
sk AS (SELECT conv_id, i, family, {_CLASS} AS skill FROM qs), cn AS (SELECT conv_id, skill, count(*) AS n FROM sk GROUP BY ALL),
dom AS (SELECT conv_id, skill FROM cn QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, list_position({sql_list(T.SKILL_PRIORITY)}, skill)) = 1),
agg AS (SELECT conv_id, count(*) AS questions, count(*) FILTER (skill <> 'counting') AS other FROM sk GROUP BY conv_id),
row AS (SELECT f.conv_id, f.family, f.duration, coalesce(dom.skill, CASE WHEN family = 'caption' THEN 'summary' ELSE 'general' END) AS skill, coalesce(questions, 0) AS questions, coalesce(other, 0) AS other
 FROM f LEFT JOIN dom USING (conv_id) LEFT JOIN agg USING (conv_id)),
dr AS (SELECT *, CASE WHEN family = 'unknown' THEN 'unknown_source' WHEN family = 'count_eval' AND NOT (questions > 0 AND other = 0) THEN 'count_eval_non_pure_counting'
 WHEN family = 'askmodelanything' AND skill = 'general' THEN 'askmodelanything_general' WHEN family NOT IN ('count_eval', 'askmodelanything') AND skill = 'general' THEN 'general_skill' ELSE '' END AS drop_reason FROM row),
kept AS (SELECT *, drop_reason = '' AS keep, CASE WHEN drop_reason <> '' THEN '' WHEN family = 'count_eval' THEN 'count_eval_pure_counting' WHEN family = 'askmodelanything' THEN 'askmodelanything_targeted'
 ELSE family || '_' || skill END AS keep_reason FROM dr)"""


def sft_question_skill(spark, sf):
    return _tagged(spark, sf).select("conv_id", F.posexplode("skills").alias("i", "skill"))


def sft_dominant_skill(spark, sf):
    return _tagged(spark, sf).select("conv_id", "family", "duration", "skill")


def sft_keep_decision(spark, sf):
    return _tagged(spark, sf).select("conv_id", "decision.*")


def sft_counts_grouping_sets(spark, sf):
    rows = _tagged(spark, sf).select(pick(_FILES, F.col("conv_id")).alias("file"), "family", "duration", "skill", F.col("decision.keep_reason").alias("keep_reason"), F.col("decision.drop_reason").alias("drop_reason"))
    return stats.grouped_counts(rows, "file", ["family", "duration", "skill", "keep_reason", "drop_reason"])


_DIMENSIONS = " UNION ALL ".join(f"SELECT {sql_pick(_FILES, 'conv_id')} AS file, '{d}' AS dimension, {d} AS value FROM kept" for d in ("family", "duration", "skill", "keep_reason", "drop_reason"))
SFT_COUNTS = f"{_SFT}, long AS ({_DIMENSIONS}) SELECT file, dimension, value, count(*) AS n FROM long WHERE value <> '' GROUP BY GROUPING SETS ((file, dimension, value), (dimension, value))"


def sft_target_buckets(spark, sf):
    rows = _tagged(spark, sf).where("decision.keep")
    return rows.select("conv_id", F.concat_ws(",", sft.target_buckets(F.col("duration"), F.col("skill"))).alias("targets"))


_TARGET = "CASE " + " ".join(f"WHEN skill = '{s}' AND {sql_in('duration', d)} THEN duration || '_{n}'" for s, d, n in T.TARGETS) + " ELSE '' END"
SFT_TARGETS = f"{_SFT} SELECT conv_id, {_TARGET} AS targets FROM kept WHERE keep"

# -- files ---------------------------------------------------------------------------------------------------------------------------

_BANK = {"subjects": ["art", "music"], "subfields": ["mechanics"], "visual_cues": ["table", "map"], "question_cues": ["most likely", "determine"]}


def _questions(spark, sf):
    d = table(spark, sf, "documents")
    cues = ["which of the following ", "Options (A) ", "describe this image ", "solve the equation in biology ", "find the circuit of art ", ""]
    return d.select("doc_id", F.concat("source", F.lit(".jsonl")).alias("file"), F.concat(pick(cues, F.col("doc_id")), F.col("text")).alias("question")), cues


def file_signal_ratios(spark, sf):
    rows = files.file_scores(files.file_ratios(_questions(spark, sf)[0], "file", "question", _BANK))
    return rows.select("file", "sample_n", *[F.round(c, 6).alias(c) for c in rows.columns if c not in ("file", "sample_n")])


def _sql_signals() -> str:
    matches = lambda ps: "(" + " OR ".join(f"regexp_matches(question, {base.quoted(p)}, 'i')" for p in ps) + ")"
    return f"""WITH q0 AS (SELECT source || '.jsonl' AS file, {sql_pick(['which of the following ', 'Options (A) ', 'describe this image ', 'solve the equation in biology ', 'find the circuit of art ', ''], 'doc_id')} || text AS question FROM documents),
q1 AS (SELECT *, lower(question) AS low, {matches(T.CHOICE_PATTERNS)} AS mcq, {matches(T.CAPTION_PATTERNS)} AS low_caption FROM q0),
q2 AS (SELECT *, mcq OR {sql_any('low', T.REASONING_STYLE)} AS style FROM q1),
q3 AS (SELECT *, {sql_any('low', T.MATH)} AS math, style AND {sql_any('low', T.SCIENCE)} AS sci, style AND {sql_any('low', T.ENGINEERING)} AS eng, style AND {sql_any('low', T.HUMANITIES)} AS hum,
 {sql_any('low', [*_BANK['subjects'], *_BANK['subfields'], *_BANK['visual_cues']])} AND (style OR {sql_any('low', _BANK['question_cues'])}) AS topic FROM q2),
r AS (SELECT file, count(*) AS sample_n, {', '.join(f'avg(CAST({k} AS DOUBLE)) AS {k}_ratio' for k in ('mcq', 'math', 'sci', 'eng', 'hum', 'low_caption', 'topic'))}, avg(length(question)) AS avg_q_len FROM q3 GROUP BY file),
s AS (SELECT *, 0.55::DOUBLE * math_ratio + 0.30::DOUBLE * mcq_ratio + 0.15::DOUBLE * (1 - least(low_caption_ratio, 0.5::DOUBLE)) AS score_math,
 0.30::DOUBLE * (sci_ratio + eng_ratio + hum_ratio) + 0.25::DOUBLE * mcq_ratio + 0.30::DOUBLE * topic_ratio + 0.15::DOUBLE * (1 - least(low_caption_ratio, 0.5::DOUBLE)) AS score_mmmu FROM r),
scores AS (SELECT *, 0.55::DOUBLE * score_math + 0.45::DOUBLE * score_mmmu AS combined_score FROM s)"""


_RATIOS = [f"{k}_ratio" for k in ("mcq", "math", "sci", "eng", "hum", "low_caption", "topic")] + ["avg_q_len", "score_math", "score_mmmu", "combined_score"]
SIGNALS = f"{_sql_signals()} SELECT file, sample_n, {', '.join(f'round({c}, 6) AS {c}' for c in _RATIOS)} FROM scores"


def file_tiering(spark, sf):
    ranked = files.file_scores(files.file_ratios(_questions(spark, sf)[0], "file", "question", _BANK)).withColumn("combined_score", F.round("combined_score", 6))
    return files.tiers(ranked, 5, 4, "file").select("file", "combined_score", "rank", "tier")


TIERING = f"""{_sql_signals()}, k AS (SELECT file, round(combined_score, 6) AS combined_score FROM scores), n AS (SELECT *, CAST(row_number() OVER (ORDER BY combined_score DESC, file) AS INT) AS rank FROM k)
SELECT *, CASE WHEN rank <= 5 THEN 'P0' WHEN rank <= 9 THEN 'P1' ELSE 'excluded' END AS tier FROM n"""

_EXACT, _CONTENT, _PREFIXES = {"src0.jsonl": ["math", "science"], "src1.jsonl": ["art"]}, {"tion": ["nouns"], "que": ["french", "grammar"], "sch": ["german"]}, ["src1", "src2", "src3"]


def _manifest(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.concat("source", F.lit(".jsonl")).alias("file"), "text")
    sampled = files.head(d, 5, "file", "doc_id").groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda x: x["text"]), " ").alias("content"))
    return sampled.select("file", files.file_domains(F.col("file"), F.col("content"), _EXACT, _CONTENT, _PREFIXES).alias("domains"))


def domain_manifest(spark, sf):
    rows = _manifest(spark, sf)
    return rows.select("file", F.array_join(F.array_sort("domains"), ";").alias("domains"), files.related(F.col("domains"), ["math"]).alias("math_related"), files.related(F.col("domains"), ["art", "science"]).alias("mmmu_related"))


def domain_to_files(spark, sf):
    d = table(spark, sf, "documents").select(F.concat("source", F.lit(".jsonl")).alias("file"), "text")
    found = d.groupBy("file").agg(files.domains_of_all(F.col("text"), _CONTENT).alias("found"))
    return files.inverted_rows(found.select("file", files.grown_domains(F.col("file"), F.col("found"), _EXACT, _PREFIXES).alias("domains")))


_DOMAINS = f"""c AS (SELECT file, lower(string_agg(text, ' ' ORDER BY doc_id)) AS content FROM s GROUP BY file),
d AS (SELECT file, CASE WHEN file = 'src0.jsonl' THEN ['math', 'science'] WHEN file = 'src1.jsonl' THEN ['art'] WHEN {' OR '.join(f"starts_with(file, '{p}')" for p in _PREFIXES)}
 THEN list_concat(['general'], {', '.join(f"CASE WHEN contains(content, '{k}') THEN {sql_list(v)} ELSE [] END" for k, v in _CONTENT.items())}) ELSE ['general'] END AS domains FROM c)"""
_MANIFEST = f"""WITH s AS (SELECT source || '.jsonl' AS file, doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5),
{_DOMAINS}"""
MANIFEST = f"{_MANIFEST} SELECT file, array_to_string(list_sort(domains), ';') AS domains, list_contains(domains, 'math') AS math_related, list_has_any(domains, ['art', 'science']) AS mmmu_related FROM d"
INVERTED = f"""WITH s AS (SELECT source || '.jsonl' AS file, doc_id, text FROM documents),
{_DOMAINS}, p AS (SELECT DISTINCT domain, file FROM (SELECT file, unnest(domains) AS domain FROM d))
SELECT domain, file, row_number() OVER (PARTITION BY domain ORDER BY file NULLS LAST) AS place FROM p"""

# -- resuming, routing, early stop ----------------------------------------------------------------------------------------------------


def resume_left_anti(spark, sf):
    items = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    done = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("id")).distinct()
    return resume.pending(items, done)


def resume_counts(spark, sf):
    items = table(spark, sf, "orders").select(F.when(F.col("o_custkey") % 10 != 0, F.col("o_orderkey")).alias("id"))
    done = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("id")).distinct()
    return resume.resume_summary(items, done)


RESUME_COUNTS = """WITH i AS (SELECT CASE WHEN o_custkey % 10 <> 0 THEN o_orderkey END AS id FROM orders), d AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_quantity > 45)
SELECT count(*) AS total, count(*) FILTER (i.id IS NULL) AS invalid, count(*) FILTER (d.id IS NOT NULL) AS skipped, count(*) FILTER (i.id IS NOT NULL AND d.id IS NULL) AS pending FROM i LEFT JOIN d USING (id)"""


def dedupe_first_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", F.md5(normalized("text")).alias("text_key"))
    return first_of(d, ["text_key"], "doc_id")


def dedupe_ids(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    done = e.where("event_type = 'purchase' and value > 60").select("user_id").distinct()
    return resume.accepted(e, done, "user_id", "event_id")


def stable_hash_route(spark, sf):
    return table(spark, sf, "pages").select("page_id", md5_modulo("url", 7).cast("int").alias("endpoint"))


_MD5 = "list_reduce(list_prepend(0::HUGEINT, [('0x' || substr(md5(url), i * 8 + 1, 8))::HUGEINT for i in range(4)]), lambda a, c: (a * 4294967296 + c) % {0})"


def route_retry_rotation(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url", F.explode(F.array(*map(F.lit, [1, 2, 3]))).alias("attempt"))
    return p.select("page_id", "attempt", calls.route(F.col("url"), 5, F.col("attempt")).cast("int").alias("rotated"), calls.route(F.col("url"), 5, F.col("attempt"), rotate=False).cast("int").alias("same"))


ROTATION = f"SELECT page_id, CAST(attempt AS INT) AS attempt, CAST(({_MD5.format(5)} + attempt - 1) % 5 AS INT) AS rotated, CAST({_MD5.format(5)} AS INT) AS same FROM pages, (SELECT unnest([1, 2, 3]) AS attempt)"


def early_stop_running_dirty(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    return until_dirty(e, F.col("event_type") == "error", 500, "event_id", block=1000)


EARLY_STOP = "SELECT event_id, event_type FROM (SELECT *, sum(CAST(event_type = 'error' AS INT)) OVER (ORDER BY event_id) - CAST(event_type = 'error' AS INT) AS before FROM events) WHERE before < 500"

# -- captions and calls ---------------------------------------------------------------------------------------------------------------


def _captions(spark, sf):
    b = table(spark, sf, "benchmark")
    n = F.col("item_id")
    text = F.concat(
        F.lit("### 1. Main Subject of the video\n"), F.col("text"), F.lit("\n### 3. Motion & Detail description\n- ** "), n % 5, F.lit(" – "), n % 7, F.lit(".5 seconds ** : first  part\n- **9-12 second**: second\n part\n"),
        F.lit("### 4. Something else\nlost\n### 5. Highlights\n- **At approximately "), n % 5, F.lit(" seconds**: a point"),
    )
    rows = b.select("item_id", caption.video_id(F.array(F.concat(F.lit("/v/clip_d"), n * 10, F.lit(".mp4"))), F.lit("x")).alias("video_id"), text.alias("caption"))
    rows = rows.withColumn("sections", caption.sections(F.col("caption")))
    rows = rows.withColumn("events", caption.events(F.col("sections")["motion_detail_description"], F.col("sections")["highlight_moments"]))
    return rows.withColumn("seconds", caption.duration(F.col("video_id"), F.lit("f_90s.jsonl")))


def round_trip_sections(spark, sf):
    rows = _captions(spark, sf)
    return rows.select("item_id", "video_id", F.col("sections")["main_subject"].alias("main_subject"), F.size("sections").alias("known"), caption.structured(F.col("sections")).alias("structured"), "seconds")


_CLEAN = r"regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')"
_MOTION = "'- ** ' || (item_id % 5) || ' – ' || (item_id % 7) || E'.5 seconds ** : first  part\\n- **9-12 second**: second\\n part'"
_POINTS = "'- **At approximately ' || (item_id % 5) || ' seconds**: a point'"
SECTIONS = f"""SELECT item_id, 'clip_d' || (item_id * 10) AS video_id, {_CLEAN} AS main_subject, 3 AS known, E'### 1. Main subject of the video\\n' || {_CLEAN}
 || E'\\n\\n### 3. Motion Detail Description\\n' || {_MOTION} || E'\\n\\n### 5. Highlight Moments\\n' || {_POINTS} AS structured, CAST(item_id * 10 AS DOUBLE) AS seconds FROM benchmark"""


def caption_events(spark, sf):
    return _captions(spark, sf).select("item_id", F.posexplode("events").alias("i", "e")).select("item_id", "i", "e.*")


CAPTION_EVENTS = """WITH e AS (SELECT item_id, CAST(item_id % 5 AS DOUBLE) AS start_sec, item_id % 7 + 0.5::DOUBLE AS end_sec, 'first part' AS description, 'motion_detail_description' AS source, 'range' AS type, 0 AS o
 FROM benchmark WHERE item_id % 7 + 0.5 > item_id % 5
 UNION ALL SELECT item_id, 9, 12, 'second part', 'motion_detail_description', 'range', 1 FROM benchmark UNION ALL SELECT item_id, item_id % 5, NULL, 'a point', 'highlight_moments', 'point', 2 FROM benchmark)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY start_sec, end_sec IS NULL, o) - 1 AS INT) AS i, start_sec, end_sec, description, source, type FROM e"""


def caption_prompt(spark, sf):
    rows = _captions(spark, sf)
    return rows.select("item_id", caption.prompt(F.col("video_id"), F.col("seconds"), F.col("events"), caption.structured(F.col("sections"))).alias("prompt"))


_LINES = """string_agg((i + 1) || '. ' || CASE WHEN end_sec IS NULL THEN '[point ~' || start_sec || 's] ' ELSE '[range ' || start_sec || '-' || end_sec || 's] ' END || left(description, 250), E'\\n' ORDER BY i)"""
CAPTION_PROMPT = f"""WITH ev AS ({CAPTION_EVENTS}), se AS ({SECTIONS}), li AS (SELECT item_id, {_LINES} AS lines FROM ev WHERE i < 15 GROUP BY item_id)
SELECT item_id, '{caption.TEMPLATE.format(video="' || video_id || '", seconds="' || seconds || '", segments="' || coalesce(lines, '') || '", caption="' || left(structured, 3000) || '", questions=5)}' AS prompt FROM se LEFT JOIN li USING (item_id)"""


def caption_reply_lists(spark, sf):
    reply = F.concat(F.lit('```json\n{"temporal_grounding": [{"query": "q", "answer": "a", "start_sec": "1.5"}, {"answer": "x"}, 3], "segment_qa": {}, "understanding_qa": [{"question": "u", "answer": "v", "category": "c'), F.col("item_id"), F.lit('"}]}\n```'))
    v = caption.reply_lists(F.when(F.col("item_id") % 4 == 0, F.lit("none")).otherwise(reply))
    rows = table(spark, sf, "benchmark").select("item_id", v.alias("v"))
    u = F.get("v.understanding_qa", F.lit(0))
    t = F.get("v.temporal_grounding", F.lit(0))
    return rows.select("item_id", F.size("v.temporal_grounding").alias("grounded"), F.size("v.segment_qa").alias("segments"), t["start_sec"].alias("start_sec"), u["query"].alias("query"), u["category"].alias("category"), F.col("v.error").alias("error"))


REPLY_LISTS = """SELECT item_id, CAST(CASE WHEN b THEN 0 ELSE 1 END AS INT) AS grounded, 0 AS segments, CASE WHEN NOT b THEN 1.5::DOUBLE END AS start_sec, CASE WHEN NOT b THEN 'u' END AS query,
 CASE WHEN NOT b THEN 'c' || item_id END AS category, CASE WHEN b THEN 'Failed to parse JSON object from model output: none' END AS error FROM (SELECT item_id, item_id % 4 = 0 AS b FROM benchmark)"""


def _stub(endpoint: str, payload: str) -> tuple[int, str]:
    n = len(payload)
    if n % 11 == 0:
        return 400, ""
    if n % 3 == 0 and endpoint == "a":
        return 500, ""
    return 200, '{"choices": [{"message": {"content": "{\\"relevance_score\\": 5, \\"necessity_score\\": ' + str(n % 5 + 1) + '}"}}]}'


def judge_stub_pipeline(spark, sf):
    """Requests for conversations to a stub of a service: local answers, retries on another endpoint, errors, verdicts."""
    m = F.col("messages")
    rows = _chats(spark, sf).select(F.col("conv_id").cast("string").alias("id"), verdict.question_prompt(messages.question(m), verdict.prompt_budget()).alias("payload"))
    local = F.when(F.length("payload") < 30, F.lit('{"choices": []}'))
    answers = calls.called(rows.withColumn("local", local), ["a", "b"], _stub, calls.Retries(2, 0.0))
    return answers.select("id", "endpoint", "attempts", "error", verdict.parsed(F.col("response"))["necessity_score"].alias("necessity_score"))


STUB_PIPELINE = f"""WITH fu AS ({FIRST_USER}), p AS (SELECT conv_id::VARCHAR AS id, least(length('The question: ' || {_STRIP.format('question')}), {verdict.prompt_budget()} + length('..[truncated for length]')) AS n, ('0x' || right(md5(conv_id::VARCHAR), 1))::INT % 2 = 0 AS first FROM fu)
SELECT id, CASE WHEN n < 30 THEN '' WHEN first AND (n % 11 = 0 OR n % 3 > 0) THEN 'a' ELSE 'b' END AS endpoint, CASE WHEN n < 30 THEN 0 WHEN first AND n % 11 > 0 AND n % 3 = 0 THEN 2 ELSE 1 END AS attempts,
 CASE WHEN n >= 30 AND n % 11 = 0 THEN 'status 400' END AS error, CASE WHEN n >= 30 AND n % 11 > 0 THEN n % 5 + 1 END::DOUBLE AS necessity_score FROM p"""


def incremental_resume_stream(spark, sf):
    """Two runs over a growing folder: each id is written once."""
    from ..streaming import incremental

    folder = base.scratch(spark)  # a run of its own: another one may share the folder it is in
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), "event_type")
    for part in (0, 1):
        e.where(F.col("id") % 2 == part).union(e.where("id % 10 = 0")).write.mode("append").parquet(f"{folder}/in")
        incremental.run_available(incremental.stream_of(spark, f"{folder}/in", e.schema), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").select("id", "event_type")


_ALL = {
    "first_user_question": (first_user_question, FIRST_USER),
    "first_assistant_answer": (first_assistant_answer, FIRST_ANSWER),
    "qa_pairs_explode": (qa_pairs_explode, QA_PAIRS),
    "verdict_keep_and": (verdict_keep_and, KEEP_AND),
    "verdict_keep_relevance_only": (verdict_keep_relevance_only, f"{_JUDGED} SELECT doc_id, CASE WHEN rel IS NOT NULL THEN rel >= 3 ELSE fine END AS keep FROM j"),
    "verdict_keep_necessity_only": (verdict_keep_necessity_only, f"{_JUDGED} SELECT doc_id, CASE WHEN nec IS NOT NULL THEN nec >= 4 ELSE needed END AS keep FROM j"),
    "clean_dirty_split_counts": (clean_dirty_split_counts, f"{_JUDGED} SELECT CASE WHEN rel IS NOT NULL THEN rel >= 4 AND nec >= 4 ELSE fine AND needed END AS keep, count(*) AS n FROM j GROUP BY keep"),
    "rejudge_necessity": (rejudge_necessity, REJUDGE),
    "verdict_json_parse": (verdict_json_parse, VERDICT_PARSE),
    "json_path_extract": (json_path_extract, "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k, json_valid(props) AS valid FROM events"),
    "perplexity": (perplexity, "SELECT user_id, round(round(exp(avg(value / 100)), 4), 3) AS ppl FROM events GROUP BY user_id"),
    "sft_question_skill": (sft_question_skill, f"{_SFT} SELECT conv_id, CAST(i AS INT) AS i, skill FROM sk"),
    "sft_dominant_skill": (sft_dominant_skill, f"{_SFT} SELECT conv_id, family, duration, skill FROM kept"),
    "sft_keep_decision": (sft_keep_decision, f"{_SFT} SELECT conv_id, keep, keep_reason, drop_reason FROM kept"),
    "sft_counts_grouping_sets": (sft_counts_grouping_sets, SFT_COUNTS),
    "sft_target_buckets": (sft_target_buckets, SFT_TARGETS),
    "file_signal_ratios": (file_signal_ratios, SIGNALS),
    "file_tiering": (file_tiering, TIERING),
    "domain_manifest": (domain_manifest, MANIFEST),
    "domain_to_files": (domain_to_files, INVERTED),
    "resume_left_anti": (resume_left_anti, "SELECT o_orderkey AS id, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)"),
    "resume_counts": (resume_counts, RESUME_COUNTS),
    "dedupe_first_text": (dedupe_first_text, f"SELECT doc_id, source, text_key FROM (SELECT doc_id, source, md5({base.sql_norm('text')}) AS text_key FROM documents) QUALIFY row_number() OVER (PARTITION BY text_key ORDER BY doc_id) = 1"),
    "dedupe_ids": (dedupe_ids, "SELECT user_id, event_id, event_type FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 60) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1"),
    "stable_hash_route": (stable_hash_route, f"SELECT page_id, CAST({_MD5.format(7)} AS INT) AS endpoint FROM pages"),
    "route_retry_rotation": (route_retry_rotation, ROTATION),
    "early_stop_running_dirty": (early_stop_running_dirty, EARLY_STOP),
    "round_trip_sections": (round_trip_sections, SECTIONS),
    "caption_events": (caption_events, CAPTION_EVENTS),
    "caption_prompt": (caption_prompt, CAPTION_PROMPT),
    "caption_reply_lists": (caption_reply_lists, REPLY_LISTS),
    "judge_stub_pipeline": (judge_stub_pipeline, STUB_PIPELINE),
    "incremental_resume_stream": (incremental_resume_stream, "SELECT event_id AS id, event_type FROM events"),
}
QUERIES = {k: q for k, (q, _) in _ALL.items()}
ORACLE = {k: s for k, (_, s) in _ALL.items() if s}
