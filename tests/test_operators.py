"""Operators on small literal tables; expected values are worked out by hand."""

import collections
import json
import math

import pytest
from pyspark.sql import functions as F

from sievework.functions import profiles, tables, verdict
from sievework.operators import buckets, calls, files, matching, resume, selection
from sievework.plans import chat_queries
from sievework.sources import loaders, readers, sinks
from sievework.streaming import incremental


def lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


# -- sources and sinks ------------------------------------------------------------------------------------------------------------


def test_examples_of_lines_with_an_exploded_list(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", [{"vid": "v1", "qas": [{"Q": "one?", "A": "1"}, {"Q": "two?", "A": "2"}]}, {"vid": "v2", "qas": [{"Q": "three?", "A": ""}]}])
    spec = readers.SourceSpec("s", [path], ids=["vid"], questions=["Q"], answers=["A"], explode="qas")
    got = {r.source_record_id: r for r in readers.examples(spark, spec).collect()}
    assert sorted(got) == ["v1#e0", "v1#e1", "v2#e0"]
    assert got["v1#e1"].question == "two?" and got["v1#e1"].answer == "2" and got["v1#e1"].id == "s:a:v1#e1"


def test_json_document_with_a_list_in_a_field(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"data": [{"id": 1}, {"id": 2}]}))
    assert sorted(r.id for r in readers.read_records(spark, [str(tmp_path / "d.json")], record_field="data").collect()) == [1, 2]


def test_missing_paths(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", [{"id": "x"}])
    with pytest.raises(FileNotFoundError):
        readers.read_records(spark, [path, str(tmp_path / "none.jsonl")])
    assert readers.read_records(spark, [path, str(tmp_path / "none.jsonl")], skip_missing=True).count() == 1
    with pytest.raises(ValueError):
        readers.format_of("a.xml")


def test_line_counts(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("a\n\nb\n")
    got = readers.line_counts(spark, [str(tmp_path / "x.jsonl")]).first()
    assert (got.file, got.total_lines, got.filled_lines) == ("x.jsonl", 3, 2)


def test_sink_takes_new_ids_once(spark, tmp_path):
    out = str(tmp_path / "out")
    spark.createDataFrame([("0", 1)], "id string, v int").write.json(out)
    new = spark.createDataFrame([("1", 1), ("1", 2), ("0", 3), ("2", 4)], "id string, v int")
    sinks.append_results(new, out, resume.processed_ids(spark, out))
    assert sorted(r.id for r in spark.read.json(out).collect()) == ["0", "1", "2"]


def test_clean_and_dirty(spark, tmp_path):
    df = spark.createDataFrame([("a", True, "v"), ("b", False, "v"), ("c", None, "v")], "id string, _clean_keep boolean, _clean_verdict string")
    assert sinks.split_clean_dirty(df, str(tmp_path / "c"), str(tmp_path / "d")) == (1, 2)
    assert spark.read.json(str(tmp_path / "c")).columns == ["id"]
    assert readers.dirty_count(spark, str(tmp_path / "d")) == 1


# -- resuming and streams ---------------------------------------------------------------------------------------------------------


def test_resume_skips_what_is_done(spark):
    items = spark.createDataFrame([(str(i),) for i in range(10)] + [(None,)], "id string")
    done = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    assert resume.pending(items, done).count() == 7
    got = resume.resume_summary(items, done).first()
    assert (got.total, got.invalid, got.skipped, got.pending) == (11, 1, 3, 7)


def test_two_runs_of_a_growing_folder(spark, tmp_path):
    data, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for low, high, expected in ((0, 100, 100), (50, 150, 150)):
        spark.range(low, high).withColumnRenamed("id", "k").write.mode("append").parquet(data)
        incremental.run_available(incremental.stream_of(spark, data, "k long"), out, check, "k")
        assert spark.read.parquet(out).select("k").distinct().count() == spark.read.parquet(out).count() == expected


# -- selection --------------------------------------------------------------------------------------------------------------------


def scored(spark, rows):
    return spark.createDataFrame(rows, "id string, family string, score double")


def test_soft_cap_prefers_the_first_tier_and_then_fills_up(spark):
    rows = [(f"a{i}", "a", 1.0 - i / 100) for i in range(10)] + [(f"b{i}", "b", 0.5 - i / 100) for i in range(2)] + [("c0", "c", 2.0)]
    tier = F.when(F.col("family") == "c", 1).otherwise(0)
    got = [r.id for r in selection.soft_cap(scored(spark, rows), 10, "family", tier, "score", "id").collect()]
    # at most 3 of a family first, then more of the first tier, before the other tier
    assert got == ["a0", "a1", "a2", "b0", "b1", "a3", "a4", "a5", "a6", "a7"]


def test_capped_family(spark):
    rows = [(f"x{i}", "x", 1.0) for i in range(5)] + [(f"y{i}", "y", 0.1) for i in range(20)]
    got = selection.capped_top(scored(spark, rows), 20, "family", "x", "score", "id").collect()
    assert len(got) == 20 and sum(r.family == "x" for r in got) == 2


def test_best_per_id_takes_the_first_of_ties(spark):
    got = selection.best_per_id(scored(spark, [("i", "b", 1.0), ("i", "a", 1.0), ("j", "c", 0.5)]), "id", "score", "family").collect()
    assert sorted((r.id, r.family) for r in got) == [("i", "a"), ("j", "c")]


def test_sources_in_turn_count_only_what_was_taken(spark):
    make = lambda *names: spark.createDataFrame([(i, n) for i, n in enumerate(names)], "n int, text string")
    got = selection.sources_in_turn([make("a", "b", "b"), make("b", "c", "a")], F.col("text"), 1, 0, "n").collect()
    # b is beyond the first source's limit, so the second source may bring it
    assert sorted(r.text for r in got) == ["a", "b"]


def test_until_dirty_stops_at_the_row_that_reaches_the_number(spark):
    rows = spark.range(1000).withColumn("bad", F.col("id") % 10 == 9)
    assert selection.until_dirty(rows, F.col("bad"), 3, "id", block=7).count() == 30
    assert selection.until_dirty(rows, F.col("bad"), 10_000, "id", block=64).count() == 1000


# -- buckets ----------------------------------------------------------------------------------------------------------------------


def test_priorities_and_tiers(spark):
    rows = [(f"d{b:02d}", "t", 0.0 if i < b + 1 else 1.0) for b in range(13) for i in range(20)]
    current = spark.createDataFrame(rows, "duration string, task_type string, score double")
    baseline = current.withColumn("score", F.lit(1.0))
    got = buckets.priorities(current, baseline).orderBy("rank").collect()
    worst = got[0]
    # 13 of 20 wrong: accuracy 35, gap 65, 13 * (1 + 6.5)
    assert (worst.duration, worst.accuracy, worst.error_rate, worst.baseline_gap_pp, worst.priority_score) == ("d12", 35.0, 65.0, 65.0, 97.5)
    assert [r.difficulty_tier for r in got] == ["critical"] * 5 + ["hard"] * 7 + ["easy"]


def test_every_file_has_a_rank(spark):
    rows = [(f"f{i:04d}", float(i * 7919 % 300)) for i in range(1000)]
    scores = spark.createDataFrame(rows, "file string, combined_score double").repartition(5, "file")
    got = [tuple(r) for r in files.tiers(scores, 5, 4, "file").orderBy("rank").select("file", "rank", "tier").collect()]
    order = [f for f, s in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert got == [(f, i + 1, "P0" if i < 5 else "P1" if i < 9 else "excluded") for i, f in enumerate(order)]


def test_each_domain_has_all_its_files(spark):
    rows = [("b.jsonl", ["art", "music"]), ("a.jsonl", ["art"]), ("c.jsonl", []), ("a.jsonl", ["art"])]
    got = {tuple(map(str, r)) for r in files.inverted(spark.createDataFrame(rows, "file string, domains array<string>")).collect()}
    assert got == {("art", "['a.jsonl', 'b.jsonl']"), ("music", "['b.jsonl']")}


def test_domains_come_from_all_rows_of_a_file(spark, tmp_path):
    rows = [(i, "plain", "src2") for i in range(5)] + [(5, "a Question", "src2"), (6, "nation", None), (7, None, "src3"), (8, "Schule", "src3"), (9, "nation", "src1"), (10, None, "src19")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in chat_queries.domain_to_files(spark, str(tmp_path)).collect()), key=lambda r: (r[0], r[2]))
    general = [("general", f, i + 1) for i, f in enumerate(["src19.jsonl", "src2.jsonl", "src3.jsonl", None])]
    assert got == [("art", "src1.jsonl", 1), ("french", "src2.jsonl", 1), *general, ("german", "src3.jsonl", 1), ("grammar", "src2.jsonl", 1), ("nouns", "src2.jsonl", 1)]


def test_places_of_files_within_domains(spark):
    names = [*(f"f{i:03d}" for i in range(300)), None]
    lists = {f: ["a", None] if i % 3 else ["a", "b", "b"] for i, f in enumerate(names)}
    manifest = spark.createDataFrame(list(lists.items()) * 2, "file string, domains array<string>").repartition(5)
    got = {tuple(r) for r in files.inverted_rows(manifest).collect()}
    assert got == {(d, f, i + 1) for d in ("a", "b", None) for i, f in enumerate(f for f in names if d in lists[f])}
    assert files.inverted_rows(manifest.where("false")).count() == 0


def test_shares_of_a_plan(spark):
    b = spark.createDataFrame([("x", 3.0), ("y", 1.0)], "bucket_key string, priority_score double")
    m = spark.createDataFrame([("x", "f", 1), ("x", "g", 3), ("y", "f", 5)], "bucket_key string, family string, count long")
    got = {(r.bucket_key, r.family): (r.bucket_weight, r.source_share) for r in buckets.plan(b, m).collect()}
    assert got == {("x", "f"): (0.75, 0.25), ("x", "g"): (0.75, 0.75), ("y", "f"): (0.25, 1.0)}


# -- similarity -------------------------------------------------------------------------------------------------------------------


def test_token_cosine_and_filling_up(spark):
    c = spark.createDataFrame([(1, "a b b"), (2, "z"), (3, ""), (4, None)], "c int, text string")
    b = spark.createDataFrame([(10, "a b"), (11, "b"), (12, "q")], "b int, text string")
    found = matching.ranked(matching.compared(c, b, "c", "b", 2), "c").collect()
    best = {(r.c, r.rank): (r.b, r.semantic) for r in found}
    assert best == {(1, 1): (10, 0.948683), (1, 2): (11, 0.894427), **{(k, r): (10 + r - 1, 0.0) for k in (2, 3, 4) for r in (1, 2)}}
    assert matching.compared(c, b.limit(0), "c", "b", 2).where("size(matches) = 0 and max_similarity = 0").count() == 4
    assert matching.compared(c.limit(0), b, "c", "b", 2).count() == 0


@pytest.mark.parametrize("backend", ["token_overlap", "tfidf", "embedding"])
def test_slices_of_a_benchmark_give_what_one_gives(spark, backend):
    c = spark.range(60).selectExpr("cast(id as int) as c", "concat_ws(' ', transform(sequence(1, 1 + id % 9), i -> concat('w', (id * i * 7) % 13))) as text", "array(cos(id), sin(id)) as embedding")
    b = spark.range(40).selectExpr("cast(id as int) as b", "concat_ws(' ', transform(sequence(1, 1 + id % 7), i -> concat('w', (id * i * 5) % 13))) as text", "array(cos(id * 3), sin(id * 3)) as embedding", "concat('s', id % 3) as source")
    one, many = (matching.compared(c, b, "c", "b", 3, backend, source="source", slice_bytes=n, grams=7).drop("scored").orderBy("c").collect() for n in (1 << 20, 2000))
    assert len(one) == 60 and list(map(str, one)) == list(map(str, many))


def test_parts_of_matches_are_those_of_the_rules(spark):
    rnd = __import__("random").Random(4)
    some = lambda tags: sorted(rnd.sample(tags, rnd.randrange(0, 4)))
    kinds = ["short", "medium", "long", "very_long", "unknown"], ["unknown", "binary", "number", "short_phrase", "sentence"]
    families = ["count_eval", "subtitleqa", "longcapqa", "caption", "tracking", "other"]
    profile = lambda: (some(["counting", "summary", "grounding", "ocr"]), some(["a", "b", "c"]), some(["x", "y", "z"]), some(["subtitle", "visual", "ocr"]), some(["local", "global", "multi_segment"]), rnd.choice(kinds[0]), rnd.choice(kinds[1]), rnd.choice(["videomme", "lvbench", "none"]), rnd.choice(families))
    kind = "struct<skill_tags array<string>, domain_tags array<string>, reasoning_tags array<string>, modality_tags array<string>, locality_tags array<string>, duration_bucket string, answer_type string, benchmark_name string, source_family string>"
    kind = kind.replace(" array", ": array").replace(" string", ": string")
    c = spark.createDataFrame([(i, f"w{i % 5} w1", profile()) for i in range(30)], f"c int, text string, p {kind}")
    b = spark.createDataFrame([(i, f"w{i % 4}", profile()) for i in range(20)], f"b int, text string, q {kind}")
    found = {(r.c, r.b): r for r in matching.ranked(matching.compared(c, b, "c", "b", 20, profile=("p", "q")), "c").collect()}
    for x in c.collect():
        for y in b.collect():
            got, parts = found[x.c, y.b], rules_of_a_match(y.q, x.p)
            only = sum(w * parts[k] for k, w in tables.WEIGHTS.items() if k != "semantic") / sum(w for k, w in tables.WEIGHTS.items() if k != "semantic")
            assert {k: round(got[k], 9) for k in matching.PARTS} == {k: round(v, 9) for k, v in parts.items()} and abs(got.profile_only - only) < 1e-8


@pytest.mark.parametrize("size", [1 << 20, 300])
def test_candidates_keep_their_profile(spark, size):
    lists = ", ".join(f"{k}: array<string>" for k in ("skill_tags", "domain_tags", "reasoning_tags", "modality_tags", "locality_tags"))
    kind = f"struct<{lists}, duration_bucket: string, answer_type: string, benchmark_name: string, source_family: string, more: string>"
    p = lambda i: (["a"] * (i % 2), ["b"], [], [], ["local"], "short", "unknown", "", "caption", f"m{i}")
    c = spark.createDataFrame([(i % 9, f"w{i % 5}", p(i)) for i in range(10)], f"c int, text string, p {kind}")
    b = spark.createDataFrame([(i, f"w{i}", p(i)) for i in range(6)], f"b int, text string, q {kind}")
    found = matching.compared(c, b, "c", "b", 2, profile=("p", "q"), slice_bytes=size, keep_profile=True)
    rows = matching.summarized(found, "c", more=("p", "matches"))
    assert sorted(map(str, rows.select("c", "p").collect())) == sorted(map(str, c.select("c", "p").collect()))
    assert all(len(r.matches) == 2 and (r.c, r.p.more) in {(i % 9, f"m{i}") for i in range(10)} for r in rows.collect())


def rules_of_a_match(b, c):
    """The parts of a match, one pair at a time."""
    dice = lambda k: 2 * len({*b[k]} & {*c[k]}) / (len(b[k]) + len(c[k])) if b[k] and c[k] else 0.0
    both = b.locality_tags, c.locality_tags
    near = "global" in both[0] and {"global", "multi_segment"} & {*both[1]} or "local" in both[0] and "local" in both[1]
    steps = {"short": 0, "medium": 1, "long": 2, "very_long": 3}
    prior = tables.PRIORS.get(b.benchmark_name, {}).get(c.source_family, tables.OTHER_PRIOR)
    prior += sum(more for field, tag, families, more in profiles.BOOSTS if tag in b[field] and c.source_family in families)
    unknown = lambda k: "unknown" in (b[k], c[k])
    return {
        "skill": dice("skill_tags"),
        "domain": dice("domain_tags"),
        "reasoning": dice("reasoning_tags"),
        "modality": len({*b.modality_tags} & {*c.modality_tags}) / len(b.modality_tags) if b.modality_tags else 0.5,
        "locality": 0.5 if not both[0] else 1.0 if near else dice("locality_tags"),
        "duration": 0.5 if unknown("duration_bucket") else [1.0, 0.65, 0.25, 0.0][abs(steps[b.duration_bucket] - steps[c.duration_bucket])],
        "answer_type": 0.5 if unknown("answer_type") else 1.0 if b.answer_type == c.answer_type else 0.75 if {b.answer_type, c.answer_type} == {"short_phrase", "sentence"} else 0.0,
        "source_prior": min(1.0, max(0.0, prior)),
    }


@pytest.mark.parametrize("backend", ["token_overlap", "tfidf"])
def test_pruned_scores_are_those_of_all_pairs(spark, backend):
    rnd = __import__("random").Random(8)
    words = [f"w{i}" for i in range(400)]
    some = lambda: " ".join(rnd.choices(words, [1 / (i + 1) for i in range(400)], k=rnd.choice([0, 3, 40, 160])))
    items = [(i, some(), f"s{i % 3}") for i in range(300)]
    rows = [(i % 50, some()) for i in range(60)]
    c, b = spark.createDataFrame(rows, "c int, text string"), spark.createDataFrame(items, "b int, text string, source string")
    got = matching.compared(c, b, "c", "b", 4, backend, source="source")
    grams = lambda t: t.split() + ([" ".join(p) for p in zip(t.split(), t.split()[1:])] if backend == "tfidf" else [])
    df = collections.Counter(g for _, t, _ in items for g in set(grams(t)))
    idf = lambda g: math.log((1 + len(items)) / (1 + df[g])) + 1 if backend == "tfidf" else 1.0
    vector = lambda t: {g: n * idf(g) for g, n in collections.Counter(grams(t)).items() if backend != "tfidf" or df[g]}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values())) or 1.0
    own, expected = [(i, vector(t), s) for i, t, s in items], collections.Counter()
    for k, t in rows:
        v = vector(t)
        scores = [(round(sum(x * o.get(g, 0) for g, x in v.items()) / (norm(v) * norm(o)), 6), i, s) for i, o, s in own]
        best = tuple(sorted((-x, i) for x, i, _ in scores)[:4])
        expected[k, best, tuple(max(x for x, _, z in scores if z == f"s{q}") for q in range(3))] += 1
    made = collections.Counter((r.c, tuple((-m.semantic, m.b) for m in r.matches), tuple(r.best[f"s{q}"] for q in range(3))) for r in got.collect())
    assert made == expected
    if backend == "tfidf":  # counts weigh the commonest words most, so that no bound is tight for them
        assert got.agg(F.sum("scored")).first()[0] < 0.9 * 60 * 300


@pytest.mark.parametrize("size", [1 << 20, 600])
def test_equal_and_null_keys_keep_a_row_each(spark, size):
    c = spark.createDataFrame([(1, "a b"), (1, "b q"), (None, "a"), (None, None)], "c int, text string")
    b = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "b", "q", "a q", "b b a", "z"])], "b int, text string")
    found = matching.compared(c, b, "c", "b", 1, slice_bytes=size).collect()
    assert sorted((str(r.c), r.matches[0].b, r.matches[0].semantic) for r in found) == [("1", 0, 1.0), ("1", 1, 0.707107), ("None", 0, 0.0), ("None", 0, 0.707107)]


def test_summary_counts_sources_without_a_score(spark):
    c = spark.createDataFrame([(1, "a b"), (2, None)], "c int, text string")
    b = spark.createDataFrame([(10, "a b", "s"), (11, "a q r", "t"), (12, "z", "u")], "b int, text string, source string")
    got = {r.c: r for r in matching.summarized(matching.compared(c, b, "c", "b", 2, source="source"), "c", {"u": 2.0}, score="semantic").collect()}
    # 1, 1 / sqrt(6) and 0 by source, with weights 1, 1 and 2
    assert (got[1].balanced_score, got[1].coverage, got[1].best_source) == (0.352062, 0.25, "s")
    assert (got[1].max_similarity, got[1].mean_topk_similarity) == (1.0, 0.704124)
    assert (got[2].balanced_score, got[2].coverage, got[2].best_source, got[2].selection_score) == (0.0, 0.0, "s", 0.0)


def test_backends():
    assert matching.backend_of(["id", "embedding"]) == "embedding" and matching.backend_of(["id", "text"]) == "tfidf"
    with pytest.raises(ValueError):
        matching.backend_of(["id"], "embedding")


def test_nearest_rows_in_slices(spark):
    rows = spark.range(200).selectExpr("id", "array(cos(id * id), sin(id * id)) as v")
    one, many = (sorted(map(tuple, matching.nearest_rows(rows.repartition(k), rows.where("id % 50 = 0"), "id", "v", 4, slice_bytes=n).collect())) for k, n in ((1, 1 << 20), (3, 20)))
    assert len(one) == 16 and set(one) <= set(many)
    assert matching.nearest_rows(rows, rows.limit(0), "id", "v", 4).count() == 0
    c = rows.selectExpr("id as c", "v as embedding")
    assert matching.compared(c, c.limit(0).withColumnRenamed("c", "b"), "c", "b", 2, "embedding").where("size(matches) = 0").count() == 200


# -- calls and verdicts -----------------------------------------------------------------------------------------------------------


def test_calls_are_retried_elsewhere_or_given_up(spark):
    def transport(endpoint, payload):
        if payload == "bad":
            return 400, ""
        if endpoint == "down":
            return 500, ""
        return 200, f"{payload}!"

    rows = [(f"i{k}", "hello", None) for k in range(20)] + [("x", "bad", None), ("l", "", "local")]
    requests = spark.createDataFrame(rows, "id string, payload string, local string")
    got = {r.id: r for r in calls.called(requests, ["down", "up"], transport, calls.Retries(2, 0.0)).collect()}
    assert len(got) == 22 and all(got[f"i{k}"].response == "hello!" and got[f"i{k}"].endpoint == "up" for k in range(20))
    assert {got[f"i{k}"].attempts for k in range(20)} == {1, 2}
    assert got["x"].attempts == 1 and got["x"].stage == "llm_request" and got["x"].error == "status 400"
    assert got["l"].response == "local" and got["l"].attempts == 0


def test_least_loaded_follows_weights():
    assert calls.least_loaded([1, 1], [1.0, 4.0]) == 1
    assert calls.least_loaded([0, 0, 0], [1.0, 1.0, 1.0], first=2) == 2


def reply(text):
    return json.dumps({"choices": [{"message": {"content": text}}]})


def test_verdicts(spark):
    texts = {
        "scores": reply('```json\n{"relevance_score": 5, "necessity_score": 9, "reason": "r"}\n```'),
        "labels": reply('{"relevance": "Relevant", "necessity": "unnecessary"}'),
        "broken": reply('{"relevance_score": 4, "necessity_score": 2, "reason": "un'),
        "none": reply("no object"),
        "empty": "{}",
    }
    df = spark.createDataFrame(list(texts.items()), "k string, response string")
    got = {r.k: r.v for r in df.select("k", verdict.parsed(F.col("response")).alias("v")).collect()}
    assert (got["scores"].relevance_score, got["scores"].necessity_score, got["scores"].reason) == (5.0, 5.0, "r")
    assert (got["labels"].relevance, got["labels"].necessity, got["labels"].necessity_score) == ("relevant", "unnecessary", 1.0)
    assert (got["broken"].relevance, got["broken"].necessity) == ("relevant", "unnecessary")
    assert got["none"].relevance == got["empty"].relevance == "unknown"


def test_necessity_judged_again(spark):
    fields = ["relevance_score", "relevance", "reason"]
    rows = [("5", None, "r", 4.25, "n", True), ("3", "relevant", "r", 5.0, "", True), (None, "Relevant", None, None, "n", True), ("5", "relevant", "r", 5.0, "n", False), ("x", "relevant", "r", 9.0, "n", None)]
    df = spark.createDataFrame(rows, "relevance_score string, relevance string, reason string, score double, said string, asked boolean")
    old = F.when(F.coalesce(F.col("reason"), F.lit("")) != "gone", F.struct(*fields))
    made = verdict.rejudged_verdict(old, fields, F.struct(F.col("score"), F.col("said").alias("reason")), F.col("asked"))
    got = [(r.v.verdict.necessity_score, r.v.verdict.necessity, r.v.verdict.reason_necessity, r.v.verdict.reason, r.v.keep) for r in df.select(made.alias("v")).collect()]
    assert got == [(4.2, "necessary", "n", "r", True), (5.0, "necessary", None, "r", False), (1.0, "unnecessary", "n", None, False), (None, "unknown", None, "r", False), (None, "unknown", None, "r", False)]
    gone = df.limit(1).select(verdict.rejudged_verdict(F.lit(None).cast("struct<relevance_score string, relevance string, reason string>"), fields, F.struct(F.lit(5.0).alias("score"), F.lit("n").alias("reason")), F.lit(True)).alias("v")).first().v
    assert (gone.verdict.necessity_score, gone.verdict.relevance, gone.keep) == (5.0, None, False)


def test_any_value_as_text_and_all_that_it_holds(spark):
    schema = "a struct<z string, text string>, b struct<z string, y boolean>, c array<string>, d map<string, array<int>>, e boolean, f string, g array<struct<n int, m array<string>>>"
    rows = [(("p", " q "), ("p", True), [" u ", "", None, "v"], {"k": [1, 2]}, False, " x\n", [(1, ["a", None]), (None, ["b"])]), (None, None, None, None, None, None, None), (("p", None), (None, None), [], {}, True, "", [])]
    df = spark.createDataFrame(rows, schema)
    text = lambda c: readers.text_of(F.col(c), df.schema[c].dataType).alias(c)
    held = lambda c: readers.values_of(F.col(c), df.schema[c].dataType).alias(c)
    first, nulls, empty = df.select(*map(text, "abcef")).collect()
    assert tuple(first) == ("q", '{"y":true,"z":"p"}', "u | v", "False", "x")
    assert tuple(nulls) == (None, None, "", None, None) and tuple(empty) == (None, "{}", "", "True", "")
    first, nulls, empty = df.select(*map(held, "abcdefg")).collect()
    assert tuple(first) == (["p", " q "], ["p", "True"], [" u ", "", "v"], ["1", "2"], ["False"], [" x\n"], ["1", "a", "b"])
    assert all(x == [] for x in nulls) and tuple(empty) == (["p"], [], [], [], ["True"], [""], [])


def test_profiles_read_all_values_of_the_metadata(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", [{"id": "1", "question": "q", "more": {"deep": [{"name": "basketball"}], "none": None}, "flag": True}, {"id": "2", "question": "q2", "more": None}])
    spec = readers.SourceSpec("s", [path], metadata=["more", "flag", "absent"])
    got = {r.source_record_id: r for r in loaders.sourced(spark, [spec]).collect()}
    assert got["1"].metadata == {"more": '{"deep":[{"name":"basketball"}]}', "flag": "True"} and got["2"].metadata == {}
    assert "metadata_values" not in got["1"] and (got["1"].profile.domain_tags, got["2"].profile.domain_tags) == (["basketball"], [])
