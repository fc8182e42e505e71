"""Loaders, runs of tasks, calls, settings and streams on small files."""

import json

import pytest
from pyspark.sql import functions as F

from sievework import config
from sievework.operators import calls, runs, tasks
from sievework.sources import loaders, readers
from sievework.streaming import incremental


def lines(path, rows):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
    return str(path)


# -- loaders --------------------------------------------------------------------------------------------------------------------------


def caption(text):
    return [{"role": "user", "content": "  "}, {"role": "assistant", "content": text}]


def test_caption_items(spark, tmp_path):
    text = "### 1. Motion Detail\n- **1 - 4.5 seconds**: a dog runs\n### 2. Highlight\n- **At approximately 3 seconds**: it barks"
    good = {"id": "x", "images_source": ["/f/clip_d30.5_a.mp4", " "], "messages": caption(text)}
    path = lines(tmp_path / "clips_60s.jsonl", [good, "", {"id": "", "messages": caption(text)}, {"id": "y", "messages": []}, {"id": "z", "messages": caption("plain")}])
    got = {r.video_id: r for r in loaders.caption_items(spark, [path]).collect()}
    assert set(got) == {"clip_d30.5_a", "z"}
    first = got["clip_d30.5_a"]
    assert first.duration_sec == 30.5 and [s.type for s in first.segments] == ["range", "point"] and first.images_source == ["/f/clip_d30.5_a.mp4"]
    assert got["z"].duration_sec == 60.0 and got["z"].segments == []
    assert [r.video_id for r in loaders.caption_items(spark, [path], most=1).collect()] == ["clip_d30.5_a"]
    with pytest.raises(Exception):  # noqa: B017
        loaders.caption_items(spark, [lines(tmp_path / "bad.jsonl", [good, "{broken"])]).collect()
    with pytest.raises(FileNotFoundError):
        loaders.caption_items(spark, [str(tmp_path / "none.jsonl")])


def test_broken_lines_are_skipped_or_raise(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", [{"id": "1"}, "{broken", "[1]", " ", {"id": "2"}])
    assert [r.id for r in loaders.json_lines(spark, [path], "id string").collect()] == ["1", "2"]
    broken = lines(tmp_path / "b.jsonl", [{"id": "1"}, "{broken"])
    assert readers.read_records(spark, [broken], "id string").count() == 1
    with pytest.raises(Exception):  # noqa: B017
        readers.read_records(spark, [broken], "id string", strict=True).collect()


def test_heads_of_files(spark, tmp_path):
    ask = lambda q: {"messages": [{"role": "user", "content": q}]}
    path = lines(tmp_path / "f.jsonl", [ask(" a  b "), ask(""), "{", ask("c"), ask("d")])
    assert sorted(r.question for r in loaders.heads(spark, [path], 2, filled=True).collect()) == ["a b", "c"]
    assert sorted(r.question for r in loaders.heads(spark, [path], 2, filled=False).collect()) == ["", "a b"]


def test_lists_of_files(spark, tmp_path):
    for name, size in (("b.jsonl", 9), ("a.jsonl", 3), ("a_clean.jsonl", 1), ("other_a.jsonl", 1), ("x.txt", 1)):
        (tmp_path / name).write_text("x" * size)
    found = loaders.listed(spark, str(tmp_path))
    assert found.count() == 4
    assert [r.file for r in loaders.to_clean(found).collect()] == ["a.jsonl", "b.jsonl"]
    assert [r.file for r in loaders.to_clean(found, ["b.jsonl"]).collect()] == ["b.jsonl"]
    wanted = spark.createDataFrame([("a.jsonl",), ("a.jsonl",), ("a_clean.jsonl",), ("none.jsonl",), ("other_a.jsonl",)], "file string")
    assert [r.file for r in loaders.present(wanted, found, ["other"]).collect()] == ["a.jsonl"]
    assert loaders.present(wanted, found, [], variants=True).count() == 3
    assert loaders.rules('{"exact": {"a": "x"}, "hints": {"k": ["y"]}, "prefixes": ["p"]}') == {"exact": {"a": ["x"]}, "hints": {"k": ["y"]}, "prefixes": ["p"]}


def test_images_and_known_sources(spark, tmp_path):
    (tmp_path / "i.png").write_bytes(b"\x89PNG")
    got = loaders.images(spark, [str(tmp_path / "i.png")]).first()
    assert (got.data, got.mime) == ("iVBORw==", "image/png")
    specs = {s.name: s for s in loaders.known_sources("/root/", 5)}
    assert len(specs) == 7 and specs["molmo2_longcapqa"].explode == "qa_list" and all(s.limit == 5 for s in specs.values())


# -- outputs --------------------------------------------------------------------------------------------------------------------------


def test_tuning_tags_and_outputs(spark, tmp_path):
    rows = [
        ("1", "/d/Molmo2-VideoCountEval/x.mp4", ["How many dogs?", "count of cats"], "a_0_60s.jsonl"),
        ("2", "/d/Molmo2-VideoCountEval/x.mp4", ["How many dogs?", "find the dog"], "a_0_60s.jsonl"),
        ("3", "/d/Molmo2-Cap/x.mp4", [], "b_180_600s.jsonl"), ("4", "/d/none.mp4", ["why?"], "c.jsonl"),
    ]
    df = spark.createDataFrame(rows, "id string, path string, questions array<string>, name string")
    tagged = df.select("id", runs.tuning_tags(F.col("path"), F.col("questions"), F.col("name")).alias("tags"))
    got = {r.id: r.tags for r in tagged.collect()}
    assert got["1"].keep and got["1"].question_skill_counts == {"counting": 2} and got["1"].target_buckets == ["short_counting_problem"] and got["1"].source_name == "molmo2_videocounteval"
    assert got["2"].drop_reason == "count_eval_non_pure_counting" and got["2"].question_skill_counts == {"counting": 1, "general": 1} and got["2"].target_buckets == []
    assert got["3"].skill_bucket == "summary" and got["3"].question_count == 0 and got["4"].drop_reason == "unknown_source"
    counts = {(r.file, r.dimension, r.value): r.n for r in runs.tuning_outputs(tagged, str(tmp_path / "out")).collect()}
    assert counts[None, "family", "count_eval"] == 2 and counts["a_0_60s.jsonl", "drop_reason", "count_eval_non_pure_counting"] == 1
    assert sorted(r.id for r in spark.read.json(str(tmp_path / "out/filtered")).collect()) == ["1", "3"]
    assert spark.read.json(str(tmp_path / "out/tags")).count() == 4


def test_selector_outputs(spark, tmp_path):
    rows = [("i", "x", "f", 0.9), ("i", "y", "f", 0.8), ("j", "x", "g", 0.7), ("k", "y", "g", 0.6)]
    selected = spark.createDataFrame(rows, "id string, bucket_key string, source_family string, selection_score double")
    weights = spark.createDataFrame([("x", 3.0), ("y", 1.0), ("z", 9.0)], "bucket_key string, priority_score double")
    plan = {(r.bucket_key, r.family): (r.bucket_weight, r.source_share) for r in runs.selector_outputs(selected, weights, str(tmp_path), 2).collect()}
    assert plan == {("x", "f"): (0.75, 0.5), ("x", "g"): (0.75, 0.5), ("y", "f"): (0.25, 0.5), ("y", "g"): (0.25, 0.5)}
    assert sorted(r.id for r in spark.read.json(f"{tmp_path}/merged").collect()) == ["i", "j"]
    assert spark.read.json(f"{tmp_path}/buckets").groupBy("bucket_key").count().count() == 2


def test_primary_skill(spark):
    rows = [("b", ["ocr"]), ("", ["zz", "ocr", "counting"]), (None, ["zz", "yy"]), ("", [])]
    got = spark.createDataFrame(rows, "bucket string, tags array<string>").select(runs.primary_skill(F.col("bucket"), F.col("tags")).alias("s")).collect()
    assert [r.s for r in got] == ["b", "counting", "zz", ""]


# -- calls and tasks ------------------------------------------------------------------------------------------------------------------


def answering(endpoint, payload):
    if payload.startswith("long"):
        return (400, "prompt too long") if len(payload) > 8 else (200, payload)
    if payload == "odd":
        return 200, "not json"
    if payload.startswith("second"):
        return (200, "more") if payload == "second" else (500, "")
    return 200, json.dumps({"said": payload})


def parsed(body):
    return body if body.startswith("long") else json.loads(body)["said"]


def test_too_long_requests_second_ones_and_stages(spark):
    rows = [("a", "hi", None, "second"), ("b", "hi", None, "second fails"), ("c", "long " * 9, None, None), ("d", "odd", None, None), ("e", None, None, None), (None, "hi", None, None), ("f", "hi", "here", None)]
    requests = spark.createDataFrame(rows, "id string, payload string, local string, second string")
    shorten = lambda payload, n: payload[: 12 // n]
    got = {r.id: r for r in calls.called(requests, ["x", "y"], answering, calls.Retries(1, 0.0), pool=calls.Pool(3, "least_inflight_weighted", (1.0, 2.0), (1, 0)), shorten=shorten, parse=parsed).collect()}
    assert (got["a"].response, got["a"].second, got["b"].response, got["b"].second) == ("hi", "more", "hi", None)
    assert got["c"].response.startswith("long") and got["c"].attempts == 1
    assert (got["d"].stage, got["e"].stage, got[None].stage) == ("parse_response", "validate", "validate")
    assert got["f"].response == "here" and got["f"].attempts == 0
    broken = calls.called(requests.where("id = 'c'"), ["x"], answering, calls.Retries(1, 0.0), shorten=lambda p, n: 1 / 0).first()
    assert broken.stage == "build_request"


def test_least_loaded_routing():
    assert calls.least_loaded([1, 1], [1.0, 4.0]) == 1
    assert calls.least_loaded([0, 0, 0], [1.0, 1.0, 1.0], first=2) == 2
    assert calls.least_loaded([0, 0, 0], [1.0, 1.0, 1.0], first=2, attempt=2) == 0
    assert calls.least_loaded([0, 0, 0], [1.0, 1.0, 1.0], first=2, attempt=2, rotate=False) == 2
    assert calls.least_loaded([0, 1], [0.0, 1.0]) == 0


def test_a_task_runs_and_resumes(spark, tmp_path):
    data = tmp_path / "in.jsonl"

    def load(spark):
        return loaders.json_lines(spark, [str(data)], "id string, text string").select("id", "text")

    what = tasks.Task(
        "echo", load, lambda items: items.select("id", F.col("text").alias("payload"), F.when(F.col("text") == "", "empty").alias("local")),
        lambda answers: answers.select("id", "response"), lambda results: {"results": results.count()},
    )
    assert tasks.task(tasks.register(what).name) is what and "echo" in tasks.names()
    for bad in (lambda: tasks.register(what), lambda: tasks.task("none")):
        with pytest.raises(ValueError):
            bad()
    out, errors = str(tmp_path / "out"), str(tmp_path / "errors")
    lines(data, [{"id": str(i), "text": f"t{i}"} for i in range(3)] + [{"id": "x", "text": ""}, {"id": "odd", "text": "odd"}, {"text": "no id"}])
    first = tasks.run(spark, what, out, errors, ["e"], answering, calls.Retries(0, 0.0), parse=parsed)
    assert (first["total"], first["invalid"], first["skipped"], first["succeeded"], first["failed"], first["results"]) == (6, 1, 0, 4, 1, 4)
    assert [r.stage for r in spark.read.json(errors).collect()] == ["parse_response"]
    lines(data, [{"id": str(i), "text": f"t{i}"} for i in range(5)])
    second = tasks.run(spark, what, out, errors, ["e"], answering, calls.Retries(0, 0.0), parse=parsed)
    assert (second["skipped"], second["succeeded"], second["results"]) == (3, 2, 6)


# -- settings -------------------------------------------------------------------------------------------------------------------------


def test_settings(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"task_name": "t", "concurrency": 3, "urls": ["http://a"]}))
    held = config.Settings.read(str(path), {"SIEVEWORK_RESUME": "no", "SIEVEWORK_CONCURRENCY": "7", "SIEVEWORK_BACKOFF": "0.5", "SIEVEWORK_URLS": "http://b, http://c", "SIEVEWORK_TASK_CONFIG": '{"k": 1}'})
    assert (held.task_name, held.resume, held.concurrency, held.backoff, held.urls, held.task_config) == ("t", False, 7, 0.5, ["http://b", "http://c"], {"k": 1})
    assert [(e.name, e.url) for e in held.resolved()] == [("fallback-0", "http://b"), ("fallback-1", "http://c")]
    path.write_text('{"unknown": 1}')
    with pytest.raises(ValueError):
        config.Settings.read(str(path), {})
    with pytest.raises(ValueError):
        config.Settings().resolved()


def test_groups_and_requests(monkeypatch):
    monkeypatch.setenv("A_KEY", "k")
    text = json.dumps({"groups": {"g": {"endpoints": [{"name": "a", "url": "http://a/", "provider": "azure_openai", "auth_type": "api_key", "api_key_env": "A_KEY", "deployment": "d"}]}, "h": [{"name": "b", "url": "http://b", "model": "m", "api_key": "s"}]}})
    (a,), (b,) = config.group(text, "g"), config.group(text, "h")
    url, payload, headers = a.prepared({"model": "x", "n": 1})
    assert url == f"http://a/openai/deployments/d/chat/completions?api-version={config.API_VERSION}" and payload == {"n": 1} and headers["api-key"] == "k"
    assert b.prepared({"n": 1}, {"h": "1"}) == ("http://b", {"model": "m", "n": 1}, {"h": "1", "Authorization": "Bearer s"})
    for bad in (lambda: config.group(text, "none"), lambda: config.group("{}", "g"), lambda: config.Endpoint("x", "").prepared({}), lambda: config.Endpoint("x", "u", auth_type="api_key").prepared({})):
        with pytest.raises(ValueError):
            bad()


# -- streams --------------------------------------------------------------------------------------------------------------------------


def test_a_stopped_stream_goes_on_where_it_stopped(spark, tmp_path):
    data, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for k in range(4):
        spark.createDataFrame([(5 * k + i, i == 0) for i in range(5)], "id long, bad boolean").coalesce(1).write.mode("append").parquet(data)
    source = lambda: incremental.stream_of(spark, data, "id long, bad boolean", files=1)
    assert incremental.run_until_dirty(source(), out, check, "bad", 2) == 2
    assert spark.read.parquet(out).count() == 10
    assert incremental.run_until_dirty(source(), out, check, "bad", 2) == 2 and spark.read.parquet(out).count() == 10
    assert incremental.run_until_dirty(source(), out, check, "bad", 3) == 3 and spark.read.parquet(out).count() == 15
    assert incremental.run_until_dirty(source(), out, check, "bad", 99) == 4
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(20))


def test_progress_and_a_query_at_intervals(spark, tmp_path):
    data, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.range(10).write.parquet(data)
    seen = []
    assert incremental.run_available(incremental.stream_of(spark, data, "id long"), out, check, progress=seen.append) == 10
    assert sum(p["rows"] for p in seen) == 10
    query = incremental.run_continuously(incremental.stream_of(spark, data, "id long"), f"{out}2", f"{check}2", 0.2)
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{out}2").count() == 10
