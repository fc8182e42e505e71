"""Numbered lines, batches of files, versions, limits of endpoints, latency."""


import time

import pytest
from pyspark.sql import functions as F

from sievework.operators import calls, filebatch, latency
from sievework.sources import loaders, readers, sinks


def test_lines_of_files_of_several_splits(spark, tmp_path):
    texts = {"a.jsonl": ["x" * (i % 40) if i % 5 else "" for i in range(3000)], "b.jsonl": ["", "", "last"], "c.jsonl": [""]}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        found = readers.numbered_lines(spark, [f"{tmp_path}/*.jsonl"])
        assert found.rdd.getNumPartitions() > 8
        got = {(r.path.rsplit("/", 1)[1], r.line_number, r.value) for r in found.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {(name, i + 1, x) for name, lines in texts.items() for i, x in enumerate(lines)}


def test_judged_files_and_the_first_rows(spark, tmp_path):
    (tmp_path / "a_judged_2.jsonl").write_text('{"id": "1"}\n\nnot json\n{"id": "2"}\n')
    (tmp_path / "b.jsonl").write_text('{"id": "9"}\n')
    got = [tuple(r) for r in loaders.judged_rows(spark, str(tmp_path), "id string").orderBy("line_number").collect()]
    assert got == [("1", "a_judged_2.jsonl", 1), ("2", "a_judged_2.jsonl", 4)]
    assert loaders.judged_rows(spark, str(tmp_path), "id string", 1).collect()[0].id == "1"
    with pytest.raises(FileNotFoundError):
        loaders.judged_rows(spark, f"{tmp_path}/none", "id string")


def test_only_unfinished_files_run_again(spark, tmp_path):
    table = spark.createDataFrame([(f"f{i % 5}", i) for i in range(20)], "file string, x long")
    seen, broken = [], {"f2"}

    def read(files):
        seen.append(sorted(files))
        return table.where(F.col("file").isin(files))

    fail = lambda rows: rows.withColumn("x", F.when(F.col("file").isin(sorted(broken)), F.raise_error(F.lit("broken"))).otherwise(F.col("x")).cast("long"))
    files, out = [f"f{i}" for i in range(6)], str(tmp_path / "out")
    with pytest.raises(Exception, match="broken"):
        filebatch.run_files(spark, files, read, fail, out, at_once=2)
    broken.clear()
    assert filebatch.run_files(spark, files, read, fail, out, at_once=2) == {"f2": 4, "f3": 4, "f4": 4, "f5": 0}
    assert filebatch.run_files(spark, files, read, fail, out) == {}
    assert seen == [["f0", "f1"], ["f2", "f3"], ["f2", "f3"], ["f4", "f5"]]
    back = spark.read.schema("x long, file string").parquet(f"{out}/rows")
    assert sorted((r.file, r.x) for r in back.collect()) == sorted((f"f{i % 5}", i) for i in range(20))


def test_a_failed_rewrite_leaves_the_old_version(spark, tmp_path):
    out = filebatch.Versions(spark, str(tmp_path / "v"))
    with pytest.raises(FileNotFoundError):
        out.read("id long")
    rows = spark.range(4).withColumn("file", F.concat(F.lit("f"), F.col("id") % 2))
    assert out.rewrite(rows, "file") == 0
    with pytest.raises(Exception, match="broken"):
        out.rewrite(rows.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long")), "file")
    assert out.current() == 0 and out.read("id long, file string").count() == 4
    assert out.rewrite(rows.where("id < 2"), "file") == 1
    assert sorted(map(tuple, out.read("id long, file string").collect())) == [(0, "f0"), (1, "f1")]
    out.drop_old()
    assert out.current() == 1 and out.read("id long").count() == 2


def test_no_endpoint_sees_more_than_its_limit(spark, tmp_path):
    folder = str(tmp_path)

    def counted(endpoint, payload):
        """Notes how many are on their way at this endpoint, over all tasks."""
        import os
        import uuid

        mine = f"{folder}/{endpoint}-{uuid.uuid4().hex}"
        open(mine, "w").close()
        here = sum(x.startswith(f"{endpoint}-") for x in os.listdir(folder))
        time.sleep(0.01)
        os.remove(mine)
        if endpoint == "a" and int(payload) % 4 == 0:
            return 503, "busy"
        return 200, str(here)

    requests = spark.range(120).select(F.col("id").cast("string").alias("id"), F.col("id").cast("string").alias("payload")).repartition(4)
    got = calls.called_in_lanes(requests, ["a", "b", "c"], [1, 2, 1], counted, calls.Retries(2, 0.0)).collect()
    assert len(got) == 120 and all(r.error is None for r in got)
    most = {e: max(int(r.response) for r in got if r.endpoint == e) for e in "abc"}
    assert most["a"] == 1 and most["b"] <= 2 and most["c"] == 1
    assert {r.attempts for r in got} == {1, 2} and all(r.endpoint == "b" for r in got if r.attempts == 2)


def test_lanes_give_up(spark):
    requests = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, payload string")
    got = {r.id: r for r in calls.called_in_lanes(requests, ["a"], [3], lambda e, p: (503, "") if p == "x" else (404, ""), calls.Retries(1, 0.0)).collect()}
    assert (got["1"].status, got["1"].attempts, got["2"].status, got["2"].attempts) == (503, 2, 404, 1)


def test_a_transport_that_breaks_is_an_error_of_its_row(spark):
    def broken(endpoint, payload):
        raise KeyError(payload)

    requests = spark.createDataFrame([("1", "x", None)], "id string, payload string, local string")
    [r] = calls.called(requests, ["a"], broken).collect()
    assert (r.stage, r.attempts, r.response) == ("llm_request", 1, None) and "KeyError" in r.error


def test_sketches_of_runs_are_merged(spark):
    runs = [spark.range(a, b).select(F.lit("e").alias("endpoint"), F.col("id").cast("double").alias("s"), (F.col("id") % 10 == 0).alias("bad")) for a, b in ((0, 400), (400, 1000), (0, 0))]
    sketches = [latency.sketched(r, "s", "endpoint", failed=F.col("bad")) for r in runs]
    [r] = latency.figures(latency.merged(sketches[0].union(sketches[1]).union(sketches[2]), "endpoint"), 50.0).collect()
    assert (r.calls, r.failed, r.mean_seconds, r.calls_per_second) == (1000, 100, 499.5, 20.0)
    assert abs(r.p50 - 500) <= 10 and abs(r.p99 - 990) <= 10
    assert latency.figures(latency.sketched(runs[2], "s")).count() == 0


def test_truthy_columns(spark):
    rows = spark.createDataFrame([(True, 1, "a", [1], 0.0), (False, 0, "", [], 2.0), (None, None, None, None, None)], "b boolean, n int, t string, l array<int>, d double")
    got = [tuple(r) for r in rows.select(*[sinks.truthy(rows, c).alias(c) for c in rows.columns]).collect()]
    assert got == [(True, True, True, True, False), (False, False, False, False, True), (False,) * 5]


def test_sources_with_roles_and_limits(spark, tmp_path):
    spark.createDataFrame([("1", "a?"), ("2", "b?"), ("3", "c?")], "id string, question string").coalesce(1).write.parquet(f"{tmp_path}/one.parquet")
    spark.createDataFrame([("7", "B?"), ("8", "C?"), ("9", " "), ("x", "d?")], "id string, question string").coalesce(1).write.parquet(f"{tmp_path}/two.parquet")
    spec = lambda name, limit=0: readers.SourceSpec(name, [f"{tmp_path}/{name}.parquet"], limit=limit)
    got = loaders.sourced(spark, [spec("one", 2), spec("none"), spec("two")], "benchmark", skip_missing=True)
    assert sorted((r.source_name, r.source_record_id, r.profile.role) for r in got.collect()) == [("one", "1", "benchmark"), ("one", "2", "benchmark"), ("two", "8", "benchmark"), ("two", "x", "benchmark")]
    assert loaders.sourced(spark, [spec("one"), spec("two")], once=False).count() == 6 and loaders.sourced(spark, [spec("one"), spec("two")], most=4).count() == 4
    with pytest.raises(FileNotFoundError):
        loaders.sourced(spark, [spec("one"), spec("none")])
    spark.createDataFrame([("9", " ")], "id string, question string").write.parquet(f"{tmp_path}/blank.parquet")
    with pytest.raises(ValueError, match="no candidate examples"):
        loaders.sourced(spark, [spec("blank")])
    with pytest.raises(ValueError, match="role"):
        loaders.sourced(spark, [spec("one")], "judge")


def test_part_files_of_a_folder_do_not_change_ids(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("q"), F.col("id") % 30).alias("question"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/one/d.parquet")
    rows.orderBy(F.desc("id")).repartition(7).write.parquet(f"{tmp_path}/many/d.parquet")
    found = []
    for part in ("one", "many"):
        spec = lambda name, limit, part=part: readers.SourceSpec(name, [f"{tmp_path}/{part}/*.parquet"], answers=[], limit=limit)
        rows = loaders.sourced(spark, [spec("a", 12), spec("b", 0)]).select("id", "question", "source_path").collect()
        assert {r.source_path.rsplit("/", 2)[1:] == [part, "d.parquet"] for r in rows} == {True}
        found.append(sorted((r.id, r.question) for r in rows))
    assert found[0] == found[1] and ("a:d:0", "q0") in found[0] and len(found[0]) == 30
