"""Incremental runs and the sink that commits results and errors together."""

import pytest
from pyspark.sql import functions as F

from sievework.streaming import committed, incremental


def test_an_id_is_processed_once_and_its_row_does_not_depend_on_partitions(spark, tmp_path):
    out = []
    for n in (1, 5):
        data, to, check = (str(tmp_path / f"{x}{n}") for x in ("in", "out", "check"))
        seen = []
        for rows in ([(i % 7, f"v{i}") for i in range(40)] + [(None, "x")], [(i, "later") for i in range(5, 9)], [(0, "again")]):
            spark.createDataFrame(rows, "id long, v string").repartition(n).write.mode("append").parquet(data)
            incremental.run_available(incremental.stream_of(spark, data, "id long, v string"), to, check, progress=seen.append, done=spark.createDataFrame([(8,)], "id long"))
        out.append(sorted((r.id, r.v) for r in spark.read.parquet(to).collect()))
        assert [(p["rows"], p["written"]) for p in seen] == [(41, 7), (4, 1), (1, 0)]
    assert out[0] == out[1] == [(0, "v0"), (1, "v1"), (2, "v16"), (3, "v10"), (4, "v11"), (5, "v12"), (6, "v13"), (7, "later")]


def test_what_a_batch_reads_does_not_grow_with_batches(spark, tmp_path):
    data, to, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    reads = []

    def counted(df):
        reads.append(df.count())
        return df

    for k in range(6):
        spark.range(100 * k, 100 * k + 100).write.mode("append").parquet(data)
        incremental.run_available(incremental.stream_of(spark, data, "id long"), to, check, transform=counted)
    assert reads == [100] * 6 and spark.read.parquet(to).count() == 600


def rows_of(sink, name):
    return sorted((r.id, r.batch) for r in sink.read(name, "id long, bad boolean").collect())


def test_a_killed_batch_repeats_without_a_double_row(spark, tmp_path):
    sink = committed.Sink(spark, str(tmp_path / "sink"))
    rows = spark.createDataFrame([(i, i % 3 == 0) for i in range(9)], "id long, bad boolean")
    assert sink.commit(rows, 0, F.col("bad"), {"largest": F.max("id")}) == {"rows": 9, "errors": 3, "largest": 8}
    # stopped after its results, before its commit
    spark.range(90, 95).withColumn("bad", F.lit(False)).write.parquet(f"{sink.folder}/results/batch=1")
    assert len(rows_of(sink, "results")) == 6
    sink.commit(spark.createDataFrame([(90, False), (91, None)], "id long, bad boolean"), 1, F.col("bad"))
    assert rows_of(sink, "results") == [(i, 0) for i in range(9) if i % 3] + [(90, 1), (91, 1)]
    # stopped after its commit
    assert sink.commit(rows, 1, F.col("bad")) == {"rows": 2, "errors": 0}
    assert rows_of(sink, "errors") == [(0, 0), (3, 0), (6, 0)] and set(sink.commits()) == {0, 1}


def test_rows_are_made_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def slow(i):
        calls.add(1)
        return i % 2 == 0

    sink = committed.Sink(spark, str(tmp_path / "sink"))
    assert sink.commit(spark.range(20).withColumn("bad", slow("id")), 7, F.col("bad")) == {"rows": 20, "errors": 10}
    assert calls.value == 20


def test_flush_is_due_by_rows_or_seconds():
    now = [0.0]
    flush = committed.Flush(10, 5.0, clock=lambda: now[0])
    assert not flush.due(9) and flush.due(10) and not flush.due(0)
    now[0] = 5.0
    assert flush.due(1) and not flush.due(0)
    flush.done()
    assert not flush.due(9)


def test_a_run_flushes_what_arrives(spark, tmp_path):
    data, check, sink = str(tmp_path / "in"), str(tmp_path / "check"), committed.Sink(spark, str(tmp_path / "sink"))
    spark.range(3).write.parquet(data)
    steps, batches = iter([12, 0, 2]), []

    def going():
        batches.append(sum(x["rows"] for x in sink.commits().values()))
        more = next(steps, None)
        if more:
            start = spark.read.schema("id long").parquet(data).count()
            spark.range(start, start + more).write.mode("append").parquet(data)
        return more is not None

    source = lambda: incremental.stream_of(spark, data, "id long")
    waiting = lambda read: spark.read.schema("id long").parquet(data).count() - read
    call = lambda df: df.withColumn("bad", F.col("id") % 4 == 0)
    total = committed.run_flushed(source, waiting, sink, check, call, F.col("bad"), committed.Flush(10, 1000.0), going, poll=0.01)
    # 3 rows wait, 15 are due, 2 are left for the end
    assert total == 17 and batches == [0, 15, 15, 15]
    assert len(rows_of(sink, "results")) == 12 and len(rows_of(sink, "errors")) == 5


def test_an_empty_sink(spark, tmp_path):
    sink = committed.Sink(spark, str(tmp_path / "sink"))
    assert sink.commits() == {} and sink.read("results", "id long").count() == 0
    assert sink.commit(spark.createDataFrame([], "id long, bad boolean"), 0, F.col("bad")) == {"rows": 0, "errors": 0}
    with pytest.raises(Exception, match="nothing"):
        sink.commit(spark.range(1).withColumn("bad", F.expr("raise_error('nothing')").isNull()), 1, F.col("bad"))
    assert set(sink.commits()) == {0}
