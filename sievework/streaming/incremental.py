"""Incremental runs: a folder that grows is read from where the last run stopped.

Each batch is written to a folder of its own number, which a repeated batch overwrites, so that a retry adds nothing twice. Which ids have been
processed is keyed state in the checkpoint, in RocksDB: a batch reads and writes the state of its own ids, and no batch reads the output of
former ones."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sources.readers import exists

BATCH = "batch"


class _Stop(Exception):
    """Ends a query before its batch is taken as read."""


def stream_of(spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "parquet", files: int = 0) -> DataFrame:
    reader = spark.readStream.format(kind).schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).load(path)


def written_before(spark: SparkSession, output: str, schema: T.StructType, number: int | None = None) -> DataFrame:
    """What other batches than `number` have written."""
    if not exists(spark, output):
        return spark.createDataFrame([], schema)
    found = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(output)
    return (found.where(F.col(BATCH) != number) if number is not None else found).drop(BATCH)


def _write(df: DataFrame, output: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{output}/{BATCH}={number}")


def _started(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None, mode: str = "append", name: str | None = None):
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = stream.writeStream.queryName(name) if name else stream.writeStream
    return writer.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()


_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def first_rows(stream: DataFrame, key: str) -> DataFrame:
    """A row for each id of a batch: (row, first, last), the smallest of the id's rows so far, and the times of the first and the latest batch that had the id.

    Where the times are equal, the batch is the id's first one, and the row is the smallest of its rows in that batch, whatever partitions they were in."""
    whole = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    rows = stream.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.to_json(whole).alias("text"), whole.alias("row"), F.current_timestamp().alias("time"))
    return rows.groupBy("key").agg(F.min_by("row", "text").alias("row"), F.min("time").alias("first"), F.max("time").alias("last")).drop("key")


def run_available(
    stream: DataFrame, output: str, checkpoint: str, key: str = "id", transform: Callable[[DataFrame], DataFrame] | None = None, progress: Callable[[dict], None] | None = None, done: DataFrame | None = None
) -> int:
    """Processes what is there and not yet done, each id once over all runs with this checkpoint, and returns the rows read. progress gets what each batch has done, when it is done.

    done: ids (key) of other outputs, which count as processed. Rows without an id are skipped."""
    spark, total = stream.sparkSession, [0]

    def batch(df: DataFrame, number: int) -> None:
        rows = df.where(F.col("first") == F.col("last")).select("row.*")
        rows = rows.join(done.select(key).distinct(), key, "left_anti").select(*rows.columns) if done is not None else rows
        kept = Observation(f"batch {number}")
        _write((transform(rows) if transform else rows).observe(kept, F.count(F.lit(1)).alias("rows")), output, number)
        written[number] = kept.get["rows"]

    written: dict[int, int] = {}

    class Reports(StreamingQueryListener):
        """Every batch reports once; a query's own list of reports keeps the last hundred only."""

        def onQueryStarted(self, event) -> None:
            if event.name == name:
                own.append(str(event.id))

        def onQueryProgress(self, event) -> None:
            p = event.progress
            if p.name == name:
                total[0] += p.numInputRows
                if progress and p.batchId in written:
                    progress({"batch": p.batchId, "rows": p.numInputRows, "written": written.pop(p.batchId), "rows_per_second": p.processedRowsPerSecond})

        def onQueryTerminated(self, event) -> None:
            if str(event.id) in own:
                ended.set()

    before = {k: spark.conf.get(k, None) for k in _STATE}
    ended, reports, own, name = threading.Event(), Reports(), [], f"run-{uuid.uuid4().hex}"
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    spark.streams.addListener(reports)
    try:
        query = _started(first_rows(stream, key), batch, checkpoint, None, "update", name)
        query.awaitTermination()
        ended.wait(30)
    finally:
        spark.streams.removeListener(reports)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return total[0]


def run_continuously(stream: DataFrame, output: str, checkpoint: str, seconds: float):
    """Starts a query that appends what has arrived every so many seconds; the caller stops it."""
    return _started(stream, lambda df, number: _write(df, output, number), checkpoint, f"{seconds} seconds")


def run_until_dirty(stream: DataFrame, output: str, checkpoint: str, dirty: str, most: int) -> int:
    """Writes batches until `most` rows of this and earlier runs meet the condition; returns how many do.

    The batch after that ends the query and stays unread: a later run with a larger number goes on with it."""
    spark, fields = stream.sparkSession, stream.schema

    def bad(number: int | None = None) -> int:
        return written_before(spark, output, fields, number).where(dirty).count()

    def batch(df: DataFrame, number: int) -> None:
        if bad(number) >= most:
            raise _Stop
        _write(df, output, number)

    if (had := bad()) >= most:
        return had
    query = _started(stream, batch, checkpoint, None)
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if _Stop.__name__ not in str(e):
            raise
    return bad()
