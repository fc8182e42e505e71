"""A sink of results and errors that are committed together.

A batch writes its results and its errors to folders of its number and then a commit of that number, a small file that is put in place by one
rename. Readers see committed batches only. A batch that was stopped before its commit is written again under its number, over what it had left, so that
no row is there twice; one that was stopped after it finds the commit and does nothing.

`Flush` decides when a batch is due: as soon as so many rows wait, or so many seconds after the last one if any wait."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.readers import exists
from ..sources.scratch import release, written

BATCH = "batch"


class Sink:
    """results, errors and commits under one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def commits(self) -> dict[int, dict]:
        """What each committed batch has written: rows, results, errors and what else was observed."""
        if not exists(self.spark, f"{self.folder}/commits"):
            return {}
        rows = self.spark.read.schema("batch long, figures map<string, long>").json(f"{self.folder}/commits").collect()
        return {r.batch: dict(r.figures) for r in rows}

    def commit(self, rows: DataFrame, number: int, failed: Column, figures: dict[str, Column] | None = None) -> dict[str, int]:
        """Writes rows, those where `failed` holds as errors, and returns what was counted in the pass that made them. rows is evaluated once."""
        if (had := self.commits().get(number)) is not None:
            return had
        wrong = F.coalesce(failed, F.lit(False))
        seen = Observation(f"{self.folder} {number}")
        counted = {"rows": F.count(F.lit(1)), "errors": F.count_if(wrong), **(figures or {})}
        held = written(rows.withColumn("__failed", wrong).observe(seen, *[c.cast("long").alias(k) for k, c in counted.items()]), "batch")
        found = {k: int(v or 0) for k, v in seen.get.items()}
        for name, part in (("results", held.where("not __failed")), ("errors", held.where("__failed"))):
            part.drop("__failed").write.mode("overwrite").parquet(f"{self.folder}/{name}/{BATCH}={number}")
        text = json.dumps({"batch": number, "figures": found})
        (draft, files), (final, _) = self._path(f"_drafts/{number}.json"), self._path(f"commits/{number}.json")
        out = files.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        files.mkdirs(final.getParent())
        if not files.rename(draft, final):
            raise RuntimeError(f"batch {number} could not be committed")
        release(held)
        return found

    def read(self, name: str, schema: T.StructType | str) -> DataFrame:
        """Results or errors of committed batches, with the batch's number."""
        whole = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        numbers = sorted(self.commits())
        if not numbers:
            return self.spark.createDataFrame([], T.StructType([*whole.fields, T.StructField(BATCH, T.LongType())]))
        rows = self.spark.read.schema(T.StructType([*whole.fields, T.StructField(BATCH, T.LongType())])).parquet(f"{self.folder}/{name}")
        return rows.where(F.col(BATCH).isin(numbers))


@dataclass
class Flush:
    """Due when `rows` wait, or when any wait and `seconds` have gone since the last one."""

    rows: int
    seconds: float
    clock: Callable[[], float] = time.monotonic
    last: float = field(init=False)

    def __post_init__(self) -> None:
        self.last = self.clock()

    def due(self, waiting: int) -> bool:
        return waiting >= self.rows or waiting > 0 and self.clock() - self.last >= self.seconds

    def done(self) -> None:
        self.last = self.clock()


def run_flushed(
    source: Callable[[], DataFrame], waiting: Callable[[int], int], sink: Sink, checkpoint: str, call: Callable[[DataFrame], DataFrame], failed: Column, flush: Flush, going: Callable[[], bool], poll: float = 0.5
) -> int:
    """Reads what arrives whenever a flush is due, until `going` says no more; then the rest. Returns the rows read.

    source makes the stream, waiting tells how many rows are there beyond those that were read; call makes a result or an error of each row."""
    read = sum(x["rows"] for x in sink.commits().values())

    def once() -> None:
        def batch(df: DataFrame, number: int) -> None:
            sink.commit(call(df), number, failed)

        source().writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        flush.done()

    while going():
        if flush.due(waiting(read)):
            once()
            read = sum(x["rows"] for x in sink.commits().values())
        else:
            time.sleep(poll)
    if waiting(read) > 0:
        once()
    return sum(x["rows"] for x in sink.commits().values())
