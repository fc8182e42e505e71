"""Many files in one run, and outputs that change as a whole.

`run_files` takes the files that have no mark yet, some at a time, through one plan; their rows go to a folder for each file, which a repeated run
overwrites, and then each file gets its mark. `Versions` keeps an output in numbered folders; a small file names the one that
is read, and is replaced by one rename after a new version is whole, so that a failed run leaves the old one readable."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.readers import exists

FILE = "file"


def marked(spark: SparkSession, folder: str) -> DataFrame:
    """(file, rows) of the files that are done."""
    path = f"{folder.rstrip('/')}/_marks"
    rows = spark.read.schema("file string, rows long").json(path) if exists(spark, path) else spark.createDataFrame([], "file string, rows long")
    return rows.groupBy(FILE).agg(F.max("rows").alias("rows"))


def run_files(spark: SparkSession, files: list[str], read: Callable[[list[str]], DataFrame], transform: Callable[[DataFrame], DataFrame], folder: str, at_once: int = 100) -> dict[str, int]:
    """Rows written of each file that was not done before. read gives rows of these files with a column `file`, their names as given; transform keeps the column.

    The files of a step are one job; a step that fails leaves those before it done. Files without rows are done too."""
    folder, counts = folder.rstrip("/"), {}
    done = {r.file for r in marked(spark, folder).toLocalIterator()}
    todo = [f for f in dict.fromkeys(files) if f not in done]
    for i in range(0, len(todo), at_once):
        step = todo[i : i + at_once]
        rows = transform(read(step))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FILE).parquet(f"{folder}/rows")
        kept = spark.read.schema(rows.schema).parquet(f"{folder}/rows").where(F.col(FILE).isin(step)).groupBy(FILE).count() if exists(spark, f"{folder}/rows/{FILE}=*") else None
        found = {f: 0 for f in step} | ({r[FILE]: r["count"] for r in kept.collect()} if kept is not None else {})
        spark.createDataFrame(list(found.items()), "file string, rows long").coalesce(1).write.mode("append").json(f"{folder}/_marks")
        counts |= found
    return counts


class Versions:
    """An output in folders of versions."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _files(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def current(self) -> int | None:
        """The number of the version that is read."""
        if not exists(self.spark, f"{self.folder}/current-*"):
            return None
        rows = self.spark.read.schema("version long").json(f"{self.folder}/current-*").collect()
        return max(r.version for r in rows)

    def rewrite(self, rows: DataFrame, *by: str) -> int:
        """A new version of all rows, in folders by these columns; it is read from when it is whole."""
        number = 0 if (now := self.current()) is None else now + 1
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).json(f"{self.folder}/version-{number}")
        (draft, files), (final, _) = self._files(f"_draft-{number}"), self._files(f"current-{number}")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps({"version": number}).encode()))
        out.close()
        if not files.rename(draft, final):
            raise RuntimeError(f"version {number} could not be put in place")
        return number

    def read(self, schema: T.StructType | str) -> DataFrame:
        number = self.current()
        if number is None:
            raise FileNotFoundError(self.folder)
        return self.spark.read.schema(schema).json(f"{self.folder}/version-{number}")

    def drop_old(self, keep: int = 1) -> None:
        """Removes versions older than the last `keep` ones."""
        last = self.current()
        for k in range(0, (last if last is not None else -1) + 1 - keep):
            for name in (f"version-{k}", f"current-{k}"):
                path, files = self._files(name)
                files.delete(path, True)
