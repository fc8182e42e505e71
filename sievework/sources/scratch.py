"""Tables that a run writes for itself, in the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_places: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The named folder; one temporary folder for the process where none is named and the master is local. Elsewhere executors would
    write to folders that the others cannot see, so that is an error."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _own:
        kept = tempfile.TemporaryDirectory(prefix="sievework-", ignore_cleanup_errors=True)
        atexit.register(kept.cleanup)
        _own["dir"] = kept.name
    return _own["dir"]


def new_folder(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder; it is removed when the driver exits."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, path)
        except Exception:  # the session is gone: nothing can be removed any more
            return


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cuts the lineage: df as a Parquet table in the shared folder, which survives the loss of executors."""
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    _places[found] = path
    return found


def release(*tables: DataFrame) -> None:
    """Removes tables that written() has made and nothing reads any more."""
    for df in tables:
        delete(df.sparkSession, _places.pop(df))
