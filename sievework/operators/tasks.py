"""Tasks: what is loaded, what is asked about it, how answers are read and what is made of the results; and a run of one.

A task is a plan over DataFrames. A run leaves out what an earlier run has done, writes the answers before it reads them, and appends
results and errors each in one job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import exists
from . import calls, resume


@dataclass(frozen=True)
class Task:
    """load: items with an id; requests: (id, payload, local, perhaps second) of items; parse: results with an id from items joined to
    `response` and `second`; finalize: whatever follows from all results, by name."""

    name: str
    load: Callable[[SparkSession], DataFrame]
    requests: Callable[[DataFrame], DataFrame]
    parse: Callable[[DataFrame], DataFrame]
    finalize: Callable[[DataFrame], dict] = field(default=lambda results: {})


_TASKS: dict[str, Task] = {}


def register(task: Task) -> Task:
    if task.name in _TASKS:
        raise ValueError(f"there is a task {task.name!r} already")
    _TASKS[task.name] = task
    return task


def task(name: str) -> Task:
    if name not in _TASKS:
        raise ValueError(f"no task {name!r}; there are {', '.join(names())}")
    return _TASKS[name]


def names() -> list[str]:
    return sorted(_TASKS)


def run(spark: SparkSession, what: Task, output: str, errors: str, endpoints: list[str], transport: calls.Transport, retries: calls.Retries | None = None, again: bool = True, **options) -> dict:
    """Processes the items that are not yet in the output (all, unless `again`), and returns counts and what finalize gives.

    Answers go to a folder beside the output that a new run overwrites; results and errors are appended as JSON lines."""
    items = what.load(spark)
    done = resume.processed_ids(spark, output) if again and exists(spark, output) else spark.createDataFrame([], "id string")
    counts = resume.resume_summary(items, done).first().asDict()
    todo = resume.accepted(items, done, "id", "id")
    answers, place = calls.called(what.requests(todo), endpoints, transport, retries, **options), f"{output.rstrip('/')}-answers"
    answers.write.mode("overwrite").parquet(place)
    answers = spark.read.parquet(place)
    fine = answers.where("error is null").select(F.col("id").alias("__id"), "response", "second")
    results = what.parse(todo.join(fine, F.col("id").cast("string") == F.col("__id")).drop("__id"))
    results.write.mode("append").json(output)
    failed = calls.split(answers)[1]
    failed.write.mode("append").json(errors)
    counts |= answers.agg(F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.coalesce(F.sum("attempts"), F.lit(0)).alias("attempts")).first().asDict()
    return counts | what.finalize(spark.read.schema(results.schema).json(output))
