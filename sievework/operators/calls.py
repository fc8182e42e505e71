"""External calls: requests are routed to endpoints, sent with retries by a transport that the caller supplies, and answered in rows.

The transport is the only part that talks to a network. It is a function of (endpoint, payload) and returns (status, body); it runs on
the executors, once for each try. A task sends a batch of rows through a pool of threads; no more rows than the pool has threads are on their way, and an
endpoint's own limit holds within each task."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from threading import BoundedSemaphore, Lock

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tables import RETRYABLE
from ..functions.text import md5_modulo
from ..sources.scratch import written

Transport = Callable[[str, str], tuple[int, str]]
ANSWERS = "id string, response string, second string, status int, endpoint string, attempts int, stage string, error string"
#: Words in the body of a 400 that say a request was too long.
TOO_LONG = ("too long", "multimodal prompt", "token", "origin_input_ids")


@dataclass(frozen=True)
class Retries:
    """tries beyond the first, seconds before the second try (they double), whether a retry goes to the next endpoint, and how often a
    request that is too long is made shorter."""

    most: int = 3
    backoff: float = 0.5
    rotate: bool = True
    shorter: int = 2


@dataclass(frozen=True)
class Pool:
    """Rows that a task has on their way, the strategy of routing, and weights and limits of endpoints (0: none)."""

    threads: int = 8
    strategy: str = "stable_hash"
    weights: tuple[float, ...] = ()
    limits: tuple[int, ...] = ()


def route(key: Column, endpoints: int, attempt: int | Column = 1, rotate: bool = True) -> Column:
    """The endpoint of a key: md5 of it modulo the endpoints, one further for each retry."""
    first = md5_modulo(key, endpoints)
    return (first + attempt - 1) % endpoints if rotate else first


def least_loaded(inflight: list[int], weights: list[float], first: int = 0, attempt: int = 1, rotate: bool = True) -> int:
    """The endpoint with the least load for its weight, from `first` on where loads are equal; a retry takes the next in that order."""
    n = len(weights)
    order = sorted(range(n), key=lambda i: (inflight[i] / (weights[i] if weights[i] > 0 else 1.0), (i - first) % n))
    return order[(attempt - 1) % n] if rotate else order[0]


class Router:
    """Endpoints of a task with their load."""

    def __init__(self, endpoints: list[str], pool: Pool, rotate: bool) -> None:
        self.endpoints, self.pool, self.rotate = endpoints, pool, rotate
        self.inflight, self.lock = [0] * len(endpoints), Lock()
        self.weights = list(pool.weights) or [1.0] * len(endpoints)
        limits = list(pool.limits) or [0] * len(endpoints)
        self.gates = [BoundedSemaphore(max(1, min(x, pool.threads))) if x > 0 else nullcontext() for x in limits]

    def pick(self, item: str, attempt: int) -> int:
        first = int(hashlib.md5(item.encode(), usedforsecurity=False).hexdigest(), 16) % len(self.endpoints)
        if self.pool.strategy == "stable_hash":
            return (first + attempt - 1) % len(self.endpoints) if self.rotate else first
        with self.lock:
            return least_loaded(self.inflight, self.weights, first, attempt, self.rotate)

    def send(self, at: int, payload: str, transport: Transport) -> tuple[int, str]:
        with self.lock:
            self.inflight[at] += 1
        try:
            with self.gates[at]:
                return transport(self.endpoints[at], payload)
        finally:
            with self.lock:
                self.inflight[at] -= 1


def call_one(item: str, payload: str, second: str | None, router: Router, transport: Transport, retries: Retries, shorten: Callable[[str, int], str] | None = None, parse: Callable[[str], str] | None = None) -> tuple:
    """One row of ANSWERS. Time-outs, connection errors and the statuses that may pass are tried again; a request that is too long is made
    shorter and does not count as a try. A second request follows an answer, at the same endpoint; where it fails there is only the first."""
    attempt, shortened, status, error, at = 0, 0, None, None, 0
    while True:
        attempt += 1
        at = router.pick(item, attempt)
        try:
            status, body = router.send(at, payload, transport)
            error = None if status == 200 else f"status {status}"
        except (TimeoutError, ConnectionError) as e:
            status, body, error = None, "", f"{type(e).__name__}: {e}"
        except Exception as e:  # noqa: BLE001  a caller's transport: an error of this row, not of the job
            return item, None, None, None, router.endpoints[at], attempt, "llm_request", f"{type(e).__name__}: {e}"
        if error is None:
            break
        if status == 400 and shorten is not None and shortened < retries.shorter and any(x in (body or "").lower() for x in TOO_LONG):
            shortened += 1
            try:
                payload = shorten(payload, shortened)
            except Exception as e:  # noqa: BLE001  a caller's function
                return item, None, None, status, router.endpoints[at], attempt, "build_request", f"{type(e).__name__}: {e}"
            attempt -= 1
            continue
        if status is not None and status not in RETRYABLE or attempt > retries.most:
            return item, None, None, status, router.endpoints[at], attempt, "llm_request", error
        time.sleep(retries.backoff * 2 ** (attempt - 1))
    more = None
    if second is not None:
        try:
            answered, text = router.send(at, second, transport)
            more = text if answered == 200 else None
        except Exception:  # noqa: BLE001  best effort
            more = None
    if parse is not None:
        try:
            body = parse(body)
        except Exception as e:  # noqa: BLE001  a caller's function
            return item, None, None, status, router.endpoints[at], attempt, "parse_response", f"{type(e).__name__}: {e}"
    return item, body, more, status, router.endpoints[at], attempt, None, None


def called(
    requests: DataFrame, endpoints: list[str], transport: Transport, retries: Retries | None = None, tasks: int = 0, pool: Pool | None = None,
    shorten: Callable[[str, int], str] | None = None, parse: Callable[[str], str] | None = None,
) -> DataFrame:
    """ANSWERS for requests(id, payload, local, and perhaps second): rows with a local answer are not sent, rows without an id or a payload are errors of
    the stage validate. More tasks than cores keep slow endpoints busy. Write the answers before they are read twice."""
    retries, pool = retries or Retries(), pool or Pool()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, router = [x.strip().split(" ")[0] for x in ANSWERS.split(",")], Router(endpoints, pool, retries.rotate)
        with ThreadPoolExecutor(pool.threads) as threads:
            for batch in batches:
                seconds = [None if pd.isna(x) else x for x in batch["second"]]
                rows = list(threads.map(lambda r: call_one(*r, router, transport, retries, shorten, parse), zip(batch["id"], batch["payload"], seconds, strict=True)))
                yield pd.DataFrame(rows, columns=names).astype({"status": "Int32", "attempts": "int32"})

    key, none = F.col("id").cast("string"), F.lit(None).cast("string")
    second = F.col("second") if "second" in requests.columns else none
    rows = requests.select(key.alias("id"), F.col("payload").cast("string").alias("payload"), F.col("local").cast("string").alias("local"), second.alias("second"))
    invalid = rows.where("local is null and (id is null or payload is null)").select("id", none.alias("response"), none.alias("second"), F.lit(None).cast("int").alias("status"), F.lit("").alias("endpoint"), F.lit(0).alias("attempts"), F.lit("validate").alias("stage"), F.lit("no id or no payload").alias("error"))
    local = rows.where("local is not null").select("id", F.col("local").alias("response"), none.alias("second"), F.lit(200).alias("status"), F.lit("").alias("endpoint"), F.lit(0).alias("attempts"), none.alias("stage"), none.alias("error"))
    sent = rows.where("local is null and id is not null and payload is not null").select("id", "payload", "second")
    sent = sent.repartition(tasks, "id") if tasks else sent
    return sent.mapInPandas(run, ANSWERS).unionByName(local).unionByName(invalid)


def called_in_lanes(
    requests: DataFrame, endpoints: list[str], limits: list[int], transport: Transport, retries: Retries | None = None, shorten: Callable[[str, int], str] | None = None, parse: Callable[[str], str] | None = None
) -> DataFrame:
    """ANSWERS for requests(id, payload), as a written table, with never more than limits[i] requests at endpoint i at a time, over all tasks.

    An endpoint has as many lanes as its limit. A request is dealt to a lane by its id, a lane is in one task, and a task sends one request at a time. Tries
    are passes: what failed and may pass goes to lanes of the next endpoint in the next one. A task that Spark runs twice at once would break the limit, so
    speculation must be off."""
    retries, spark = retries or Retries(), requests.sparkSession
    if str(spark.conf.get("spark.speculation", "false")).lower() == "true":
        raise ValueError("limits of endpoints hold only without speculative tasks")
    lanes = [(i, k) for i, n in enumerate(limits) for k in range(max(1, n))]
    first = [sum(max(1, n) for n in limits[:i]) for i in range(len(limits))]
    one = Retries(0, 0.0, False, retries.shorter)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.strip().split(" ")[0] for x in ANSWERS.split(",")]
        for batch in batches:
            rows = []
            for item, payload, second, at, attempt in zip(batch["id"], batch["payload"], batch["second"], batch["endpoint"], batch["attempt"], strict=True):
                router = Router([endpoints[at]], Pool(1), False)
                got = call_one(item, payload, None if pd.isna(second) else second, router, transport, one, shorten, parse)
                rows.append((*got[:5], int(attempt), *got[6:]))
            yield pd.DataFrame(rows, columns=names).astype({"status": "Int32", "attempts": "int32"})

    key, none = F.col("id").cast("string"), F.lit(None).cast("string")
    second = F.col("second") if "second" in requests.columns else none
    todo, made = written(requests.select(key.alias("id"), F.col("payload").cast("string").alias("payload"), second.alias("second")), "requests"), None
    for attempt in range(1, retries.most + 2):
        at = route(F.col("id"), len(endpoints), attempt, retries.rotate).cast("int")
        counts, starts = F.array(*[F.lit(max(1, n)) for n in limits]), F.array(*map(F.lit, first))
        lane = F.get(starts, F.col("endpoint")) + F.pmod(F.xxhash64("id"), F.get(counts, F.col("endpoint"))).cast("int")
        dealt = todo.withColumn("endpoint", at).withColumn("attempt", F.lit(attempt)).withColumn("lane", lane)
        # one partition for each lane, by its number
        answers = written(dealt.repartitionById(len(lanes), "lane").mapInPandas(run, ANSWERS), "answers")
        again = F.col("error").isNotNull() & (F.col("stage") == "llm_request") & (F.col("status").isNull() & F.col("error").rlike("^(Timeout|Connection)") | F.col("status").isin(sorted(RETRYABLE)))
        again = F.coalesce(again, F.lit(False)) if attempt <= retries.most else F.lit(False)
        done = answers.where(~again)
        made = done if made is None else made.union(done)
        left = answers.where(again).select("id")
        if attempt > retries.most or left.isEmpty():
            break
        todo = written(todo.join(left.distinct(), "id", "left_semi"), "requests")
        time.sleep(retries.backoff * 2 ** (attempt - 1))
    return made


def split(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results and errors. Write the answers first: a plan that reads them twice would call twice."""
    return answers.where("error is null").select("id", "response"), answers.where("error is not null").select("id", "error", "stage", "attempts")
