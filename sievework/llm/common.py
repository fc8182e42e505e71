"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_made: list[tuple[SparkSession, str]] = []
_places: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Spark drops the shuffle files of a query once it has ended.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is set, a temporary one if the master is local; elsewhere
    executors would write to folders that the others cannot see, so that is an error."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    here = spark.sparkContext.getCheckpointDir()
    if not here:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sievework-"))
        here = spark.sparkContext.getCheckpointDir()
    return here.rstrip("/")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder; it is removed when the driver exits."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
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
    spark = df.sparkSession
    path, before = new_folder(spark, tag), spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    found = spark.read.schema(df.schema).parquet(path)
    _places[found] = path
    return found


def release(*tables: DataFrame) -> None:
    """Removes tables that written() has made and nothing reads any more."""
    for df in tables:
        delete(df.sparkSession, _places.pop(df))


def packed(docs: DataFrame) -> DataFrame:
    """docs as (row, text): all other columns in a struct, so that no name clashes with those an operator adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), F.col("text").cast("string").alias("text"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """These columns of rows that packed() has made."""
    return df.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns])


def held_out(doc_id: str, modulus: int, remainder: int):
    """True where crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


class Texts:
    """UTF-8 bytes of a string column without copying: text i is buf[off[i]:off[i + 1]]; null texts are empty."""

    def __init__(self, column: pa.Array) -> None:
        column = pc.fill_null(column, "") if column.null_count else column
        column = column.cast(pa.large_string())
        _, offsets, data = column.buffers()
        self.n = len(column)
        self.off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + self.n + 1] if self.n else np.zeros(1, np.int64)
        self.buf = np.frombuffer(data, np.uint8)[: self.off[-1]] if data is not None and self.off[-1] else np.zeros(0, np.uint8)
        self._raw = data

    def __getitem__(self, i: int) -> bytes:
        return self.buf[self.off[i] : self.off[i + 1]].tobytes()

    def sizes(self) -> np.ndarray:
        return np.diff(self.off)


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Record batches cut so that each has at most `most` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = Texts(batch.column(text))
        i = 0
        while i < batch.num_rows:
            j = int(np.searchsorted(texts.off, texts.off[i] + most, "right")) - 1
            j = min(max(j, i + 1), batch.num_rows)
            part = batch.slice(i, j - i)
            yield part, Texts(part.column(text))
            i = j


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: An odd factor and its inverse modulo 2^64, and a value for each byte: fixed, so that reruns agree. For strings of some hundred bytes only: some of a thousand collide.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, at least n of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
    return have[:n]


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes."""
    edge = np.diff(np.concatenate(([1], _SPACE[buf].view(np.int8), [1])))
    return np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]


def words_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The different strings buf[start:end], and the number of each span's own."""
    length = ends - starts
    offsets = np.concatenate(([0], np.cumsum(length)))
    data = buf[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], length)]
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of buf[start:end]; equal strings have equal ones. Each different string is hashed once."""
    number, words = words_of(buf, starts, ends)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[number]


def joined(texts: Texts, separator: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts with a separator after each, and where each starts (with the end of all)."""
    sizes = texts.sizes() + 1
    starts = np.concatenate(([0], np.cumsum(sizes)))
    return np.frombuffer(separator.join([texts[i] for i in range(texts.n)] + [b""]), np.uint8), starts


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def crc_sql(text: str) -> str:
    """CRC-32 of a string of `text`, byte by byte in DuckDB, with the table of CTE crc_table."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"


CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, [0::BIGINT for x in range(8)]),
 lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""
