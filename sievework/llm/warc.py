"""WARC archives: a deterministic sharded writer, and a reader.

Writing: pages are sorted by page_id, and those of one id by a hash of payload and url, within ranges of this order, one shard for
each range. Bounds are exact: a sample of keys, chosen by their hash, cuts the order into at most COARSE parts, and running sums of payload bytes within each part
cut it into shards of about `shard_bytes`, so that reruns make the same shards, their number follows the bytes and one id with many
pages is split. A task writes its shard record by record, each a gzip member of its own with fresh headers
and digests, and starts a new file when the compressed size reaches `roll`. Files are written under temporary names that hold
the attempt; a manifest of the attempts that Spark committed lists them, and a second job moves just these to their final names,
which a repeated task finds done. What lost attempts left goes with the temporary folder.

Of records with equal payloads of at least `least` bytes the one with the largest page_id is a response and the others revisit it.
Which page revisits which is decided on digests alone; the few facts travel to the shard sorted in front of their page, so that
payloads are shuffled once.

Reading: tasks stream the files in pieces of PIECE bytes through the decompressor, so that they hold one record at a time and the work is in
proportion to the bytes, whatever number of records a file has.

Edge cases: a null html is an empty payload; a null page_id sorts first and is the response only where all of its equals are null;
repeated rows of a page are one response and revisits of the same page_id (rows that are equal in id, url and payload share a shard); an empty
table makes an empty manifest; a payload of any length is one record, which a task holds whole, three times over, while it packs or
checks it; a url with control characters is kept in a header of its own; other columns of pages are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import delete, new_folder, table, written

#: Compressed bytes after which a new file starts; bytes of payload of a shard; keys that choose the coarse parts, and how many parts.
ROLL, SHARD, SAMPLE, COARSE = 32 << 20, 64 << 20, 20_000, 1024
#: Compressed bytes that a reader takes at a time.
PIECE = 16 << 10
DATE = "1970-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "shard int, name string, temporary string, records long, bytes long, sha256 string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, key: int, digest: str, ordinal: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{key}:{digest}:{ordinal}')}>"


def record(page_id: int | None, key: int, ordinal: int, url: str | None, payload: bytes, refers_to: tuple[int | None, int] | None) -> bytes:
    """One record, not compressed. A revisit (refers_to: id and key of the response) has the HTTP header of its payload, with the
    payload's length, but no payload."""
    revisits = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisits else http + payload
    digest = base32_sha1(payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}", f"WARC-Record-ID: {record_id(page_id, key, digest, ordinal)}", f"WARC-Date: {DATE}"]
    if url is not None:
        plain = "".join(c for c in url if c.isprintable()).strip()
        head.append(f"WARC-Target-URI: {plain}")
        if plain != url:
            head.append(f"Page-URL: {json.dumps(url)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisits:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {record_id(*refers_to, digest, 0)}"]
        if refers_to[0] is not None:
            head.append(f"Refers-To-Page-ID: {refers_to[0]}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive of gzip members, from anything with read()."""
    unpacker, parts, piece = zlib.decompressobj(31), [], b""
    while piece := piece or bytes(stream.read(PIECE)):
        parts.append(unpacker.decompress(piece))
        piece = unpacker.unused_data  # of this piece only
        if unpacker.eof:
            yield _record(b"".join(parts))
            unpacker, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the archive ends inside a record")


def _record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    n = int(headers["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("the block's length is not that of its header")
    return headers, rest[:n]


class _Rolling:
    """Files of a shard, each under a temporary name of this attempt."""

    def __init__(self, folder: str, shard: int, attempt: str, roll: int) -> None:
        self.fs, self.path = pafs.FileSystem.from_uri(folder)
        self.shard, self.attempt, self.roll, self.made, self.stream = shard, attempt, roll, [], None

    def add(self, member: bytes) -> None:
        if self.stream is not None and self.size >= self.roll:
            self.close()
        if self.stream is None:
            self.name = f"shard-{self.shard:06d}-{len(self.made):05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{self.attempt}"
            self.fs.create_dir(f"{self.path}/_temporary", recursive=True)
            self.stream, self.size, self.count, self.digest = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None), 0, 0, hashlib.sha256()
        self.stream.write(member)
        self.digest.update(member)
        self.size, self.count = self.size + len(member), self.count + 1

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.made.append((self.shard, self.name, self.temporary, self.count, self.size, self.digest.hexdigest()))
            self.stream = None


def _writer(folder: str, roll: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, shard, last, ordinal, refers, fact = None, None, None, 0, None, None
        context, made = TaskContext.get(), []
        attempt = f"{context.stageId()}-{context.taskAttemptId()}"
        for batch in batches:
            for i in range(batch.num_rows):
                number, page_id, key, digest, is_fact, url, html, target, target_key = (c[i].as_py() for c in batch.columns)
                here = (page_id, key, digest)
                if is_fact:
                    fact, refers = here, (target, target_key)
                    continue
                if number != shard:
                    if files:
                        files.close()
                        made += files.made
                    files, shard = _Rolling(folder, number, attempt, roll), number
                ordinal, last = (ordinal + 1 if here == last else 0), here
                payload = (html or "").encode()
                if here == fact:
                    to = refers
                else:
                    to = (page_id, key) if ordinal > 0 and len(payload) >= least else None
                files.add(gzip_member(record(page_id, key, ordinal, url, payload, to)))
        if files:
            files.close()
            made += files.made
        kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.record_batch([pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)], ["shard", "name", "temporary", "records", "bytes", "sha256"])

    return run


def _moved(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                if files.get_file_info(f"{path}/{temporary}").type != pafs.FileType.NotFound:
                    files.move(f"{path}/{temporary}", f"{path}/{name}")
                elif files.get_file_info(f"{path}/{name}").type == pafs.FileType.NotFound:
                    raise FileNotFoundError(temporary)
            yield pa.record_batch([batch.column("name")], ["name"])

    return run


class Bounds:
    """Places in the order of (page_id, key), null ids first: sorted lower bounds of all ranges but the first."""

    def __init__(self, rows: list[tuple[int | None, int]]) -> None:
        held = sorted({(self.LEAST if p is None else p, k) for p, k in rows})
        self.ids, self.keys = (np.array([r[i] for r in held], np.int64) for i in range(2))

    LEAST = np.iinfo(np.int64).min

    def __len__(self) -> int:
        return len(self.ids)

    def ranges(self, page_id: pa.Array, key: pa.Array) -> np.ndarray:
        """The range that each row falls in."""
        ids, keys = page_id.fill_null(self.LEAST).to_numpy(zero_copy_only=False), key.to_numpy(zero_copy_only=False)
        low, high = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        for i in np.nonzero(high > low)[0]:
            low[i] += np.searchsorted(self.keys[low[i] : high[i]], keys[i], "right")
        return low.astype(np.int32)

    def dealt(self, rows: DataFrame, name: str) -> DataFrame:
        """rows (page_id, key, ...) with their range in front."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                number = pa.array(self.ranges(batch.column("page_id"), batch.column("key")))
                yield pa.record_batch([number, *batch.columns], [name, *batch.schema.names])

        return rows.mapInArrow(run, ", ".join([f"{name} int", *(f"{c} {kind}" for c, kind in rows.dtypes)]))


def bounds(slim: DataFrame, shard_bytes: int, sample: int = SAMPLE, coarse: int = COARSE) -> Bounds:
    """Bounds of shards of about shard_bytes each; slim has page_id, key and n, the bytes. The driver sees the sample and a row for each shard."""
    n, total = slim.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    coarse = min(coarse, max(1, total // shard_bytes // 8))  # each part ends with a shard that is not full
    part = F.pmod(F.xxhash64("page_id", "key"), F.lit(1 << 30)) < int(min(1.0, sample / max(n, 1)) * (1 << 30))
    held = sorted({(Bounds.LEAST if r.page_id is None else r.page_id, r.key) for r in slim.where(part).select("page_id", "key").toLocalIterator()})
    parts = Bounds([held[i * len(held) // coarse] for i in range(1, coarse)] if coarse <= len(held) else held[1:])
    order = W.partitionBy("part").orderBy("page_id", "key").rowsBetween(W.unboundedPreceding, 0)
    cut = parts.dealt(slim.select("page_id", "key", "n"), "part").withColumn("shard", F.floor(F.sum("n").over(order) / shard_bytes))
    first = cut.groupBy("part", "shard").agg(F.min(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "key")).alias("first"))
    return Bounds(sorted((Bounds.LEAST if r.page_id is None else r.page_id, r.key) for r in first.select("first.*").toLocalIterator())[1:])


def write(pages: DataFrame, folder: str, roll: int = ROLL, shard_bytes: int = SHARD, least: int = 0) -> DataFrame:
    """Writes pages (page_id, url, html) to folder; returns the manifest, which is also written there."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary"))).withColumn("key", F.xxhash64("digest", "url"))
    # page_id, digest and key decide who revisits whom
    slim = written(rows.select("page_id", "key", "digest", F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("n")), "payloads")
    place = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", (-F.col("key").cast("decimal(20,0)")).alias("back"), "key")  # the largest id, of it the least key
    top = slim.where(F.col("n") >= least).groupBy("digest").agg(F.max(place).alias("top"), F.count("*").alias("copies")).where("copies > 1")
    top = written(top.select("digest", F.col("top.page_id").alias("target"), F.col("top.key").alias("target_key")), "tops")
    facts = slim.join(top, "digest").where(~(F.col("page_id").eqNullSafe(F.col("target")) & (F.col("key") == F.col("target_key"))))
    facts = facts.select("page_id", "key", "digest", "target", "target_key").distinct()
    total = slim.agg(F.sum("n")).first()[0] or 0
    limits = bounds(slim, max(1, min(shard_bytes, total // int(spark.conf.get("spark.sql.shuffle.partitions")))))

    none = F.lit(None).cast("string")
    both = rows.select("page_id", "key", "digest", F.lit(False).alias("fact"), "url", "html", F.lit(None).cast("long").alias("target"), F.lit(None).cast("long").alias("target_key")).union(
        facts.select("page_id", "key", "digest", F.lit(True), none, none, "target", "target_key")
    )
    sharded = limits.dealt(both, "shard").repartitionById(len(limits) + 1, F.col("shard"))
    ordered = sharded.sortWithinPartitions("shard", "page_id", "key", "digest", F.desc("fact"), "url")
    ordered.mapInArrow(_writer(folder, roll, least), _MANIFEST).write.parquet(f"{folder}/manifest")
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    manifest.mapInArrow(_moved(folder), "name string").agg(F.count("*")).collect()
    delete(spark, f"{folder}/_temporary")
    return manifest


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], list(kinds))

    def number(headers: dict[str, str], name: str) -> int | None:
        return int(headers[name]) if name in headers else None

    for batch in batches:
        for path in batch.column("path").to_pylist():
            # Spark writes file:/x where the file systems of pyarrow ask for file:///x
            files, place = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
            rows, size = [], 0
            for headers, block in records(files.open_input_stream(place, compression=None)):
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
                digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
                if base32_sha1(block) != headers["warc-block-digest"].removeprefix("sha1:") or kind == "response" and (base32_sha1(payload) != digest or len(payload) != length):
                    raise ValueError(f"record {headers['warc-record-id']} does not have the bytes of its digest")
                url = json.loads(headers["page-url"]) if "page-url" in headers else headers.get("warc-target-uri")
                rows.append((number(headers, "page-id"), url, length, digest, kind, number(headers, "refers-to-page-id"), payload if kind == "response" else None))
                size += len(payload)
                if size > 8 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            yield batch_of(rows)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in folder; digests and lengths are verified."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("path").mapInArrow(_parsed, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    write(table(spark, sf_dir, "pages"), folder)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op9_warc": op9_warc}
ORACLE: dict[str, str] = {}
