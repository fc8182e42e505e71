"""Target-distribution importance resampling over hashed n-grams, by suffix arrays of word ids.

A task takes texts in pieces of a few MB. The different words of a piece get ids. Its suffixes, each up to the end of its text, are
sorted by their first `longest` words, which is all that n-grams of so many words see; ranks of longer beginnings come from those of
shorter ones. The LCP of neighbours cuts the array into runs of suffixes that share their first n words. A run is one n-gram: it is
hashed once, and its length counts its occurrences. For scores, its bucket goes back to the places of all its suffixes.

Gains come from the counts of all documents and of the target (`buckets` rows, which the driver holds, and no others that grow with the
corpus). A document's weight is the floored mean gain of its features. Its score adds a Gumbel number made of its id, so that the highest scores are a
draw by weight without replacement. Where ranks start follows from the number of documents of each score: scores are integers, some tens of
thousands of them at any size.

Edge cases: null texts and texts without a word have no feature and weight 0; a null id is drawn by the key of an empty one and comes
after the others of its score; repeated rows are documents of their own; texts may have any length (a task holds one and some 40
times its bytes); an empty table gives an empty result; an empty target has no occurrences in any bucket. `drawn` keeps all columns of
the documents but those named weight and score, which it replaces; rows of one id and score at the cut are interchangeable.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CRC_TABLE, Texts, crc_sql, joined, pieces, sums, table, words_of, written
from .numbering import numbered

#: Words of the longest feature, buckets, words that a drawn document has at least, documents drawn of 100, seed.
LONGEST, BUCKETS, LEAST, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Bytes of a piece, documents of one score that a task ranks.
PIECE, ROWS = 4 << 20, 1 << 20

#: Digits, letters (A-Z in lower case) and all bytes above ASCII stay; the rest separates words.
_WORD = np.array([b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)


class Grams:
    """The n-grams of texts: word ids, one text after the other, and the suffix array by their first `longest` words."""

    def __init__(self, texts: Texts, longest: int) -> None:
        whole, begins = joined(texts)
        buf = _WORD[whole]
        inside = np.concatenate(([False], buf != 32, [False])).view(np.int8)
        starts, ends = np.nonzero(np.diff(inside) == 1)[0], np.nonzero(np.diff(inside) == -1)[0]
        self.first = np.searchsorted(starts, begins)
        self.ids, self.words = words_of(buf, starts, ends)
        self.left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.ids))  # words up to the end of the text
        self.array = self._suffixes(longest)
        self.lcp = self._lcp(longest)

    def _next(self, values: np.ndarray, by: int) -> np.ndarray:
        """The value `by` words later in the same text, 0 beyond its end."""
        out = np.zeros_like(values)
        out[: max(0, len(values) - by)] = values[by:]
        return np.where(self.left > by, out, 0)

    def _suffixes(self, longest: int) -> np.ndarray:
        rank, known = self.ids + 1, 1
        while known < longest:
            step = min(known, longest - known)
            rank = np.unique(rank * (rank.max(initial=0) + 1) + self._next(rank, step), return_inverse=True)[1] + 1
            known += step
        return np.argsort(rank, kind="stable")

    def _lcp(self, longest: int) -> np.ndarray:
        """Equal words at the start of each suffix and the one before it in the array, `longest` at most."""
        lcp, same = np.zeros(len(self.array), np.int64), np.ones(max(0, len(self.array) - 1), bool)
        for k in range(longest):
            word = self._next(self.ids + 1, k)[self.array]
            same &= (word[1:] == word[:-1]) & (word[1:] > 0)
            lcp[1:] += same
        return lcp

    def runs(self, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes of at least n words in the array's order, the length of each run of equal n-grams, and its bucket."""
        whole = self.left[self.array] >= n
        members, begin = self.array[whole], np.nonzero(self.lcp[whole] < n)[0]
        length = np.diff(np.append(begin, len(members)))
        ids = self.ids[members[begin][:, None] + np.arange(n)].tolist()
        return members, length, np.array([zlib.crc32(b" ".join([self.words[i] for i in gram])) % buckets for gram in ids], np.int64)


def counts(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of all n-grams of column text in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for _, texts in pieces(batches, "text", PIECE):
            grams = Grams(texts, longest)
            for n in range(1, longest + 1):
                _, length, bucket = grams.runs(n, buckets)
                np.add.at(found, bucket, length)
        some = np.nonzero(found)[0]
        yield pa.record_batch([pa.array(some), pa.array(found[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the target's smoothed share over the corpus's) of each bucket."""
    size, s, t = len(own), float(own.sum()) + len(own), float(target.sum()) + len(own)
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(own.tolist(), target.tolist(), strict=True)], np.int64).reshape(size)


def gumbel(key: str, seed: int) -> int:
    """A Gumbel number in thousandths, by the key."""
    u = (int(sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
    return math.floor(-1000 * math.log(-math.log(u)))


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED, texts_too: bool = True) -> DataFrame:
    """(row, text, n_words, n_features, weight, score) of documents with columns doc_id and text; row holds the columns other than text."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("key"),
    )
    added = ["n_words", "n_features", "weight", "score"]
    kept = ["row", "text"] if texts_too else ["row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", PIECE):
            grams = Grams(texts, longest)
            words = np.diff(grams.first)
            features, total = np.zeros(texts.n, np.int64), np.zeros(texts.n, np.int64)
            for n in range(1, longest + 1):
                members, length, bucket = grams.runs(n, len(gain))
                each = np.zeros(len(grams.ids), np.int64)
                each[members] = np.repeat(gain[bucket], length)
                total += sums(each, grams.first)
                features += np.maximum(words - n + 1, 0)
            weight = total // np.maximum(features, 1)
            score = weight + np.array([gumbel(k, seed) for k in batch.column("key").to_pylist()], np.int64)
            yield pa.record_batch([*(batch.column(c) for c in kept), *map(pa.array, (words, features, weight, score))], [*kept, *added])

    schema = T.StructType([*(rows.schema[c] for c in kept), *(T.StructField(c, T.LongType()) for c in added)])
    return rows.mapInArrow(run, schema)


def cut(scores: DataFrame, percent: int = PERCENT) -> tuple[int, int | None, int]:
    """Of rows with a score: how many are drawn, the score of the last one, and how many have more."""
    by_score = sorted(scores.groupBy("score").count().collect(), key=lambda r: -r.score)
    number, above = percent * sum(r["count"] for r in by_score) // 100, 0
    for r in by_score if number else []:
        if above + r["count"] >= number:
            return number, r.score, above
        above += r["count"]
    return 0, None, 0


def ranked(scores: DataFrame, least: int = LEAST, percent: int = PERCENT, most: int = ROWS) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score), written before, with rank: 1, 2, ... for those drawn, by score and doc_id."""
    can = F.col("n_words") >= least
    number, last, _ = cut(scores.where(can), percent)
    if last is None:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    top = can & (F.col("score") >= last)
    high, low, up = scores.where(top).agg(F.max("score"), F.min("doc_id"), F.max("doc_id")).first()
    parts = -(-scores.where(top).groupBy("score").count().agg(F.max("count")).first()[0] // most)
    # documents of one score are ranked in parts by ranges of ids, null ids in the last one
    part = F.floor((F.col("doc_id").cast("double") - float(low or 0)) / (float(up or 0) - float(low or 0) + 1) * parts)
    part = F.least(F.coalesce(part, F.lit(parts)), F.lit(parts - 1))
    found = numbered(scores.where(top).withColumn("block", (F.lit(high) - F.col("score")) * parts + part), [], "block", [F.asc_nulls_last("doc_id"), *map(F.col, ("n_words", "n_features", "weight"))], "rank")
    found = found.drop("block").withColumn("rank", F.when(F.col("rank") < number, F.col("rank") + 1))
    return found.union(scores.where(~top).withColumn("rank", F.lit(None).cast("long")))


def drawn(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least: int = LEAST, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """The documents that are drawn, whole, with weight and score."""
    gain = gains(counts(docs, longest, buckets), counts(target, longest, buckets))
    rows = written(weighed(docs, gain, longest, seed), "weighed").where(F.col("n_words") >= least)
    own = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in ("weight", "score")]
    number, last, above = cut(rows, percent)
    if last is None:
        return rows.limit(0).select(*own, "weight", "score")
    ends = rows.where(F.col("score") == last).withColumn("id", F.col("row.doc_id").cast("long"))
    # of the last score, the smallest ids: how many rows each has, and how many of them are drawn
    by_id = numbered(ends.groupBy("id").agg(F.count("*").alias("n")).withColumn("zero", F.lit(0)), [], "zero", [F.asc_nulls_last("id")], "at").where(F.col("at") < number - above)
    before = F.coalesce(F.sum("n").over(W.orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    by_id = written(by_id.withColumn("drawn", F.least("n", number - above - before)).where("drawn > 0"), "ends")
    whole = ends.join(by_id.where("drawn = n").select(F.col("id").alias("same")), F.col("id").eqNullSafe(F.col("same")), "left_semi")
    chosen = rows.where(F.col("score") > last).union(whole.select(*rows.columns))
    for r in by_id.where("drawn < n").collect():  # one id at most
        chosen = chosen.union(ends.where(F.col("id").eqNullSafe(F.lit(r.id))).limit(r.drawn).select(*rows.columns))
    return chosen.select(*own, "weight", "score")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text")
    gain = gains(counts(docs), counts(target))
    rows = weighed(docs, gain, texts_too=False).select("row.doc_id", "n_words", "n_features", "weight", "score")
    return ranked(written(rows, "scores")).select("doc_id", "n_features", "weight", "score", "rank")


def _words_sql(source: str) -> str:
    return rf"SELECT id, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM {source}"


RESAMPLING = f"""WITH {CRC_TABLE}, d AS (SELECT row_number() OVER () AS id, doc_id, text FROM documents), b AS (SELECT 0 AS id, 0 AS doc_id, text FROM benchmark),
dw AS ({_words_sql('d')}), bw AS ({_words_sql('b')}),
h AS (SELECT word, {crc_sql('word')} % {BUCKETS} AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc_table),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN h USING (word) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM bw JOIN h USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + {BUCKETS})::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
 FROM s FULL JOIN t USING (bucket)),
w AS (SELECT id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM dw JOIN h USING (word) JOIN g USING (bucket) GROUP BY id),
x AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
 (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM d LEFT JOIN w USING (id)),
r AS (SELECT *, CASE WHEN n_features >= {LEAST} THEN row_number() OVER (PARTITION BY n_features >= {LEAST} ORDER BY score DESC, doc_id) END AS rank FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * (SELECT count(*) FROM x WHERE n_features >= {LEAST}) // 100 THEN rank END AS rank FROM r"""

QUERIES = {"op11_resampling": op11_resampling}
ORACLE = {"op11_resampling": RESAMPLING}
