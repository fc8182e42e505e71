"""Sharding by a hierarchical weighted hash tree.

A tree has regions, these have racks and these have shards; a shard has a weight, and what is above it the sum of the weights below. A
row descends level by level: each child draws a straw, ln(u) / weight, where u in (0, 1) comes from the MD5 of the child's name and the
row's key, and the longest straw wins. So a child is taken in proportion to its weight, by the key and the tree alone.

A straw depends on its own child's name and weight only. Where weights change, a row therefore moves only into a child whose weight has
grown or out of one whose weight has shrunk, level by level; below children of equal weights everything stays. A shard that stands in a region
of its own thus takes rows into itself and moves no other, which is how `grid` adds shards beyond those planned; one that joins a rack
also raises its rack and its region, and rows that these win descend anew within them.

Slots number the rows of a shard by the MD5 of id and text mark, so they depend on the rows only. Rows with equal id and text are
interchangeable. Nothing is collected: the tree is a constant in the plan, as large as the number of shards.

Edge cases: a null id is the key '' (all such rows share a shard, and are spread over tasks by their texts); a null text has 16 bytes and CRC 0, like an empty one; texts may have
any length; repeated rows get slots of their own; an empty table gives an empty result; shards of weight 0 take nothing. `sharded` and `stored` keep all columns, a column named shard is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CRC_TABLE, crc_sql, packed, table, written
from .numbering import numbered

SHARDS, REGIONS, RACKS = 40, 4, 2
#: Bytes that a row has besides its text, and rows of a block of slots.
EXTRA, ROWS = 16, 1 << 16


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


Tree = list[Leaf]


def grid(shards: int, planned: int = SHARDS, regions: int = REGIONS, racks: int = RACKS) -> Tree:
    """Shards 0, 1, ... in equal parts of regions and racks, as far as they are planned; each further one in a region of its own."""
    return [
        Leaf(f"r{i * regions // planned}", f"k{i * regions * racks // planned}", i) if i < planned else Leaf(f"r+{i}", f"k+{i}", i)
        for i in range(shards)
    ]


def weighted(tree: Tree, weights: dict[int, float]) -> Tree:
    """The tree with other weights of some shards."""
    return [replace(x, weight=float(weights.get(x.shard, x.weight))) for x in tree]


def _levels(tree: Tree) -> list[list[list[tuple[str, float, int]]]]:
    """For each level the children of each node above, as (name, weight, own number)."""
    used = [x for x in tree if x.weight > 0]
    if not used:
        raise ValueError("a tree needs a shard with a weight above 0")
    regions = list(dict.fromkeys(x.region for x in used))
    racks = list(dict.fromkeys((x.region, x.rack) for x in used))
    total = lambda rows: float(sum(x.weight for x in rows))
    top = [(f"region {r}", total(x for x in used if x.region == r), i) for i, r in enumerate(regions)]
    middle = [[(f"rack {r} {k}", total(x for x in used if (x.region, x.rack) == (r, k)), i) for i, (r, k) in enumerate(racks) if r == region] for region in regions]
    low = [[(f"shard {x.shard}", x.weight, x.shard) for x in used if (x.region, x.rack) == rack] for rack in racks]
    return [[top], middle, low]


def _children(level: list[list[tuple[str, float, int]]]) -> Column:
    one = lambda c: F.struct(F.lit(c[0]).alias("name"), F.lit(c[1]).alias("weight"), F.lit(c[2]).alias("at"))
    return F.array(*[F.array(*map(one, node)) for node in level])


def uniform(name: Column, key: Column) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of name and key."""
    return (F.conv(F.substring(F.md5(F.concat(name, F.lit(":"), key)), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard that a key (a string, null as '') comes down to."""
    key, at = F.coalesce(key, F.lit("")), F.lit(0)
    for level in _levels(tree):
        straw = lambda c: F.struct((F.ln(uniform(c["name"], key)) / c["weight"]).alias("straw"), c["at"].alias("at"))
        at = F.array_max(F.transform(F.get(_children(level), at), straw))["at"]
    return at.cast("int")


def sharded(docs: DataFrame, tree: Tree, key: str = "doc_id") -> DataFrame:
    """docs with a column shard."""
    return docs.withColumn("shard", shard_of(F.col(f"`{key}`").cast("string"), tree))


def stored(docs: DataFrame, tree: Tree, path: str, files: int = 1, rows: int = 1 << 20) -> None:
    """Writes docs as Parquet in a folder for each shard, each by `files` tasks or more and in files of `rows` rows at most."""
    found = sharded(docs, tree)
    salt = F.pmod(F.xxhash64(*[f"`{c}`" for c in docs.columns if c in ("doc_id", "text")]), F.lit(files))
    found.repartition(len(tree) * files, "shard", salt).write.option("maxRecordsPerFile", rows).partitionBy("shard").parquet(path)


def slots(docs: DataFrame, tree: Tree, grown: Tree) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) of documents, where grown_shard is that under the tree `grown`."""
    doc, key = F.col("row.doc_id").cast("long"), F.col("row.doc_id").cast("string")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = packed(docs).select(
        doc.alias("doc_id"),
        (F.octet_length(raw) + F.lit(EXTRA)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        shard_of(key, tree).alias("shard"),
        shard_of(key, grown).alias("grown_shard"),
    )
    spot = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text_crc32").cast("string"))), 1, 8), 16, 10).cast("long")
    narrow = written(narrow.withColumn("spot", spot), "placed")
    blocks = max(1, narrow.count() // (ROWS * len(tree)))
    found = numbered(narrow.withColumn("block", F.expr(f"spot * {blocks}L div 4294967296L")), ["shard"], "block", [F.col("spot"), F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot")
    return found.select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = slots(docs, grid(SHARDS), grid(SHARDS + 1))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _tree_sql(name: str, tree: Tree) -> str:
    """A CTE of doc_id's key and the shard that it comes down to."""
    levels, value = _levels(tree), lambda parent, c: f"({parent}, '{c[0]}', {c[1]!r}::DOUBLE, {c[2]})"
    out, last = [], "(SELECT key, 0 AS place FROM keys)"
    for depth, level in enumerate(levels):
        rows = ", ".join(value(parent, c) for parent, node in enumerate(level) for c in node)
        u = "(('0x' || substr(md5(c.name || ':' || key), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE"
        out.append(f"{name}{depth} AS (SELECT key, c.place FROM {last} b JOIN (VALUES {rows}) c(parent, name, weight, place) ON c.parent = b.place QUALIFY row_number() OVER (PARTITION BY key ORDER BY ln({u}) / c.weight DESC, c.place DESC) = 1)")
        last = f"{name}{depth}"
    return ", ".join(out)


SHARDING = f"""WITH {CRC_TABLE}, d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, coalesce(text, '') AS text FROM documents), keys AS (SELECT DISTINCT key FROM d),
{_tree_sql('old', grid(SHARDS))}, {_tree_sql('new', grid(SHARDS + 1))},
c AS (SELECT doc_id, d.key, octet_length(encode(text)) + {EXTRA} AS size, {crc_sql('text')} AS text_crc32 FROM d, crc_table),
p AS (SELECT c.*, ('0x' || substr(md5(key || ':' || text_crc32), 1, 8))::BIGINT AS spot FROM c)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, old2.place::INT AS shard, row_number() OVER (PARTITION BY old2.place ORDER BY spot, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, new2.place::INT AS grown_shard
FROM p JOIN old2 USING (key) JOIN new2 USING (key)"""

QUERIES = {"op13_sharding": op13_sharding}
ORACLE = {"op13_sharding": SHARDING}
