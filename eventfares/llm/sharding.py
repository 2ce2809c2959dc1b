"""Shards by a hierarchical weighted hash tree of regions, racks and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventfares.settings import keep

SHARDS = 40
RACK_SHARDS = 5
REGION_RACKS = 2
FIXED_BYTES = 16
BLOCK_ROWS = 1_000_000

Tree = list[list[list[tuple[int, float]]]]


def tree(shards: int, weights: dict[int, float] | None = None) -> Tree:
    """Regions of racks of `(shard, weight)`, filled in order. Weights are 1 unless given."""
    weights = weights or {}
    leaves = [(s, float(weights.get(s, 1.0))) for s in range(shards)]
    racks = [leaves[i : i + RACK_SHARDS] for i in range(0, shards, RACK_SHARDS)]
    return [racks[i : i + REGION_RACKS] for i in range(0, len(racks), REGION_RACKS)]


def shard_of(key: Column, nodes: Tree) -> Column:
    """The shard a key reaches by descending the tree.

    Each leaf draws an exponential time, of a rate as its weight, from the hash of the key and the
    leaf. A rack's draw is the earliest of its leaves, and a region's the earliest of its racks,
    which is an exponential draw of their summed weights. The key goes to the region, then the rack,
    then the shard that draws earliest. A weight that changes moves keys into or out of its own leaf
    alone, so every subtree whose weights stay as they are keeps its order; a new leaf takes keys
    and moves none between others. Leaves of no weight draw nothing.
    """

    def leaf(shard: int, weight: float) -> Column:
        # 53 bits of the hash, halfway between steps, so that the logarithm is finite.
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
        draw = -F.log((bits + 0.5) / F.lit(float(1 << 53))) / F.lit(weight)
        return F.struct(draw.alias("draw"), F.lit(shard).alias("shard"))

    def earliest(draws: list[Column]) -> Column:
        return F.least(*draws) if len(draws) > 1 else draws[0]

    def rack(leaves) -> Column | None:
        draws = [leaf(s, w) for s, w in leaves if w > 0]
        return earliest(draws) if draws else None

    regions = []
    for racks in nodes:
        draws = [d for d in map(rack, racks) if d is not None]
        if draws:
            regions.append(earliest(draws))
    if not regions:
        raise ValueError("no shard has any weight")
    return earliest(regions)["shard"]


def shards(docs: DataFrame, n_shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, size, text_crc32, law, shard, slot, grown_shard` of every row.

    The law is `key`: the id and the number of shards decide, whatever the text, so equal texts of
    different ids are not held together. `grown_shard` is the place with one shard more, which is
    the same place or the new shard. A null id is a key like any other. `size` is the text's UTF-8
    bytes (null: none) plus 16, and the check sum of a null text that of an empty one.

    Slots count from 0 in each shard without gaps. Shards are numbered in blocks of about
    `BLOCK_ROWS`, dealt by a hash of id and text, and each block starts where the one before ends:
    no task sorts a whole shard. Rows alike in id, size and check sum are alike in all that is
    returned, so it does not matter which comes first. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = keep(
        docs.select(
            F.col(doc_id).cast("bigint").alias("doc_id"),
            (F.octet_length(body) + FIXED_BYTES).cast("bigint").alias("size"),
            F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        ),
        "sizes",
    )
    key = F.col("doc_id").cast("bigint")
    blocks = rows.count() // (BLOCK_ROWS * n_shards) + 1
    placed = rows.select(
        "*",
        shard_of(key, tree(n_shards)).alias("shard"),
        shard_of(key, tree(n_shards + 1)).alias("grown_shard"),
        F.pmod(F.xxhash64("text_crc32", "size", "doc_id"), F.lit(blocks)).cast("int").alias("block"),
    )
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "size", "text_crc32")
    numbered = placed.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "block"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("start") + F.col("place")).alias("slot"),
        "grown_shard",
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
