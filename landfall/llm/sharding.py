"""Sharding by a hierarchical weighted hash tree.

A cluster is a tree of regions, racks and shards; shards carry weights, and a node has
those of the shards below it, summed. A row goes down level by level: each child of the
node that it has reached draws an exponential value from the hash of level, child and key,
the smaller the likelier for a larger weight, and the smallest draw wins. So a node receives
rows in proportion to its weight. A child's draw depends on its own weight alone, so a
changed weight moves rows only into or out of the region that holds it, and among the rows
that stay in the region only into or out of its rack, and so on. By default one more shard
comes as a region of its own: it then takes rows only into itself.

The law is `key`: the row's key and the tree alone decide. Null keys draw like any other
value and so share a shard; rows of equal keys do as well. Slots number the rows of a
shard without gaps, by key and then by size and checksum; tied rows are alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from landfall.session import settle


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int, racks_per_region: int = 3, shards_per_rack: int = 4) -> list[Shard]:
    """Shards 0 to n-1 of equal weight, filling racks and regions in turn."""
    return [Shard(i // (racks_per_region * shards_per_rack), i // shards_per_rack, i)
            for i in range(shards)]


def more(tree: list[Shard]) -> list[Shard]:
    """The tree with one more shard, in a region and a rack of its own."""
    return [*tree, Shard(1 + max(t.region for t in tree), 1 + max(t.rack for t in tree),
                         1 + max(t.shard for t in tree))]


def _winner(key: Column, level: int, children: dict[int, float]) -> Column:
    """The child with the smallest draw: exponential, of the rate of its weight, from 53 bits
    of the hash; of equal draws the smaller number."""
    def draw(child: int) -> Column:
        h = F.shiftrightunsigned(
            F.xxhash64(F.lit(level), F.lit(child), key, F.lit(0x5EED)), 11)
        uniform = (h.cast("double") + 0.5) / float(2**53)
        return F.struct((-F.log(uniform) / F.lit(children[child])).alias("draw"),
                        F.lit(child).alias("child"))

    drawn = [draw(c) for c in sorted(children)]
    return drawn[0]["child"] if len(drawn) == 1 else F.least(*drawn)["child"]


def descend(rows: DataFrame, tree: list[Shard], key: Column, name: str) -> DataFrame:
    """Adds the shard that `key` reaches, as `name`: a region wins first, then one of its
    racks, then one of the rack's shards; only children of the winner draw."""
    leaves = [leaf for leaf in tree if leaf.weight > 0]
    if not leaves:
        raise ValueError("a tree needs a shard with a weight")
    steps = [lambda t: (), lambda t: (t.region,), lambda t: (t.region, t.rack)]
    numbers = [lambda t: t.region, lambda t: t.rack, lambda t: t.shard]
    for level, (above, number) in enumerate(zip(steps, numbers, strict=True)):
        nodes: dict[tuple, dict[int, float]] = {}
        for leaf in leaves:
            children = nodes.setdefault(above(leaf), {})
            children[number(leaf)] = children.get(number(leaf), 0.0) + leaf.weight
        found = F.lit(None).cast("int")
        for path, children in nodes.items():
            here = F.lit(True)
            for k, step in enumerate(path):
                here &= F.col(f"{name}_{k}") == step
            found = F.when(here, _winner(key, level, children)).otherwise(found)
        rows = rows.withColumn(f"{name}_{level}", found)
    return rows.withColumnRenamed(f"{name}_2", name).drop(f"{name}_0", f"{name}_1")


def assign(docs: DataFrame, shards: int = 24, tree: list[Shard] | None = None,
           grown: list[Shard] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and the shard in the `grown` tree, by
    default that of one more shard. Runs Spark jobs when called."""
    tree = tree or even_tree(shards)
    grown = grown or more(tree)
    key, text = F.col("doc_id"), F.coalesce("text", F.lit("")).cast("binary")
    sized = docs.select(
        "doc_id",
        (F.length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = descend(descend(sized, tree, key, "shard"), grown, key, "grown_shard")
    return number(placed, "shard", ["doc_id", "size", "text_crc32"])


def number(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds `slot`: 0, 1, ... in each group by `order`, with no task holding a whole group.

    Rows are dealt by range into chunks and stored with their chunk; a chunk's rows follow
    those of earlier chunks, so only counts per chunk and group are summed up.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The salt splits runs of equal rows, which no range could.
    salt = F.xxhash64(F.monotonically_increasing_id())
    stored = settle(
        df.withColumn("salt", salt).repartitionByRange(parts, group, *order, "salt")
        .withColumn("chunk", F.spark_partition_id()), "chunks")
    before = Window.partitionBy(group).orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = stored.groupBy(group, "chunk").agg(F.count("*").alias("n")).select(
        group, "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("chunk", group).orderBy(*order, "salt")
    return (
        stored.withColumn("at", F.row_number().over(within) - 1)
        .join(starts, [group, "chunk"])
        .withColumn("slot", (F.col("start") + F.col("at")).cast("long"))
        .select(*[c for c in df.columns if c != "grown_shard"], "slot",
                *[c for c in df.columns if c == "grown_shard"])
    )
