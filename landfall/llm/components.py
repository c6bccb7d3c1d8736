"""Connected components of a graph of links, by union-find and star contraction."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from landfall.llm.text import map_rows
from landfall.session import settle


def union_find(links: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Each node's smallest connected node."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        parent.setdefault(node, node)
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in list(parent)}


def _within_tasks(links: DataFrame) -> DataFrame:
    """The links of each task replaced by a star per component that the task sees."""

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        found = union_find((r["u"], r["v"]) for r in records)
        yield from ((node, root) for node, root in found.items() if node != root)

    return map_rows(links, "u long, v long", rows)


def components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node u that is not the smallest of its component, with that v.

    `links` has long columns u and v. Tasks first join what they see by union-find; then
    each round points the neighbours of every node to the smallest of them, larger ones
    and smaller ones in turn, until nothing changes. Hubs are only ever joined with one
    row per node, which Spark can split.
    """
    now = settle(_within_tasks(links.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))).distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        now = settle(
            large.join(smallest, "u").select(F.explode(F.array(
                F.struct(F.col("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u != v").distinct(), "links")
