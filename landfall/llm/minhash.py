"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

A document's set holds its distinct word shingles (of A-Z lower-cased words). Equal sets
collapse to one node. SuperMinHash lets every element draw slots in the order of a random
permutation of its own, so that slots agree less by chance than with independent hashes,
and stops as soon as no later draw can be smaller. Slots are cut into bands; nodes that
share a band are candidates.

First every node of a band is compared with the band's smallest node. In bands that then
still hold several components, all nodes of different components are compared: as pairs in
small bands, in large ones by blocks of nodes in tasks that pass over what they or the
first round have joined, and send on only what joins more. A link stands
only if the full sets overlap enough. With the default bands two documents just at the
similarity asked for miss each other in every band with a probability below one in a
million.

Null and empty texts have the empty set and no links; copies and rows that share an id are
linked if their sets are. Null ids take part in the groups but never name one; a group
without ids has a null component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.components import components
from landfall.llm.text import map_rows, mix, shingle_hashes, to_bytes, word_hashes
from landfall.session import settle

_GOLDEN = 0x9E3779B97F4A7C15
_STEP = np.uint64(_GOLDEN)
#: Shingles whose permutations a task holds at once; members of a leader in one task.
ELEMENTS, MEMBERS = 1 << 15, 512
#: Nodes of a band up to which all its pairs of different components are listed.
SMALL = 12


def banding(percent: int) -> tuple[int, int]:
    """(bands, slots per band) that miss a pair of this similarity less than once in 1e6."""
    slots = 5 if percent >= 85 else 4 if percent >= 70 else 3
    hit = (percent / 100) ** slots
    return math.ceil(math.log(1e-6) / math.log1p(-hit)), slots


def superminhash(elements: np.ndarray, slots: int) -> np.ndarray:
    """The signature of a set of 64-bit hashes: for each slot the smallest step + fraction."""
    best = np.full(slots, np.inf)
    for at in range(0, len(elements), ELEMENTS):
        part = elements[at:at + ELEMENTS]
        rows = np.arange(len(part))
        order = np.tile(np.arange(slots, dtype=np.uint8 if slots < 256 else np.int32),
                        (len(part), 1))
        for step in range(slots):
            # Step s draws from s to s + 1: no slot can still improve.
            if best.max() < step:
                break
            draw = mix(part + np.uint64((step + 1) * _GOLDEN % 2**64))
            swap = step + (mix(draw) % np.uint64(slots - step)).astype(np.int64)
            slot = order[rows, swap]
            order[rows, swap] = order[:, step]
            np.minimum.at(best, slot, step + (draw >> np.uint64(11)) / 2.0**53)
    return best


def band_hashes(signature: np.ndarray, bands: int, slots: int) -> np.ndarray:
    values = signature.view(np.uint64).reshape(bands, slots)
    h = np.arange(bands, dtype=np.uint64)
    for k in range(slots):
        h = mix(h * _STEP + values[:, k])
    return h.view(np.int64)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return shingle_hashes(word_hashes(np.frombuffer(to_bytes(text), np.uint8), True), size)


def _key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _profiles(docs: DataFrame, size: int, bands: int, slots: int) -> DataFrame:
    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        for record in records:
            found = shingle_set(record["text"], size)
            marks = None
            if len(found):
                marks = band_hashes(superminhash(found, bands * slots), bands, slots).tolist()
            yield (record["doc_id"], record["at"], record["mark"], len(found), _key(found),
                   marks)

    return map_rows(docs, "doc_id long, at long, mark long, n_shingles long, "
                          "set_key binary, bands array<long>", rows)


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the (u, v) whose sets are similar enough.

    The partners of a u are dealt in lots of about MEMBERS; u's text goes to each lot.
    """
    lots = pairs.groupBy("u").agg(F.ceil(F.count("*") / MEMBERS).alias("lots"))
    dealt = pairs.join(lots, "u").select(
        "u", F.col("v").alias("node"), F.pmod(F.xxhash64("v"), F.col("lots")).alias("lot"),
        F.lit(1).alias("member"))
    heads = lots.select("u", F.col("u").alias("node"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("lot"),
        F.lit(0).alias("member"))
    met = (dealt.unionByName(heads).join(texts, "node").repartition("u", "lot")
           .sortWithinPartitions("u", "lot", "member"))

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        head, of = None, None
        for r in records:
            if not r["member"]:
                head, of = shingle_set(r["text"], size), (r["u"], r["lot"])
                continue
            assert of == (r["u"], r["lot"])
            found = shingle_set(r["text"], size)
            if 100 * min(len(head), len(found)) < percent * max(len(head), len(found)):
                continue
            both = len(np.intersect1d(head, found, assume_unique=True))
            if 100 * both >= percent * (len(head) + len(found) - both):
                yield r["u"], r["node"]

    return map_rows(met, "u long, v long", rows)


def _linked_within(rest: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (u, v) that join the components of each large band, from (band, node, root, size).

    A band's nodes are dealt into lots of about MEMBERS, and each two lots meet in a task,
    which counts the overlaps of a set with all others through an index of their shingles.
    Sets in one component, also by links just found, need no comparing.
    """
    lots = F.ceil(F.col("size") / MEMBERS)
    dealt = rest.withColumn("side", F.pmod(F.xxhash64("node"), lots)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), lots - 1)))
    met = (
        dealt.select("band", F.least("side", "other").alias("i"),
                     F.greatest("side", "other").alias("j"), "side", "node", "root")
        .join(texts, "node").repartition("band", "i", "j")
        .sortWithinPartitions("band", "i", "j"))

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        for (_, i, j), found in groupby(records, key=lambda r: (r["band"], r["i"], r["j"])):
            members = list(found)
            first = [r for r in members if r["side"] == i]
            yield from _join_lots(first, [r for r in members if r["side"] == j] if i < j
                                  else first, size, percent)

    return map_rows(met, "u long, v long", rows)


def _join_lots(left: list[dict], right: list[dict], size: int, percent: int) -> Iterator[tuple]:
    parent = {r["root"]: r["root"] for r in (*left, *right)}

    def root(node: int) -> int:
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    sets = [shingle_set(r["text"], size) for r in right]
    sizes = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate([*sets, np.empty(0, np.uint64)])
    order = np.argsort(every, kind="stable")
    shingles, owners = every[order], np.repeat(np.arange(len(sets)), sizes)[order]
    parts = len({root(r) for r in parent})
    for r in left:
        if parts < 2:
            return
        mine = shingle_set(r["text"], size)
        low = np.searchsorted(shingles, mine, "left")
        counts = np.searchsorted(shingles, mine, "right") - low
        # Places low, low + 1, ... of each of my shingles in the index.
        steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        both = np.bincount(owners[np.repeat(low, counts) + steps], minlength=len(sets))
        alike = 100 * both >= percent * (len(mine) + sizes - both)
        for k in np.flatnonzero(alike).tolist():
            a, b = root(r["root"]), root(right[k]["root"])
            if a != b:
                parent[max(a, b)] = min(a, b)
                parts -= 1
                yield r["node"], right[k]["node"]


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, mark (the text's hash), n_shingles, component_id, stays, kept of every row.

    `kept` marks the rows whose id names their group; `stays` is true for the one row of a
    group that comes first by id and text hash, for rows without ids as well.
    """
    bands, slots = banding(percent)
    # `at` finds the row again; rows without an id are found by their text.
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("at"),
        F.xxhash64("text").alias("mark"), "text")
    profiles = settle(_profiles(keyed, size, bands, slots), "profiles")
    # Numbered once, as stored.
    nodes = settle(
        profiles.where("n_shingles > 0").groupBy("set_key").agg(
            F.min(_row()).alias("first"), F.min("at").alias("at"),
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")

    marks = nodes.select("node", "n", F.explode("bands").alias("band"))
    heads = marks.groupBy("band").agg(
        F.min(F.struct("node", "n")).alias("head"), F.count("*").alias("size")
    ).where("size > 1").select("band", "head")
    shared = settle(marks.join(heads, "band").select("band", "node", "n", "head"), "bands")

    def alike(a: str, b: str):
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    stars = settle(
        shared.where(F.col("node") != F.col("head.node")).where(alike("n", "head.n"))
        .select(F.col("head.node").alias("u"), F.col("node").alias("v")).distinct(), "stars")
    wanted = shared.select("node").distinct().join(
        nodes.select("node", "at", "set_key"), "node")
    texts = settle(_of_nodes(keyed, wanted, size), "texts")

    links = settle(_confirmed(stars, texts, size, percent), "confirmed")
    found = components(links)
    placed = shared.select("band", "node", "n").join(
        found.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left"
    ).withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("band").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")
    ).where("low < high").select("band", "size")
    rest = settle(placed.join(mixed, "band"), "rest")
    a, b = (rest.where(F.col("size") <= SMALL).alias(x) for x in "ab")
    pairs = settle(
        a.join(b, F.col("a.band") == F.col("b.band"))
        .where((F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root")))
        .where(alike("a.n", "b.n"))
        .select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()
        .join(stars, ["u", "v"], "left_anti"), "pairs")
    more = settle(_confirmed(pairs, texts, size, percent).unionByName(
        _linked_within(rest.where(F.col("size") > SMALL), texts, size, percent)), "more")
    found = components(found.unionByName(more))

    roots = nodes.select("set_key", "node", "first").join(
        found.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left"
    ).withColumn("root", F.coalesce("root", "node"))
    names = roots.groupBy("root").agg(F.min("first").alias("first"))
    classes = roots.drop("first").join(names, "root").select("set_key", "first")
    alone = F.col("n_shingles") == 0
    return (
        profiles.select("doc_id", "mark", "n_shingles", "set_key")
        .join(classes, "set_key", "left")
        .select("doc_id", "mark", "n_shingles",
                F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id"))
                .alias("component_id"),
                (alone | (_row() == F.col("first"))).alias("stays"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def _row() -> Column:
    """Orders rows by id, rows without one last, and then by text."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")


def remove_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay: one of each group, the one with the smallest id.

    Of rows with one id and one text, one stays. Rows without words all stay, alike or not.
    """
    stays = near_duplicates(docs, size, percent).where("stays").select(
        F.col("doc_id").alias("its_id"), F.col("mark").alias("its_mark"),
        (F.col("n_shingles") == 0).alias("wordless")).distinct()
    # Clashing column names stay inside the struct.
    rows = docs.select(F.struct(*docs.columns).alias("kept"), F.col("doc_id").cast("long").alias(
        "doc_id"), F.xxhash64("text").alias("mark"))
    kept = rows.join(
        stays, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("mark") == F.col("its_mark"))
    ).drop("its_id", "its_mark")
    twice = rows.groupBy("doc_id", "mark").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("doc_id").alias("its_id"), F.col("mark").alias("its_mark"))
    again = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("mark") == F.col("its_mark"))
    once = kept.join(twice, again & ~F.col("wordless"), "left_anti").select("kept.*")
    repeated = kept.where(~F.col("wordless")).join(twice, again, "left_semi").groupBy("doc_id", "mark").agg(
        F.first("kept").alias("kept")).select("kept.*")
    return once.unionByName(repeated)


def _of_nodes(keyed: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, text) of the wanted nodes; of rows that share an id, those with the set."""

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        for r in records:
            if _key(shingle_set(r["text"], size)) == r["set_key"]:
                yield r["node"], r["text"]

    return map_rows(keyed.select("at", "text").join(wanted, "at").select(
        "node", "set_key", "text"), "node long, text string", rows)
