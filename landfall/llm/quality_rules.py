"""Quality rules: an isolation forest over rule statistics.

Fixed rules reject texts of few words or many repeated words. The other texts are judged
by a forest of random splits: a text whose mean path to a leaf is short is unlike the rest.
All labelled rows outside fold 2 that pass the rules grow the forest, level by level and
without their labels; with their labels all of them set the threshold, where the share of
good rows kept less the share of bad rows kept is largest.

Each level is one pass over the stored statistics, in which a task reduces its rows to the
counts and bounds of the nodes. The driver gets only these, whatever the number of rows.

Null and empty texts have no words and fail the rules. Extra columns are ignored, copies
are judged alike, rows are kept one for one; without labels of both kinds only the fixed
rules decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.labels import fold
from landfall.llm.stats import BASE, RATES, statistics
from landfall.llm.text import map_rows
from landfall.session import settle

TREES = 100
DEPTH = 8
#: Decimals of a path length: there are few different ones, so all rows can be counted by it.
DECIMALS = 3
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
# Repetition is left to the fixed rules: short texts with one repeated line are often good.
USED = [RATES.index(name) for name in (
    "word_length", "symbols", "capitals", "exclaims", "bars", "marks")]

MEASURED = "doc_id long, mark long, " + ", ".join(
    f"{name} long" for name in BASE) + ", rates array<double>"
_LOW, _HIGH = ([f"{side}{k}" for k in range(len(USED))] for side in ("low", "high"))


def measure(docs: DataFrame) -> DataFrame:
    """The counts of BASE, the scaled rates and a hash of the text, row for row."""

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        for record in records:
            counts, rates = statistics(record["text"])
            yield record["doc_id"], record["mark"], *counts, _scaled(rates).tolist()

    return map_rows(docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text"), MEASURED, rows)


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def _scaled(rates: list[float]) -> np.ndarray:
    return np.log(np.array(rates, float)[USED] + 0.01)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    rates = batch.column("rates").flatten().to_numpy(zero_copy_only=False)
    return rates.reshape(-1, len(USED))


def _mean_path(n: int) -> float:
    """Mean path of a failed search among n rows, for leaves that hold several."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees as complete binary heaps of DEPTH levels; leaves above the bottom repeat."""

    feature: np.ndarray
    split: np.ndarray
    length: np.ndarray
    threshold: float = 0.0

    def places(self, tree: int, x: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row among those `depth` levels below the root."""
        feature, split = self.feature[tree], self.split[tree]
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(depth):
            node = 2 * node + 1 + (x[rows, feature[node]] >= split[node])
        return node - (2**depth - 1)

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for tree, length in enumerate(self.length):
            total += length[self.places(tree, x, DEPTH)]
        return np.round(total / len(self.length), DECIMALS)


def _level(rows: DataFrame, forest: Forest, depth: int) -> dict[tuple[int, int], tuple]:
    """(rows, lowest and highest value per column) of the nodes `depth` levels down, of all
    `rows`. There are at most TREES * 2^depth of them."""
    trees, width, columns = len(forest.length), 2**depth, len(USED)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((trees, width), np.int64)
        low = np.full((trees, width, columns), np.inf)
        high = -low
        for batch in batches:
            x = _matrix(batch)
            if not len(x):
                continue
            for tree in range(trees):
                place = forest.places(tree, x, depth).astype(np.uint16)
                order = np.argsort(place, kind="stable")
                place, held = place[order], x[order]
                first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                node = place[first]
                count[tree, node] += np.diff(np.append(first, len(x)))
                low[tree, node] = np.minimum(low[tree, node], np.minimum.reduceat(held, first))
                high[tree, node] = np.maximum(high[tree, node], np.maximum.reduceat(held, first))
        tree, node = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree.astype(np.int32)), pa.array(node.astype(np.int32)),
             pa.array(count[tree, node]), *[pa.array(side[tree, node, k]) for side in (low, high)
                                            for k in range(columns)]],
            names=["tree", "node", "n", *_LOW, *_HIGH])

    schema = "tree int, node int, n long, " + ", ".join(f"{c} double" for c in _LOW + _HIGH)
    found = rows.select("rates").mapInArrow(reduced, schema).groupBy("tree", "node").agg(
        F.sum("n"), *[F.min(c) for c in _LOW], *[F.max(c) for c in _HIGH]).collect()
    return {(r[0], r[1]): (r[2], np.array(r[3:3 + columns]), np.array(r[3 + columns:]))
            for r in found}


def fit_forest(rows: DataFrame, trees: int = TREES, seed: int = 7) -> Forest:
    """Trees grown on the `rates` of all `rows`, which should be stored: each level reads
    them once."""
    rng = np.random.default_rng(seed)
    inner = 2**DEPTH - 1
    forest = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                    np.zeros((trees, inner + 1)))
    growing = {(tree, 0) for tree in range(trees)}
    for depth in range(DEPTH + 1):
        found = _level(rows, forest, depth)
        leaves, below = DEPTH - depth, set()
        for tree, node in sorted(growing):
            # A split drawn at the very edge leaves one side empty: a leaf of no row.
            n, low, high = found.get((tree, node), (0, np.zeros(1), np.zeros(1)))
            usable = np.flatnonzero(high > low)
            if depth == DEPTH or n < 2 or not len(usable):
                forest.length[tree, node << leaves:(node + 1) << leaves] = depth + _mean_path(n)
                continue
            at, heap = rng.choice(usable), 2**depth - 1 + node
            forest.feature[tree, heap] = at
            forest.split[tree, heap] = rng.uniform(low[at], high[at])
            below |= {(tree, 2 * node), (tree, 2 * node + 1)}
        growing = below
        if not growing:
            break
    return forest


def calibrated_threshold(lengths: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The path length from which a row counts as good, from the numbers of good and bad
    rows of each length, in ascending order."""
    gain = np.cumsum(bad) / bad.sum() - np.cumsum(good) / good.sum()
    best = int(gain.argmax())
    if gain[best] <= 0:
        return 0.0
    if best + 1 == len(lengths):
        return float(np.nextafter(lengths[best], np.inf))
    return float((lengths[best] + lengths[best + 1]) / 2)


def _with_paths(rows: DataFrame, forest: Forest) -> DataFrame:
    """`rows` with their path lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(forest.path_lengths(_matrix(batch)))],
                names=[*batch.schema.names, "path_length"])

    types = ", ".join(f"{name} {dtype}" for name, dtype in rows.dtypes)
    return rows.mapInArrow(run, f"{types}, path_length double")


def labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(good, rates) of all labelled rows outside fold 2 that pass the fixed rules.

    Null ids or labels are left out; an id with several labels has the largest. Of documents
    that share an id one counts, that with the smallest hash of its text.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .where(fold("doc_id") != 2)
             .groupBy("doc_id").agg((F.max("quality").cast("int") == 1).alias("good")))
    return (measured.join(known, "doc_id").groupBy("doc_id")
            .agg(F.min(F.struct("mark", *BASE, "rates", "good")).alias("row"))
            .select("row.*").where(~base_failed()).select("good", "rates"))


def fit_measured(measured: DataFrame, labels: DataFrame) -> Forest | None:
    """`fit` on what `measure` returns."""
    rows = settle(labelled(measured, labels), "labelled")
    if rows.select("good").distinct().count() < 2:
        return None
    forest = fit_forest(rows)
    counted = np.array(
        _with_paths(rows, forest).groupBy("path_length")
        .agg(F.count_if("good"), F.count_if(~F.col("good"))).orderBy("path_length").collect())
    forest.threshold = calibrated_threshold(*counted.T)
    return forest


def fit(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """The forest and its threshold; None without rows of both qualities."""
    return fit_measured(measure(docs), labels)


def judge_measured(measured: DataFrame, forest: Forest | None) -> DataFrame:
    """`judge` on what `measure` returns."""
    if forest:
        found, usual = _with_paths(measured, forest), F.col("path_length") >= forest.threshold
    else:
        found, usual = measured.withColumn("path_length", F.lit(None).cast("double")), F.lit(True)
    return found.select("doc_id", *BASE, base_failed().alias("base_failed"), "path_length",
                        (~base_failed() & usual).alias("kept"))


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """One row per document: the counts, the fixed rules' verdict, path length, kept."""
    return judge_measured(measure(docs), forest)


def fit_and_judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`judge` by the forest of the same documents, whose texts are read once."""
    measured = settle(measure(docs), "measured")
    return judge_measured(measured, fit_measured(measured, labels))
