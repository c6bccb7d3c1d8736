"""Quality classifier: document evidence with hierarchical empirical Bayes over sites.

A logistic model on rule statistics gives each document a probability of being good. The
mean of a host's probabilities is shrunk towards the global mean, that of a path below it
towards the host's: with the strength of a Beta prior that the spread between the groups
suggests (method of moments). So sites with few rows follow the prior. A document's own
probability is left out of its site's, and the site's log odds against the global ones
are added to the document's own.

Null host or path count as one site named by the empty text. Empty texts have the
statistics zero. Rows are scored one for one. Without labels of both kinds the evidence
of every document is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.labels import fold, labelled_sample
from landfall.llm.stats import RATES, statistics
from landfall.llm.text import map_rows
from landfall.session import settle

THRESHOLD = 0.5
_LEAST = 1e-4


def _inputs(found: list[tuple[list[int], list[float]]]) -> np.ndarray:
    counts = np.array([c for c, _ in found], float).reshape(-1, 5)
    rates = np.array([r for _, r in found], float).reshape(-1, len(RATES))
    x = np.log(rates + 0.01)
    return np.column_stack([
        np.ones(len(x)), x, x**2, np.log1p(counts[:, 0]), counts[:, 0] < 10, rates[:, 3] > 0.2])


class Evidence:
    """Logistic regression with a ridge, by Newton steps on a bounded sample."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.scale = x.mean(0), x.std(0)
        self.mean[0], self.scale[self.scale == 0] = 0, 1
        z = (x - self.mean) / self.scale
        self.weights = np.zeros(z.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            slope = z.T @ (p - y) + self.weights
            curve = (z * (p * (1 - p))[:, None]).T @ z + np.eye(z.shape[1])
            step = np.linalg.solve(curve, slope)
            self.weights -= step
            if np.abs(step).max() < 1e-6:
                break

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -10, 10)
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> Evidence | None:
    sample = labelled_sample(docs, labels, "quality")

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        for r in records:
            yield r["doc_id"], r["label"], *statistics(r["text"])

    # Bounded by the sample's documented size.
    found = sorted(tuple(r) for r in map_rows(
        sample, "doc_id long, label int, counts array<long>, rates array<double>",
        rows).collect())
    y = np.array([float(r[1] == 1) for r in found])
    if not len(y) or y.min() == y.max():
        return None
    return Evidence(_inputs([(r[2], r[3]) for r in found]), y)


def _evidence(docs: DataFrame, model: Evidence | None) -> DataFrame:
    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        block: list[dict] = []

        def scored() -> Iterator[tuple]:
            if block:
                p = (model(_inputs([statistics(r["text"]) for r in block])) if model
                     else np.full(len(block), 0.5))
                for r, v in zip(block, p.tolist(), strict=True):
                    yield r["doc_id"], r["host"], r["path"], min(max(v, _LEAST), 1 - _LEAST)
                block.clear()

        for record in records:
            block.append(record)
            if len(block) == 512:
                yield from scored()
        yield from scored()

    return map_rows(docs, "doc_id long, host string, path string, evidence double", rows)


def _strength(groups: DataFrame, total: Column) -> float:
    """Rows that the Beta prior is worth, from (n, total, squares) of each group."""
    n, mean = F.col("n"), F.col("total") / F.col("n")
    row = groups.where(n > 1).agg(
        F.count("*").alias("groups"), F.avg(mean).alias("centre"),
        F.var_samp(mean).alias("between"),
        F.avg(F.greatest(F.lit(0.0), F.col("squares") / n - mean * mean) / n).alias("noise"),
    ).first()
    if not row["groups"] or row["groups"] < 2:
        return 10.0
    spread = max(row["between"] - row["noise"], 1e-6)
    return float(min(max(row["centre"] * (1 - row["centre"]) / spread - 1, 1.0), 1e4))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def score(docs: DataFrame, model: Evidence | None, host: Column, path: Column) -> DataFrame:
    """doc_id, held_out, host, path, evidence, site_prior, score, kept of each document."""
    rows = settle(_evidence(docs.select(
        F.col("doc_id").cast("long"), F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"), "text"), model), "evidence")
    sums = (F.count("*").alias("n"), F.sum("evidence").alias("total"),
            F.sum(F.col("evidence") ** 2).alias("squares"))
    # Hosts are summed up from their paths, so the rows are grouped once.
    paths = settle(rows.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "total", "squares")))
    overall = hosts.agg(F.sum("total") / F.sum("n")).first()[0]
    mean = 0.5 if overall is None else min(max(overall, _LEAST), 1 - _LEAST)
    of_hosts = _strength(hosts, F.col("total"))
    of_paths = _strength(paths, F.col("total"))
    sites = paths.select("host", "path", "n", "total").join(
        hosts.select("host", F.col("n").alias("host_n"), F.col("total").alias("host_total")),
        "host")
    p = F.col("evidence")
    host_prior = (of_hosts * mean + F.col("host_total") - p) / (of_hosts + F.col("host_n") - 1)
    site_prior = (of_paths * host_prior + F.col("total") - p) / (of_paths + F.col("n") - 1)
    prior = F.least(F.lit(1 - _LEAST), F.greatest(F.lit(_LEAST), site_prior))
    odds = _logit(p) + _logit(prior) - _logit(F.lit(mean))
    return (
        rows.join(sites, ["host", "path"])
        .withColumn("site_prior", prior)
        .withColumn("score", 1 / (1 + F.exp(-odds)))
        .select("doc_id", F.coalesce(fold("doc_id") == 2, F.lit(False)).alias("held_out"),
                "host", "path", "evidence", "site_prior", "score",
                (F.col("score") >= THRESHOLD).alias("kept"))
    )
