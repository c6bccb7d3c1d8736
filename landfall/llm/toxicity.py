"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon is learnt from labelled texts: words that toxic texts hold far more often. The
features of a text are how dense such words are, plain or obfuscated (`1` for i, `$` for
s, ...), how close they stand to second-person pronouns, and the rates of capitals,
punctuation and tokens that mix letters with signs. Only the text is looked at.

Rows of folds 0 and 1 of the labelled sample give the lexicon and the trees, fold 3 the
calibration; fold 2 is never used. Null and empty texts get the score of zero features.
Rows are scored one for one; copies alike. Without labels of both kinds every score is
the share of toxic labels, 0 if there are none.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.labels import SAMPLE_ROWS, fold, labelled_sample
from landfall.session import settle

#: Most words of the lexicon, which every task holds.
LEXICON_WORDS = 4000
#: Letters of a stem; a stem enters the lexicon as `stem-`.
STEM = 5
TREES, TREE_DEPTH = 20, 3
THRESHOLD = 0.3

# Second-person pronouns of the languages served.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner euch euer eure tu te toi ton "
    "tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra".split())

_EDGE = ".,;:!?\"'()[]{}<>|*#%&$@_-~^`/\\…«»“”¿¡"
_SIGNS = str.maketrans("013457@$!|", "oieastasil")
_MIXED = re.compile(r"[^\W\d_][0-9@$!*|.\-_]+[^\W\d_]")
_CAPITALS = re.compile(r"[A-Z]")
_LETTERS = re.compile(r"[A-Za-z]")
_MARKS = re.compile(r"[^\w\s]")

FEATURES = ["strong", "strong_count", "weak", "top_weight", "obfuscated_hits", "second_person",
            "proximity", "capitals", "exclaims", "questions", "marks", "mixed", "log_words"]


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    tokens = text.lower().split()
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    weights = [(i, w) for i, t in enumerate(t.strip(_EDGE) for t in tokens)
               if (w := lexicon.get(t) or lexicon.get(t[:STEM] + "-"))]
    mixed = hits = 0
    for i, token in enumerate(tokens):
        if not token.isalpha() and _MIXED.search(token):
            mixed += 1
            plain = token.strip(".,;:?\"'()").translate(_SIGNS)
            weight = lexicon.get(plain) or lexicon.get(re.sub(r"[*.\-_]", "", plain))
            if weight and lexicon.get(token.strip(_EDGE)) is None:
                hits += 1
                weights.append((i, weight))
    strong = [(i, w) for i, w in weights if w >= STRONG]
    people = [i for i, t in enumerate(tokens) if t.strip(_EDGE) in SECOND_PERSON]
    near = 0.0
    if strong and people:
        near = max(1 / (1 + abs(i - _nearest(people, i))) for i, _ in strong)
    letters = len(_LETTERS.findall(text))
    return [
        len(strong) / n, math.log1p(len(strong)), (len(weights) - len(strong)) / n,
        max((w for _, w in weights), default=0.0), hits / n, len(people) / n, near,
        len(_CAPITALS.findall(text)) / max(1, letters), text.count("!") / n,
        text.count("?") / n, len(_MARKS.findall(text)) / n, mixed / n, math.log1p(n),
    ]


def _nearest(places: list[int], at: int) -> int:
    k = bisect_left(places, at)
    return min(places[max(0, k - 1):k + 1], key=lambda p: abs(p - at))


#: Log odds of weak and strong words of the lexicon, and the share of toxic texts that
#: must hold a word.
WEAK, STRONG, LEAST_SHARE, LEAST_TEXTS = math.log(4), math.log(20), 0.02, 3


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words with their log odds in toxic against other texts of (text, label)."""
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(
        F.count("*").alias("n")).collect()}
    toxic, other = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not other:
        return {}
    whole = F.split(F.lower("text"), r"[^\p{L}]+")
    stems = F.transform(F.filter(whole, lambda w: F.length(w) >= STEM),
                        lambda w: F.concat(F.substring(w, 1, STEM), F.lit("-")))
    words = sample.select("label", F.explode(F.array_distinct(F.concat(whole, stems)))
                          .alias("word")).where(F.length("word") > 1)
    odds = F.log((F.col("bad") + 0.5) / (toxic + 1.0)) - F.log(
        (F.col("good") + 0.5) / (other + 1.0))
    found = (
        words.groupBy("word").agg(
            F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
        .where(F.col("bad") >= max(LEAST_TEXTS, math.ceil(LEAST_SHARE * toxic)))
        .withColumn("weight", odds).where(F.col("weight") >= WEAK)
        .orderBy(F.desc("weight"), "word").limit(LEXICON_WORDS)
    )
    return {r["word"]: r["weight"] for r in found.collect()}


def _with_features(docs: DataFrame, lexicon: dict[str, float], keep: Sequence[str]
                   ) -> DataFrame:
    """kept (a struct of the columns to keep), doc_id, features.

    Only the text goes to the Python workers and only the features come back."""
    @F.pandas_udf("array<double>")
    def dense(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: features(text, lexicon))

    return docs.select(F.struct(*keep).alias("kept"), "doc_id",
                       array_to_vector(dense("text")).alias("features"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    sample = labelled_sample(docs, labels, "toxic", rows)
    learning = sample.where(F.col("fold") != 3)
    lexicon = learn_lexicon(learning)
    share = sample.agg(F.avg("label")).first()[0] or 0.0
    if not lexicon:
        return Model({}, None, None, float(share))
    dense = settle(
        _with_features(sample, lexicon, ["label", "fold"])
        .select("doc_id", "kept.label", "kept.fold", "features")
        .orderBy("doc_id", "label").coalesce(4), "features")
    trees = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.2,
                          maxBins=64, seed=11).fit(dense.where(F.col("fold") != 3))
    held = trees.transform(dense.where(F.col("fold") == 3)).select(
        F.col("label").cast("double").alias("label"), _margin().alias("margin"))
    calibration = None
    if held.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(
            held.coalesce(1))
    return Model(lexicon, trees, calibration, float(share))


def _margin() -> Column:
    return vector_to_array("rawPrediction")[1]


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep` and held_out, score, predicted."""
    if model.trees is None:
        scored = docs.select(F.struct(*keep).alias("kept"), "doc_id").withColumn(
            "score", F.lit(model.share))
    else:
        scored = model.trees.transform(_with_features(docs, model.lexicon, keep))
        if model.calibration is None:
            scored = scored.withColumn("score", vector_to_array("probability")[1])
        else:
            scored = model.calibration.setPredictionCol("score").transform(
                scored.withColumn("margin", _margin()))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return scored.select(
        "kept.*", F.coalesce(fold("doc_id") == 2, F.lit(False)).alias("held_out"),
        score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))
