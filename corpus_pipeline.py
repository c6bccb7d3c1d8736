"""From raw documents to token ids: the training-data operators one after the other.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the
columns of `docs`; the last returns their token ids. A stage's result is written as
Parquet in the shared folder and read again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm import bpe, decontaminate, minhash, suffix_dedup, toxicity
from landfall.session import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the calibrated score calls toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = docs.columns
    hidden = docs.select(F.struct(*names).alias("doc"), "doc_id", "text")
    return toxicity.score(hidden, model, ["doc"]).where("predicted = 0").select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return minhash.remove_near_duplicates(docs, size=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without bytes in strings of 100 bytes that start earlier; n_chars is counted anew."""
    rest = [c for c in docs.columns if c != "text"]
    hidden = docs.select("doc_id", "text", F.struct(*rest).alias("doc"))
    found = suffix_dedup.remove_repeats(hidden, 100, ["doc"], as_text=True)
    changed = {"text": F.col("rest"), "n_chars": F.length("rest").cast("long")}
    return found.select(*[
        changed[c].alias(c) if c in changed else F.col("doc")[c].alias(c)
        for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark passage, word for word or nearly so."""
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hidden = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text")
    return decontaminate.judge(hidden, tests, ["doc"]).where("NOT contaminated").select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, their count, and digests of the ids and of the decoded text."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = bpe.encode(docs, path, ["doc_id", "lang", "source"])
    return bpe.decode(ids, path).select(
        "doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# SQL has neither the models nor the tokenizer; the stages are tested against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
