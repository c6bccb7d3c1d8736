"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions alone.

Texts become arrays of word hashes (words are lower-case runs of letters and digits). A
mask looks at five of the words that follow a position and ignores those between, so that
substituted words can fall into its gaps. Equal mask hashes of a test item and a document
give an alignment; the item's words are then compared with the document's along it. A
document is contaminated if some WINDOW words of an item in a row (the whole item, if it
is shorter) agree with it in at least PERCENT of their places. Items of 5 to 7 words, in
which one word may differ, have masks of their own with four places; shorter items must
agree in full and have one mask of all their words.

Null texts and texts without words match nothing. Rows are judged one for one by their text; rows that share an id do not mix, copies are judged alike. Without test
items nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from landfall.session import settle

#: Positions that a mask looks at, for items of SHORT words or more: of all substitutions
#: of a fifth of 8 to 20 words, each leaves a mask whole.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 5), (0, 1, 3, 6, 7))
#: For items of EXACT words or more: any one substitution in 5, 6 or 7 words leaves one whole.
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))
EXACT, SHORT = 5, 8
#: A mask's number is part of its hashes.
NUMBERS = {m: n for n, m in enumerate(dict.fromkeys(
    MASKS + SHORT_MASKS + tuple(tuple(range(n)) for n in range(1, EXACT))))}
WINDOW, PERCENT = 20, 80
#: Distinct test hashes up to which they are sent to every task (32 MB at most).
BROADCAST_HASHES = 1_000_000


def word_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return F.transform(F.coalesce(words, F.array().cast("array<string>")),
                       lambda w: F.xxhash64(w))


def masks_of(kind: int) -> tuple[tuple[int, ...], ...]:
    """Masks of the items with `kind` words: 1 to EXACT - 1, or EXACT or SHORT and more."""
    return MASKS if kind == SHORT else SHORT_MASKS if kind == EXACT else (tuple(range(kind)),)


def _seeds(rows: DataFrame, keys: list[str], masks: Sequence[tuple[int, ...]]) -> DataFrame:
    """keys, at, seed: the mask hashes at every position of `words`."""
    span = 1 + max(m[-1] for m in masks)
    shifts = F.arrays_zip(*[
        F.slice("words", k + 1, F.greatest(F.lit(0), F.size("words") - k)).alias(f"w{k}")
        for k in range(span)])
    at = rows.select(*keys, F.posexplode(shifts).alias("at", "w"))
    # Beyond the end a zipped field is null: the mask does not fit there.
    hashes = F.array(*[
        F.when(F.col(f"w.w{m[-1]}").isNotNull(),
               F.xxhash64(F.lit(NUMBERS[m]), *[F.col(f"w.w{k}") for k in m]))
        for m in masks])
    return at.select(*keys, "at", F.explode(hashes).alias("seed")).where("seed IS NOT NULL")


def _agreeing(item: Column, doc: Column, delta: Column) -> Column:
    """1 for each word of the item that the document has at its place, else 0."""
    return F.transform(item, lambda w, i: F.when(
        (i + delta >= 0) & (F.get(doc, (i + delta).cast("int")) == w), 1).otherwise(0))


def alignments(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """(doc_id, mark, item_id, delta) of verified overlaps; `mark` is the text's hash.

    Of the overlaps with an item below EXACT words, which are all alike, a text has the first.
    """
    mark = F.xxhash64("text")
    tests = tests.select("item_id", word_hashes(F.col("text")).alias("words")).where(
        F.size("words") > 0)
    n = F.size("words")
    kind = F.when(n >= SHORT, SHORT).when(n >= EXACT, EXACT).otherwise(n)
    items = settle(tests.withColumn("item", F.monotonically_increasing_id()), "items")
    # Six kinds at most; documents are asked for the masks of those that there are.
    kinds = sorted(r[0] for r in items.select(kind).distinct().collect()) or [SHORT]
    seeds = settle(reduce(DataFrame.unionByName, [
        _seeds(items.where(kind == k), ["item"], masks_of(k)).withColumn("kind", F.lit(k))
        for k in kinds]).withColumnRenamed("at", "begin"), "seeds")
    distinct = seeds.select("seed").distinct()
    known = settle(distinct, "hashes")
    few = known.count() <= BROADCAST_HASHES
    rows = docs.select("doc_id", mark.alias("mark"), word_hashes(F.col("text")).alias("words"))
    asked = _seeds(rows, ["doc_id", "mark"],
                   list(dict.fromkeys(m for k in kinds for m in masks_of(k))))
    # Most seeds of the corpus meet no test: only hashes are compared at first.
    met = settle(asked.join(F.broadcast(known) if few else known, "seed", "left_semi"), "met")
    hits = settle(
        met.join(seeds, "seed")
        .select("doc_id", "mark", "item", "kind", (F.col("at") - F.col("begin")).alias("delta"))
        .groupBy("doc_id", "mark", "item", F.when(F.col("kind") >= EXACT, F.col("delta")).alias(
            "place")).agg(F.min("delta").alias("delta")).drop("place"), "hits")
    words = rows.withColumnRenamed("words", "doc")
    size, window = F.size("words"), F.least(F.lit(WINDOW), F.size("words"))
    # Each window is summed by itself: the cost is linear in the item's length.
    agreeing = _agreeing(F.col("words"), F.col("part"), F.col("shift"))
    enough = F.exists(
        F.sequence(F.lit(1), size - window + 1),
        lambda b: 100 * F.aggregate(F.slice("agreeing", b, window), F.lit(0), lambda s, x: s + x)
        >= PERCENT * window)
    first = F.greatest(F.lit(0), F.col("delta"))
    return (
        hits.join(words, hits.doc_id.eqNullSafe(words.doc_id) & (hits.mark == words.mark))
        .select(hits.doc_id, hits.mark, "item", "delta", "doc")
        .join(items, "item")
        .select("doc_id", "mark", "item_id", "delta", "words",
                F.slice("doc", first + 1, size).alias("part"),
                (F.col("delta") - first).alias("shift"))
        .withColumn("agreeing", agreeing).where(enough)
        .select("doc_id", "mark", "item_id", "delta").distinct()
    )


def judge(docs: DataFrame, tests: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep`, contaminated and the sorted item_ids of every document."""
    found = settle(alignments(docs, tests), "found").groupBy("doc_id", "mark").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    rows = docs.select(F.struct(*keep).alias("kept"), "doc_id", F.xxhash64("text").alias("mark"))
    same = rows.doc_id.eqNullSafe(found.doc_id) & (rows.mark == found.mark)
    return rows.join(found, same, "left").select(
        "kept.*", found.mark.isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"))
