"""Documents in blocks of neighbouring ids, and their texts in packs for a shuffle.

A block is the unit that puts its questions (distinct words, repeated strings) to buckets
and gets their answers back before its texts are read again. Rows without an id are spread
by their text. A block with many rows (of one id, say) or many bytes is cut by the hash of
id and text, so only rows alike in both stay together whatever their number; those are read
as a stream. Packs compress many texts to a row; a pack belongs to one block.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.text import map_rows, to_bytes
from landfall.session import settle

BLOCK_DOCS = 4096
PACK_BYTES = 4 << 20
#: A block with more bytes of text, or with twice BLOCK_DOCS rows, is cut.
BLOCK_BYTES = 32 << 20
#: Bytes of text for each task of a shuffle, where the session's tasks would get more.
TASK_BYTES = 128 << 20


def squeezed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=9).compress(data)


def unsqueezed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _home(doc_id: Column) -> Column:
    """The block of a row before large blocks are cut."""
    spread = -1 - F.pmod(F.xxhash64("text"), F.lit(1024))
    return F.coalesce(F.floor(doc_id / BLOCK_DOCS), spread).cast("long")


def blocked(docs: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, int]:
    """(block, doc_id, text, kept), and the tasks that a shuffle of them wants.

    `kept` is a struct of the columns to keep. Runs a job that sums the texts of each block.
    """
    number = F.col("doc_id").cast("long")
    sizes = settle(docs.select(
        _home(number).alias("block"), F.octet_length("text").alias("bytes")
    ).groupBy("block").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")), "blocks")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                -(-total // TASK_BYTES))
    parts = F.greatest(F.ceil(F.col("rows") / BLOCK_DOCS),
                       F.ceil(F.coalesce("bytes", F.lit(0)) / BLOCK_BYTES))
    large = settle(sizes.where(
        (F.col("rows") > 2 * BLOCK_DOCS) | (F.col("bytes") > BLOCK_BYTES)
    ).select("block", parts.alias("parts")), "large_blocks")
    rows = docs.select(_home(number).alias("block"), number.alias("doc_id"), "text",
                       F.struct(*keep).alias("kept"))
    if large.isEmpty():
        return rows, tasks
    # Two blocks that get one number by chance are read as one.
    cut = F.xxhash64("block", F.pmod(F.xxhash64("doc_id", "text"), F.col("parts")))
    return rows.join(large, "block", "left").select(
        F.when(F.col("parts").isNull(), F.col("block")).otherwise(cut).alias("block"),
        "doc_id", "text", "kept"), tasks


def dealt(df: DataFrame, tasks: int, key: str, *order: str) -> DataFrame:
    """`df` shuffled by `key` and sorted by it and `order` in each task.

    Only more tasks than the session's are named, so that few rows may still share a task.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moved = df.repartition(tasks, key) if tasks > usual else df.repartition(key)
    return moved.sortWithinPartitions(key, *order)


def packs(blocks: DataFrame) -> DataFrame:
    """(block, pack) of (block, doc_id, text, kept)."""

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        held: dict[int, list[tuple]] = {}
        size = 0

        def sent() -> Iterator[tuple]:
            for block, found in held.items():
                yield block, squeezed(pickle.dumps(found, 5))
            held.clear()

        for r in records:
            text = to_bytes(r["text"])
            held.setdefault(r["block"], []).append(
                (r["doc_id"], tuple(r["kept"].values()), text))
            size += len(text) + 200
            if size > PACK_BYTES:
                yield from sent()
                size = 0
        yield from sent()

    return map_rows(blocks, "block long, pack binary", rows)


def read_pack(pack: bytes) -> list[tuple]:
    """(doc_id, kept values, text as bytes) of each document."""
    return pickle.loads(unsqueezed(pack))


def ddl(docs: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     for f in docs.select(*columns).schema)
