"""BPE encoding and decoding by a table of distinct words.

Documents fall into blocks of neighbouring ids. Each block states its distinct words once
(a word is cut by ASCII white space, which no piece of this kind of tokenizer spans);
the words meet in buckets by their hash, where each distinct word is encoded once by the
tokenizer itself; the ids go back to the blocks that asked, and there each document's
words are replaced, by position, with their ids. Decoding looks every id up in the table
of pieces, whose size the vocabulary fixes.

Words travel many to a row, in sorted order, so the shuffles stay well below the texts'
size. The blocks' texts and the ids for their words are sorted together and read as a
stream: a task holds one block's distinct words and one pack of texts. There are as many
buckets as the bytes of the texts ask for, at least four a task of the session.

Null and empty texts have no ids. Rows are encoded one for one; rows that share an id stay
apart; rows without an id are spread by their text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from landfall.llm.blocks import (
    blocked, ddl, dealt, packs, read_pack, squeezed, unsqueezed)
from landfall.llm.text import map_rows, to_bytes

#: Distinct words that a task gathers before it sends them on.
WORDS_HELD = 250_000


def _questions(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, words): a block's distinct words, by bucket."""

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        held: dict[int, set[bytes]] = {}
        size = 0

        def sent() -> Iterator[tuple]:
            for block, words in held.items():
                parts: dict[int, list[bytes]] = {}
                for word in words:
                    parts.setdefault(zlib.crc32(word) % buckets, []).append(word)
                for bucket, found in parts.items():
                    yield bucket, block, squeezed(b" ".join(sorted(found)))
            held.clear()

        for record in records:
            words = held.setdefault(record["block"], set())
            size -= len(words)
            words.update(to_bytes(record["text"]).split())
            size += len(words)
            if size > WORDS_HELD:
                yield from sent()
                size = 0
        yield from sent()

    return map_rows(docs, "bucket int, block long, words binary", rows)


def _answers(questions: DataFrame, tokenizer: str, tasks: int) -> DataFrame:
    """(block, words, ids): the ids of the words, each distinct word encoded once."""

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        encoder = load(tokenizer)
        asked: list[tuple[int, bytes]] = []

        def told() -> Iterator[tuple]:
            words = sorted(set().union(*(w.split(b" ") for _, w in asked)))
            known: dict[bytes, list[int]] = {}
            for at in range(0, len(words), 20_000):
                part = words[at:at + 20_000]
                for word, found in zip(part, encoder.encode_batch_fast(
                        [w.decode() for w in part], add_special_tokens=False), strict=True):
                    known[word] = found.ids
            for block, joined in asked:
                found = [known[w] for w in joined.split(b" ")]
                lengths = np.array([len(f) for f in found], "<u4")
                ids = np.fromiter((i for f in found for i in f), "<u4", int(lengths.sum()))
                yield (block, squeezed(joined), squeezed(_pack_numbers(lengths)),
                       squeezed(_pack_numbers(ids)))
            asked.clear()

        bucket = None
        for record in records:
            if asked and record["bucket"] != bucket:
                yield from told()
            bucket = record["bucket"]
            asked.append((record["block"], unsqueezed(record["words"])))
        if asked:
            yield from told()

    return map_rows(dealt(questions, tasks, "bucket"),
                    "block long, words binary, lengths binary, ids binary", rows)


def _pack_numbers(values: np.ndarray) -> bytes:
    """Numbers in two bytes each if they fit, with a flag in front."""
    if len(values) and values.max() > 0xFFFF:
        return b"4" + values.astype("<u4").tobytes()
    return b"2" + values.astype("<u2").tobytes()


def _unpack_numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4" if packed[:1] == b"4" else "<u2", offset=1)


def load(tokenizer: str):
    """The tokenizer from the text of its file."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
    found = Tokenizer.from_str(tokenizer)
    found.no_truncation()
    found.no_padding()
    return found


def encode(docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep` and ids, as little-endian unsigned 32-bit integers, for each row of docs."""
    tokenizer = open(path, encoding="utf-8").read()
    blocks, tasks = blocked(docs, keep)
    none = F.lit(None).cast("binary")
    told = _answers(_questions(blocks, 4 * tasks), tokenizer, tasks).select(
        "block", F.lit(0).alias("kind"), "words", "lengths", "ids", none.alias("pack"))
    texts = packs(blocks).select(
        "block", F.lit(1).alias("kind"), none.alias("words"), none.alias("lengths"),
        none.alias("ids"), "pack")
    met = dealt(told.unionByName(texts), tasks, "block", "kind")

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        block, table = None, {}
        for record in records:
            if record["block"] != block:
                block, table = record["block"], {}
            if record["kind"] == 0:
                lengths = _unpack_numbers(unsqueezed(record["lengths"]))
                ends = np.cumsum(lengths, dtype=np.int64) * 4
                ids = _unpack_numbers(unsqueezed(record["ids"])).astype("<u4").tobytes()
                begin = 0
                for word, end in zip(unsqueezed(record["words"]).split(b" "), ends.tolist(), strict=True):
                    table[word] = ids[begin:end]
                    begin = end
            else:
                for _, kept, text in read_pack(record["pack"]):
                    yield *kept, b"".join(map(table.__getitem__, text.split()))

    return map_rows(met, f"{ddl(docs, keep)}, ids binary", rows)


def pieces(path: str) -> list[str]:
    """The piece of each id, as decode() of the tokenizer spells it."""
    tokenizer = load(open(path, encoding="utf-8").read())
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    return [tokenizer.id_to_token(i) or "" for i in range(size)]


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds `decoded` to rows with `ids`: each id joined with its piece, joined by blanks.

    That is how this kind of tokenizer decodes, for its file names no decoder.
    """
    # The table of pieces has the vocabulary's fixed size.
    table = encoded.sparkSession.sparkContext.broadcast(
        [p.encode() for p in pieces(path)])

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        piece = table.value.__getitem__
        for record in records:
            ids = record["ids"] or b""
            text = b" ".join(map(piece, np.frombuffer(ids, "<u4").tolist()))
            yield *record.values(), text.decode()

    return map_rows(encoded, f"{ddl(encoded, encoded.columns)}, decoded string", rows)
