"""Alignment of a byte-level and a piece tokenizer through inverted pair bitmaps.

Both tokenizers cut the same bytes, a space and the text. Two token occurrences are linked
if their bytes overlap, so every byte offset at which a token of either ends closes one
link; offsets at which both end close a group. A block of documents is inverted in its
task: per pair of ids a container with the block's documents that hold the pair, as sorted
numbers or as bits, and planes of the same form with bit 0, 1, ... of (links - 1). Blocks
share no document, so OR-merging a pair's containers keeps them all and its popcount is the
sum of theirs: the pair's count of documents. The counts are joined back to the containers,
and these postings return count and rank to the documents of their block.

A task holds one block, which ends after DOCS documents or BYTES of text; longer texts are
blocks of their own. A pair has one container a block, so hot pairs are many small rows,
summed by task before they are shuffled. Runs Spark jobs when called.

Texts that are null, empty or not spelt by the tokens of both tokenizers have no tokens.
Rows are aligned one for one: rows that share an id, null ids and copies count as documents
of their own. Of several pairs with an id's highest count, all count as best.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from landfall.llm.text import to_bytes
from landfall.session import settle

#: Documents and text bytes of a block. Bits of a block's container take DOCS / 8 bytes.
DOCS, BYTES = 1024, 4 << 20

_STORED = ("block long, pair long, n_docs int, docs binary, planes array<binary>, slot int, "
           "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, groups string")
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
           "count_sum long, groups_sha256 string, groups string")


class ByteLevel:
    """The tokens of a byte-level BPE file; strings of special tokens are plain text."""

    def __init__(self, file: str, pattern: str):
        import tiktoken

        parsed = json.loads(file)
        special = {t["content"] for t in parsed.get("added_tokens", ())}
        # The alphabet of byte-level BPE: printable bytes as they are, others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(others)}
        ranks = {bytes(byte[c] for c in token): i
                 for token, i in parsed["model"]["vocab"].items() if token not in special}
        self.spelt = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.spelt[i] = token
        # Ids are in the order of merges, so they serve as ranks.
        self.engine = tiktoken.Encoding(
            "byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return self.engine.encode_to_numpy(text, disallowed_special=()).astype(np.int64)


class Pieces:
    """The tokens of a sentencepiece model."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.engine = SentencePieceProcessor(model_proto=model)
        self.spelt = [self._bytes(i) for i in range(self.engine.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.engine.id_to_piece(i)
        if self.engine.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self.engine.is_control(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.engine.encode(text), np.int64)


class _Side:
    """One tokenizer with what is looked up for each of its ids."""

    def __init__(self, tokens: ByteLevel | Pieces):
        self.encode = tokens.encode
        self.spelt = np.array(tokens.spelt, object)
        self.lengths = np.array([len(s) for s in tokens.spelt], np.int64)

    def ends(self, text: str, wanted: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and the byte after each token, if the tokens spell the wanted bytes."""
        ids = self.encode(text)
        ends = np.cumsum(self.lengths[ids])
        if not len(ids) or ends[-1] != len(wanted) or b"".join(self.spelt[ids]) != wanted:
            return None
        return ids, ends


def _shown(a: _Side, b: _Side) -> np.ndarray:
    """Ids as the groups' text has them: of the first tokenizer within a group and at its
    end, then of the second."""
    return np.array([
        shape % i for side, shapes in ((a, (b"%d,", b"%d|")), (b, (b"%d,", b"%d;")))
        for i in range(len(side.spelt)) for shape in shapes], object)


def _aligned(a: _Side, b: _Side, shown: np.ndarray, text: str | None):
    """(n_a, n_b, n_groups, n_links, groups as text, the pair of each link) or None."""
    if not text:
        return None
    wanted = b" " + to_bytes(text)
    first, second = a.ends(" " + text, wanted), b.ends(text, wanted)
    if first is None or second is None:
        return None
    (ids_a, ends_a), (ids_b, ends_b) = first, second
    # 1 where a token of the first ends, 2 for the second, 3 for both.
    marks = np.zeros(len(wanted) + 1, np.uint8)
    marks[ends_a] = 1
    marks[ends_b] += 2
    marks = marks[np.flatnonzero(marks)]
    of_a, of_b, both = (marks & 1).astype(bool), marks > 1, marks == 3
    # Tokens that have ended before: the one that covers the last byte is the next.
    at_a, at_b = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
    pairs = ids_a[at_a] * len(b.spelt) + ids_b[at_b]
    # A group's ids of the first tokenizer stand before those of the second.
    group = np.cumsum(both) - both
    until_a, until_b = at_a[both] + 1, at_b[both] + 1
    before_b = np.concatenate([[0], until_b])
    items = np.empty(len(ids_a) + len(ids_b), np.int64)
    items[np.arange(len(ids_a)) + before_b[group[of_a]]] = 2 * ids_a + both[of_a]
    items[np.arange(len(ids_b)) + until_a[group[of_b]]] = (
        2 * (len(a.spelt) + ids_b) + both[of_b])
    groups = b"".join(shown[items])[:-1]
    return len(ids_a), len(ids_b), len(until_a), len(marks), groups, pairs


def _container(slots: np.ndarray) -> bytes:
    """Sorted document numbers of a block: as such, or as bits from DOCS / 16 on."""
    if len(slots) < DOCS // 16:
        return slots.astype("<u2").tobytes()
    bits = np.zeros(DOCS, np.uint8)
    bits[slots] = 1
    return np.packbits(bits).tobytes()


def _slots(container: bytes) -> np.ndarray:
    if len(container) < DOCS // 8:
        return np.frombuffer(container, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8)))


def _inverted(found: list[tuple[int, np.ndarray]]) -> Iterator[tuple]:
    """(pair, n_docs, docs, planes) for each pair of a block, from its documents' links."""
    links = np.sort(np.concatenate([pairs * DOCS + slot for slot, pairs in found]))
    firsts = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]]))
    pairs, slots = np.divmod(links[firsts], DOCS)
    more = np.diff(firsts, append=len(links)) - 1
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    ends = np.append(starts[1:], len(pairs))
    most = np.maximum.reduceat(more, starts)
    packed = slots.astype("<u2").tobytes()
    for pair, i, j, top in zip(pairs[starts].tolist(), starts.tolist(), ends.tolist(),
                               most.tolist(), strict=True):
        docs = packed[2 * i:2 * j] if j - i < DOCS // 16 else _container(slots[i:j])
        planes = [_container(slots[i:j][more[i:j] >> bit & 1 == 1])
                  for bit in range(top.bit_length())]
        yield pair, j - i, docs, planes or None


def _encoded(docs: DataFrame, byte_file: str, pattern: str, model: bytes,
             with_groups: bool) -> DataFrame:
    """Rows of the pairs (docs, planes) and rows of the documents, by block."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_STORED))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
            schema=schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held, size = [], 0
        for found in batches:
            for at in range(found.num_rows):
                text = found["text"][at].as_py()
                held.append((found["doc_id"][at].as_py(), text))
                size += len(text or "")
                if len(held) == DOCS or size >= BYTES:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = _Side(ByteLevel(byte_file, pattern)), _Side(Pieces(model))
        shown = _shown(a, b)
        first = TaskContext.get().partitionId() << 33
        for number, block in enumerate(blocks(batches), first):
            rows, found = [], []
            for slot, (doc_id, text) in enumerate(block):
                got = _aligned(a, b, shown, text)
                n_a, n_b, n_groups, n_links, groups = got[:5] if got else (0, 0, 0, 0, b"")
                if got:
                    found.append((slot, got[5]))
                rows.append((
                    number, None, None, None, None, slot, doc_id, n_a, n_b, n_groups, n_links,
                    hashlib.sha256(groups).hexdigest() if got else "",
                    groups.decode() if with_groups else None))
                if with_groups:
                    yield batch(rows)
                    rows.clear()
            if rows:
                yield batch(rows)
            rows = []
            for pair in _inverted(found) if found else ():
                rows.append((number, *pair, *[None] * 8))
                if len(rows) == 16_384:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, _STORED)


def _returned(postings: DataFrame) -> DataFrame:
    """The documents with the sums that the scored postings of their block bring."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_RESULT))

    def add(sums: np.ndarray, part: pa.RecordBatch) -> None:
        """Counts and ranks of some containers of one block to their documents."""
        counts = part["count"].to_numpy(zero_copy_only=False)
        best = part["best"].to_numpy(zero_copy_only=False).astype(np.int64)
        each = [_slots(c) for c in part["docs"].to_pylist()]
        sizes = [len(s) for s in each]
        slots = np.concatenate(each)
        np.add.at(sums[0], slots, np.repeat(counts, sizes))
        np.add.at(sums[1], slots, np.repeat(best, sizes))
        for k, planes in enumerate(part["planes"].to_pylist()):
            for bit, plane in enumerate(planes or ()):
                also = _slots(plane)
                sums[0, also] += counts[k] << bit
                sums[1, also] += best[k] << bit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sums = None, np.zeros((2, DOCS), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 8192):
                part = whole.slice(at, 8192)
                numbers = part["block"].to_numpy()
                of_docs = part["slot"].is_valid().to_numpy(zero_copy_only=False)
                cuts = np.flatnonzero((numbers[1:] != numbers[:-1])
                                      | (of_docs[1:] != of_docs[:-1])) + 1
                for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)],
                                strict=True):
                    if numbers[i] != block:
                        block = numbers[i]
                        sums[:] = 0
                    piece = part.slice(i, j - i)
                    if not of_docs[i]:
                        add(sums, piece)
                        continue
                    slots = piece["slot"].to_numpy(zero_copy_only=False).astype(np.int64)
                    new = {"count_sum": pa.array(sums[0, slots]),
                           "n_best": pa.array(sums[1, slots])}
                    yield pa.RecordBatch.from_arrays(
                        [new[f.name] if f.name in new else piece[f.name] for f in schema],
                        schema=schema)

    return postings.mapInArrow(run, _RESULT)


def align(docs: DataFrame, byte_path: str, pattern: str, piece_path: str,
          with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    `byte_path` and `piece_path` are the files of the two tokenizers, `pattern` splits text
    for the first. `with_groups` adds the groups themselves, as `a1,a2|b1;a3|b2,b3`; null
    where a text has no tokens.
    """
    with open(byte_path, encoding="utf-8") as file:
        byte_file = file.read()
    with open(piece_path, "rb") as file:
        model = file.read()
    second = len(Pieces(model).spelt)
    stored = settle(_encoded(docs, byte_file, pattern, model, with_groups), "postings")
    postings = stored.where("pair IS NOT NULL").select("block", "pair", "n_docs", "docs", "planes")

    counts = settle(
        postings.groupBy("pair").agg(F.sum("n_docs").alias("count"))
        .withColumn("a", F.floor(F.col("pair") / second)), "pairs")
    tops = counts.groupBy("a").agg(F.max("count").alias("top"))
    scored = counts.join(tops, "a").select(
        "pair", "count", (F.col("count") == F.col("top")).alias("best"))

    def none(name: str):
        return F.lit(None).cast(stored.schema[name].dataType).alias(name)

    per_doc = ["slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]
    # By merging at any size: a small table of pairs would be broadcast, a large one not.
    sent = postings.join(scored.hint("merge"), "pair").select(
        "block", "docs", "planes", "count", "best", *[none(c) for c in per_doc])
    heads = stored.where("pair IS NULL").select(
        "block", none("docs"), none("planes"), F.lit(None).cast("long").alias("count"),
        F.lit(None).cast("boolean").alias("best"), *per_doc)
    met = sent.unionByName(heads).repartition("block").sortWithinPartitions(
        F.col("block"), F.col("slot").asc_nulls_first())
    found = _returned(met)
    if with_groups:
        return found.withColumn("groups", F.when(F.col("n_a") > 0, F.col("groups")))
    return found.drop("groups")
