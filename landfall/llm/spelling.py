"""Spelling variants of words, found in the neighbourhoods of their reduced forms.

A letter is hashed to one of SYMBOLS symbols, and a word is reduced to the symbols of its
letters. Two words that differ by one inserted, deleted or replaced letter have reduced
forms that differ by one such edit, or not at all. So every word lists the full
neighbourhood of its reduced form, which is small, for the alphabet is; the list is joined
with the vocabulary by reduced form, and only pairs of words that really differ by one edit
stay. Each word of a pair finds the other, once, so nothing need be made distinct.

Reduced forms are known by a polynomial hash, whose changes by an edit follow from sums
over the word's parts. A bitmap of the hashes in the vocabulary, of FILTER bits at any
size of input, is sent to all tasks and keeps those neighbours from the shuffle that
nothing can match; a full one would keep none back and change no result.

The vocabulary grows with the input: words are counted by task, then in all. Words are
followed to their roots by pointer doubling; as each form is at least RATIO times as
frequent, that takes few rounds, and each joins every word with one row. Runs Spark jobs
when called.

Null and empty texts have no words. Without an id a row's words are taken as they are.
Rows that share an id, and copies, all count. Of forms equally frequent the first in
code-point order is taken.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from landfall.llm.text import map_rows, mix, to_bytes
from landfall.session import settle

#: Runs that count, the divisor that marks an occurrence, shortest word.
RUN, DIVISOR, SHORTEST = re.compile("[a-zÀ-ÿ]+"), 31, 7
#: Least occurrences of a word; how much more frequent a form must be than its variant.
LEAST, RATIO = 2, 10
#: Symbols of the reduced alphabet; bits of the filter (16 MB).
SYMBOLS, FILTER = 8, 1 << 27
#: Words counted in a task before they are sent on; neighbours that are listed at once.
WORDS_HELD, HELD = 200_000, 1 << 21

_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_B = np.uint64(_BASE)
_SEGMENT = 1 << 15  # bits of one of Spark's bitmaps


def occurrences(doc_id: int | None, text: str | None) -> Iterator[str]:
    """The words of a text: its lower-cased runs, of which the hash of id and run marks
    some to lose a letter."""
    begun = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
    # Bytes are lower-cased in A-Z alone.
    for run in RUN.findall(to_bytes(text).lower().decode()):
        if len(run) < SHORTEST:
            continue
        if begun is not None:
            mark = zlib.crc32(run.encode(), begun)
            if mark % DIVISOR == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < SHORTEST:
                    continue
        yield run


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words with at least LEAST occurrences."""

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        held: Counter[str] = Counter()
        for r in records:
            held.update(occurrences(r["doc_id"], r["text"]))
            if len(held) > WORDS_HELD:
                yield from held.items()
                held.clear()
        yield from held.items()

    found = map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                     "word string, n long", rows)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def symbols(points: np.ndarray) -> np.ndarray:
    """The symbol, 1 to SYMBOLS, of each letter."""
    return mix(points.astype(np.uint64) + np.uint64(1)) % np.uint64(SYMBOLS) + np.uint64(1)


def _matrix(words: list[str]) -> np.ndarray:
    """Symbols of words of one length, a row for each."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    return symbols(points).reshape(len(words), -1)


def _powers(n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _B))])


def _prefixes(rows: np.ndarray) -> np.ndarray:
    """Hash sums of the symbols before each place; the last column is the word's hash."""
    sums = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    np.cumsum(rows * _powers(rows.shape[1])[:-1], axis=1, out=sums[:, 1:])
    return sums


def reduced(words: list[str]) -> np.ndarray:
    """Hash of the reduced form of each of some words of one length."""
    return _prefixes(_matrix(words))[:, -1]


def neighbourhood(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, which word) of all words over the symbols at most one edit away from the
    reduced form of each of some words of one length, each once."""
    rows = _matrix(words)
    n, length = rows.shape
    powers, before = _powers(length + 1), _prefixes(rows)
    whole = before[:, -1:]
    number = np.broadcast_to(np.arange(n)[:, None], rows.shape)
    yield whole[:, 0], number[:, 0]

    # Of equal symbols in a row, the last one is deleted.
    shorter = before[:, :-1] + (whole - before[:, 1:]) * _INVERSE
    last = np.ones(rows.shape, bool)
    last[:, :-1] = rows[:, 1:] != rows[:, :-1]
    yield shorter[last], number[last]

    for symbol in range(1, SYMBOLS + 1):
        other = rows != np.uint64(symbol)
        changed = whole + (np.uint64(symbol) - rows) * powers[:length]
        yield changed[other], number[other]
        # A symbol goes before a different one or to the end, so equal results come once.
        longer = before[:, :-1] + np.uint64(symbol) * powers[:length] + (
            whole - before[:, :-1]) * _B
        yield longer[other], number[other]
        yield whole[:, 0] + np.uint64(symbol) * powers[length:length + 1], number[:, 0]


def _by_length(words: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers and words of one length at a time, about HELD neighbours together."""
    groups: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        groups.setdefault(len(word), []).append(k)
    for length, numbers in groups.items():
        step = max(1, HELD // (2 * SYMBOLS * (length + 1)))
        for at in range(0, len(numbers), step):
            part = numbers[at:at + step]
            yield part, [words[k] for k in part]


def _reduced_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """(word, n, mark): each word with the hash of its reduced form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch["word"].to_pylist()
            marks = np.zeros(len(words), np.uint64)
            for numbers, part in _by_length(words):
                marks[numbers] = mix(reduced(part))
            yield pa.RecordBatch.from_arrays(
                [batch["word"], batch["n"], pa.array(marks.view(np.int64))],
                names=["word", "n", "mark"])

    return vocabulary.mapInArrow(run, "word string, n long, mark long")


def _filter(marks: DataFrame) -> np.ndarray:
    """A bitmap of FILTER bits, with those of all marks set; built by segments."""
    place = F.col("mark").bitwiseAND(FILTER - 1) + 1
    segments = (
        marks.select(F.bitmap_bucket_number(place).alias("segment"),
                     F.bitmap_bit_position(place).alias("bit"))
        .groupBy("segment").agg(F.bitmap_construct_agg("bit").alias("bits")))
    found = np.zeros((FILTER // _SEGMENT, _SEGMENT // 8), np.uint8)
    for row in segments.toLocalIterator():
        found[row["segment"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return found.reshape(-1)


def _probes(vocabulary: DataFrame, bits: np.ndarray) -> DataFrame:
    """(word, n, mark): a row for each neighbour of a word's reduced form that may exist."""
    told = vocabulary.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = told.value
        for batch in batches:
            whole = batch["word"].to_pylist()
            for numbers, words in _by_length(whole):
                marks, which = [], []
                for found, number in neighbourhood(words):
                    found = mix(found)
                    at = found & np.uint64(FILTER - 1)
                    there = bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(
                        np.uint8) & 1 == 1
                    marks.append(found[there])
                    which.append(number[there])
                taken = pa.array(np.array(numbers)[np.concatenate(which)])
                yield pa.RecordBatch.from_arrays(
                    [batch["word"].take(taken), batch["n"].take(taken),
                     pa.array(np.concatenate(marks).view(np.int64))],
                    names=["word", "n", "mark"])

    return vocabulary.mapInArrow(run, "word string, n long, mark long")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): each ordered pair of words that differ by one edit."""
    known = settle(_reduced_vocabulary(vocabulary), "reduced")
    probes = _probes(known.select("word", "n"), _filter(known.select("mark")))
    return probes.join(known.select(
        "mark", F.col("word").alias("near"), F.col("n").alias("near_n")), "mark").where(
        F.levenshtein("word", "near", 1) == 1).drop("mark")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, from (word, form)."""
    now = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = settle(now.join(onward, "root", "left").select(
            "word", F.coalesce("onward", "root").alias("root"),
            F.col("onward").isNotNull().alias("moved")), "roots")
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return now


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the whole texts.

    `form` is the most frequent near word if it is RATIO times as frequent as the word, or
    null; `root` is where following the forms ends.
    """
    vocabulary = settle(count_words(docs), "vocabulary")
    near = settle(near_words(vocabulary).groupBy("word", "n").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
        .alias("top")), "near")
    frequent = -F.col("top.n") >= RATIO * F.col("n")
    judged = near.select(
        "word", "n_near", F.when(frequent, F.col("top.word")).alias("form"),
        F.when(frequent, -F.col("top.n")).alias("form_n"))
    roots = _roots(judged.where("form IS NOT NULL").select("word", "form"))
    return vocabulary.join(judged, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
