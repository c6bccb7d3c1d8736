"""Words and hashes of texts, as numpy arrays over the UTF-8 bytes.

A word is a maximal run of characters that are no ASCII white space,
`[^\\x20\\x09-\\x0D]+`. A null text counts as empty.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# A byte's random value in the polynomial hash; A-Z as a-z in the second table.
_RANDOM = np.random.Generator(np.random.PCG64(2026)).integers(
    0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_RANDOM_LOWER = _RANDOM.copy()
_RANDOM_LOWER[0x41:0x5B] = _RANDOM[0x61:0x7B]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_powers = np.cumprod(np.full(1 << 10, _BASE))


def to_bytes(text: str | None) -> bytes:
    return text.encode("utf-8") if text else b""


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX1
    h = h ^ (h >> np.uint64(29))
    h = h * _MIX2
    return h ^ (h >> np.uint64(32))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after it."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    global _powers
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    if lengths.max() > len(_powers):
        _powers = np.cumprod(np.full(2 * int(lengths.max()), _BASE))
    letters = (_RANDOM_LOWER if lower else _RANDOM)[data[~_SPACE[data]]]
    offsets = np.cumsum(lengths) - lengths
    at = np.arange(len(letters)) - np.repeat(offsets, lengths)
    return mix(np.add.reduceat(letters * _powers[at], offsets) ^ lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the `size`-word shingles.

    Fewer words count as one shingle of them all; no words give none.
    """
    if not len(words):
        return np.empty(0, np.uint64)
    n = max(1, len(words) - size + 1)
    h = np.full(n, np.uint64(min(size, len(words))))
    for k in range(min(size, len(words))):
        h = mix(h * _BASE + words[k:k + n])
    return np.unique(h)


def map_rows(df: DataFrame, schema: str, rows: Callable[[Iterator[dict]], Iterator[tuple]],
             flush: int = 4096) -> DataFrame:
    """`rows` over each partition: dicts in, tuples of `schema` out, in Arrow batches."""
    names = [f.name for f in _schema(df, schema)]
    types = _arrow(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[dict]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    yield from batch.slice(at, 256).to_pylist()

        out: list[tuple] = []
        size = 0
        for row in rows(records()):
            out.append(row)
            size += sum(map(_weight, row))
            if len(out) >= flush or size > 1 << 22:
                yield _batch(out, names, types)
                out, size = [], 0
        if out:
            yield _batch(out, names, types)
        out.clear()
        _release()

    return df.mapInArrow(run, schema)


def _weight(value: object) -> int:
    """About the bytes of a value, those inside it included."""
    if isinstance(value, (str, bytes)):
        return len(value)
    if isinstance(value, dict):
        return sum(map(_weight, value.values()))
    if isinstance(value, (list, tuple)):
        plain = not value or isinstance(value[0], (int, float))
        return 8 * len(value) if plain else sum(map(_weight, value))
    return 0


def _release() -> None:
    """Give back what a task has freed: the worker lives on and takes tasks of other
    stages, which count together with it against the executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names)


def _schema(df: DataFrame, schema: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(schema)


def _arrow(df: DataFrame, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    return [to_arrow_type(f.dataType) for f in _schema(df, schema)]
