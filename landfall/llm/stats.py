"""Rule statistics of a text, for the quality operators."""

from __future__ import annotations

from collections import Counter

import numpy as np

from landfall.llm.text import _SPACE, mix, to_bytes, word_hashes, word_spans

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATES = ["word_length", "symbols", "dup_lines", "repeats", "capitals", "exclaims", "bars",
         "marks", "digits", "distinct"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def _table(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_UPPER, _LOWER = _table(bytes(range(0x41, 0x5B))), _table(bytes(range(0x61, 0x7B)))
_DIGIT = _table(b"0123456789")


def repeated_words(words: list[bytes], hashes: np.ndarray, size: int = 5) -> int:
    """Words inside a window of `size` words that occurs more than once."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n])
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    # Equal hashes only nominate; the words themselves decide.
    places = np.flatnonzero(hit).tolist()
    windows = [tuple(words[i:i + size]) for i in places]
    count = Counter(windows)
    cover = np.zeros(len(words) + 1, np.int64)
    for i, w in zip(places, windows, strict=True):
        if count[w] > 1:
            cover[i] += 1
            cover[i + size] -= 1
    return int((np.cumsum(cover)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The exact counts of BASE and the rates of RATES. Empty texts have zeros."""
    raw = to_bytes(text)
    data = np.frombuffer(raw, np.uint8)
    starts, ends = word_spans(data)
    n = len(starts)
    symbols = int(_SYMBOL[data].sum())
    if not n:
        return [0, 0, symbols, 0, 0], [0.0] * len(RATES)
    inside = ~_SPACE[data]
    chars = int((inside & ((data & 0xC0) != 0x80)).sum())
    words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    hashes = word_hashes(data)
    seen: set[bytes] = set()
    lines = dup = 0
    for line in raw.split(b"\n"):
        if not line.strip(b" \t\r\x0b\x0c"):
            continue
        lines += 1
        if line in seen:
            dup += 1
        seen.add(line)
    repeats = repeated_words(words, hashes)
    upper, lower = int(_UPPER[data].sum()), int(_LOWER[data].sum())
    rates = [
        chars / n, symbols / n, dup / lines, repeats / n, upper / max(1, upper + lower),
        raw.count(b"!") / n, raw.count(b"|") / n, int(_MARK[data].sum()) / n,
        int(_DIGIT[data].sum()) / n, len(set(words[:])) / n,
    ]
    return [n, chars, symbols, dup, repeats], rates
