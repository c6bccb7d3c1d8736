"""Language of texts and of the spans of mixed texts, by word scores and Viterbi.

A word is a run of letters (with their marks) of one script. The scripts narrow its
candidates to the languages that were learnt with that script in at least RARE of their
letters; a script that no language was learnt with leaves all of them. A word's score in a
language is the log probability of its letters, each given the two before it, with longer
contexts smoothed by shorter ones. Viterbi picks the labels of all words of a text at
once, at a price for each switch between neighbouring words; words with one label in a row
are a span. The text's language is the one with most letters in its spans.

The letters of a labelled sample of at most SAMPLE_ROWS documents are counted in hashed
tables of fixed size per language, so the model's size depends on the number of languages
alone. Everything else runs on all rows, whole texts, without a shuffle. `fit` runs Spark
jobs when called.

Null texts and texts without a letter are `und` with score 0 and no spans; so are all
without anything to learn from. Among languages with as many letters, and for paths of
equal score, the first in code-point order wins. Rows are labelled one for one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.labels import fold
from landfall.llm.text import map_rows
from landfall.session import settle

#: Most documents that the model is fitted on.
SAMPLE_ROWS = 16_000
#: Hash values of one letter, two and three; a word's ends count as a letter.
SIZES = (1 << 12, 1 << 14, 1 << 16)
#: Weight of a shorter context, price of a switch, share of letters that a script needs.
SMOOTH, SWITCH, RARE = 4.0, 12.0, 0.001
#: Letters that are scored at once, at least; a text is never cut between two words.
HELD = 1 << 20

# First code points of the blocks in which a script's letters lie, and the
# first code point after them.
SCRIPTS = {
    "Latin": [(0x41, 0x250), (0x1E00, 0x1F00), (0x2C60, 0x2C80), (0xA720, 0xA800),
              (0xFB00, 0xFB07), (0xFF21, 0xFF5B)],
    "Greek": [(0x370, 0x400), (0x1F00, 0x2000)],
    "Cyrillic": [(0x400, 0x530), (0x1C80, 0x1C90), (0x2DE0, 0x2E00), (0xA640, 0xA6A0)],
    "Armenian": [(0x530, 0x590), (0xFB13, 0xFB18)],
    "Hebrew": [(0x590, 0x600), (0xFB1D, 0xFB50)],
    "Arabic": [(0x600, 0x700), (0x750, 0x780), (0x8A0, 0x900), (0xFB50, 0xFE00),
               (0xFE70, 0xFF00)],
    "Devanagari": [(0x900, 0x980), (0xA8E0, 0xA900)],
    "Bengali": [(0x980, 0xA00)], "Gurmukhi": [(0xA00, 0xA80)], "Gujarati": [(0xA80, 0xB00)],
    "Oriya": [(0xB00, 0xB80)], "Tamil": [(0xB80, 0xC00)], "Telugu": [(0xC00, 0xC80)],
    "Kannada": [(0xC80, 0xD00)], "Malayalam": [(0xD00, 0xD80)], "Sinhala": [(0xD80, 0xE00)],
    "Thai": [(0xE00, 0xE80)], "Lao": [(0xE80, 0xF00)], "Tibetan": [(0xF00, 0x1000)],
    "Myanmar": [(0x1000, 0x10A0)], "Georgian": [(0x10A0, 0x1100), (0x1C90, 0x1CC0)],
    "Ethiopic": [(0x1200, 0x13A0)], "Khmer": [(0x1780, 0x1800)],
    "Hangul": [(0x1100, 0x1200), (0x3130, 0x3190), (0xAC00, 0xD7B0)],
    "Kana": [(0x3040, 0x3100), (0x31F0, 0x3200), (0xFF66, 0xFFA0)],
    "Han": [(0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0x20000, 0x323B0)],
}
_OTHER = len(SCRIPTS)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: its script (-1 for no letter or mark), whether it is a letter,
    and its small letter if that is one code point."""
    letters, marks, small = [], [], np.arange(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            letters.append(point)
            if len(c.lower()) == 1:
                small[point] = ord(c.lower())
        elif point >= 0x300 and unicodedata.category(c)[0] == "M":
            marks.append(point)
    script = np.full(0x110000, _OTHER, np.int8)
    for number, ranges in enumerate(SCRIPTS.values()):
        for low, high in ranges:
            script[low:high] = number
    is_letter = np.zeros(0x110000, bool)
    is_letter[letters] = True
    of_word = is_letter.copy()
    of_word[marks] = True
    script[~of_word] = -1
    return script, is_letter, small


class _Words:
    """The words of some texts: code points, where words begin and end, their scripts."""

    def __init__(self, texts: Sequence[str | None]):
        script, is_letter, small = _tables()
        # A line feed between two texts, so that no word spans both.
        points = np.frombuffer("\n".join(t or "" for t in texts).encode("utf-32-le"), "<u4")
        kinds = np.full(len(points) + 2, -1, np.int8)
        kinds[1:-1] = script[points]
        self.points = small[points]
        change = np.flatnonzero(kinds[1:] != kinds[:-1])
        inside = kinds[change + 1] >= 0
        # A run ends where the next one starts.
        runs = np.append(change, len(points))
        self.begins = runs[:-1][inside]
        self.ends = runs[1:][inside]
        self.scripts = kinds[self.begins + 1]
        self.letters = np.zeros(0, np.int64)
        if len(self.begins):
            told = np.concatenate([[0], np.cumsum(is_letter[points])])
            self.letters = told[self.ends] - told[self.begins]
        # Marks alone make no word.
        keep = self.letters > 0
        self.begins, self.ends = self.begins[keep], self.ends[keep]
        self.scripts, self.letters = self.scripts[keep], self.letters[keep]
        sizes = np.array([len(t or "") for t in texts], np.int64)
        self.offsets = np.cumsum(sizes + 1) - sizes - 1
        #: Word numbers at which the texts begin, and the number of all.
        self.firsts = np.searchsorted(self.begins, np.append(self.offsets, len(points) + 1))


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _grams(points: np.ndarray, begins: np.ndarray, ends: np.ndarray):
    """Hashes of each letter alone, after one and after two others, and of the contexts.

    The letters of a word are followed by an end and preceded by two of them: all are
    listed word after word, with the number of the word. Before a word's start stands a
    mark of its own, so that the first letter has a context too."""
    sizes = ends - begins + 1
    word = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    last = at == sizes[word] - 1
    place = begins[word] + at
    here = np.where(last, 0, points[np.minimum(place, len(points) - 1)]).astype(np.uint64)
    before = np.where(at > 0, points[place - 1], 0).astype(np.uint64)
    earlier = np.where(at > 1, points[place - 2], at == 0).astype(np.uint64)

    def spread(value: np.ndarray, size: int) -> np.ndarray:
        mixed = (value + np.uint64(1)) * _SPREAD
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * _SPREAD) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)

    pair = before << np.uint64(21) | here
    context = earlier << np.uint64(21) | before
    triple = earlier << np.uint64(42) | pair
    return (spread(here, SIZES[0]), spread(before, SIZES[0]), spread(pair, SIZES[1]),
            spread(context, SIZES[1]), spread(triple, SIZES[2]), word)


def _counted(texts: Sequence[str | None]) -> np.ndarray:
    """Hashed counts of the three orders, then letters by script, in one array."""
    words = _Words(texts)
    one, _, two, context, three, word = _grams(words.points, words.begins, words.ends)
    # A context of two letters was counted as a pair, but for the one before a word.
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    two = np.concatenate([two, context[starts]])
    return np.concatenate([
        np.bincount(one, minlength=SIZES[0]), np.bincount(two, minlength=SIZES[1]),
        np.bincount(three, minlength=SIZES[2]),
        np.bincount(words.scripts, words.letters, minlength=_OTHER + 1).astype(np.int64)])


class Model:
    """Languages in code-point order and, for each, what `fit` counted."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        table = np.stack([counts[lang] for lang in self.langs], axis=1).astype(np.float32) \
            if counts else np.zeros((sum(SIZES) + _OTHER + 1, 0), np.float32)
        one, two, three = SIZES
        self.orders = table[:one], table[one:one + two], table[one + two:one + two + three]
        scripts = table[one + two + three:]
        share = scripts / np.maximum(scripts.sum(0), 1)
        known = share >= RARE
        #: Which languages are candidates for a word of a script.
        self.candidates = np.where(known.any(1, keepdims=True), known, True)

    def scores(self, words: _Words) -> np.ndarray:
        """Words x languages; -inf for those that are no candidates."""
        out = np.zeros((len(words.begins), len(self.langs)), np.float32)
        # Equal words are scored once.
        first, which = _distinct(words)
        for at in range(0, len(first), 50_000):
            chosen = first[at:at + 50_000]
            out[at:at + len(chosen)] = self._of_words(
                words.points, words.begins[chosen], words.ends[chosen])
        out = out[which]
        out[~self.candidates[words.scripts]] = -np.inf
        return out

    def _of_words(self, points: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        one, before, two, context, three, word = _grams(points, begins, ends)
        singles, doubles, triples = self.orders
        total = singles.sum(0)
        p = (singles[one] + 0.1) / (total + 0.1 * SIZES[0])
        p = (doubles[two] + SMOOTH * p) / (singles[before] + SMOOTH)
        p = (triples[three] + SMOOTH * p) / (doubles[context] + SMOOTH)
        # Two contexts may share a hash value; a probability never passes 1.
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        return np.add.reduceat(np.log(np.minimum(p, 1)), starts, axis=0)


def _distinct(words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """One word of each spelling, and for each word which of them it is."""
    if not len(words.begins):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = words.ends - words.begins
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    letters = words.points[np.repeat(words.begins, sizes) + at].astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (letters + np.uint64(1)) * _SPREAD ^ (at.astype(np.uint64) + np.uint64(7))
        mixed = (mixed ^ mixed >> np.uint64(31)) * _SPREAD
        mixed ^= mixed >> np.uint64(29)
        spelt = np.add.reduceat(mixed, np.cumsum(sizes) - sizes)
    _, first, which = np.unique(spelt, return_index=True, return_inverse=True)
    return first, which


def _labels(scores: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The label of each word on the best path of its text.

    All texts take their n-th step together; those with more words stand first."""
    counts = np.diff(firsts)
    order = np.argsort(-counts, kind="stable")
    counts, starts = counts[order], firsts[:-1][order]
    n_langs = scores.shape[1]
    back = np.zeros(scores.shape, np.min_scalar_type(n_langs))
    own = np.arange(n_langs)
    state = np.zeros((len(counts), n_langs), np.float64)
    steps = int(counts.max(initial=0))
    active = np.searchsorted(-counts, -np.arange(steps), side="left")
    for t in range(steps):
        n = active[t]
        at = starts[:n] + t
        now = state[:n]
        if t:
            top = now.argmax(1)
            switched = now[np.arange(n), top] - SWITCH
            moves = switched[:, None] > now
            back[at] = np.where(moves, top[:, None], own)
            now = np.where(moves, switched[:, None], now)
        state[:n] = now + scores[at]
    labels = np.zeros(len(scores), np.int64)
    current = state.argmax(1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = current[:n]
        current[:n] = back[at, current[:n]]
    return labels


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """The model of at most `rows` documents with a language, never of fold 2.

    They are those with the smallest hashes of id and text; null ids are left out and rows
    that agree in both count once. One array a language reaches the driver.
    """
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(
        fold("doc_id") != 2).select("text", "lang", F.xxhash64("doc_id", "text").alias("mark"))
    few = settle(known.select("mark").distinct().orderBy("mark").limit(rows), "marks")
    last = few.agg(F.max("mark")).first()[0]
    if last is None:
        return Model({})
    sample = known.where(F.col("mark") <= last).groupBy("mark").agg(
        F.min(F.struct("lang", "text")).alias("row")).select("row.*")

    def count(records: Iterator[dict]) -> Iterator[tuple]:
        sums: dict[str, np.ndarray] = {}
        held: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}

        def add(lang: str) -> None:
            sums[lang] = sums.get(lang, 0) + _counted(held.pop(lang))
            sizes[lang] = 0

        for r in records:
            held.setdefault(r["lang"], []).append(r["text"])
            sizes[r["lang"]] = sizes.get(r["lang"], 0) + len(r["text"])
            if sizes[r["lang"]] >= HELD:
                add(r["lang"])
        for lang in list(held):
            add(lang)
        for lang, found in sums.items():
            yield lang, found.astype("<i8").tobytes()

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        both = sum(np.frombuffer(c, "<i8") for c in frame["counts"])
        return pd.DataFrame({"lang": frame["lang"][:1], "counts": [both.tobytes()]})

    parts = map_rows(sample, "lang string, counts binary", count)
    summed = parts.groupBy("lang").applyInPandas(total, "lang string, counts binary")
    return Model({r["lang"]: np.frombuffer(r["counts"], "<i8") for r in summed.collect()})


def label(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and spans of every row.

    `spans` are the begins and ends, in code points, and the languages of the labelled
    parts, from the first letter to the last; `score` is the share of the text's letters
    that lie in spans of `lang_pred`.
    """
    told = docs.sparkSession.sparkContext.broadcast(model)

    def labelled(texts: list[str | None]) -> Iterator[tuple]:
        model = told.value
        words = _Words(texts)
        if not model.langs or not len(words.begins):
            for _ in texts:
                yield "und", 0.0, []
            return
        labels = _labels(model.scores(words), words.firsts)
        for offset, i, j in zip(words.offsets.tolist(), words.firsts[:-1].tolist(),
                                words.firsts[1:].tolist(), strict=True):
            if i == j:
                yield "und", 0.0, []
                continue
            mine = labels[i:j]
            letters = np.bincount(mine, words.letters[i:j], minlength=len(model.langs))
            best = int(letters.argmax())
            cuts = np.flatnonzero(mine[1:] != mine[:-1]) + 1
            begins = words.begins[i + np.concatenate([[0], cuts])] - offset
            ends = words.ends[i + np.concatenate([cuts, [j - i]]) - 1] - offset
            spans = [(b, e, model.langs[k]) for b, e, k in zip(
                begins.tolist(), ends.tolist(), mine[np.concatenate([[0], cuts])].tolist(),
                strict=True)]
            yield model.langs[best], float(letters[best] / letters.sum()), spans

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        ids, texts, size = [], [], 0
        for r in records:
            ids.append(r["doc_id"])
            texts.append(r["text"])
            size += len(r["text"] or "")
            if size >= HELD or len(ids) == 4096:
                yield from ((i, *found) for i, found in zip(ids, labelled(texts), strict=True))
                ids, texts, size = [], [], 0
        if ids:
            yield from ((i, *found) for i, found in zip(ids, labelled(texts), strict=True))

    return map_rows(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        "doc_id long, lang_pred string, score double, "
        "spans array<struct<begin: int, end: int, lang: string>>", rows)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row was kept from learning by its fold; null ids have none."""
    return F.coalesce(fold(doc_id) == 2, F.lit(False))
