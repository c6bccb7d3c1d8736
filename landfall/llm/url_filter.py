"""URL filter: rules first, then naive Bayes on the words of host and path.

Concatenated names such as `cheappills` are split into words by a unigram Viterbi search:
every part of a token of up to MAX_WORD letters is joined with the counts of the words of
all pages, and the likeliest split wins (of equal ones the one with the longer first
word). Seeds and unknown parts have fixed probabilities, those of unknown parts falling by a
factor of ten a letter: splits depend on the shares of the words, not on how many pages
there are. Parts that together spell a seed are joined again, so a seed is never split.

Multinomial naive Bayes over the segmented words of host and path, each as often as it
occurs, is trained on all pages. What blocks a word is its company: a use of it counts as
bad if the url holds a word of BLOCK_SEEDS other than it, and as good if the url holds no
seed. A seed that labels a url alone is left out there, so no seed is evidence for itself;
pages are blocked without a seed, and freed with one, by the words around.

Null urls or urls without `://` have no host or path, no words, and are allowed, as is a
score of 0. A page is judged by its url alone; pages of one url share the verdict. Page
words of more than MAX_WORD letters are not counted, and a longer part of a name is cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.text import map_rows
from landfall.session import settle

MAX_WORD = 20

# Words of unwanted sites.
BLOCK_SEEDS = frozenset(
    "casino poker bet bets betting gambling jackpot slots pills viagra cialis pharma porn sex "
    "xxx adult escort spam ads adserver track tracker tracking malware phishing warez crack "
    "torrent loan loans replica".split())

#: Least probability of a seed as a word, about that of the hundredth word of sf0.1's pages.
SEED_SHARE = 1e-3
#: Probability of a word never seen, before its letters count.
UNSEEN_SHARE = 1e-6


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"),
         Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return (F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule], value: str) -> Column:
    """Text or verdict of the longest rule that fits; null if none. For a list of rules."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def page_words(pages: DataFrame) -> DataFrame:
    """Lower-case words of all pages, without scripts, styles, comments and tags, counted."""
    text = F.lower(F.regexp_replace(
        "html", r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^<>]*>|&\w+;", " "))
    return (
        pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word"))
        .where((F.length("word") > 0) & (F.length("word") <= MAX_WORD))
        .groupBy("word").agg(F.count("*").alias("n"))
    )


def whole_seeds(words: list[str]) -> list[str]:
    """`words` with neighbours joined that together are a seed, the longest first."""
    longest = max(map(len, BLOCK_SEEDS))
    out, at = [], 0
    while at < len(words):
        end = next((e for e in range(min(len(words), at + longest), at + 1, -1)
                    if "".join(words[at:e]) in BLOCK_SEEDS), at + 1)
        out.append("".join(words[at:end]))
        at = end
    return out


def best_split(token: str, cost: dict[tuple[int, int], float]) -> list[str]:
    """The split with the least total cost, no seed in parts; `cost` of known (begin, length)."""

    def price(begin: int, size: int) -> float:
        least = min(cost.get((begin, size), math.inf),
                    size * math.log(10) - math.log(UNSEEN_SHARE))
        return min(least, -math.log(SEED_SHARE)) if (
            token[begin:begin + size] in BLOCK_SEEDS) else least

    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        best.append(min((best[end - size][0] + price(end - size, size), size)
                        for size in range(1, min(end, MAX_WORD) + 1)))
    words = []
    at = len(token)
    while at:
        size = best[at][1]
        words.append(token[at - size:at])
        at -= size
    return whole_seeds(words[::-1])


def segment(tokens: DataFrame, counts: DataFrame) -> DataFrame:
    """(token, words) of the distinct tokens, by their parts' counts in (word, n)."""
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    # A row for each begin, then one for each part from there.
    parts = tokens.select("token", F.explode(F.sequence(F.lit(1), F.length("token"))).alias(
        "begin")).select("token", "begin", F.explode(F.sequence(F.lit(1), F.least(
            F.lit(MAX_WORD), F.length("token") - F.col("begin") + 1))).alias("size"))
    word = F.expr("substring(token, begin, size)")
    known = parts.withColumn("word", word).join(counts, "word").select(
        "token", F.col("begin") - 1, "size", F.log(total / F.col("n")).alias("cost"))
    # The row with size 0 keeps tokens of which no part is known.
    every = known.toDF("token", "begin", "size", "cost").unionByName(tokens.select(
        "token", F.lit(0).alias("begin"), F.lit(0).alias("size"), F.lit(0.0).alias("cost")))

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        for token, found in groupby(records, key=lambda r: r["token"]):
            cost = {(r["begin"], r["size"]): r["cost"] for r in found}
            yield token, best_split(token, cost)

    return map_rows(every.repartition("token").sortWithinPartitions("token"),
                    "token string, words array<string>", rows)


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score of each page."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    # Each distinct host and path once, with its share of the pages as weight.
    sites = settle(urls.groupBy("host", "path").agg(F.count("*").alias("pages")), "sites")
    tokens = F.filter(F.split(F.lower(F.concat_ws("/", "host", "path")), r"[^\p{L}]+"),
                      lambda t: F.length(t) > 0)
    uses = sites.select("host", "path", "pages", F.explode(tokens).alias("token"))
    split = settle(segment(uses.select("token").distinct(), settle(
        page_words(pages), "page_words")), "segments")
    words = settle(uses.join(split, "token").select(
        "host", "path", "pages", F.explode("words").alias("word")
    ).groupBy("host", "path", "pages", "word").agg(F.count("*").alias("times")), "words")
    seed = F.col("word").isin(*BLOCK_SEEDS).cast("int")
    # Seeds other than the word; a url has a row for each of its distinct words.
    others = F.col("seeds") - seed
    labelled = words.join(words.groupBy("host", "path").agg(F.sum(seed).alias("seeds")),
                          ["host", "path"]).withColumns({
        "bad": (others > 0).cast("int"), "good": (F.col("seeds") == 0).cast("int")})
    counts = settle(labelled.groupBy("word").agg(
        F.sum(F.col("pages") * F.col("times") * F.col("bad")).alias("bad"),
        F.sum(F.col("pages") * F.col("times") * F.col("good")).alias("good")), "counts")
    sums = counts.agg(F.count("*"), F.sum("bad"), F.sum("good")).first()
    kinds, bad, good = sums[0], float(sums[1] or 0), float(sums[2] or 0)
    weight = F.log((F.col("bad") + 1) / (bad + kinds)) - F.log(
        (F.col("good") + 1) / (good + kinds))
    prior = math.log((bad + 1) / (good + 1))
    scores = words.join(counts.select("word", weight.alias("weight")), "word").groupBy(
        "host", "path").agg((
            F.sum(F.col("weight") * F.col("times")) + F.lit(prior)).alias("score"))
    by = F.col("score") > 0
    return urls.join(scores, ["host", "path"], "left").select(
        "page_id", "host", "path", matched_rule(F.col("host"), F.col("path"), rules, "text").alias(
            "rule"),
        F.coalesce(matched_rule(F.col("host"), F.col("path"), rules, "verdict"),
                   F.when(by, "block").otherwise("allow")).alias("verdict"), "score")
