"""URL filters by host word segmentation and naive Bayes (operator 9).

Rules come first: a rule names a host and a path prefix, fits its host and all
subdomains, and of the rules that fit the longest wins.  Where none fits, the
method judges: host labels are cut into words by unigram Viterbi (so that
"casinowin" reads casino win), and a multinomial naive Bayes model scores the
host words and the path words.

Both models are learned from the whole table and behave alike at every size.
Unigrams are half the path words of all urls, half a lexicon of host words.  A
word counts as one if its share of all path words is ``min_share`` or more,
which bounds the dictionary by 1/min_share words.  Naive Bayes is fitted on
the urls that a rule labels, all of them: their segmented host words and path
words, by the rule's verdict.  BLOCK_WORDS and HOST_WORDS are prior knowledge:
they hold half of each class's mass.  Counts are kept in a table of fixed
size by hash, so no word is dropped for being rare; words that share a place
share their counts, and a place that was never met says nothing.  Both classes
are equally likely beforehand: what the rules cover says nothing on the rest.

Cases: a null url, or one without ``://``, has empty host and path, no rule
fits it, and it has no words, so it is allowed.  Repeated rows are judged one
by one.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.scratch import materialise

#: share of all path words from which a word is in the dictionary of the segmenter
MIN_SHARE = 2e-6
#: part of the unigrams, and of each class's words, that the word lists hold
LEXICON_SHARE = 0.5
#: places of the table of word counts
PLACES = 1 << 18
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCK_WORDS = (
    "ads adserver adult advert bet bets betting bingo casino cam cams click clicks cialis crack cracked dating escort free gambling gamble "
    "hack jackpot keygen loan loans lottery lotto nude payday pills poker popup porn prize promo roulette sex slot slots spam sponsor "
    "spy stream tracker track tracking torrent viagra warez win winner xxx"
)
HOST_WORDS = (
    "about academy account all api app art auto best bio blog board book books buy car care cdn center chat city cloud club code "
    "community daily data dev digital docs doctor edu energy family farm film finance fit food forum fun game games garden global go "
    "green group guide health help history home hotel house info kids lab law learn library life link live local mail map market "
    "media mobile money music my net network new news now online open page park party phone photo plan play post press pro project "
    "radio review save school science search shop site social soft space sport store story studio support team tech test the time "
    "today tools top travel tv video view web wiki work world"
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = None, None
    for say, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, say) if verdict is None else verdict.when(fits, say)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


class Segmenter:
    """Unigram Viterbi over runs of letters."""

    LONGEST = 24

    def __init__(self, shares: dict[str, float]):
        self.cost = {w: -math.log(p) for w, p in shares.items()}
        # unknown words: ever less likely with length
        self.base, self.step = 12.0, 2.3
        self.words = lru_cache(maxsize=100_000)(self._words)

    def _words(self, run: str) -> tuple[str, ...]:
        best = [0.0] + [math.inf] * len(run)
        cut = [0] * (len(run) + 1)
        for end in range(1, len(run) + 1):
            for start in range(max(0, end - self.LONGEST), end):
                w = run[start:end]
                c = best[start] + self.cost.get(w, self.base + self.step * len(w))
                if c < best[end]:
                    best[end], cut[end] = c, start
        out, end = [], len(run)
        while end:
            out.append(run[cut[end] : end])
            end = cut[end]
        return tuple(reversed(out))


_RUN = re.compile(r"[^\W\d_]+")


def words_of(seg: Segmenter, host: str, path: str) -> tuple[list[str], list[str]]:
    """Segmented host words (without the top-level label), path words."""
    labels = host.split(":")[0].split(".")
    host_words = [w for label in labels[:-1] for run in _RUN.findall(label) for w in seg.words(run)]
    return host_words, _RUN.findall(path.lower())


def unigrams(counts: dict[str, int]) -> dict[str, float]:
    """Word shares: path words by count, mixed with the word lists."""
    total = sum(counts.values())
    lexicon = sorted(set((BLOCK_WORDS + " " + HOST_WORDS).split()))
    part = LEXICON_SHARE if total else 1.0
    shares = {w: (1 - part) * c / total for w, c in counts.items()}
    for w in lexicon:
        shares[w] = shares.get(w, 0.0) + part / len(lexicon)
    return shares


def place(kind: str, word: str) -> int:
    """The place of a host ("h") or path ("p") word in the table of counts."""
    return zlib.crc32(f"{kind}:{word}".encode("utf-8", "surrogatepass")) % PLACES


def places(host_words: list[str], path_words: list[str]) -> list[int]:
    return [place("h", w) for w in host_words] + [place("p", w) for w in path_words]


def _count(handle) -> callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seg = Segmenter(handle.value)
        for pdf in frames:
            total = np.zeros((2, PLACES), np.int64)
            for host, path, verdict in zip(pdf["host"], pdf["path"], pdf["verdict"], strict=True):
                np.add.at(total[int(verdict == "block")], places(*words_of(seg, host, path)), 1)
            at = np.flatnonzero(total.any(axis=0))
            yield pd.DataFrame({"place": at.astype(np.int32), "n_allow": total[0, at], "n_block": total[1, at]})

    return run


class Bayes:
    """Log-odds of block against allow, by place."""

    def __init__(self, counts: dict[int, tuple[int, int]]):
        n = np.zeros((2, PLACES))
        for k, (a, b) in counts.items():
            n[:, k] = a, b
        for i, words in enumerate((HOST_WORDS.split(), BLOCK_WORDS.split())):
            # as much as all that was counted, or one each where nothing was
            weight = max(n[i].sum() * LEXICON_SHARE / (1 - LEXICON_SHARE) / len(words), 1.0)
            np.add.at(n[i], [place("h", w) for w in words], weight)
        met = n.any(axis=0)
        p = (n + 1) / (n.sum(axis=1, keepdims=True) + met.sum())
        self.odds = np.where(met, np.log(p[1]) - np.log(p[0]), 0.0)

    def score(self, host_words: list[str], path_words: list[str]) -> float:
        return float(self.odds[places(host_words, path_words)].sum()) if host_words or path_words else 0.0


def _judge(shares, counts):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seg, bayes = Segmenter(shares.value), Bayes(counts.value)
        for pdf in frames:
            said = [words_of(seg, h, p) for h, p in zip(pdf["host"], pdf["path"], strict=True)]
            yield pdf.assign(host_words=[" ".join(h) for h, _ in said], score=[bayes.score(h, p) for h, p in said])

    return run


def _parsed(pages: DataFrame) -> DataFrame:
    host, path = split_url(F.col("url").cast("string"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))


def fit(pages: DataFrame, rules=RULES, min_share: float = MIN_SHARE) -> tuple[dict[str, float], dict[int, tuple[int, int]]]:
    """(unigram shares, naive Bayes counts by place), from all urls of the table."""
    parsed = _parsed(pages)
    words = parsed.select(F.explode(F.split(F.lower("path"), r"[^\p{L}]+")).alias("w")).where("w <> ''")
    counted = materialise(words.groupBy("w").agg(F.count("*").alias("n")), "words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    shares = unigrams({r["w"]: r["n"] for r in counted.where(F.col("n") >= min_share * total).collect()})  # at most 1 / min_share words
    handle = pages.sparkSession.sparkContext.broadcast(shares)
    labelled = parsed.select("host", "path", rule_of(F.col("host"), F.col("path"), rules)[1].alias("verdict")).where("verdict IS NOT NULL")
    counts = labelled.mapInPandas(_count(handle), "place int, n_allow long, n_block long")
    counts = counts.groupBy("place").agg(F.sum("n_allow").alias("a"), F.sum("n_block").alias("b"))
    return shares, {r["place"]: (r["a"], r["b"]) for r in counts.collect()}  # at most PLACES rows


def judge(pages: DataFrame, model: tuple[dict, dict] | None = None, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, host_words, score (log-odds of block)."""
    shares, bayes = model or fit(pages, rules)
    context = pages.sparkSession.sparkContext
    scored = _parsed(pages).mapInPandas(_judge(context.broadcast(shares), context.broadcast(bayes)), "page_id long, host string, path string, host_words string, score double")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("score") > 0, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "host_words", "score")
