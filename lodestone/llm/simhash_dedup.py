"""SimHash near-dedup over a byte-position inverted index (operator 5).

A text's fingerprint is the bitwise majority of the XXH64 hashes of its word
shingles.  Fingerprints link at ``max_bits`` (4) or fewer differing bits, and
components of links are groups.

*Index.* Two linked fingerprints differ in at most 4 of their 8 bytes, so they
share at least 4 bytes in place: the guaranteed minimum.  A posting list per
single (position, byte) would hold 1/256 of the corpus, so lists are kept for
combinations of 4 positions with their bytes: the intersection of 4 single
lists, a 32-bit key under which unrelated fingerprints rarely meet.  Each
distinct fingerprint is posted under all 70 combinations, dealt out before
they are written so that tasks stay even.

*Count filter.* Where a pair meets, its shared positional bytes are tallied.
A pair that shares m positions meets in C(m, 4) lists and is taken in one of
them, the one of its first 4 shared positions.  Pairs whose tally reaches the
minimum are then verified by their differing bits.

*Long lists.* A list of over ``list_limit`` entries holds a group of very many
near copies, whose pairs grow with its square.  The tally there is not taken
pair by pair: two fingerprints are within 4 bits if and only if some value
lies within 2 bits of both, so each posts itself under the 2,081 values within
2 bits and is linked to the smallest one posted there.  Whatever meets there
is within 4 bits and nothing is missed, so the components are the same for
any limit (tests); both ways are linear in the number of fingerprints.

Cases: null and word-less texts have fingerprint 0 and link like any other;
fewer words than a shingle are one shingle; only A-Z are lower-cased; repeated
rows are documents of their own; null doc_ids never name a group unless all
of it is null; an empty table gives an empty result.  Other columns are
ignored by simhash_components() and kept by keep_one().
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.components import components
from lodestone.llm.scratch import materialise, parallelism, text_batches

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: positional bytes that two linked fingerprints share at least
MIN_SHARED = 8 - MAX_BITS
#: lists of postings up to this long are compared pair by pair
LIST_LIMIT = 64
_WEIGHT = (1 << np.arange(64, dtype=np.uint64)).astype(np.uint64)


def fingerprints(texts: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Fingerprints of UTF-8 texts, unsigned 64-bit."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    first = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        if words:
            line = b" ".join(words)
            if len(words) <= shingle:
                hashes.append(digest(line, seed))
            else:
                end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                start = np.concatenate(([0], end[:-1]))[: len(words) - shingle + 1].tolist()
                hashes += [digest(line[a:b], seed) for a, b in zip(start, (end[shingle - 1 :] - 1).tolist(), strict=True)]
        first[i + 1] = len(hashes)
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros((len(texts), 64), np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    for lo in range(0, len(h), 1 << 16):
        part, who = h[lo : lo + (1 << 16)], owner[lo : lo + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
        ones[who[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    return ((ones * 2 > np.diff(first)[:, None]) * _WEIGHT).sum(axis=1, dtype=np.uint64)


def _fingerprint(shingle: int, seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from lodestone.llm.wordhash import blocks

        for pdf in frames:
            for at, texts in blocks(pdf["text"]):
                fp = fingerprints(texts, shingle, seed)
                rest = pdf.drop(columns="text").iloc[at : at + len(texts)]
                yield rest.assign(fp=fp.view(np.int64))

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _lists() -> list[int]:
    """Masks of the combinations of 4 byte positions."""
    return [_signed(sum(0xFF << (8 * p) for p in c)) for c in combinations(range(8), MIN_SHARED)]


def _near() -> list[int]:
    """Masks of up to 2 bits."""
    one = [1 << i for i in range(64)]
    return [0] + [_signed(x) for x in one] + [_signed(x | y) for x, y in combinations(one, 2)]


def links(prints: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b), enough to connect every component, none too many bits apart."""
    masks = _lists()
    spread = prints.select("fp").repartition(parallelism(prints.sparkSession), "fp")
    posted = spread.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("place", "bytes"))
    posted = posted.withColumn("place", F.col("place").cast("byte"))
    size = posted.groupBy("place", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    # the same plan at every size: lists that meet are hashed where their postings are dealt, without a sort
    met = posted.join(size.hint("shuffle_hash"), ["place", "bytes"])
    short = met.where(F.col("n") <= list_limit).groupBy("place", "bytes").agg(F.sort_array(F.collect_list("fp")).alias("l"))
    last = F.element_at(F.array(*[F.lit(c[-1]) for c in combinations(range(8), MIN_SHARED)]), F.col("place").cast("int") + 1)

    def linked(x: Column, y: Column) -> Column:
        """Whether the tally of shared positional bytes reaches the minimum, in the list whose last position is the pair's 4th shared one, and few bits differ."""
        apart = x.bitwiseXOR(y)
        shared = [apart.bitwiseAND(F.lit(_signed(0xFF << (8 * p)))) == 0 for p in range(8)]
        tally = reduce(add, [c.cast("int") for c in shared])
        upto = reduce(add, [(c & (F.lit(p) <= F.col("last"))).cast("int") for p, c in enumerate(shared)])
        return (F.bit_count(apart) <= MAX_BITS) & (tally >= MIN_SHARED) & (upto == MIN_SHARED)

    # pairs are tallied and verified within the list; only links come out of it
    pairs = F.flatten(
        F.transform(
            "l",
            lambda x, i: F.transform(F.filter(F.slice("l", i + 2, F.lit(list_limit)), lambda y: linked(x, y)), lambda y: F.struct(x.alias("a"), y.alias("b"))),
        )
    )
    found = short.withColumn("last", last).select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    dense = materialise(met.where(F.col("n") > list_limit).select("fp").distinct().repartition(parallelism(prints.sparkSession), "fp"), "dense")
    if dense.isEmpty():
        return found
    near = dense.select("fp", F.explode(F.transform(F.array(*[F.lit(m) for m in _near()]), lambda m: F.col("fp").bitwiseXOR(m))).alias("v"))
    low = near.groupBy("v").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    hub = near.join(low.hint("merge"), "v").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    return found.unionByName(hub)


def _roots(docs: DataFrame, prints: DataFrame, list_limit: int) -> DataFrame:
    """(fp, component_id): the smallest doc_id of each fingerprint's component."""
    root = components(links(prints.select("fp"), list_limit))
    named = prints.join(root.hint("merge"), prints["fp"] == root["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return named.join(low.hint("merge"), "root").select("fp", "component_id")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, list_limit: int = LIST_LIMIT) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    text_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = materialise(base.mapInPandas(_fingerprint(shingle, seed), "doc_id long, fp long"), "prints")
    prints = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    found = marked.join(_roots(marked, prints, list_limit).hint("merge"), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_key() -> Column:
    """A row's text hash, which with its doc_id names it."""
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))


def keep_rows(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of `docs` that are the smallest of their group; named: (row, root), row as (null id, doc_id, tkey)."""
    keep = materialise(named.groupBy("root").agg(F.min("row").alias("row")).select(F.col("row.doc_id").alias("_keep_id"), F.col("row.tkey").alias("_keep_key")), "keep")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_id"), row_key().alias("_key"))
    kept = packed.join(keep, (packed["_key"] == keep["_keep_key"]) & packed["_id"].eqNullSafe(keep["_keep_id"]))
    # a row that is there twice, doc_id and text, stays once
    kept = kept.withColumn("_n", F.row_number().over(W.partitionBy("_id", "_key").orderBy(F.lit(0)))).where("_n = 1")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def keep_one(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, list_limit: int = LIST_LIMIT) -> DataFrame:
    """The rows of `docs` without near copies: of each group, the row with the smallest doc_id stays.

    Ties (repeated doc_ids, or null ones) go to the smallest text hash.
    """
    text_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.withColumn("tkey", row_key())
    marked = materialise(base.mapInPandas(_fingerprint(shingle, seed), "doc_id long, tkey string, fp long"), "prints")
    prints = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("low"), F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tkey"))).alias("row")), "distinct")
    root = components(links(prints.select("fp"), list_limit))
    named = prints.join(root, prints["fp"] == root["node"], "left").select("row", F.coalesce("root", "fp").alias("root"))
    return keep_rows(docs, named)
