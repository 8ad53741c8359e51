"""Exact Jaccard join of shingle sets, tile by tile.

A set is cut where its text is and travels as halves of 64-bit hashes.  Sets of
like size make blocks, and each two blocks that may hold a pair are one task,
which counts common hashes in memory: no pair is shuffled before it is known to
share enough.  What passes is verified on the whole sets of 64-bit hashes.  Blocks have a bounded
size; what is shuffled is one part of each set per block that its own meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of a block's hashes, at most and at least; about so many blocks if both allow it
BLOCK, LEAST_BLOCK, BLOCKS = 16 << 20, 32 << 10, 8
#: cells or postings that a task counts at once
CELLS = 1 << 20
#: rows that the order of hashes is learnt from (the result does not turn on it), and the places of its counts
LEARNT, PLACES = 2000, 1 << 18
#: sets of so many hashes (at a threshold of a half or more) travel by their rarest hashes only: the prefix of the threshold and a share of the set more
LONG, EXTRA = 512, 0.05


def hashes(text: str, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-grams of a lower-cased text; a shorter text is its own gram."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(c) < k:  # no character has the number of the filling
        c = np.concatenate([c, np.full(k - len(c), 0x110000, np.uint64)])
    h = np.zeros(len(c) - k + 1, np.uint64)
    for i in range(k):
        h = (h ^ c[i : i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def set_id(h: np.ndarray) -> int:
    """64 bits that stand for a whole set."""
    m = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    m ^= m >> np.uint64(30)
    x = (int(m.sum(dtype=np.uint64)) * 0xD6E8FEB86659FD93 ^ int(np.bitwise_xor.reduce(m * np.uint64(0xA0761D6478BD642F))) ^ len(h)) & (2**64 - 1)
    return x - 2**64 if x >= 2**63 else x


def least(t: float, n):
    """Common hashes that a pair with a set of n has at least."""
    return np.maximum(np.ceil(t * np.asarray(n) - 1e-9), 1).astype(np.int64)


def shared(t: float, n):
    """Common hashes among those that travel: all that a pair must have, or for large sets a share."""
    n = np.asarray(n)
    return np.where(n * (t >= 0.5) < LONG, least(t, n), np.maximum((EXTRA * n).astype(np.int64), 1))


def travels(t: float, n):
    """How many of a set's n hashes travel."""
    return np.asarray(n) - least(t, n) + shared(t, n)


def _places(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(46)).astype(np.int64) % PLACES


def sketches(rows: DataFrame, k: int, t: float) -> DataFrame:
    """rows(key, ..., _text) -> key, ..., sid, n, pre: a set's id, its size, and the hashes that travel; rows without shingles are gone."""
    kept = [f for f in rows.schema.fields if f.name != "_text"]
    rows = rows.withColumn("_text", F.lower(F.coalesce("_text", F.lit("")))).where("_text <> ''")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(PLACES, np.int64)
        for p in parts:
            for x in p["_text"]:
                total += np.bincount(_places(hashes(x, k)), minlength=PLACES)
        yield pd.DataFrame({"c": [total.astype(np.int32).tobytes()]})

    total = np.zeros(PLACES, np.int64)
    if t >= 0.5:
        for r in rows.select("_text").limit(LEARNT).mapInPandas(count, "c binary").toLocalIterator():
            total += np.frombuffer(r["c"], np.int32)
    order = np.minimum(total, 2**31 - 1).astype(np.int32)

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            sid, n, pre = [], [], []
            for x in p.pop("_text"):
                h = hashes(x, k)
                sid.append(set_id(h))
                n.append(len(h))
                m = int(travels(t, len(h)))
                if m < len(h):
                    h = np.sort(h[np.lexsort((h, order[_places(h)]))[:m]])
                # half of each hash: equal halves of two hashes add to a count, which is no more than a bound
                pre.append((h >> np.uint64(32)).astype(np.uint32).tobytes())
            yield p.assign(sid=np.array(sid, np.int64), n=np.array(n, np.int32), pre=pre)

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInPandas(cut, f"{names}, sid bigint, n int, pre binary")


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    kind = starts.dtype
    at = (np.cumsum(sizes) - sizes).astype(kind)
    return np.arange(int(sizes.sum()), dtype=kind) + np.repeat(starts - at, sizes)


def meet(a: tuple, b: tuple | None, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i of a, j of b) that share enough of what travelled; without b the pairs i < j of a.

    A side is (n, hashes, sizes).  Of a row's hashes those with the longest
    lists in b are left out, at most one less than a pair must share; what is
    counted plus what was left out has to reach that number, and pairs that
    pass are counted again in full.
    """
    own = b is None
    n, h, size = a
    nb, hb, sizeb = a if own else b
    by_hash = np.argsort(hb, kind="stable")
    lists = np.repeat(np.arange(len(nb), dtype=np.int32), sizeb)[by_hash]
    words, first, lens = np.unique(hb[by_hash], return_index=True, return_counts=True)
    row = np.repeat(np.arange(len(n)), size)
    at = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
    known = words[at] == h
    df = np.where(known, lens[at], 0)
    by_df = np.lexsort((df, row))
    begin = np.cumsum(size) - size
    # what every pair of the row shares: of its own size if whole sets travel, else of the smallest partner's
    whole = (size == n) & np.all(sizeb == nb)
    must = np.where(whole, least(t, n), np.minimum(shared(t, n), np.maximum((EXTRA * np.floor(t * n)).astype(np.int64), 1)))
    must = np.minimum(must, size)
    cost = np.cumsum(df[by_df])
    base = cost[begin] - df[by_df][begin]
    firm = begin + size - must  # the last hash that has to be looked up
    limit = 2 * (cost[firm] - base) + 64
    place = np.arange(len(h))
    # more than these only until a pair that shares by chance what most share falls short, and at most at the same cost again
    more = (cost - base[row] <= limit[row]) & (place - firm[row] < 2 * (cost - base[row]) / len(nb) + 5)
    keep = (place <= firm[row]) | more
    left_out = size - np.bincount(row[keep], minlength=len(n))
    use = by_df[keep]
    use = use[df[use] > 0]
    urow, ustart, ulen = row[use], first[at[use]].astype(np.int32), lens[at[use]]
    ends = np.searchsorted(urow, np.arange(len(n)), side="right")
    todo = np.concatenate([[0], np.cumsum(ulen)])[ends]  # postings up to and with each row
    key = np.repeat(np.arange(len(nb)), sizeb) * len(words) + np.searchsorted(words, hb)
    key.sort()
    out_i, out_j = [], []
    lo = 0
    width = max(len(nb), 1)
    most = max(1, CELLS // width)
    while lo < len(n):
        done = todo[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(todo, done + CELLS, side="right")))
        hi = min(hi, len(n))
        dense = (todo[hi - 1] - done) * 16 > (hi - lo) * width
        if dense:
            hi = min(hi, lo + most)
        u0, u1 = (ends[lo - 1] if lo else 0), ends[hi - 1]
        kind = np.int32 if (hi - lo) * width < 2**31 else np.int64
        codes = np.repeat(((urow[u0:u1] - lo) * width).astype(kind), ulen[u0:u1]) + lists[_spread(ustart[u0:u1], ulen[u0:u1])]
        if dense:
            cells = np.bincount(codes, minlength=(hi - lo) * width)
            short = np.maximum(must[lo:hi] - left_out[lo:hi], 1)
            codes = np.flatnonzero(cells.reshape(hi - lo, width) >= short[:, None])
            c = cells[codes]
        else:
            codes, c = np.unique(codes, return_counts=True)
        i, j = (codes // width + lo).astype(np.int64), (codes % width).astype(np.int64)
        small, large = np.minimum(n[i], nb[j]), np.maximum(n[i], nb[j])
        need = np.where(whole[i], np.ceil(t / (1 + t) * (n[i] + nb[j]) - 1e-9).astype(np.int64), np.minimum(shared(t, n[i]), shared(t, nb[j])))
        ok = (small >= t * large - 1e-9) & (c + left_out[i] >= need)
        if own:
            ok &= i < j
        i, j, need = i[ok], j[ok], need[ok]
        step = max(1, CELLS // max(1, int(size[i].max()) if len(i) else 1))
        for p in range(0, len(i), step):  # in full
            pi, pj = i[p : p + step], j[p : p + step]
            tok = _spread(begin[pi], size[pi])
            want = np.repeat(pj, size[pi]) * len(words) + at[tok]
            hit = known[tok] & (key[np.minimum(np.searchsorted(key, want), len(key) - 1)] == want)
            o = np.bincount(np.repeat(np.arange(len(pi)), size[pi])[hit], minlength=len(pi))
            fine = o >= need[p : p + step]
            out_i.append(pi[fine])
            out_j.append(pj[fine])
        lo = hi
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_i]), np.concatenate([empty, *out_j])


def blocks(counts: list[tuple[int, int]], t: float) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """(bands, tiles) from (size of set, sets of that size): bands (smallest, largest size, first block, blocks), tiles of block numbers (i <= j)."""
    weight = [(n, c * int(travels(t, n)) * 4) for n, c in sorted(counts)]
    limit = min(BLOCK, max(LEAST_BLOCK, sum(w for _, w in weight) // BLOCKS))
    bands: list[tuple[int, int, int, int]] = []
    of: list[tuple[int, int]] = []
    lo, total = None, 0

    def close(hi: int) -> None:
        nonlocal lo, total
        parts = max(1, math.ceil(total / limit))
        bands.append((lo, hi, len(of), parts))
        of.extend([(lo, hi)] * parts)
        lo, total = None, 0

    for x, (n, w) in enumerate(weight):
        lo, total = (n if lo is None else lo), total + w
        if x + 1 == len(weight) or total + weight[x + 1][1] > limit:
            close(n)
    tiles = [(i, j) for i in range(len(of)) for j in range(i, len(of)) if of[j][0] * t <= of[i][1] + 1e-9]
    return bands, tiles


def similar(rows: DataFrame, made: DataFrame, key: str, text: str, t: float, k: int) -> DataFrame:
    """(sa, sb, jaccard) of the different sets of `made` (sketches() of `rows`) with a similarity of at least t, sa < sb."""
    spark = rows.sparkSession
    distinct = made.groupBy("sid").agg(F.first("n").alias("n"), F.first("pre").alias("pre"))
    sizes = [(r["n"], r["c"]) for r in made.groupBy("n").agg(F.count_distinct("sid").alias("c")).collect()]
    bands, tiles = blocks(sizes, t)
    met: dict[int, list[tuple[int, int]]] = {}
    for x, (i, j) in enumerate(tiles):
        met.setdefault(i, []).append((x, 0))
        if i != j:
            met.setdefault(j, []).append((x, 1))
    band = spark.createDataFrame([(lo, hi, first, parts) for lo, hi, first, parts in bands], "lo int, hi int, first int, parts int")
    where = spark.createDataFrame([(b, x, side) for b, l in met.items() for x, side in l], "block int, tile int, side int")
    placed = distinct.join(F.broadcast(band), F.col("n").between(F.col("lo"), F.col("hi")))
    placed = placed.select("sid", "n", "pre", (F.col("first") + F.pmod(F.xxhash64("sid"), F.col("parts"))).cast("int").alias("block"))
    dealt = placed.join(F.broadcast(where), "block").select("tile", "side", "sid", "n", "pre").repartition(max(1, 2 * len(tiles)), "tile")

    def side(p: pd.DataFrame) -> tuple:
        h = np.frombuffer(b"".join(p["pre"]), np.uint32)
        return p["n"].to_numpy(np.int64), h, np.array([len(x) // 4 for x in p["pre"]], np.int64)

    def run(p: pd.DataFrame) -> pd.DataFrame:
        one, two = p[p["side"] == 0], p[p["side"] == 1]
        own = tiles[int(p["tile"].iloc[0])]
        if not len(one) or (own[0] != own[1] and not len(two)):
            return pd.DataFrame({"tile": [], "sa": [], "sb": []})
        i, j = meet(side(one), None if own[0] == own[1] else side(two), t)
        a, b = one["sid"].to_numpy()[i], (one if own[0] == own[1] else two)["sid"].to_numpy()[j]
        return pd.DataFrame({"tile": np.full(len(a), p["tile"].iloc[0], np.int32), "sa": np.minimum(a, b), "sb": np.maximum(a, b)})

    found = dealt.groupBy("tile").applyInPandas(run, "tile int, sa bigint, sb bigint").persist(StorageLevel.DISK_ONLY)
    # the whole sets of what is in a pair, once a tile
    asked = found.select(F.col("tile").alias("at"), F.explode(F.array("sa", "sb")).alias("sid")).distinct()
    source = made.join(asked.select("sid").distinct(), "sid", "left_semi").groupBy("sid").agg(F.min("key").alias("key"))
    texts = rows.select(F.col(key).alias("key"), F.lower(F.coalesce(text, F.lit(""))).alias("_text")).where("_text <> ''").join(source, "key")

    def whole(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            h = [hashes(x, k) for x in p["_text"]]
            good = np.array([set_id(x) for x in h], np.int64) == p["sid"].to_numpy()
            yield pd.DataFrame({"sid": p["sid"][good], "set": [x.tobytes() for x, g in zip(h, good, strict=True) if g]})

    sets = texts.mapInPandas(whole, "sid bigint, set binary").dropDuplicates(["sid"])
    sets = asked.join(sets, "sid")

    def verify(pairs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        held = {s: np.frombuffer(x, np.uint64) for s, x in zip(own["sid"], own["set"], strict=True)}
        out = []
        for a, b in zip(pairs["sa"], pairs["sb"], strict=True):
            x, y = held[a], held[b]
            o = len(x) + len(y) - len(np.union1d(x, y))
            j = o / (len(x) + len(y) - o)
            if j >= t:
                out.append((a, b, j))
        return pd.DataFrame(out, columns=["sa", "sb", "jaccard"])

    return found.groupBy("tile").cogroup(sets.groupBy("at")).applyInPandas(verify, "sa bigint, sb bigint, jaccard double")
