"""SimHash near-dedup with bounds of its own (operator 5 as the pipeline's stage).

Two texts are near copies if the Jaccard similarity of their sets of word
shingles (five words) is ``similarity`` (0.8) or more; groups are components
of such links.  The steps are those of operator 5: fingerprints, an inverted
index of their bytes by position, a tally of shared positional bytes with a
count filter, and verification.  Its 64 bits and its bound of 4 are too narrow
for this (0.8 is some 10 differing bits of 64, give or take 3, which leaves no
byte that is surely shared), so the fingerprint is longer.

*Fingerprints.* Equal sets are collapsed before.  Each set has 384 SimHash
bits (bitwise majorities over its shingles' hashes): 48 bytes.

*Index and tally.* A set is posted under each (position, byte).  Pairs at 0.8
share 13 of 48 positions, give or take 3, unrelated ones 0.2; MIN_SHARED (3)
is the least tally of a candidate, which a pair at 0.8 misses with 3e-5.  A
list is split by the byte of each later position, and once more if still long,
so a pair is met only where it shares two or three positions, and taken in one
such place alone: that of its first ones.  Candidates differ in at most MOST
bits (see there) and in size by no more than the similarity allows.

*Dense lists.* What still holds over LIST_LIMIT sets that share three positions
is a part of one large group, whose pairs grow with its square.  Such parts
that overlap in a list are one dense list, whose pairs are never made; its
sets meet through a hub, and nothing is cut.  The hub is the member closest to
the majority of their bits, in a group of edited copies what they were made
from.  Lists without that one have hubs of their own, which lie in others of
its lists, so a list goes to the hub of most sets that its own hub meets.  A
set is then compared with one hub for all its lists, or a few.

With h the hub, a set x is kept as its delta X, the shingles that only one of
x and h holds.  Deltas tell sets apart as the sets themselves do: x and y differ
in as many shingles as X and Y.  They are a pair if they differ in at most
d = (1 - t) / (1 + t) * (|x| + |y|), which is if X and Y share (|X| + |Y| - d) / 2
or more.  Where that is not above 0, both are pairs with h (if y is not,
|Y| > (1 - t) / (1 + t) * (|y| + |h|), so |X| < (1 - t) / (1 + t) * (|x| - |h|) < |X|).
All others share a shingle of their deltas: with |X| <= |Y| one of the first
d / 2 + 1 of X and the first d + 1 of Y, in any fixed order.  What h lacks
comes first, as few copies have it in common, and what over half of them differ
from h in comes last.  Copies of one text that were edited apart share no such
shingle and are never met.

Those first shingles make lists again, and pairs within a component need no
look, as they change no component.  So a list is compared pair by pair, each
set of it with the few that are outside its largest component or, if fewer,
with those that have the shingle in their shorter prefix.  Where both are over
the limit, it is a part of the group that was edited alike: it gets its own hub
(of the smallest delta) and is dealt with as above.  It holds fewer sets than
the one before, and the limit grows by GROWTH at each step, as sets are in
several such lists and these must not multiply; so the steps are no more than
the logarithm of the largest group.  What is left to compare there, groups of
which no two sets are of one component, is limit times the list.

*Verifying.* Candidates are verified on their shingles' 64-bit hashes, in dense
lists on those of their deltas.

Cases: as in operator 5: texts without words (or null) are copies of each
other, fewer words than a shingle are one shingle, only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.components import components
from lodestone.llm.scratch import discard, materialise, parallelism, release, text_batches
from lodestone.llm.simhash_dedup import keep_rows, row_key
from lodestone.llm.wordhash import Words, blocks, grams, mix, spans_hash

SHINGLE = 5
SIMILARITY = 0.8
WORDS = 6
#: bytes of a fingerprint
POSITIONS = 8 * WORDS
#: positional bytes that a candidate pair shares at least
MIN_SHARED = 3
#: differing bits of a candidate pair, at most: 0.8 is 57 of 384, give or take 7; the majorities of
#: sets of fewer than FEW shingles are less steady (up to 72, give or take 8)
MOST, MOST_FEW, FEW = 92, 120, 24
#: lists up to this long are compared pair by pair
LIST_LIMIT = 32
#: what the limit grows by from one step of dense lists to the next
GROWTH = 4
_SALT = np.random.default_rng(20240805).integers(1, 2**63, size=WORDS, dtype=np.uint64)
#: the bits of a byte, each in a byte of its own
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts, by text, and the bounds of each text's (one more than texts)."""
    words = Words([t.lower() for t in texts])
    h, first = words.hashes(), words.first
    count = np.diff(first)
    at = np.arange(max(len(h) - shingle + 1, 0))
    own = words.owner[: len(at)]
    inside = at + shingle <= first[1:][own]
    few = np.flatnonzero((count > 0) & (count < shingle))
    value = np.concatenate((grams(h, shingle)[inside], spans_hash(h, first[few], first[few + 1])))
    owner = np.concatenate((own[inside], few))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def fingerprints(value: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """SimHash bytes of sets, one row of POSITIONS each; zero for a set without shingles."""
    count = np.diff(bound)
    out = np.zeros((len(count), POSITIONS), np.uint8)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    # ones are summed in lanes of a byte, so over 255 shingles at a time
    runs = -(-count[full] // 255)
    cut = np.concatenate(([0], np.cumsum(runs)[:-1]))
    start = np.repeat(bound[full], runs) + 255 * (np.arange(runs.sum()) - np.repeat(cut, runs))
    for w in range(WORDS):
        byte = mix(value ^ _SALT[w]).view(np.uint8).reshape(-1, 8)
        for p in range(8):
            lanes = np.add.reduceat(_LANES[byte[:, p]], start).view(np.uint8).reshape(-1, 8)
            ones = np.add.reduceat(lanes, cut, axis=0, dtype=np.int64)
            out[full, 8 * w + p] = np.packbits(ones * 2 > count[full, None], axis=1, bitorder="little")[:, 0]
    return out


def set_ids(value: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Ids of sets; 0 for a set without shingles."""
    sid = np.zeros(len(bound) - 1, np.uint64)
    full = np.flatnonzero(np.diff(bound))
    if len(full):
        sid[full] = mix(np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), bound[full]))
    return sid


def _mark(shingle: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at, texts in blocks(pdf["text"]):
                value, bound = shingle_sets(texts, shingle)
                rest = pdf.drop(columns="text").iloc[at : at + len(texts)]
                fp = [x.tobytes() for x in fingerprints(value, bound)]
                yield rest.assign(sid=set_ids(value, bound).view(np.int64), n=np.diff(bound).astype(np.int32), fp=fp)

    return run


def _sets(shingle: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at, texts in blocks(pdf["text"]):
                value, bound = shingle_sets(texts, shingle)
                mine = [value[a:b].view(np.int64) for a, b in zip(bound[:-1], bound[1:], strict=True)]
                yield pd.DataFrame({"sid": pdf["sid"].iloc[at : at + len(texts)].to_numpy(), "hs": mine})

    return run


def _runs(key: np.ndarray) -> np.ndarray:
    """Lengths of the runs of equal values."""
    return np.diff(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))) if len(key) else np.zeros(0, np.int64)


def _join(label: np.ndarray, rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Labels (rows' numbers) once the rows of each run are one; the smallest wins."""
    start = np.cumsum(length) - length
    while True:
        own = label[rows]
        low = np.repeat(np.minimum.reduceat(own, start), length)
        if (own == low).all():
            return label
        parent = np.arange(len(label))
        np.minimum.at(parent, own, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]


def _hubs(label: np.ndarray, sid: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Of each label's rows, the set closest to the majority of their bits; the smallest of equals."""
    if not len(label):
        return sid
    order = np.argsort(label, kind="stable")
    fp = fp[order]
    length = _runs(label[order])
    start, group = np.cumsum(length) - length, np.repeat(np.arange(len(length)), length)
    apart = np.zeros(len(fp), np.int64)
    for p in range(POSITIONS):
        ones = np.add.reduceat(np.unpackbits(fp[:, p : p + 1], axis=1), start, axis=0, dtype=np.int64)
        apart += np.bitwise_count(fp[:, p] ^ np.packbits(ones * 2 > length[:, None], axis=1)[group, 0])
    best = np.lexsort((sid[order], apart, group))[start]
    out = np.empty_like(sid)
    out[order] = sid[order][best][group]
    return out


def meet(place: np.ndarray, byte: np.ndarray, sid: np.ndarray, n: np.ndarray, fp: np.ndarray, similarity: float, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole lists of postings -> pairs (x, y) and members of dense lists (sid, place, hub of the dense list)."""
    order = np.lexsort((sid, byte, place))
    place, byte, sid, n, fp = place[order].astype(np.int64), byte[order], sid[order], n[order].astype(np.int64), np.ascontiguousarray(fp[order])
    word = fp.view(np.uint64)
    group = np.cumsum(np.concatenate(([0], (place[1:] != place[:-1]) | (byte[1:] != byte[:-1])))) if len(sid) else place
    label = np.arange(len(sid))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(rows: np.ndarray, key: np.ndarray, *later: int) -> None:
        for d in range(1, limit):
            at = np.flatnonzero(key[d:] == key[:-d])
            if not len(at):
                return
            x, y = rows[at], rows[at + d]
            small = np.minimum(n[x], n[y])
            most = np.where(small < FEW, MOST_FEW, MOST)
            ok = (label[x] != label[y]) & (small >= similarity * np.maximum(n[x], n[y]) - 1e-9)
            x, y, most = x[ok], y[ok], most[ok]
            ok = np.bitwise_count(word[x] ^ word[y]).sum(axis=1) <= most
            x, y = x[ok], y[ok]
            tally = (fp[x] == fp[y]).cumsum(axis=1)
            one = np.arange(len(x))
            ok = (tally[:, -1] >= MIN_SHARED) & (tally[one, place[x]] == 1)
            for k, p in enumerate(later):
                ok &= tally[one, p] == k + 2
            found.append((x[ok], y[ok]))

    for p in range(1, POSITIONS):
        end = np.searchsorted(place, p)
        key = group[:end] * 256 + fp[:end, p]
        rows = np.argsort(key, kind="stable")
        key = key[rows]
        length = _runs(key)
        pick = np.repeat((length > 1) & (length <= limit), length)
        compare(rows[pick], key[pick], p)
        pick = np.repeat(length > limit, length)
        if not pick.any():
            continue
        long, key = rows[pick], key[pick]
        for q in range(p + 1, POSITIONS):
            finer = key * 256 + fp[long, q]
            by = np.argsort(finer, kind="stable")
            rows, finer = long[by], finer[by]
            length = _runs(finer)
            pick = np.repeat(length > limit, length)
            if pick.any():
                label = _join(label, rows[pick], length[length > limit])
            pick = np.repeat((length > 1) & (length <= limit), length)
            compare(rows[pick], finer[pick], p, q)
    x, y = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (list(zip(*found, strict=True)) or [[], []]))
    # what one dense list holds meets through its hub
    ok = label[x] != label[y]
    dense = np.flatnonzero(np.bincount(label, minlength=len(label))[label] > 1)
    return sid[x[ok]], sid[y[ok]], sid[dense], place[dense], _hubs(label[dense], sid[dense], fp[dense])


def _meet(similarity: float, limit: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        pdf = pd.concat(held)
        del held
        fp = np.frombuffer(b"".join(pdf["fp"]), np.uint8).reshape(-1, POSITIONS)
        place = pdf["place"].to_numpy()
        byte = fp[np.arange(len(fp)), place]
        x, y, sid, at, hub = meet(place, byte, pdf["sid"].to_numpy(), pdf["n"].to_numpy(), fp, similarity, limit)
        yield pd.DataFrame({"a": np.concatenate((x, sid)), "b": np.concatenate((y, hub)), "place": np.concatenate((np.full(len(x), -1), at)).astype(np.int32)})

    return run


def _met(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with the shingles of a as x and of b as y."""
    # b may be in very many pairs: it is met first, while rows are narrow
    x, y = sets.select(F.col("sid").alias("a"), F.col("hs").alias("x")), sets.select(F.col("sid").alias("b"), F.col("hs").alias("y"))
    return pairs.join(y.hint("merge"), "b").join(x.hint("merge"), "a")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) pairs that are similar enough; sets: (sid, hs)."""
    pairs = materialise(pairs.select("a", "b").distinct(), "pairs")
    both = F.size(F.array_intersect("x", "y"))
    sure = materialise(_met(pairs, sets).where(both >= similarity * (F.size("x") + F.size("y") - both) - 1e-9).select("a", "b"), "links")
    discard(pairs)
    return sure


def _differ(groups: DataFrame, *key: str) -> DataFrame:
    """The keys whose sets are of several components."""
    return groups.groupBy(*key).agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select(*key)


def _crowd(dense: DataFrame) -> DataFrame:
    """Members of dense lists (sid, hub) -> groups (g, a, b): a set and the hub it is compared with."""
    fame = dense.groupBy("hub").agg(F.count("*").alias("c"))
    best = dense.join(fame.hint("merge"), "hub").groupBy("sid").agg(F.max(F.struct("c", "hub")).alias("m"))
    moved = dense.join(best.select(F.col("sid").alias("hub"), F.col("m.hub").alias("b")).hint("merge"), "hub")
    return moved.where("sid <> b").select(F.col("b").alias("g"), F.col("sid").alias("a"), "b").distinct()


def _deltas(groups: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Groups (g, a, b) -> (g, hub, sid, n, delta, m its size, sure: whether the set and the hub are a pair)."""
    both = F.size(F.array_intersect("x", "y"))
    sure = both >= similarity * (F.size("x") + F.size("y") - both) - 1e-9
    delta = F.concat(F.sort_array(F.array_except("x", "y")), F.sort_array(F.array_except("y", "x")))
    rows = _met(groups, sets).select("g", F.col("b").alias("hub"), F.col("a").alias("sid"), F.size("x").alias("n"), delta.alias("delta"), sure.alias("sure"))
    return materialise(rows.withColumn("m", F.size("delta")), "deltas")


def _ordered(own: DataFrame) -> DataFrame:
    """Deltas with what over half of their group has in them at the end: there the hub is the odd one.

    Any order will do, so a quarter of the sets tell what most have.
    """
    some = own.where(F.pmod(F.xxhash64("sid"), F.lit(4)) == 0)
    seen = some.select("g", F.explode("delta").alias("s")).groupBy("g", "s").agg(F.count("*").alias("k")).where("k > 1")
    size = some.groupBy("g").agg(F.count("*").alias("all"))
    common = seen.join(size.hint("merge"), "g").where("2 * k > all").groupBy("g").agg(F.sort_array(F.collect_list("s")).alias("common"))
    delta = F.concat(F.array_except("delta", "common"), F.array_intersect("common", "delta"))
    rows = own.join(common.hint("merge"), "g", "left").withColumn("delta", F.when(F.col("common").isNull(), F.col("delta")).otherwise(delta))
    return rows.drop("common")


def _apart(deltas: DataFrame, root: DataFrame, similarity: float, limit: int) -> tuple[DataFrame, DataFrame]:
    """Sets of groups and their components (node, root) -> links (a, b) between components, groups (g, a, b) of what is still dense."""
    own = deltas.drop("sure").join(root.withColumnRenamed("node", "sid").hint("merge"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    own = materialise(_ordered(own.join(_differ(own, "g").hint("merge"), "g")), "open")
    # the most that a set differs in from any it is a pair with
    most = (1 - similarity) / similarity * F.col("n") + 1e-6
    prefix = F.slice("delta", F.lit(1), (F.floor(most) + 1).cast("int"))
    posted = own.select("g", "sid", "m", "root", F.floor(most / 2).alias("short"), F.posexplode(prefix).alias("at", "s"))
    posted = materialise(posted.select("g", "s", "sid", "m", "root", (F.col("at") <= F.col("short")).alias("first")), "posted")
    part = posted.groupBy("g", "s", "root").agg(F.count("*").alias("k"), F.count_if("first").alias("c"), F.min(F.struct("m", "sid")).alias("l"))
    size = part.groupBy("g", "s").agg(F.sum("k").alias("all"), F.max(F.struct("k", "root")).alias("top"), F.sum("c").alias("c"), F.min("l").alias("l"))
    size = size.where("all > top.k AND c > 0").select("g", "s", (F.col("all") - F.col("top.k")).alias("rest"), "c", F.col("top.root").alias("top"), F.col("l.sid").alias("hub"))
    lead = F.when(F.col("rest") <= F.col("c"), F.col("root") != F.col("top")).otherwise(F.col("first"))
    lists = posted.join(size.hint("merge"), ["g", "s"]).select("g", "s", "sid", "first", lead.alias("lead"), F.least("rest", "c").alias("c"), "hub")
    lists = materialise(lists, "lists")
    discard(posted)
    few = lists.where(F.col("c") <= limit).select("g", "s", "sid", "first", "lead").join(own.select("g", "sid", "n", "m", "root", "delta").hint("merge"), ["g", "sid"])
    few = materialise(few, "few")

    def side(df: DataFrame, k: str) -> DataFrame:
        return df.select("g", "s", *[F.col(c).alias(f"{c}_{k}") for c in ("sid", "n", "m", "root", "first", "delta")])

    total = F.col("n_x") + F.col("n_y")
    both = (total - F.col("m_x") - F.col("m_y")) / 2 + F.size(F.array_intersect("delta_x", "delta_y"))
    short = F.when(F.struct("m_x", "sid_x") < F.struct("m_y", "sid_y"), F.col("first_x")).otherwise(F.col("first_y"))
    fit = short & (F.col("root_x") != F.col("root_y")) & (F.least("n_x", "n_y") >= similarity * F.greatest("n_x", "n_y") - 1e-9)
    # pairs are verified within their list; only links come out of it
    met = side(few.where("lead"), "x").join(side(few, "y").hint("merge"), ["g", "s"]).where(fit & (both >= similarity * (total - both) - 1e-9))
    sure = materialise(met.select(F.col("sid_x").alias("a"), F.col("sid_y").alias("b")).distinct(), "links")
    # a group of its own for each hub in a group, so it holds fewer sets
    dense = lists.where((F.col("c") > limit) & (F.col("sid") != F.col("hub"))).select(F.xxhash64("g", "hub").alias("g"), F.col("sid").alias("a"), F.col("hub").alias("b"))
    dense = materialise(dense.distinct(), "dense")
    for frame in (own, lists, few):
        discard(frame)
    return sure, dense


def links(sets: DataFrame, texts: Callable[[DataFrame], DataFrame], similarity: float = SIMILARITY, shingle: int = SHINGLE, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Distinct sets (sid, n, fp) -> verified links (a, b), enough to connect every component.

    texts: gives (sid, text), the text of each set, for a frame of sids.
    """
    spark = sets.sparkSession
    posted = sets.where("n > 0").select("sid", "n", "fp", F.explode(F.sequence(F.lit(0), F.lit(POSITIONS - 1))).alias("place"))
    lists = posted.repartition(parallelism(spark), "place", F.substring("fp", F.col("place") + 1, F.lit(1)))
    met = materialise(lists.mapInPandas(_meet(similarity, list_limit), "a long, b long, place int"), "met")
    release(spark)
    pairs, dense = met.where("place < 0").select("a", "b"), met.where("place >= 0").select(F.col("a").alias("sid"), F.col("b").alias("hub")).distinct()
    used = met.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    # a row that is there many times is one text
    alone = texts(used).groupBy("sid").agg(F.first("text").alias("text"))
    shingles = materialise(alone.mapInPandas(_sets(shingle), "sid long, hs array<bigint>"), "sets")
    release(spark)
    found = _verified(pairs, shingles, similarity)
    groups = materialise(_crowd(dense), "groups")
    discard(met)
    release(spark)
    while not groups.isEmpty():
        deltas = _deltas(groups, shingles, similarity)
        discard(groups)
        found = found.unionByName(deltas.where("sure").select(F.col("hub").alias("a"), F.col("sid").alias("b")))
        list_limit *= GROWTH
        more, groups = _apart(deltas, components(found), similarity, list_limit)
        found = found.unionByName(more)
    discard(shingles)
    return found


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, list_limit: int = LIST_LIMIT) -> DataFrame:
    """The rows of `docs` without near copies: of each group, the row with the smallest doc_id stays.

    Ties (repeated doc_ids, or null ones) go to the smallest text hash.
    """
    text_batches(docs.sparkSession)
    doc_id, key = F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("tkey")
    base = docs.select(doc_id, key, F.col("text").cast("string").alias("text"))
    marked = materialise(base.mapInPandas(_mark(shingle), "doc_id long, tkey string, sid long, n int, fp binary"), "marked")
    row = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tkey")))
    sets = materialise(marked.groupBy("sid").agg(row.alias("row"), F.first("n").alias("n"), F.first("fp").alias("fp")), "distinct")
    discard(marked)

    def texts(used: DataFrame) -> DataFrame:
        rows = sets.join(used.hint("merge"), "sid").select("sid", F.col("row.doc_id").alias("_i"), F.col("row.tkey").alias("_k"))
        return base.join(rows.hint("merge"), (base["tkey"] == rows["_k"]) & base["doc_id"].eqNullSafe(rows["_i"])).select("sid", "text")

    root = components(links(sets.drop("row"), texts, similarity, shingle, list_limit))
    named = sets.join(root.hint("merge"), sets["sid"] == root["node"], "left").select("row", F.coalesce("root", "sid").alias("root"))
    return keep_rows(docs, named)
