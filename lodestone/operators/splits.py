"""Strata, deterministic splits, near-duplicates and split leakage."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.operators import similar

SPLITS = ("train", "val", "test")
#: leading hexadecimal digits of a hash that make a bucket of a stratum: 4,096 buckets
BUCKET_DIGITS = 3


def tool_arity(n_tools: Column) -> Column:
    return F.when(n_tools <= 0, "0").when(n_tools == 1, "1").otherwise("2+")


def stratum_key(*parts: Column) -> Column:
    """The parts joined by ``::``; null or empty is ``unknown``."""
    return F.concat_ws("::", *[F.coalesce(F.nullif(p.cast("string"), F.lit("")), F.lit("unknown")) for p in parts])


def tool_bucket(tools: Column) -> Column:
    """Sorted tool names, or ``no_tools``."""
    return F.when(F.size(tools) > 0, F.array_join(F.array_sort(tools), "+")).otherwise("no_tools")


def stratified_split(df: DataFrame, stratum: Column, key: Column, fractions: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 0) -> DataFrame:
    """Adds `stratum` and `split`.

    Rows of a stratum are ranked by a seeded hash of their key; half-even
    rounding gives the sizes of train and val, val being cut to what is left.
    A stratum is cut into 4,096 buckets by the hash's first digits: bucket sizes give
    each bucket's first rank, and rows are numbered within their bucket only,
    so one stratum may hold the whole corpus.
    """
    if any(f < 0 for f in fractions) or abs(sum(fractions) - 1.0) > 1e-6:
        raise ValueError("fractions must be non-negative and sum to 1")
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("stratum"), F.lit(":"), key.cast("string")), 256)
    df = df.withColumn("stratum", stratum).withColumn("_h", h).withColumn("_bucket", F.substring("_h", 1, BUCKET_DIGITS))
    sizes = df.groupBy("stratum", "_bucket").agg(F.count("*").alias("_c"))
    whole = W.partitionBy("stratum")
    # at most 4,096 narrow rows a stratum
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_c").over(whole.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("_n", F.sum("_c").over(whole)).drop("_c")
    rows = df.withColumn("_r", F.row_number().over(W.partitionBy("stratum", "_bucket").orderBy("_h", key)))
    rows = rows.join(sizes.withColumnsRenamed({"stratum": "_s", "_bucket": "_b"}), F.col("stratum").eqNullSafe(F.col("_s")) & (F.col("_bucket").eqNullSafe(F.col("_b"))))
    rank, n = F.col("_before") + F.col("_r"), F.col("_n")
    train = F.bround(n * F.lit(fractions[0])).cast("long")
    val = F.least(F.bround(n * F.lit(fractions[1])).cast("long"), n - train)
    out = F.when(rank <= train, SPLITS[0]).when(rank <= train + val, SPLITS[1]).otherwise(SPLITS[2])
    return rows.withColumn("split", out).drop("_h", "_bucket", "_before", "_n", "_r", "_s", "_b")


def shingles(text: Column, k: int = 5) -> Column:
    """Distinct character k-grams of lower-cased text; a shorter text is its own shingle, an empty one has none."""
    t = F.lower(F.coalesce(text, F.lit("")))

    # by array access: substring() would walk the text from its start for every gram
    def grams(c: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(c) - k)
        return F.when(F.size(c) <= k, F.array(F.array_join(c, ""))).otherwise(F.array_distinct(F.transform(at, lambda i: F.concat(*[c[i + j] for j in range(k)]))))

    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.transform(F.array(F.split(t, "")), grams)[0])


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / union).otherwise(F.lit(0.0))


def _classes(df: DataFrame, key: str, text: str, threshold: float, k: int, groups: str | None = None) -> DataFrame:
    """(key, grp, sid, n, pre): one row per row with shingles, with the id of its set and what similar() needs of it."""
    rows = df.select(F.col(key).alias("key"), *([F.col(groups).alias("grp")] if groups else []), F.col(text).alias("_text"))
    # kept on disk without the sets: later steps read it from there
    return similar.sketches(rows, k, threshold).persist(StorageLevel.DISK_ONLY)


def near_duplicates(df: DataFrame, key: str, text: str, threshold: float = 0.85, k: int = 5, groups: str | None = None) -> DataFrame:
    """All pairs (a, b) with Jaccard similarity of at least `threshold`; exact.

    The output holds every pair of a group of copies, which grows with the
    square of the group: near_duplicate_classes() says the same in one row per
    key and one per pair of different texts.  With `groups` only pairs of
    different groups count (a < b by group), else a < b by key.
    """
    sets = _classes(df, key, text, threshold, k, groups)
    distinct = sets.select("sid").distinct()
    sure = similar.similar(df, sets, key, text, threshold, k)
    links = sure.select("sa", "sb", "jaccard").unionByName(sure.select(F.col("sb").alias("sa"), F.col("sa").alias("sb"), "jaccard"))
    links = links.unionByName(distinct.select(F.col("sid").alias("sa"), F.col("sid").alias("sb"), F.lit(1.0).alias("jaccard")))
    cols = ["key", "sid"] + (["grp"] if groups else [])
    a, b = sets.select(*[F.col(c).alias(f"{c}_a") for c in cols]), sets.select(*[F.col(c).alias(f"{c}_b") for c in cols])
    pairs = a.join(links, a["sid_a"] == links["sa"]).join(b, links["sb"] == b["sid_b"])
    pairs = pairs.where(F.col("grp_a") < F.col("grp_b")) if groups else pairs.where(F.col("key_a") < F.col("key_b"))
    return pairs.select(*(["grp_a", "grp_b"] if groups else []), "key_a", "key_b", "jaccard")


def near_duplicate_classes(df: DataFrame, key: str, text: str, threshold: float = 0.85, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(members, links), linear in rows: no group of copies is expanded.

    members: key, class_key (the smallest key with the same shingles), n_links
    (rows of other classes that are similar enough, plus the other rows of the
    own class).  links: class_a, class_b, jaccard for classes of different
    shingles, class_a < class_b.  Rows without shingles have neither.
    """
    sets = _classes(df, key, text, threshold, k)
    named = sets.groupBy("sid").agg(F.min("key").alias("class_key"), F.count("*").alias("n"))
    sure = similar.similar(df, sets, key, text, threshold, k)
    a, b = (named.select(F.col("sid").alias(s), F.col("class_key").alias(c), F.col("n").alias(m)) for s, c, m in (("sa", "ca", "na"), ("sb", "cb", "nb")))
    met = sure.join(a, "sa").join(b, "sb")
    links = met.select(F.least("ca", "cb").alias("class_a"), F.greatest("ca", "cb").alias("class_b"), "jaccard")
    both = met.select(F.col("sa").alias("sid"), F.col("nb").alias("m")).unionByName(met.select(F.col("sb").alias("sid"), F.col("na").alias("m")))
    more = both.groupBy("sid").agg(F.sum("m").alias("m"))
    counted = named.join(more, "sid", "left").select("sid", "class_key", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"))
    return sets.join(counted, "sid").select("key", "class_key", "n_links"), links


def split_integrity(df: DataFrame, key: str, text: str, split: str = "split", threshold: float = 0.85, k: int = 5) -> DataFrame:
    """Near-duplicate pairs across splits: split_a, split_b, key_a, key_b, jaccard (three places)."""
    pairs = near_duplicates(df, key, text, threshold, k, groups=split)
    return pairs.select(F.col("grp_a").alias("split_a"), F.col("grp_b").alias("split_b"), "key_a", "key_b", F.bround("jaccard", 3).alias("jaccard"))


def split_leak_counts(df: DataFrame, key: str, text: str, split: str = "split", threshold: float = 0.85, k: int = 5) -> DataFrame:
    """split_summary() of split_integrity(), from the rows that a class has in each split: no pair of rows is made."""
    sets = _classes(df, key, text, threshold, k, split)
    held = sets.where("grp IS NOT NULL").groupBy("sid", "grp").agg(F.count("*").alias("n"))
    a, b = (held.select(F.col("sid").alias(s), F.col("grp").alias(g), F.col("n").alias(n)) for s, g, n in (("sa", "ga", "na"), ("sb", "gb", "nb")))
    links = similar.similar(df, sets, key, text, threshold, k).select("sa", "sb")
    links = links.unionByName(sets.select(F.col("sid").alias("sa"), F.col("sid").alias("sb")).distinct())
    met = links.join(a, "sa").join(b, "sb").where((F.col("ga") != F.col("gb")) & ((F.col("sa") != F.col("sb")) | (F.col("ga") < F.col("gb"))))
    return met.groupBy(F.least("ga", "gb").alias("split_a"), F.greatest("ga", "gb").alias("split_b")).agg(F.sum(F.col("na") * F.col("nb")).alias("n_pairs"))


def split_summary(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("split_a", "split_b").agg(F.count("*").alias("n_pairs"))


def contained(items: DataFrame, docs: DataFrame, item_key: str, item_text: str, doc_key: str, doc_text: str, k: int = 5) -> DataFrame:
    """(item, document) pairs whose word k-grams of the item all occur in the document.

    An item of fewer than k words is one gram of its own length, and one without words is in every document.
    """
    words = lambda c: F.filter(F.split(F.lower(F.coalesce(F.col(c), F.lit(""))), r"\s+"), lambda x: x != "")

    def grams(w: Column, n: int) -> Column:
        return F.when(F.size(w) >= n, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[w[i + j] for j in range(n)])))).otherwise(F.array().cast("array<bigint>"))

    left = items.select(F.col(item_key).alias("item"), words(item_text).alias("w")).withColumn("k", F.least(F.size("w"), F.lit(k)))
    # only the lengths that items have are cut from documents
    sizes = sorted(r["k"] for r in left.select("k").distinct().collect())
    right = docs.select(F.col(doc_key).alias("doc"), words(doc_text).alias("w"))
    found = left.where("k = 0").select("item").distinct().crossJoin(right.select("doc").distinct()).select("doc", "item")
    for n in (n for n in sizes if n):
        cut = lambda df, key, n=n: df.select(key, F.transform(F.array("w"), lambda w: grams(w, n))[0].alias("g"))
        # every row has grams of its own: ids may be there twice
        one = cut(left.where(F.col("k") == n), "item").distinct().withColumn("v", F.xxhash64("g"))
        one = one.select("item", "v", F.size("g").alias("n"), F.explode("g").alias("h"))
        two = cut(right, "doc").withColumn("row", F.monotonically_increasing_id()).select("doc", "row", F.explode("g").alias("h"))
        met = two.join(one, "h").groupBy("doc", "row", "item", "v", "n").agg(F.count("*").alias("m"))
        found = found.unionByName(met.where("m = n").select("doc", "item"))
    return found.distinct()


def same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    """Null-safe equality of columns of two frames."""
    return reduce(and_, [a[c].eqNullSafe(b[c]) for c in columns])
