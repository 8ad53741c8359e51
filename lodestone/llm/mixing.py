"""Mixing sources to target weights by Sainte-Lague apportionment (operator 10).

1. *Targets.* Sources share the corpus size (in words) by weight; a target
   stops at ``max_epochs`` times its source's size and the excess is shared
   again by weight.  This water level has a closed form over the sources in
   ascending order of cap per weight.
2. *Blocks.* Every source is dealt over shards of its own, as many as its size
   asks for, by a hash of doc_id and text, and each shard's stream, in seeded
   order, is cut into blocks of equal word counts (about BLOCK_WORDS).  Equal
   rows are one entry with a count until they are written out again.
3. *Seats.* Blocks are seats: Sainte-Lague gives the seats to the sources by
   highest quotients v/(2j-1), then each source's seats to its shards the
   same way.  Only the seats near the cut are ranked; the sure ones follow
   from a divisor that is known to be too high.
4. *Selection.* A shard's quota of q out of n blocks is spread evenly over the
   seeded order: block j is taken floor(((j+1)q+u)/n) - floor((jq+u)/n)
   times.  That needs no ranking of blocks, gives exactly q, and no block more
   than ceil(q/n) <= max_epochs times, so a document's share is a difference
   of two prefix values.

Everything is DataFrame code; windows are over the distinct rows of a shard of
bounded size, over one narrow row per shard of a source, or over one per source.

Cases: null text has size 0; a null source is a source of its own, last; an
empty table gives an empty result; sources of size 0 have target 0.  Repeated
rows are documents of their own, and null or repeated doc_ids are spread by
their texts.  The same rows give the same result whatever their order or
partitioning; rows that differ in other columns alone are told apart by those.  Other columns are ignored by mix(); take()
keeps them, under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.scratch import materialise

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 17
#: words in a shard, about: bounds what one window partition holds
SHARD_WORDS = 1 << 18
#: words in a block, about
BLOCK_WORDS = 16
#: sources whose sizes may be broadcast (about 100 bytes each)
BROADCAST_SOURCES = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(by_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, ...) -> the same with weight and target."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    df = by_source.withColumn("weight", turn).withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    every = W.partitionBy()
    rise = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(rise), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(rise), F.lit(0.0))))
    # the level falls from source to source until the caps no longer bind
    df = df.withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    free = F.max(F.when(~F.col("full"), F.struct(-F.col("cap") / F.col("weight"), F.col("level")))).over(every)["level"]
    return df.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * free)).drop("cap", "level", "full")


def apportion(df: DataFrame, keys: list[str], votes: str, seats: str, tie: list[str], out: str) -> DataFrame:
    """Sainte-Lague: `seats` (one number per group of `keys`) to the group's rows by `votes`.

    Ties go to the row that comes first by `tie`.
    """
    group = W.partitionBy(*keys)
    columns = df.columns
    total, rows, want = F.sum(votes).over(group), F.count("*").over(group), F.col(seats).cast("double")
    low = F.when(want > rows, F.col(votes) * (want - rows) / total).otherwise(F.lit(0.0))
    high = F.col(votes) * (want + rows) / total
    df = df.withColumn("_sure", F.when(total > 0, F.floor(low + 0.5)).otherwise(F.lit(0)).cast("long"))
    df = df.withColumn("_last", F.when(total > 0, F.floor(high + 0.5)).otherwise(F.lit(0)).cast("long"))
    df = df.withColumn("_given", F.sum("_sure").over(group))
    near = F.when(F.col("_last") > F.col("_sure"), F.sequence(F.col("_sure") + 1, F.col("_last")))
    df = df.withColumn("_seat", F.explode_outer(near))
    order = W.partitionBy(*keys).orderBy((F.col(votes) / (2 * F.col("_seat") - 1)).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie], F.col("_seat"))
    won = F.col("_seat").isNotNull() & (F.row_number().over(order) <= F.col(seats) - F.col("_given"))
    df = df.withColumn("_won", won.cast("long"))
    return df.groupBy(*columns, "_sure").agg(F.sum("_won").alias("_won")).select(*columns, (F.col("_sure") + F.col("_won")).alias(out))


def _plan(sized: DataFrame, weights: tuple[int, ...], max_epochs: int, shard_words: int) -> DataFrame:
    """Distinct (_source, _size, _order, _tie, _copies) rows -> the same with their place in a shard's stream and the shard's quota."""
    length = F.col("_size") * F.col("_copies")
    by_source = materialise(sized.groupBy("_source").agg(F.greatest(F.ceil(F.sum(length) / shard_words), F.lit(1)).alias("_shards")).withColumnRenamed("_source", "_s1"), "sources")
    if by_source.count() <= BROADCAST_SOURCES:
        by_source = F.broadcast(by_source)
    sized = sized.join(by_source, sized["_source"].eqNullSafe(by_source["_s1"])).drop("_s1")
    sized = sized.withColumn("_shard", F.pmod(F.xxhash64("_order", "_tie"), F.col("_shards")).cast("int")).drop("_shards")
    groups = sized.groupBy("_source", "_shard").agg(F.sum(length).alias("_len"))
    per = F.greatest(F.ceil(F.col("_len") / F.greatest(F.ceil(F.col("_len") / BLOCK_WORDS), F.lit(1))), F.lit(1)).cast("long")
    groups = materialise(groups.withColumn("_block", per).withColumn("_n", F.ceil(F.col("_len") / F.col("_block")).cast("long")), "streams")
    sources = groups.groupBy(F.col("_source").alias("source")).agg(F.sum("_len").alias("source_size"), F.sum("_n").alias("blocks"))
    sources = targets(sources, weights, max_epochs)
    votes = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = sources.withColumn("_votes", votes).withColumn("_seats", F.round(F.sum("_votes").over(W.partitionBy())).cast("long"))
    quotas = apportion(sources, [], "_votes", "_seats", ["source"], "_quota")
    quotas = materialise(quotas.withColumn("_quota", F.least("_quota", max_epochs * F.col("blocks"))), "quotas")
    dealt = groups.join(quotas, groups["_source"].eqNullSafe(quotas["source"])).select(groups["_source"], "_shard", "_len", "_block", "_n", "source_size", "target", "_quota", F.col("_n").cast("double").alias("_w"))
    dealt = apportion(dealt, ["_source"], "_w", "_quota", ["_shard"], "_q").withColumn("_q", F.least("_q", max_epochs * F.col("_n")))
    dealt = materialise(dealt.drop("_w", "_quota"), "shards")
    stream = W.partitionBy("_source", "_shard").orderBy("_order", "_tie").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("_from", F.coalesce(F.sum(length).over(stream), F.lit(0)))
    b = dealt.withColumnsRenamed({"_source": "_s2", "_shard": "_h2"})
    placed = placed.join(b, placed["_source"].eqNullSafe(b["_s2"]) & (placed["_shard"] == b["_h2"])).drop("_s2", "_h2")
    # equal rows follow each other in the stream
    placed = placed.withColumn("_twin", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return placed.withColumn("_from", F.col("_from") + (F.col("_twin") - 1) * F.col("_size"))


def _order(seed: int, doc_id: Column, text: Column) -> dict[str, Column]:
    return {
        "_order": F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")))),
        "_tie": F.md5(F.coalesce(text, F.lit(""))),
    }


def _times(j: Column) -> Column:
    """How often block j of its stream is taken."""
    n, q = F.col("_n"), F.col("_q")
    u = F.floor(n / 2)
    return F.floor(((j + 1) * q + u) / n) - F.floor((j * q + u) / n)


def _before(x: Column) -> Column:
    """Words taken from the first x words of a stream."""
    n, q, size = F.col("_n"), F.col("_q"), F.col("_block")
    j = F.floor(x / size)
    u = F.floor(n / 2)
    return F.floor((j * q + u) / n) * size + (x - j * size) * _times(j)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    text = F.col("text").cast("string")
    sized = docs.select(F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("_source"), n_words(text).alias("_size"), *[c.alias(k) for k, c in _order(seed, F.col("doc_id"), text).items()])
    sized = materialise(sized.groupBy(*sized.columns).agg(F.count("*").alias("_copies")), "sizes")
    placed = _plan(sized, weights, max_epochs, shard_words)
    taken = F.when(F.col("_size") > 0, _before(F.col("_from") + F.col("_size")) - _before(F.col("_from"))).otherwise(F.lit(0))
    return placed.select("doc_id", F.col("_size").alias("size"), "source_size", "target", taken.cast("long").alias("taken"))


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The mix itself: the columns of `docs`, one row per epoch that takes some of the document.

    A document taken whole in an epoch keeps its text as it is; of one taken
    in part, the words of the taken blocks remain, joined by one space.
    n_chars, where present, follows the text.
    """
    columns = docs.columns
    text = F.col("text").cast("string")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col("source").cast("string").alias("_source"), n_words(text).alias("_size"), *[c.alias(k) for k, c in _order(seed, F.col("doc_id"), text).items()])
    # sources without words count in the turn of weights
    narrow = packed.select("_source", "_size", "_order", "_tie")
    narrow = materialise(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("_copies")), "sizes")
    placed = _plan(narrow, weights, max_epochs, shard_words).where("_size > 0").drop("_size", "source_size", "target", "_copies")
    # equal rows get places of their own, in the order of their other columns
    rest = [F.col("_row")[f.name] for f in docs.schema.fields if f.name != "text" and "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    twins = W.partitionBy("_order", "_tie", "_source").orderBy(F.xxhash64(F.lit(0), *rest))
    left = packed.where("_size > 0").withColumn("_twin", F.row_number().over(twins))
    right = placed.withColumnsRenamed({"_order": "_o2", "_tie": "_t2", "_source": "_s2", "_twin": "_w2"})
    joined = left.join(right, (left["_order"] == right["_o2"]) & (left["_tie"] == right["_t2"]) & (left["_twin"] == right["_w2"]) & left["_source"].eqNullSafe(right["_s2"]))
    first, last = F.floor(F.col("_from") / F.col("_block")), F.floor((F.col("_from") + F.col("_size") - 1) / F.col("_block"))
    joined = joined.withColumn("_first", first).withColumn("_times", F.transform(F.sequence(first, last), _times))
    epochs = joined.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.lit(max_epochs)))).where(F.array_max("_times") >= F.col("_epoch"))
    words = F.regexp_extract_all(F.col("_row.text").cast("string"), F.lit(WORD), F.lit(0))
    kept = F.filter(words, lambda w, i: F.get(F.col("_times"), (F.floor((F.col("_from") + i) / F.col("_block")) - F.col("_first")).cast("int")) >= F.col("_epoch"))
    whole = F.array_min("_times") >= F.col("_epoch")
    epochs = epochs.withColumn("_text", F.when(whole, F.col("_row.text").cast("string")).otherwise(F.array_join(kept, " ")))
    out = []
    for c in columns:
        col = F.col("_row")[c]
        if c == "text":
            col = F.col("_text")
        elif c == "n_chars":
            col = F.length("_text").cast(docs.schema[c].dataType)
        out.append(col.alias(c))
    return epochs.select(*out)
