"""Benchmark decontamination by template canonicalisation (operator 6).

Numbers, names and units become typed placeholders, letters are lower-cased
and punctuation goes, which turns a text into template words.  Windows of five
template words are hashed and joined with the windows of the benchmark items.
A document is contaminated by an item if, on alignments whose slots are
consistent, at least ``min_share`` (0.8) of the item's windows occur in it:
along one alignment (document position minus item position) each item slot
value must map to one document value, so a re-parameterised copy counts and a
chance meeting of empty templates does not.

*Search.* Each item's rarest windows are its probes: as many as may be missed,
and one more, so a document that reaches ``min_share`` holds at least one of
them.  Document windows are kept only if some item has them (the side that
grows meets a unique one), candidate pairs come from the probes, and only for
those are positions joined.

DataFrame functions only.  The distinct item windows are broadcast if their
count is within ``broadcast_windows``; beyond, the same join runs as a
shuffle.  A window's hash is 64 bits; the template words of surviving pairs
are compared in full.

Definitions.  Number: digits with inner [.,:/] and an optional currency sign or
percent sign, not touching letters.  Unit: a word of UNITS right after a
number.  Name: a capitalised word that is none of OPENERS, wherever it stands,
so a name that starts a sentence is one too and a passage reads the same in
every context.  Each item is also read in lower case, for copies without
capitals.  Windows need ``min_literals`` (2) words that are no placeholders.
An item of two to four template words is one window of its own length.  An
item without such a window (one word, or placeholders only) matches documents
whose words, numbers included, are the item's, case and punctuation aside.

Cases: null texts and items without words match nothing; repeated rows of a
doc_id are judged one by one and reported once; an empty table on either side
gives an empty result.  Other columns are ignored by contaminated() and kept
by drop_contaminated().
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.scratch import materialise

WINDOW = 5
MIN_SHARE = 0.8
MIN_LITERALS = 2
MIN_CONSISTENCY = 0.75
#: rows (hash, item, position: about 40 bytes each in memory) that may be broadcast
BROADCAST_WINDOWS = 1_000_000
NUM, NAME, UNIT = "\ue000", "\ue001", "\ue002"
UNITS = (
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t oz lb lbs pound pounds ton tons ml cl l liter liters litre litres gal gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years km/h mph m/s hz khz mhz ghz b kb mb gb tb w kw mw j kj cal kcal v a "
    "pa kpa bar c f k degrees percent cents dollar dollars euro euros usd eur gbp"
)
_UNIT = "|".join(u for u in sorted(UNITS.split(), key=lambda u: (-len(u), u)))
_VALUE = r"[$€£]?\d++(?:[.,:/]\d++)*+%?"
# the character itself is looked at first: most positions end there
_FREE = r"(?=[$€£\d])(?<![\p{L}\p{N}" + NUM + "])"
MEASURE = _FREE + "(" + _VALUE + r")[ ]?(" + _UNIT + r")(?![\p{L}\p{N}])"
NUMBER = _FREE + _VALUE + r"(?![\p{L}\p{N}])"
# capitalised words that open sentences and are no names (English, then German, French and Spanish)
OPENERS = (
    "a about after all also although an and another any are as at be because before both but by can could did do does during each either every few find for from give given "
    "had has have he her here his how however i if in into is it its let many may more most my no not now of on once one only or other our over she should since so some "
    "such than that the their then there these they this those through to under until up was we were what when where whether which while who whose why will with would you your "
    "der die das ein eine und wenn wie wer wo es ist le la les un une et si il elle de du en el los las y que qué cómo cuánto se por para"
)
_OPEN = "|".join(sorted((w.capitalize() for w in OPENERS.split()), key=lambda w: (-len(w), w)))
PROPER = r"(?=\p{Lu})(?<![\p{L}\p{N}])(?!(?:" + _OPEN + r")(?![\p{L}\p{N}]))\p{Lu}[\p{L}\p{N}]*+(?:['’-][\p{L}\p{N}]++)*+"
SPLIT = "[^\\p{L}\\p{N}" + NUM + NAME + UNIT + "]+"


def _named(text: Column) -> tuple[Column, Column]:
    """Text without the placeholder characters; the same with names replaced."""
    clean = F.translate(F.coalesce(text, F.lit("")), NUM + NAME + UNIT, "   ")
    return clean, F.regexp_replace(clean, PROPER, NAME)


def _template(named: Column) -> Column:
    """Template words of a text whose names are replaced."""
    low = F.lower(named)
    low = F.regexp_replace(low, MEASURE, f" {NUM} {UNIT} ")
    low = F.regexp_replace(low, NUMBER, f" {NUM} ")
    return F.split(F.trim(F.regexp_replace(low, SPLIT, " ")), " ")


def template_words(text: Column) -> Column:
    """Array of template words; one empty word for a text without words."""
    return _template(_named(text)[1])


def slot_values(text: Column) -> tuple[Column, Column, Column]:
    """Values of the numbers, names and units of a text, each in order."""
    clean, named = _named(text)
    low = F.lower(named)
    # numbers with and without units in one pass, in the order of the text
    either = MEASURE + "|" + NUMBER
    numbers = F.transform(F.regexp_extract_all(low, F.lit(either), F.lit(0)), lambda x: F.regexp_extract(x, _VALUE, 0))
    return numbers, F.regexp_extract_all(clean, F.lit(PROPER), F.lit(0)), F.regexp_extract_all(low, F.lit(MEASURE), F.lit(2))


def _bind(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def _hash(words: Column, at: Column, n: int) -> Column:
    return F.xxhash64(*[words[at + k] for k in range(n)])


def _windows(words: Column, lengths: list[int]) -> Column:
    """Array of (dpos, h): the hashes of all windows of these lengths."""

    def of(w: Column) -> Column:
        def run(n: int) -> Column:
            every = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.struct(i.alias("dpos"), _hash(w, i, n).alias("h")))
            return F.when(F.size(w) >= n, every).otherwise(F.array().cast("array<struct<dpos:int,h:bigint>>"))

        one = [run(n) for n in lengths]
        return F.concat(*one) if len(one) > 1 else one[0]

    return _bind(words, of)


def _plain(text: Column) -> Column:
    """The words of a text in lower case, joined by one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def _readings(benchmark: DataFrame) -> DataFrame:
    """(item_id, text, ikey): each item as it is and, where that differs, in lower case."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = benchmark.select(F.col("item_id"), F.explode(F.array_distinct(F.array(text, F.lower(text)))).alias("text"))
    return both.withColumn("ikey", F.xxhash64("text"))


def _items(readings: DataFrame, window: int, min_literals: int) -> DataFrame:
    base = readings.select("item_id", "ikey", template_words(F.col("text")).alias("words"))
    base = base.withColumn("w", F.least(F.size("words"), F.lit(window)))
    rows = base.select("item_id", "ikey", "words", "w", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("w"))).alias("ipos"))
    body = F.slice("words", F.col("ipos") + 1, F.col("w"))
    rows = rows.withColumn("body", body).where(F.size(F.filter("body", lambda x: ~x.isin(NUM, NAME, UNIT) & (x != ""))) >= min_literals)
    h = F.coalesce(*[F.when(F.col("w") == n, _hash(F.col("body"), F.lit(0), n)) for n in range(1, window + 1)])
    return rows.select("item_id", "ikey", "ipos", "w", h.alias("h"), F.array_join("body", " ").alias("body")).distinct()


def _same(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    return reduce(and_, [a[c].eqNullSafe(b[c]) for c in cols])


def _probes(items: DataFrame, whole: DataFrame, min_share: float) -> DataFrame:
    """(h, item_id, ikey): of each item, the rarest windows, one more than a match may miss."""
    pair = ["item_id", "ikey"]
    own = items.select("h", *pair).distinct()
    rare = own.groupBy("h").agg(F.count("*").alias("f"))
    own = own.join(rare, "h")
    own = own.join(whole, _same(own, whole, pair)).select(own["h"], own["item_id"], own["ikey"], "f", "n_windows")
    order = F.row_number().over(W.partitionBy(*pair).orderBy("f", "h"))
    return own.withColumn("r", order).where(F.col("r") <= F.floor((1 - min_share) * F.col("n_windows") + 1e-9) + 1).select("h", *pair)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_share: float = MIN_SHARE,
    min_literals: int = MIN_LITERALS,
    min_consistency: float = MIN_CONSISTENCY,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """(doc_id, dkey, item_id, ikey, n_windows, slot_consistency, n_matched) of the contaminated documents."""
    pair = ["item_id", "ikey"]
    readings = materialise(_readings(benchmark), "readings")
    items = materialise(_items(readings, window, min_literals), "items")
    lengths = sorted(r["w"] for r in items.select("w").distinct().collect())  # at most `window` numbers
    whole = items.groupBy(*pair).agg(F.countDistinct("body").alias("n_windows"))
    keys = items.select("h").distinct()
    if keys.count() <= broadcast_windows:
        keys = F.broadcast(keys)
    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.withColumn("dkey", F.xxhash64(F.coalesce("text", F.lit(""))))
    words = template_words(F.col("text"))
    if lengths in ([], [window]):
        opened = base.select("doc_id", "dkey", F.posexplode(_bind(words, lambda w: F.when(F.size(w) >= window, F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: _hash(w, i, window))))).alias("dpos", "h"))
    else:
        opened = base.select("doc_id", "dkey", F.explode(_windows(words, lengths)).alias("x")).select("doc_id", "dkey", "x.dpos", "x.h")
    hits = materialise(opened.join(keys, "h").select("doc_id", "dkey", "dpos", "h").distinct(), "hits")
    at = hits.select("doc_id", "dkey", "h").distinct()
    pairs = at.join(_probes(items, whole, min_share), "h").select("doc_id", "dkey", *pair).distinct()
    asked = pairs.join(items, _same(pairs, items, pair)).select("doc_id", "dkey", pairs["item_id"], pairs["ikey"], "ipos", "h")
    met = asked.join(hits, _same(asked, hits, ["doc_id", "dkey"]) & (asked["h"] == hits["h"])).select(*[asked[c] for c in ("doc_id", "dkey", *pair, "ipos")], "dpos")
    met = materialise(met, "met")
    same = _same
    # enough windows in any alignment: few pairs remain
    count = met.groupBy("doc_id", "dkey", *pair).agg(F.countDistinct("ipos").alias("n"))
    count = count.join(whole, same(count, whole, pair)).where(F.col("n") >= min_share * F.col("n_windows")).select(count["doc_id"], count["dkey"], count["item_id"], count["ikey"], "n_windows")
    count = materialise(count, "pairs")
    rows = met.join(count, same(met, count, ["doc_id", "dkey", *pair])).select(*[met[c] for c in met.columns], "n_windows")
    rows = rows.groupBy("doc_id", "dkey", *pair, "n_windows", (F.col("dpos") - F.col("ipos")).alias("shift")).agg(F.sort_array(F.collect_set("ipos")).alias("at"))
    # words and slot values of the texts that take part
    few = count.select("doc_id", "dkey").distinct()
    numbers, names, units = slot_values(F.col("text"))
    d = base.join(few, same(base, few, ["doc_id", "dkey"]), "left_semi").dropDuplicates(["doc_id", "dkey"])
    d = d.select(F.col("doc_id").alias("d_id"), F.col("dkey").alias("d_key"), template_words(F.col("text")).alias("dw"), numbers.alias("dn"), names.alias("dm"), units.alias("du"))
    b = readings.select(F.col("item_id").alias("i_id"), F.col("ikey").alias("i_key"), "text").dropDuplicates(["i_id", "i_key"])
    b = b.select("i_id", "i_key", F.least(F.size(template_words(F.col("text"))), F.lit(window)).alias("w"), template_words(F.col("text")).alias("iw"), numbers.alias("inn"), names.alias("im"), units.alias("iu"))
    full = rows.join(d, rows["doc_id"].eqNullSafe(d["d_id"]) & (rows["dkey"] == d["d_key"])).join(b, rows["item_id"].eqNullSafe(b["i_id"]) & (rows["ikey"] == b["i_key"]))
    # windows that are equal in full
    full = full.withColumn("at", F.filter("at", lambda i: F.slice("iw", i + 1, F.col("w")) == F.slice("dw", i + F.col("shift") + 1, F.col("w"))))
    spots = F.array_distinct(F.flatten(F.transform("at", lambda i: F.sequence(i, i + F.col("w") - 1))))
    slots = F.filter(spots, lambda q: F.col("iw")[q].isin(NUM, NAME, UNIT))

    def value(words: str, num: str, name: str, unit: str, q: Column) -> Column:
        kind = F.col(words)[q]
        nth = F.size(F.filter(F.slice(words, F.lit(1), q + 1), lambda x: x == kind)) - 1
        pick = F.when(kind == NUM, F.get(F.col(num), nth)).when(kind == NAME, F.get(F.col(name), nth)).otherwise(F.get(F.col(unit), nth))
        return F.concat(kind, F.coalesce(pick, F.lit("")))

    full = full.withColumn("maps", F.transform(slots, lambda q: F.struct(value("iw", "inn", "im", "iu", q).alias("i"), value("dw", "dn", "dm", "du", q + F.col("shift")).alias("d"))))
    full = full.withColumn("maps", F.array_distinct("maps"))
    agree = F.when(F.size("maps") == 0, F.lit(1.0)).otherwise(F.size(F.array_distinct(F.transform("maps", lambda m: m["i"]))) / F.size("maps"))
    full = full.withColumn("agree", agree).where(F.col("agree") >= min_consistency)
    bodies = F.transform("at", lambda i: F.array_join(F.slice("iw", i + 1, F.col("w")), " "))
    found = full.select("doc_id", "dkey", *pair, "n_windows", "agree", F.explode(bodies).alias("body"))
    found = found.groupBy("doc_id", "dkey", *pair, "n_windows").agg(F.countDistinct("body").alias("n_matched"), F.min("agree").alias("slot_consistency"))
    found = found.where(F.col("n_matched") >= min_share * F.col("n_windows"))
    # items without a window: the whole text, word by word
    bare = readings.join(whole, _same(readings, whole, pair), "left_anti").select(*pair, _plain(F.col("text")).alias("plain")).where("plain <> ''").distinct()
    if bare.isEmpty():
        return found
    texts = base.select("doc_id", "dkey", _plain(F.col("text")).alias("plain")).where("plain <> ''")
    equal = texts.join(bare, "plain").select("doc_id", "dkey", *pair, F.lit(1).cast("long").alias("n_windows"), F.lit(1).cast("long").alias("n_matched"), F.lit(1.0).alias("slot_consistency")).distinct()
    return found.unionByName(equal)


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_windows, n_matched, share, slot_consistency."""
    found = contaminated(docs, benchmark, **options).withColumn("share", F.col("n_matched") / F.col("n_windows"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("share", "n_matched", "n_windows", "slot_consistency")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_windows", "b.n_matched", "b.share", "b.slot_consistency")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that no item contaminates."""
    bad = contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("_bad_id"), F.col("dkey").alias("_bad_key")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_key"))
    kept = packed.join(bad, packed["_id"].eqNullSafe(bad["_bad_id"]) & (packed["_key"] == bad["_bad_key"]), "left_anti")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
