"""PII detection, redaction with stable placeholders, and the leak gate.

Detection is one pass of native regular expressions per rule; spans come from
the pieces between matches.  Everything is local to a row: overlap resolution
and placeholder numbering are folds over the row's few spans.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.checks import aadhaar_valid, pan_valid
from lodestone.functions.pii_rules import BUILTIN, FIELDS, INDIAN_IDS, SCRIPTS, Rule, check_of, without
from lodestone.plans.schema import EVENT, EVENT_FIELDS, once

SPAN = "struct<start:int,less:int,ord:int,end:int,rule:string,category:string,text:string>"
SPANS = f"array<{SPAN}>"
#: a character of the private area; texts that hold it are split by the pattern itself
MARK = "\uf8ff"
MASK = r"\[[A-Z][A-Z_]*(?:_\d+)?\]"


def none() -> Column:
    return F.array().cast(SPANS)


def _pieces(text: Column, pattern: str) -> Column:
    """The text between the matches.  split() compiles its pattern for every row; a mark in the matches' place needs none."""
    marked = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(MARK)), MARK, -1)
    return F.when(F.contains(text, F.lit(MARK)), F.split(text, pattern, -1)).otherwise(marked)


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule.  `less` is minus the end, so that sorting puts longer spans first."""
    found = F.regexp_extract_all(text, F.lit(rule.java), F.lit(0))

    def spans(m: Column) -> Column:
        # where nothing matched, the text is not looked at again
        parts = F.struct(
            _pieces(text, rule.java).alias("s"),
            m.alias("m"),
            (F.regexp_extract_all(text, F.lit(rule.java), F.lit(rule.group)) if rule.group else F.array().cast("array<string>")).alias("g"),
        )
        return F.when(F.size(m) > 0, F.transform(F.array(parts), walk)[0]).otherwise(none())

    def walk(x: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            begin = acc["pos"] + F.length(x["s"][k])
            after = begin + F.length(x["m"][k])
            if rule.group:
                value = F.regexp_replace(x["g"][k], r"^\s+|\s+$", "")
                lead = F.length(x["g"][k]) - F.length(F.regexp_replace(x["g"][k], r"^\s+", ""))
                start = after - F.length(x["g"][k]) + lead
            else:
                value, start = x["m"][k], begin
            end = start + F.length(value)
            one = F.struct(start.alias("start"), (-end).alias("less"), F.lit(order).alias("ord"), end.alias("end"), F.lit(rule.name).alias("rule"), F.lit(rule.category).alias("category"), value.alias("text"))
            good = F.length(value) > 0
            check = check_of(rule, value)
            good = good if check is None else good & check
            return F.struct(after.alias("pos"), F.when(good, F.array_append(acc["out"], one)).otherwise(acc["out"]).alias("out"))

        start = F.struct(F.lit(0).alias("pos"), none().alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(x["m"]) - 1), start, step, lambda a: a["out"])

    out = F.transform(F.array(found), spans)[0]
    needed = [F.contains(text, F.lit(n)) if len(n) == 1 else F.rlike(text, F.lit(n)) for n in rule.needs]
    return F.when(reduce(and_, needed), out).otherwise(none()) if needed else out


def detect_all(text: Column, rules: tuple[Rule, ...] = BUILTIN) -> Column:
    """All spans of all rules, by start, longer first, then rule order; overlaps kept."""
    t = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(none(), *[rule_spans(t, r, i) for i, r in enumerate(rules)]))


def resolve(spans: Column) -> Column:
    """Leftmost-longest: drops every span that starts before the end of the one kept before."""
    start = F.struct(F.lit(0).alias("pos"), none().alias("out"))
    step = lambda a, s: F.when(s["start"] >= a["pos"], F.struct(s["end"].alias("pos"), F.array_append(a["out"], s).alias("out"))).otherwise(a)
    return F.aggregate(spans, start, step, lambda a: a["out"])


def orchestrated(text: Column, engines: tuple = (), language: Column | None = None) -> Column:
    """Checked Indian identifiers, general rules without their categories, labelled fields, then engines; overlaps resolved.

    engines: functions (text, language) -> spans (plugins.pii_engine).  What an
    engine takes for an Aadhaar or PAN number must pass its check.
    """
    native = detect_all(text, (*INDIAN_IDS, *without(BUILTIN, "GOV_ID_IN", "PHONE"), *FIELDS))
    if not engines:
        return resolve(native)
    lang = detect_language(text) if language is None else language
    found = [F.filter(e(F.coalesce(text, F.lit("")), lang), checked_id) for e in engines]
    return resolve(F.array_sort(F.concat(native, *found)))


def checked_id(span: Column) -> Column:
    """False for a span of category GOV_ID_IN in the form of a PAN or Aadhaar number that fails its check."""
    t = span["text"]
    pan, aadhaar = F.rlike(F.upper(t), F.lit(r"^[A-Z]{5}\d{4}[A-Z]$")), F.rlike(t, F.lit(r"^\d{4}[\s\-]?\d{4}[\s\-]?\d{4}$"))
    return (span["category"] != "GOV_ID_IN") | F.when(pan, pan_valid(t)).when(aadhaar, aadhaar_valid(t)).otherwise(F.lit(True))


def detect_language(text: Column) -> Column:
    """Language of the most frequent Indic script, ``en`` without one; ties go to the script met first."""
    t = F.coalesce(text, F.lit(""))
    found = []
    for lo, hi, code in SCRIPTS:
        rx = f"[\\x{{{lo:04X}}}-\\x{{{hi:04X}}}]"
        first = F.regexp_instr(t, F.lit(rx))
        found.append(F.struct(F.regexp_count(t, F.lit(rx)).alias("n"), (-first).alias("first"), F.lit(code).alias("code")))
    best = F.array_max(F.array(*found))
    return F.when(best["n"] > 0, best["code"]).otherwise("en")


MEMO = "array<struct<text:string,category:string,n:int>>"


def no_memo() -> Column:
    return F.array().cast(MEMO)


def _memo_with(memo: Column, spans: Column) -> Column:
    """The memo extended by the spans' texts: numbered by category in order of appearance."""

    def step(m: Column, s: Column) -> Column:
        n = F.size(F.filter(m, lambda e: e["category"] == s["category"])) + 1
        return F.when(F.exists(m, lambda e: e["text"] == s["text"]), m).otherwise(F.array_append(m, F.struct(s["text"].alias("text"), s["category"].alias("category"), n.alias("n"))))

    return F.aggregate(spans, memo, step)


def _splice(text: Column, spans: Column, memo: Column) -> Column:
    def token(s: Column) -> Column:
        e = F.filter(memo, lambda e: e["text"] == s["text"])[0]
        return F.concat(F.lit("["), e["category"], F.lit("_"), e["n"].cast("string"), F.lit("]"))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    step = lambda a, s: F.struct(s["end"].alias("pos"), F.concat(a["out"], F.substring(text, a["pos"] + 1, s["start"] - a["pos"]), token(s)).alias("out"))
    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["pos"] + 1, F.length(text))))


def redact_text(text: Column, rules: tuple[Rule, ...] = BUILTIN) -> Column:
    """struct(text, counts): placeholders [CATEGORY_n], the same value the same token."""
    t = F.coalesce(text, F.lit(""))

    def run(x: Column) -> Column:
        memo = _memo_with(no_memo(), x["s"])
        return F.transform(F.array(F.struct(x["t"].alias("t"), x["s"].alias("s"), memo.alias("m"))), lambda y: F.struct(_splice(y["t"], y["s"], y["m"]).alias("text"), _counts(y["m"]).alias("counts")))[0]

    return F.transform(F.array(F.struct(t.alias("t"), resolve(detect_all(t, rules)).alias("s"))), run)[0]


def _counts(memo: Column) -> Column:
    """Distinct values by category."""
    names = F.array_sort(F.array_distinct(F.transform(memo, lambda e: e["category"])))
    return F.map_from_entries(F.transform(names, lambda c: F.struct(c.alias("k"), F.size(F.filter(memo, lambda e: e["category"] == c)).alias("v"))))


def leaks(text: Column, rules: tuple[Rule, ...] = BUILTIN) -> Column:
    """What the rules still find once placeholders are cut out."""
    return detect_all(F.regexp_replace(F.coalesce(text, F.lit("")), MASK, ""), rules)


def _field_texts(e: Column) -> Column:
    """The texts of an event that are redacted, in order: content, arguments, message."""
    args = F.transform(F.coalesce(e["tool_calls"], F.array().cast("array<struct<id:string,name:string,arguments:string>>")), lambda c: F.coalesce(c["arguments"], F.lit("")))
    return F.concat(F.array(F.coalesce(e["content"], F.lit(""))), args, F.array(F.coalesce(e["message"], F.lit(""))))


def _with_texts(e: Column, texts: Column) -> Column:
    """The event with its texts put back; arguments that are no JSON any more are wrapped."""
    wrapped = lambda s: F.when(s == "", F.lit(None)).when(F.try_parse_json(s).isNotNull(), s).otherwise(F.to_json(F.struct(s.alias("_redacted"))))
    made = F.transform(e["tool_calls"], lambda c, i: F.struct(c["id"].alias("id"), c["name"].alias("name"), wrapped(texts[i + 1]).alias("arguments")))
    new = {
        "content": F.when(e["content"].isNull(), e["content"]).otherwise(texts[0]),
        "tool_calls": made,
        "message": F.when(e["message"].isNull(), e["message"]).otherwise(F.element_at(texts, -1)),
    }
    return F.struct(*[new.get(f, e[f]).alias(f) for f in EVENT_FIELDS])


def redact_trajectories(trajectories: DataFrame, rules: tuple[Rule, ...] = BUILTIN) -> DataFrame:
    """Events redacted with one memo per trajectory; adds pii_redacted, pii_counts, pii_leak_count, pii_leak_categories, leaks."""
    rows = trajectories.withColumn("_texts", F.transform("events", _field_texts))
    rows = once(rows, "_spans", F.transform("_texts", lambda ts: F.transform(ts, lambda t: resolve(detect_all(t, rules)))))
    rows = rows.withColumn("_memo", _memo_with(no_memo(), F.flatten(F.flatten("_spans"))))
    spliced = F.zip_with("_texts", "_spans", lambda ts, ss: F.zip_with(ts, ss, lambda t, s: F.when(F.size(s) > 0, _splice(t, s, F.col("_memo"))).otherwise(t)))
    rows = once(rows, "_new", spliced)
    rows = rows.withColumn("events", F.zip_with("events", "_new", _with_texts).cast(f"array<{EVENT}>"))
    rows = once(rows, "leaks", F.flatten(F.flatten(F.transform("_new", lambda ts: F.transform(ts, lambda t: leaks(t, rules))))))
    rows = rows.withColumns(
        {
            "pii_redacted": F.size("_memo") > 0,
            "pii_counts": _counts(F.col("_memo")),
            "pii_leak_count": F.size("leaks"),
            "pii_leak_categories": F.array_sort(F.array_distinct(F.transform("leaks", lambda s: s["category"]))),
        }
    )
    return rows.drop("_texts", "_spans", "_memo", "_new")


def route(redacted: DataFrame, fail_on_leak: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) rows; with fail_on_leak a leak raises when the clean rows are read."""
    clean = redacted.where("pii_leak_count = 0")
    if fail_on_leak:
        clean = redacted.where(F.assert_true(F.col("pii_leak_count") == 0, F.lit("PII left after redaction")).isNull())
    return clean, redacted.where("pii_leak_count > 0")


def category_totals(redacted: DataFrame) -> DataFrame:
    return redacted.select(F.explode("pii_counts").alias("category", "n")).groupBy("category").agg(F.sum("n").cast("long").alias("n"))


def audit_sample(df: DataFrame, key: str, rate: float, seed: int = 0, cap: int | None = None) -> DataFrame:
    """Rows whose seeded hash falls below the rate; `cap` keeps the smallest hashes (a top-k, no order dependence)."""
    h = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), 1, 16)
    limit = min(int(rate * 2**64), 2**64 - 1)
    rows = df.withColumn("audit_hash", h).where(F.col("audit_hash") < F.lit(f"{limit:016x}"))
    return rows if cap is None else rows.orderBy("audit_hash", key).limit(cap)


def audit_summary(sample: DataFrame) -> DataFrame:
    """One row on redacted rows drawn for audit: audit_total, category_counts (by name), categories_seen, n_with_leaks."""
    totals = category_totals(sample).agg(F.array_sort(F.collect_list(F.struct("category", "n"))).alias("category_counts"))
    whole = sample.agg(F.count("*").alias("audit_total"), F.count_if(F.col("pii_leak_count") > 0).alias("n_with_leaks"))
    return whole.crossJoin(totals).withColumn("categories_seen", F.transform("category_counts", lambda c: c["category"]))  # one row each


def coverage(samples: DataFrame) -> DataFrame:
    """samples(sample_id, text, expected array) -> recall of expected categories: general rules alone, all engines."""
    cats = lambda s: F.array_distinct(F.transform(s, lambda x: x["category"]))
    rows = samples.withColumns({"base": cats(resolve(detect_all(F.col("text")))), "full": cats(orchestrated(F.col("text")))})
    share = lambda c: F.when(F.size("expected") > 0, F.size(F.array_intersect(c, "expected")) / F.size("expected")).otherwise(1.0)
    return rows.select("sample_id", "expected", "base", "full", share("base").alias("base_recall"), share("full").alias("full_recall"))
