"""Teacher against student: tool-use metrics, text overlap, the replacement rubric."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.validate import json_class, type_matches

METRICS = ("tool_name_accuracy", "arg_exact_match", "arg_field_recall", "schema_validity", "text_f1")
RUBRIC = ("tool_call_validity_rate", "trajectory_success_rate", "persona_adherence_rate")
CALLS = "array<struct<name:string,arguments:string>>"


@dataclass(frozen=True)
class Thresholds:
    # fixed values: the rubric's floors and limits
    quality_ratio_floor: float = 0.95
    latency_p95_target_ms: float = 4000.0
    context_window_min: int = 32_000
    smaller_params_required: bool = True


def canonical_json(text: Column) -> Column:
    """Key-sorted JSON; {} for null or what is no JSON."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), F.lit("{}"))


def calls_or_none(calls: Column) -> Column:
    return F.coalesce(calls, F.array().cast(CALLS))


def names_equal(pred: Column, gold: Column) -> Column:
    names = lambda c: F.array_sort(F.transform(calls_or_none(c), lambda x: F.coalesce(x["name"], F.lit(""))))
    return names(pred) == names(gold)


def args_equal(pred: Column, gold: Column) -> Column:
    """Same non-zero number of calls, equal pairwise once sorted."""
    flat = lambda c: F.array_sort(F.transform(calls_or_none(c), lambda x: F.concat_ws("\u0001", F.coalesce(x["name"], F.lit("")), canonical_json(x["arguments"]))))
    return (F.size(calls_or_none(gold)) > 0) & (flat(pred) == flat(gold))


def field_recall(pred: Column, gold: Column) -> Column:
    keys = lambda c: F.array_distinct(F.flatten(F.transform(calls_or_none(c), lambda x: F.coalesce(F.json_object_keys(x["arguments"]), F.array().cast("array<string>")))))
    g = keys(gold)
    return F.when(F.size(g) > 0, F.size(F.array_intersect(g, keys(pred))) / F.size(g)).otherwise(F.lit(1.0))


def text_f1(a: Column, b: Column) -> Column:
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"\s+"), lambda w: w != ""))
    x, y = words(a), words(b)
    n = F.size(F.array_intersect(x, y))
    p, r = n / F.size(x), n / F.size(y)
    return F.when((F.size(x) > 0) & (F.size(y) > 0) & (n > 0), 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def valid_calls(calls: Column, registry: dict | None) -> Column:
    """Number of calls whose arguments fit the registry; all of them without one."""
    c = calls_or_none(calls)
    if registry is None:
        return F.size(c)
    good = F.filter(c, lambda x: _fits(x, registry))
    return F.size(good)


def _fits(call: Column, registry: dict) -> Column:
    v = F.coalesce(F.try_parse_json(call["arguments"]), F.parse_json(F.lit("{}")))
    keys = F.coalesce(F.json_object_keys(call["arguments"]), F.array().cast("array<string>"))
    out = F.lit(False)
    for tool, spec in sorted(registry.items()):
        good = call["name"] == tool
        for f in spec.get("required") or []:
            good = good & F.array_contains(keys, f)
        for f, kind in (spec.get("properties") or {}).items():
            want = kind.get("type", "") if isinstance(kind, dict) else str(kind)
            got = json_class(F.try_variant_get(v, f'$["{f}"]', "variant"))
            good = good & (~F.array_contains(keys, f) | type_matches(F.lit(want), got))
        out = out | good
    return out


def last_outputs(outputs: DataFrame, order: str | None = None) -> DataFrame:
    """One row per prompt_id: the last by `order` (any, without one)."""
    rows = outputs.where("prompt_id IS NOT NULL")
    rest = F.struct(*[c for c in outputs.columns if c != "prompt_id"])
    pick = F.max_by(rest, F.col(order)) if order else F.first(rest)
    return rows.groupBy("prompt_id").agg(pick.alias("o"))


def scored(suite: DataFrame, outputs: DataFrame, order: str | None = None, registry: dict | None = None) -> DataFrame:
    """Suite rows that have an output, with the per-row metrics."""
    o = last_outputs(outputs, order)
    rows = suite.join(o, "prompt_id")
    pred, gold = F.col("o.tool_calls"), F.col("gold_tool_calls")
    return rows.withColumns(
        {
            "m_name": names_equal(pred, gold).cast("double"),
            "m_args": args_equal(pred, gold).cast("double"),
            "m_fields": field_recall(pred, gold),
            "n_calls": F.size(calls_or_none(pred)),
            "n_valid": valid_calls(pred, registry),
            "m_text": text_f1(F.col("o.text"), F.col("gold_text")),
        }
    )


def tool_use(rows: DataFrame, *by: str) -> DataFrame:
    """Mean metrics of scored rows; schema validity is over calls, 1 without any."""
    return rows.groupBy(*by).agg(
        F.avg("m_name").alias("tool_name_accuracy"),
        F.avg("m_args").alias("arg_exact_match"),
        F.avg("m_fields").alias("arg_field_recall"),
        F.coalesce(F.sum("n_valid") / F.nullif(F.sum("n_calls"), F.lit(0)), F.lit(1.0)).alias("schema_validity"),
        F.avg("m_text").alias("text_f1"),
        F.count("*").alias("n"),
    )


def compare_outputs(suite: DataFrame, student: DataFrame, teacher: DataFrame, order: str | None = None, gate: float = 0.05) -> DataFrame:
    """metric, teacher, student, delta, regressed (student more than `gate` below)."""
    both = scored(suite, student, order).withColumn("who", F.lit("student")).unionByName(scored(suite, teacher, order).withColumn("who", F.lit("teacher")))
    means = tool_use(both, "who")
    long = means.select("who", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])).alias("m")).select("who", "m.*")
    side = lambda w: F.coalesce(F.max(F.when(F.col("who") == w, F.col("value"))), F.lit(0.0))
    out = long.groupBy("metric").agg(side("teacher").alias("teacher"), side("student").alias("student"))
    return out.withColumn("delta", F.col("student") - F.col("teacher")).withColumn("regressed", F.col("delta") < -gate)


def percentile(value: Column, q: float) -> Column:
    """Exact, with linear interpolation at q (n - 1)."""
    return F.percentile(value, q)


def by_category(suite: DataFrame, student: DataFrame, teacher: DataFrame, order: str | None = None, registry: dict | None = None) -> DataFrame:
    """category, n_prompts, and per side validity, success, persona and p95 latency."""
    base = suite.withColumn("category", F.coalesce(F.nullif("edge_case_category", F.lit("")), F.lit("other")))
    counts = base.groupBy("category").agg(F.count("*").alias("n_prompts"))
    out = counts
    for who, outputs in (("teacher", teacher), ("student", student)):
        rows = scored(base, outputs, order, registry)
        part = rows.groupBy(F.col("category").alias(f"{who}_cat")).agg(
            F.coalesce(F.sum("n_valid") / F.nullif(F.sum("n_calls"), F.lit(0)), F.lit(1.0)).alias(f"{who}_{RUBRIC[0]}"),
            F.avg(F.coalesce("o.success", "gold_success", F.lit(1.0))).alias(f"{who}_{RUBRIC[1]}"),
            F.avg(F.coalesce("o.persona_score", F.lit(1.0))).alias(f"{who}_{RUBRIC[2]}"),
            percentile(F.coalesce("o.latency_ms", F.lit(0.0)), 0.95).alias(f"{who}_latency_p95_ms"),
        )
        out = out.join(part, out["category"] == part[f"{who}_cat"], "left").drop(f"{who}_cat")
    zero = {f"{w}_{m}": 0.0 for w in ("teacher", "student") for m in (*RUBRIC, "latency_p95_ms")}
    return out.fillna(zero)


def with_reasons(categories: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Adds `reasons`: metric names that fail, prefixed by the category."""
    checks = []
    for m in RUBRIC:
        t, s = F.col(f"teacher_{m}"), F.col(f"student_{m}")
        checks.append(F.when((t > 0) & (s / t < limits.quality_ratio_floor), F.concat_ws("/", "category", F.lit(m))))
    t, s = F.col("teacher_latency_p95_ms"), F.col("student_latency_p95_ms")
    checks.append(F.when((s > 0) & (t > 0) & (s >= t), F.concat_ws("/", "category", F.lit("latency_not_below_teacher"))))
    checks.append(F.when(s > limits.latency_p95_target_ms, F.concat_ws("/", "category", F.lit("latency_over_budget"))))
    return categories.withColumn("reasons", F.array_compact(F.array(*checks)))


def verdict(categories: DataFrame, limits: Thresholds = Thresholds(), teacher_params: int | None = None, student_params: int | None = None, student_context: int | None = None) -> DataFrame:
    """One row: accepted, reasons (sorted, joined by newlines)."""
    own = []
    if limits.smaller_params_required and teacher_params and student_params and student_params >= teacher_params:
        own.append("params")
    if student_context is not None and student_context < limits.context_window_min:
        own.append("context_window")
    found = with_reasons(categories, limits).agg(F.flatten(F.collect_list("reasons")).alias("r"))
    every = F.array_sort(F.concat("r", F.array(*[F.lit(x) for x in own]).cast("array<string>")))
    return found.select((F.size(every) == 0).alias("accepted"), F.array_join(every, "\n").alias("reasons"))
