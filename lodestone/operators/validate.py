"""Consistency checks of tool calls against a registry and against results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.plans.schema import exploded

# fixed values: what an assistant says after success and after failure
SUCCESS = ("successfully", "i was able to", "the answer is", "here is", "here are", "i found", "i retrieved", "got the")
FAILURE = ("i couldn't", "i could not", "failed", "error", "unable to", "no results", "didn't work", "something went wrong", "let me try", "try again")
ISSUE = ["session_id", "severity", "code", "event_pos", "detail"]
# fixed values: JSON types of a property against the type of a value
TYPE_CLASS = {"string": "string", "number": "number", "integer": "integer", "boolean": "boolean", "object": "object", "array": "array", "null": "null"}


def registry_frame(spark, registry: dict) -> DataFrame:
    """{tool: {required: [...], properties: {field: type}}} -> (tool, required, properties)."""
    rows = [(t, list(s.get("required") or []), {k: (v.get("type", "") if isinstance(v, dict) else str(v)) for k, v in (s.get("properties") or {}).items()}) for t, s in sorted(registry.items())]
    return spark.createDataFrame(rows, "tool string, required array<string>, properties map<string,string>")


def json_class(variant: Column) -> Column:
    """JSON type of a variant: string, integer, number, boolean, object, array or null."""
    t = F.upper(F.schema_of_variant(variant))
    return (
        F.when(variant.isNull() | t.isin("VOID", "NULL"), "null")
        .when(t.startswith("STRING"), "string")
        .when(t.startswith("BOOLEAN"), "boolean")
        .when(t.startswith("BIGINT"), "integer")
        .when(t.startswith("DECIMAL") | t.startswith("DOUBLE") | t.startswith("FLOAT"), "number")
        .when(t.startswith("ARRAY"), "array")
        .otherwise("object")
    )


def type_matches(expected: Column, got: Column) -> Column:
    """Whether a value of JSON type `got` passes; unknown expectations pass, integers are numbers."""
    known = expected.isin(*TYPE_CLASS)
    return ~known | (expected == got) | ((expected == "number") & (got == "integer"))


def calls_and_results(trajectories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flat calls (session_id, pos, idx, id, name, arguments) and results (session_id, pos, id, name, is_error, content)."""
    flat = exploded(trajectories)
    calls = flat.where("kind = 'tool_call'").select("session_id", "pos", F.posexplode("tool_calls").alias("idx", "c")).select("session_id", "pos", "idx", "c.*")
    results = flat.where("kind = 'tool_result'").select("session_id", "pos", F.col("tool_call_id").alias("id"), "name", F.coalesce("is_error", F.lit(False)).alias("is_error"), "content")
    return calls, results


def _issue(df: DataFrame, severity: str, code: str, pos: Column, detail: Column) -> DataFrame:
    return df.select("session_id", F.lit(severity).alias("severity"), F.lit(code).alias("code"), pos.cast("long").alias("event_pos"), detail.cast("string").alias("detail"))


def unknown_tools(calls: DataFrame, registry: DataFrame) -> DataFrame:
    """UNKNOWN_TOOL; a registry without tools checks nothing."""
    some = registry.limit(1).select(F.lit(1).alias("_r"))
    lost = calls.join(registry, calls["name"] == registry["tool"], "left_anti").crossJoin(F.broadcast(some))
    return _issue(lost, "error", "UNKNOWN_TOOL", F.col("pos"), F.col("name"))


def arg_schema(calls: DataFrame, registry: DataFrame) -> DataFrame:
    """ARG_SCHEMA: each missing required field, each present field of another type."""
    v = F.coalesce(F.try_parse_json("arguments"), F.parse_json(F.lit("{}")))
    keys = F.coalesce(F.json_object_keys("arguments"), F.array().cast("array<string>"))
    known = calls.join(registry, calls["name"] == registry["tool"]).withColumns({"_v": v, "_keys": keys})
    missing = known.select("session_id", "pos", F.explode(F.array_except("required", "_keys")).alias("f"))
    fields = known.select("session_id", "pos", "_v", "_keys", F.explode("properties").alias("f", "want")).where(F.array_contains("_keys", F.col("f")))
    value = F.expr("try_variant_get(_v, concat('$[\"', f, '\"]'), 'variant')")
    wrong = fields.withColumn("got", json_class(value)).where(~type_matches(F.col("want"), F.col("got")))
    return _issue(missing, "error", "ARG_SCHEMA", F.col("pos"), F.concat(F.lit("missing "), F.col("f"))).unionByName(
        _issue(wrong, "error", "ARG_SCHEMA", F.col("pos"), F.concat(F.col("f"), F.lit(": expected "), F.col("want"), F.lit(", got "), F.col("got")))
    )


def dangling_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """DANGLING_RESULT: no call of that id before the result."""
    first = calls.groupBy("session_id", "id").agg(F.min("pos").alias("call_pos"))
    lost = results.join(first, ["session_id", "id"], "left").where("call_pos IS NULL OR call_pos > pos")
    return _issue(lost, "error", "DANGLING_RESULT", F.col("pos"), F.col("id"))


def name_mismatches(calls: DataFrame, results: DataFrame) -> DataFrame:
    """NAME_MISMATCH: the result's name is not that of the latest earlier call of its id."""
    c = calls.select("session_id", "id", F.col("pos").alias("call_pos"), F.col("idx").alias("call_idx"), F.col("name").alias("call_name"))
    met = results.join(c, ["session_id", "id"]).where("call_pos <= pos")
    last = met.groupBy("session_id", "id", "pos", "name").agg(F.max_by("call_name", F.struct("call_pos", "call_idx")).alias("call_name"))
    return _issue(last.where("name <> call_name"), "warning", "NAME_MISMATCH", F.col("pos"), F.concat_ws("/", "call_name", "name"))


def unresolved_calls(calls: DataFrame, results: DataFrame) -> DataFrame:
    """UNRESOLVED_CALL: a call id that no result answers, anywhere."""
    lost = calls.select("session_id", "id").distinct().join(results.select("session_id", "id"), ["session_id", "id"], "left_anti")
    return _issue(lost, "warning", "UNRESOLVED_CALL", F.lit(None), F.col("id"))


def contradictions(trajectories: DataFrame) -> DataFrame:
    """OBSERVATION_CONTRADICTION: the first assistant turn after a result claims the opposite of it."""
    flat = exploded(trajectories)
    w = W.partitionBy("session_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    last = lambda c, cond: F.last(F.when(cond, c), ignorenulls=True).over(w)
    rows = flat.select(
        "session_id",
        "pos",
        "kind",
        F.lower(F.coalesce("content", F.lit(""))).alias("said"),
        last(F.col("pos"), F.col("kind") == "tool_result").alias("result_pos"),
        last(F.coalesce("is_error", F.lit(False)), F.col("kind") == "tool_result").alias("failed"),
        last(F.col("pos"), F.col("kind") == "assistant").alias("before"),
    ).where("kind = 'assistant' AND result_pos IS NOT NULL AND result_pos > coalesce(before, -1)")
    any_of = lambda phrases: F.rlike(F.col("said"), F.lit("|".join(phrases)))
    rows = rows.withColumns({"good": any_of(SUCCESS), "bad": any_of(FAILURE)})
    found = rows.where("(failed AND good AND NOT bad) OR (NOT failed AND bad AND NOT good)")
    return _issue(found, "warning", "OBSERVATION_CONTRADICTION", F.col("pos"), F.when(F.col("failed"), "claims success").otherwise("claims failure"))


def validate(trajectories: DataFrame, registry: DataFrame) -> DataFrame:
    """All issues, one row each."""
    calls, results = calls_and_results(trajectories)
    parts = [unknown_tools(calls, registry), arg_schema(calls, registry), dangling_results(calls, results), name_mismatches(calls, results), unresolved_calls(calls, results), contradictions(trajectories)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def histogram(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity", "code").agg(F.count("*").alias("n"))


def without_errors(trajectories: DataFrame, issues: DataFrame) -> DataFrame:
    return trajectories.join(issues.where("severity = 'error'").select("session_id").distinct(), "session_id", "left_anti")
