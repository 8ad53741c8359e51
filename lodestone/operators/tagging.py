"""Trajectory helpers, complexity tags and difficulty (row-local, no shuffle)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.plans.schema import calls, of_kind, texts

# fixed values: ambiguity hints; overlapping hints count each
AMBIGUITY_HINTS = ("?", "could you", "what about", "or maybe", "not sure", "either", "perhaps", "kind of", "sort of", "depending on", "if possible", "i'm not sure")
# fixed values: score weights
WEIGHTS = {"turns": 0.6, "calls": 0.5, "distinct": 0.7, "recovery": 2.0, "errors": 0.4, "ambiguity": 1.5, "dangling": 1.0, "depth": 0.8, "thrashing": 1.5}
# fixed values: upper bounds of the bands
BANDS = (("trivial", 1.0), ("easy", 2.5), ("medium", 4.5), ("hard", 7.0))
LAST_BAND = "extreme"
# fixed values: attack and refusal patterns
JAILBREAK = (
    r"\bignore (all |the )?(previous|above) (instructions|rules)\b",
    r"\b(act as|pretend to be|roleplay as) (?!a (farmer|user))",
    r"\bdo anything now\b",
    r"\bjailbreak\b",
    r"\bbypass (the )?(safety|filter|guardrails?)\b",
    r"\bdeveloper mode\b",
)
REFUSAL = (
    r"\bi (can(?:'|no)t|won't|cannot)\b",
    r"\b(against|outside) (my|the) (policy|guidelines)\b",
    r"\bi'm not able to\b",
    r"\bi must decline\b",
)
INDIC = "[\\x{0900}-\\x{0D7F}]"
AMBIGUOUS_FROM = 0.4


def num_steps(events: Column | str = "events") -> Column:
    return F.size(F.filter(events, lambda e: e["kind"].isin("assistant", "tool_call")))


def tool_set(events: Column | str = "events") -> Column:
    """Distinct tool names in the order they are first called."""
    return F.array_distinct(F.transform(calls(events), lambda c: c["name"]))


def errors(events: Column | str = "events") -> Column:
    """Tool results that are errors."""
    return F.filter(events, lambda e: (e["kind"] == "tool_result") & F.coalesce(e["is_error"], F.lit(False)))


def has_recovery(events: Column | str = "events") -> Column:
    """Whether any tool call follows an error result."""
    ev = F.col(events) if isinstance(events, str) else events
    failed = F.transform(ev, lambda e: (e["kind"] == "tool_result") & F.coalesce(e["is_error"], F.lit(False)))
    first = F.array_position(failed, True)
    later = F.slice(ev, F.greatest(first, F.lit(1)), F.greatest(F.size(ev), F.lit(1)))
    return (first > 0) & F.exists(later, lambda e: e["kind"] == "tool_call")


def fingerprint(events: Column | str = "events") -> Column:
    """SHA-256 over the user turns, stripped and lower-cased, each closed by NUL."""
    turns = F.transform(texts("user", events), lambda t: F.concat(F.lower(F.regexp_replace(t, r"^\s+|\s+$", "")), F.lit("\0")))
    return F.sha2(F.array_join(turns, ""), 256)


def hint_hits(text: Column) -> Column:
    """Occurrences of the ambiguity hints in lower-cased text."""
    total = F.lit(0)
    for h in AMBIGUITY_HINTS:
        total = total + ((F.length(text) - F.length(F.replace(text, F.lit(h), F.lit("")))) / len(h)).cast("int")
    return total


def ambiguity_score(events: Column | str = "events") -> Column:
    text = F.lower(F.array_join(texts("user", events), " "))
    return F.least(F.lit(1.0), F.log1p(hint_hits(text).cast("double")) / math.log1p(5))


def dangling(events: Column | str = "events") -> Column:
    """Ids of results whose call was not made earlier, each once."""
    seen = F.struct(F.array().cast("array<string>").alias("ids"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, e: Column) -> Column:
        made = F.when(e["kind"] == "tool_call", F.transform(e["tool_calls"], lambda c: c["id"])).otherwise(F.array().cast("array<string>"))
        lost = (e["kind"] == "tool_result") & ~F.array_contains(acc["ids"], F.coalesce(e["tool_call_id"], F.lit("")))
        return F.struct(F.concat(acc["ids"], made).alias("ids"), F.when(lost, F.array_append(acc["out"], e["tool_call_id"])).otherwise(acc["out"]).alias("out"))

    return F.array_distinct(F.aggregate(events, seen, step, lambda a: a["out"]))


def repair_depth(events: Column | str = "events") -> Column:
    """Longest run of calls that each retry the tool whose error came just before."""
    ev = F.col(events) if isinstance(events, str) else events
    names = F.transform(calls(ev), lambda c: F.struct(c["id"].alias("id"), c["name"].alias("name")))
    start = F.struct(F.lit(None).cast("string").alias("pending"), F.lit(None).cast("string").alias("tool"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def call(acc: Column, c: Column) -> Column:
        retry = F.coalesce(acc["pending"] == c["name"], F.lit(False))
        run = F.when(~retry, 0).when(acc["tool"].eqNullSafe(c["name"]), acc["run"] + 1).otherwise(1)
        return F.struct(F.lit(None).cast("string").alias("pending"), F.when(retry, c["name"]).alias("tool"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    def step(acc: Column, e: Column) -> Column:
        tool = F.coalesce(F.try_element_at(F.transform(F.filter(names, lambda n: n["id"] == e["tool_call_id"]), lambda n: n["name"]), F.lit(-1)), e["name"])
        seen = F.struct(F.when(F.coalesce(e["is_error"], F.lit(False)), tool).alias("pending"), acc["tool"].alias("tool"), acc["run"].alias("run"), acc["best"].alias("best"))
        return F.when(e["kind"] == "tool_call", F.aggregate(e["tool_calls"], acc, call)).when(e["kind"] == "tool_result", seen).otherwise(acc)

    some = F.exists(ev, lambda e: F.coalesce(e["is_error"], F.lit(False)))
    return F.when(some, F.aggregate(ev, start, step, lambda a: a["best"])).otherwise(F.lit(0))


def band(score: Column) -> Column:
    out = None
    for name, below in BANDS:
        out = F.when(score < below, name) if out is None else out.when(score < below, name)
    return out.otherwise(LAST_BAND)


def complexity(trajectories: DataFrame) -> DataFrame:
    """Adds the complexity columns; complexity_score stays unrounded here."""
    df = trajectories.withColumns(
        {
            "num_user_turns": F.size(of_kind("user")),
            "num_assistant_turns": num_steps(),
            "num_tool_calls": F.size(calls()),
            "distinct_tools": F.size(tool_set()),
            "num_tool_errors": F.size(errors()),
            "has_recovery": has_recovery(),
            "ambiguity_score": ambiguity_score(),
            "num_dangling": F.size(dangling()),
            "repair_depth": repair_depth(),
        }
    )
    w = WEIGHTS
    thrash = F.col("repair_depth") >= 2
    score = (
        F.greatest(F.col("num_user_turns") - 1, F.lit(0)) * w["turns"]
        + F.col("num_tool_calls") * w["calls"]
        + F.col("distinct_tools") * w["distinct"]
        + F.col("has_recovery").cast("int") * w["recovery"]
        + F.col("num_tool_errors") * w["errors"]
        + F.col("ambiguity_score") * w["ambiguity"]
        + F.col("num_dangling") * w["dangling"]
        + F.col("repair_depth") * w["depth"]
        + thrash.cast("int") * w["thrashing"]
    )
    return df.withColumns({"thrashing": thrash, "complexity_score": score}).withColumn("complexity_band", band(F.col("complexity_score")))


def band_counts(trajectories: DataFrame) -> DataFrame:
    return complexity(trajectories).groupBy("complexity_band").agg(F.count("*").alias("n"))


def tier() -> Column:
    """Difficulty tier from the complexity columns."""
    c = F.col
    hard = (c("num_tool_errors") >= 2) | (c("has_recovery") & (c("num_tool_calls") >= 3)) | (c("distinct_tools") >= 3) | (c("complexity_score") >= 6.5)
    medium = (c("num_tool_calls") >= 2) | c("has_recovery") | (c("complexity_score") >= 3.0) | (c("distinct_tools") >= 2)
    return F.when(hard, "hard").when(medium, "medium").otherwise("easy")


def _any(text: Column, patterns: tuple[str, ...]) -> Column:
    return F.rlike(text, F.lit("(?i)" + "|".join(f"(?:{p})" for p in patterns)))


def edge_cases() -> Column:
    """Sorted names of the edge cases that hold; needs the complexity columns."""
    c = F.col
    n_events = F.size(of_kind("tool_call"))
    user, said = F.array_join(texts("user"), " "), F.array_join(texts("assistant"), " ")
    some = user != ""
    flags = {
        "ambiguous_query": some & (c("ambiguity_score") >= AMBIGUOUS_FROM),
        "jailbreak_refusal": some & _any(user, JAILBREAK) & _any(said, REFUSAL),
        "multi_tool": c("distinct_tools") >= 2,
        "multilingual": some & F.rlike(user, F.lit(INDIC)),
        "pure_qa": n_events == 0,
        "single_tool": (n_events > 0) & (c("distinct_tools") <= 1),
        "tool_failure_recovery": c("has_recovery") | (c("num_tool_errors") >= 1),
    }
    return F.array_compact(F.array(*[F.when(v, k) for k, v in sorted(flags.items())]))


def difficulty(trajectories: DataFrame) -> DataFrame:
    """Complexity columns, tier, edge_cases and the score rounded to three places."""
    return complexity(trajectories).withColumns({"tier": tier(), "edge_cases": edge_cases(), "difficulty_score": F.bround("complexity_score", 3)})


def cap_per_bucket(assessed: DataFrame, cap: int | None, order: list[Column | str]) -> DataFrame:
    """The first `cap` rows of each (tier, edge cases) bucket by `order`; None or a negative cap keeps all."""
    if cap is None or cap < 0:
        return assessed
    if cap == 0:
        return assessed.limit(0)
    rank = F.row_number().over(W.partitionBy("tier", F.array_join("edge_cases", ",")).orderBy(*order))
    return assessed.withColumn("_rank", rank).where(F.col("_rank") <= cap).drop("_rank")
