"""Synthetic trajectories: stub model, mock tools with failure injection, the two-step loop.

With the stub the loop ends after one call and one answer, so it unrolls into
columns.  Real models plug in through generate_with(): per step one pass of the
model over the rows that are not finished; everything else stays in columns.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import session
from lodestone.plans.schema import VERSION, event
from lodestone.sources.adapters import get

# fixed values: keywords in order, with the tool that each asks for
KEYWORDS = (
    ("moisture", "soil_sensor"),
    ("soil", "soil_sensor"),
    ("irrigat", "soil_sensor"),
    ("weather", "weather_forecast"),
    ("rain", "weather_forecast"),
    ("forecast", "weather_forecast"),
    ("price", "mandi_price"),
    ("mandi", "mandi_price"),
    ("market", "mandi_price"),
    ("pest", "pest_reports"),
)
# fixed values: default arguments
DEFAULT_ARGS = {
    "soil_sensor": {"lat": 12.97, "lng": 77.59},
    "weather_forecast": {"lat": 12.97, "lng": 77.59, "days": 3},
    "mandi_price": {"commodity": "tomato", "market": "Bengaluru"},
    "pest_reports": {"district": "Mysuru", "days": 7},
}
# fixed values: answers of the stub
FINAL_PREFIX = "Based on the tool results, here is what I found. ("
NO_TOOL = "I don't have a tool for that — answering from memory."
# fixed values: failure modes
MODES = ("TIMEOUT", "INVALID_ARGS", "NO_RESULTS", "RATE_LIMITED", "PARTIAL_DATA")
MAX_STEPS = 5


def registry_tools(registry: dict) -> list[dict]:
    """The registry as tool descriptions."""
    out = []
    for name, spec in sorted(registry.items()):
        props = {k: (v if isinstance(v, dict) else {"type": v}) for k, v in (spec.get("properties") or {}).items()}
        out.append({"name": name, "parameters": {"type": "object", "properties": props, "required": list(spec.get("required") or [])}})
    return out


def choose_tool(query: Column, registry: dict | None) -> Column:
    """First keyword whose tool is registered, else the first tool by name; null without tools."""
    low = F.lower(F.coalesce(query, F.lit("")))
    chain = None
    for word, tool in KEYWORDS:
        if registry and tool not in registry:
            continue
        hit = F.contains(low, F.lit(word))
        chain = F.when(hit, tool) if chain is None else chain.when(hit, tool)
    rest = F.lit(sorted(registry)[0] if registry else None).cast("string")
    return rest if chain is None else chain.otherwise(rest)


def default_args(tool: Column) -> Column:
    """Default arguments of a tool as JSON text."""
    out = None
    for name, args in DEFAULT_ARGS.items():
        text = json.dumps(args, sort_keys=True, separators=(",", ":"))
        out = F.when(tool == name, text) if out is None else out.when(tool == name, text)
    return out.otherwise("{}")


def final_text(observation: Column) -> Column:
    return F.concat(F.lit(FINAL_PREFIX), F.left(observation, F.lit(120)), F.lit(")"))


def parse_response(text: Column) -> Column:
    """struct(name, arguments, final) of a model's answer: JSON, else the balanced object around "tool_call" or "final", else the text."""
    v = F.try_parse_json(text)
    known = get(v, "$.tool_call", "variant").isNotNull() | get(v, "$.final", "variant").isNotNull()
    return F.when(known, _response(v, text)).otherwise(F.when(F.rlike(text, F.lit('"(tool_call|final)"')), _response(F.try_parse_json(balanced(text)), text)).otherwise(_response(F.lit(None).cast("variant"), text)))


def _response(v: Column, text: Column) -> Column:
    name = get(v, "$.tool_call.name")
    args = F.coalesce(F.to_json(get(v, "$.tool_call.arguments", "variant")), F.lit("{}"))
    final = F.when(name.isNull(), F.coalesce(get(v, "$.final"), text))
    return F.struct(name.alias("name"), F.when(name.isNotNull(), args).alias("arguments"), final.alias("final"))


def balanced(text: Column) -> Column:
    """The balanced {...} that holds "tool_call", else the one that holds "final" (Arrow UDF)."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def find(s: pd.Series) -> pd.Series:
        return s.map(find_balanced)

    return find(text)


def find_balanced(text: str | None) -> str | None:
    for key in ('"tool_call"', '"final"'):
        at = (text or "").find(key)
        while at >= 0:
            start = text.rfind("{", 0, at)
            while start >= 0:
                depth, quoted, skip = 0, False, False
                for i in range(start, len(text)):
                    ch = text[i]
                    if skip:
                        skip = False
                    elif ch == "\\":
                        skip = quoted
                    elif ch == '"':
                        quoted = not quoted
                    elif not quoted and ch in "{}":
                        depth += 1 if ch == "{" else -1
                        if not depth:
                            if i > at:
                                return text[start : i + 1]
                            break
                start = text.rfind("{", 0, start)
            at = text.find(key, at + 1)
    return None


def payload(mode: Column, tool: Column, args: Column) -> Column:
    """Content of an injected failure."""
    text = lambda *fields: F.to_json(F.struct(*fields))
    return (
        F.when(mode == "TIMEOUT", text(F.lit("timeout").alias("error"), F.concat(tool, F.lit(" did not return within budget")).alias("message")))
        .when(mode == "INVALID_ARGS", text(F.lit("invalid_arguments").alias("error"), F.concat(F.lit("argument schema rejected by "), tool).alias("message"), F.try_parse_json(args).alias("received")))
        .when(mode == "NO_RESULTS", F.lit('{"results": [], "count": 0}'))
        .when(mode == "RATE_LIMITED", F.lit('{"error": "rate_limited", "message": "request throttled", "retry_after_seconds": 5}'))
        .when(mode == "PARTIAL_DATA", text(F.lit(True).alias("partial"), F.json_object_keys(args).alias("fields_present")))
    )


def injected_mode(tool: Column, args: Column, call_index: Column, config: dict[str, dict[str, float]], seed: int = 0) -> Column:
    """The failure mode of a call, or null: each mode in order has its own draw from a hash of seed, tool, arguments and index."""
    out = F.lit(None).cast("string")
    for name, modes in config.items():
        chain = None
        for mode, share in modes.items():
            if share <= 0:
                continue
            h = F.substring(F.sha2(F.concat_ws("::", F.lit(str(seed)), tool, args, call_index.cast("string"), F.lit(mode)), 256), 1, 15)
            hit = h < F.lit(f"{min(int(share * 16**15), 16**15 - 1):015x}") if share < 1 else F.lit(True)
            chain = F.when(hit, mode) if chain is None else chain.when(hit, mode)
        if chain is not None:
            out = F.when(tool == name, chain).otherwise(out)
    return out


def call_tools(calls: DataFrame, registry: dict | None = None, config: dict | None = None, fixtures: DataFrame | None = None, hook=None, seed: int = 0) -> DataFrame:
    """Adds content, is_error, failure_mode to calls (tool, arguments, call_index).

    Order: unknown tool, argument schema, injected failure, fixture, hook, echo.
    fixtures: (f_tool, f_arguments or null for the default, f_content).
    hook: columns (tool, arguments) -> content column.
    """
    from lodestone.operators.evaluate import _fits

    tool, args = F.col("tool"), F.col("arguments")
    bad = F.lit(False)
    if registry is not None:
        bad = ~_fits(F.struct(tool.alias("name"), args.alias("arguments")), registry)
    mode = F.when(bad, "INVALID_ARGS").otherwise(injected_mode(tool, args, F.col("call_index"), config or {}, seed))
    rows = calls.withColumn("failure_mode", mode)
    given = F.lit(None).cast("string")
    if fixtures is not None:
        exact = fixtures.where("f_arguments IS NOT NULL")
        rest = fixtures.where("f_arguments IS NULL").select(F.col("f_tool").alias("d_tool"), F.col("f_content").alias("d_content"))
        rows = rows.join(exact, (rows["tool"] == exact["f_tool"]) & (rows["arguments"] == exact["f_arguments"]), "left").join(rest, F.col("tool") == F.col("d_tool"), "left")
        given = F.coalesce("f_content", "d_content")
    made = hook(tool, args) if hook else F.to_json(F.struct(tool.alias("tool"), F.try_parse_json(args).alias("args"), F.lit(True).alias("stub")))
    content = F.coalesce(payload(F.col("failure_mode"), tool, args), given, made)
    return rows.select(*calls.columns, content.alias("content"), F.col("failure_mode").isNotNull().alias("is_error"), "failure_mode")


def generate(seeds: DataFrame, registry: dict, start: Column, config: dict | None = None, drop_invalid: bool = True, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(trajectories, dropped seeds) by the stub: question, call, result, answer, one second apart.

    seeds: query, and seed_id and domain if there are any.
    """
    from lodestone.operators.evaluate import _fits

    cols = seeds.columns
    sid = F.col("seed_id") if "seed_id" in cols else F.lit(None).cast("string")
    rows = seeds.withColumn("_tool", choose_tool(F.col("query"), registry))
    rows = rows.withColumns({"tool": F.col("_tool"), "arguments": default_args(F.col("_tool")), "call_index": F.lit(0)})
    bad = F.col("tool").isNotNull() & ~_fits(F.struct(F.col("tool").alias("name"), F.col("arguments")), registry)
    rows = rows.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    dropped = rows.where("_bad").select(*cols) if drop_invalid else rows.limit(0).select(*cols)
    kept = call_tools(rows.where("NOT _bad") if drop_invalid else rows, None, config, seed=seed)
    at = lambda s: start + F.make_dt_interval(secs=F.lit(s))
    call = F.struct(F.lit("call_0").alias("id"), F.col("tool").alias("name"), F.col("arguments"))
    lineage = sid
    with_tool = F.array(
        event(kind="user", role="user", event_id="u0", timestamp=at(0), content=F.col("query"), lineage_id=lineage),
        event(kind="tool_call", role="assistant", event_id="tc0", timestamp=at(1), tool_calls=F.array(call), lineage_id=lineage),
        event(kind="tool_result", role="tool", event_id="tr0", timestamp=at(2), tool_call_id="call_0", name=F.col("tool"), content=F.col("content"), is_error=F.col("is_error"), lineage_id=lineage, metadata=F.to_json(F.struct("failure_mode"))),
        event(kind="assistant", role="assistant", event_id="a1", timestamp=at(3), content=final_text(F.col("content")), finish_reason="stop", lineage_id=lineage),
    )
    without = F.array(
        event(kind="user", role="user", event_id="u0", timestamp=at(0), content=F.col("query"), lineage_id=lineage),
        event(kind="assistant", role="assistant", event_id="a0", timestamp=at(1), content=F.lit(NO_TOOL), finish_reason="stop", lineage_id=lineage),
    )
    tags = F.to_json(F.struct(F.struct(sid.alias("seed_id"), F.when(F.col("tool").isNull(), 1).otherwise(2).alias("n_steps"), F.lit("final").alias("finish_reason")).alias("synthetic")))
    name = F.concat(F.lit("syn_"), F.substring(F.sha2(F.coalesce(sid, F.col("query")), 256), 1, 16))
    made = kept.select(
        name.alias("session_id"), F.lit("synthetic").alias("source"), (F.col("domain") if "domain" in cols else F.lit(None).cast("string")).alias("domain"),
        F.lit(VERSION).alias("schema_version"), lineage.alias("lineage_id"), tags.alias("tags"), F.when(F.col("tool").isNull(), without).otherwise(with_tool).alias("events"),
    )
    return made, dropped


def rounds(state: DataFrame, step: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], max_steps: int = MAX_STEPS, checkpoint=None) -> DataFrame:
    """Run `step` (a mapInPandas function over the state's own schema, with a boolean `finished`) until all rows are finished or the budget is spent."""
    for _ in range(max_steps):
        open_, done = state.where("NOT finished"), state.where("finished")
        state = done.unionByName(open_.mapInPandas(step, state.schema))
        if checkpoint:
            state = checkpoint(state)
    return state


def generate_with(
    seeds: DataFrame,
    registry: dict,
    start: Column,
    model: Callable[[], Callable[[list[str]], list[str]]],
    max_steps: int = MAX_STEPS,
    config: dict | None = None,
    fixtures: DataFrame | None = None,
    hook=None,
    drop_invalid: bool = True,
    seed: int = 0,
    system: str | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(trajectories, dropped seeds) by a model that proposes calls and sees their results, up to `max_steps` answers a seed.

    model: a factory (called once a worker) of chats, as JSON, -> answers.  An
    answer is {"tool_call": {"name", "arguments"}}, {"final": text}, or plain
    text, which is final.  A seed is dropped if a call is malformed or, with
    drop_invalid, does not fit the registry.  `cut` writes and rereads the rows
    twice a step, so that no answer is asked for twice and plans stay short; by
    default they are checkpointed.
    """
    from lodestone.functions.plugins import backend
    from lodestone.operators.evaluate import _fits

    seeds = session.spread(seeds)
    parts = max(seeds.rdd.getNumPartitions(), seeds.sparkSession.sparkContext.defaultParallelism)
    cols = seeds.columns
    sid = F.col("seed_id") if "seed_id" in cols else F.lit(None).cast("string")
    at = lambda s: start + F.make_dt_interval(secs=s)
    turn = lambda role, content: F.to_json(F.struct(F.lit(role).alias("role"), content.alias("content")))
    asked = event(kind="user", role="user", event_id="u0", timestamp=at(F.lit(0)), content=F.col("query"), lineage_id=sid)
    head = [turn("system", F.lit(system))] if system else []
    rows = seeds.withColumns({"_chat": F.array(*head, turn("user", F.col("query"))), "events": F.array(asked), "_state": F.lit("open"), "_n": F.lit(0)})
    cut = cut or session.cut
    for step in range(max_steps):
        open_ = rows.where("_state = 'open'").withColumn("_prompt", F.concat(F.lit("["), F.array_join("_chat", ","), F.lit("]")))
        said = cut(backend(open_, "_prompt", model, "_raw")).drop("_prompt")
        body = F.regexp_extract("_raw", r"(?s)\{.*\}", 0)
        said = said.withColumns({"_call": F.get_json_object(body, "$.tool_call"), "_final": F.get_json_object(body, "$.final")})
        args = F.coalesce(F.get_json_object("_call", "$.arguments"), F.lit("{}"))
        said = said.withColumns({"tool": F.get_json_object("_call", "$.name"), "arguments": args, "call_index": F.lit(step)})
        malformed = F.col("_call").isNotNull() & (F.coalesce(F.col("tool"), F.lit("")).eqNullSafe("") | ~F.startswith(F.ltrim("arguments"), F.lit("{")))
        unfit = F.col("_call").isNotNull() & ~_fits(F.struct(F.col("tool").alias("name"), F.col("arguments")), registry) if drop_invalid else F.lit(False)
        said = said.withColumn("_bad", F.coalesce(malformed | unfit, F.lit(True)))
        calls_ = call_tools(said.where("_call IS NOT NULL AND NOT _bad"), registry, config, fixtures, hook, seed)
        cid = F.lit(f"call_{step}")
        call = F.struct(cid.alias("id"), F.col("tool").alias("name"), F.col("arguments"))
        meta = F.when(F.col("failure_mode").isNull(), F.lit("{}")).otherwise(F.to_json(F.struct("failure_mode")))
        new = F.array(
            event(kind="tool_call", role="assistant", event_id=f"tc{step}", timestamp=at(F.lit(2 * step + 1)), tool_calls=F.array(call), lineage_id=sid),
            event(kind="tool_result", role="tool", event_id=f"tr{step}", timestamp=at(F.lit(2 * step + 2)), tool_call_id=cid, name=F.col("tool"), content=F.col("content"), is_error=F.col("is_error"), lineage_id=sid, metadata=meta),
        )
        function = F.struct(F.col("tool").alias("name"), F.col("arguments"))
        used = F.to_json(F.struct(F.lit("assistant").alias("role"), F.lit("").alias("content"), F.array(F.struct(cid.alias("id"), F.lit("function").alias("type"), function.alias("function"))).alias("tool_calls")))
        told = F.to_json(F.struct(F.lit("tool").alias("role"), cid.alias("tool_call_id"), F.col("tool").alias("name"), F.col("content")))
        keep = [*cols, "_chat", "events", "_state", "_n"]
        calls_ = calls_.withColumns({"_chat": F.concat("_chat", F.array(used, told)), "events": F.concat("events", new), "_n": F.lit(step + 1)}).select(*keep)
        text = F.trim(F.coalesce(F.nullif("_final", F.lit("")), F.col("_raw"), F.lit("")))
        done = event(kind="assistant", role="assistant", event_id=f"a{step}", timestamp=at(F.lit(2 * step + 1)), content=text, finish_reason="stop", lineage_id=sid)
        ended = said.where("_call IS NULL").withColumns({"events": F.array_append("events", done), "_state": F.lit("final"), "_n": F.lit(step + 1)}).select(*keep)
        lost = said.where("_call IS NOT NULL AND _bad").withColumn("_state", F.lit("dropped")).select(*keep)
        # the union has four times the partitions, step by step
        rows = cut(rows.where("_state <> 'open'").select(*keep).unionByName(calls_).unionByName(ended).unionByName(lost).coalesce(parts))
        if rows.where("_state = 'open'").isEmpty():
            break
    reason = F.when(F.col("_state") == "final", "final").otherwise("max_steps")
    tags = F.to_json(F.struct(F.struct(sid.alias("seed_id"), F.col("_n").alias("n_steps"), reason.alias("finish_reason")).alias("synthetic")))
    name = F.concat(F.lit("syn_"), F.substring(F.sha2(F.coalesce(sid, F.col("query")), 256), 1, 16))
    domain = F.col("domain") if "domain" in cols else F.lit(None).cast("string")
    made = rows.where("_state <> 'dropped'").select(name.alias("session_id"), F.lit("synthetic").alias("source"), domain.alias("domain"), F.lit(VERSION).alias("schema_version"), sid.alias("lineage_id"), tags.alias("tags"), "events")
    return made, rows.where("_state = 'dropped'").select(*cols)
