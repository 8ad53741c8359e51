"""Raw chat records to canonical trajectories.

Each adapter is a column expression over the VARIANT record that yields the
event array; detection chooses per row.  Rows that fail keep their record and
an error and go to the quarantine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.plans.schema import CALL, EVENT, VERSION, event, no_events, once

_ADAPTERS: dict[str, Callable[[Column, Column], Column]] = {}


def register_source(name: str):
    """Register an adapter: (record, base timestamp) columns -> events column."""

    def add(fn):
        _ADAPTERS[name] = fn
        return fn

    return add


def get_source(name: str):
    if name not in _ADAPTERS:
        raise KeyError(f"unknown source {name!r}; known: {known_sources()}")
    return _ADAPTERS[name]


def known_sources() -> list[str]:
    return sorted(_ADAPTERS)


def get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def text_of(v: Column, path: str) -> Column:
    """A value as text; objects and arrays as JSON, null as null."""
    return F.coalesce(get(v, path), F.nullif(F.to_json(get(v, path, "variant")), F.lit("null")))


def is_array(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))


def items(v: Column, path: str) -> Column:
    """Array elements as variants; empty if there is no array."""
    return F.coalesce(get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def messages(raw: Column) -> Column:
    """The messages that are objects."""
    return F.filter(items(raw, "$.messages"), lambda m: F.coalesce(F.schema_of_variant(m).startswith("OBJECT"), F.lit(False)))


def first_true(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def stamp(v: Column, default: Column) -> Column:
    """timestamp, created_at or time: seconds since the epoch or ISO 8601 (UTC without a zone)."""
    raw = first_true(*[get(v, f"$.{k}") for k in ("timestamp", "created_at", "time")])
    number = raw.try_cast("double")
    return F.coalesce(F.when(number.isNotNull() & (number != 0), F.timestamp_micros((number * 1000000).cast("bigint"))), F.try_to_timestamp(raw), default)


def detect_source(raw: Column) -> Column:
    """canonical, anthropic, openai_chat, generic_chat, or null for no chat record."""
    msgs = items(raw, "$.messages")
    has = get(raw, "$.messages", "variant")
    head = items(F.get(msgs, F.lit(0)), "$.content")
    blocks = F.exists(head, lambda b: F.coalesce(get(b, "$.type").isin("text", "tool_use", "tool_result"), F.lit(False)))
    tools = F.exists(msgs, lambda m: get(m, "$.role").isin("assistant", "tool") & (get(m, "$.tool_calls", "variant").isNotNull() & (F.schema_of_variant(get(m, "$.tool_calls", "variant")) != "VOID") | get(m, "$.tool_call_id").isNotNull()))
    canonical = is_array(get(raw, "$.events", "variant")) & get(raw, "$.session_id").isNotNull()
    return F.when(canonical, "canonical").when(has.isNotNull() & blocks, "anthropic").when(has.isNotNull() & F.coalesce(tools, F.lit(False)), "openai_chat").when(has.isNotNull(), "generic_chat")


def _id(i: Column) -> Column:
    return F.concat(F.lit("e_"), F.lpad(i.cast("string"), 5, "0"))


def _joined(blocks: Column) -> Column:
    return F.array_join(F.transform(blocks, lambda b: F.coalesce(get(b, "$.text"), F.lit(""))), "")


def _content(m: Column) -> Column:
    """Message content as text: parts joined, null empty."""
    c = get(m, "$.content", "variant")
    return F.when(is_array(c), _joined(items(m, "$.content"))).otherwise(F.coalesce(text_of(m, "$.content"), F.lit("")))


@register_source("generic_chat")
def generic_chat(raw: Column, base: Column) -> Column:
    """User and assistant turns only."""
    turn = lambda m, i: F.when(get(m, "$.role").isin("user", "assistant"), event(kind=get(m, "$.role"), role=get(m, "$.role"), event_id=_id(i), timestamp=stamp(m, base), content=_content(m)))
    return F.array_compact(F.transform(messages(raw), turn))


def _openai_call(tc: Column, where: Column) -> Column:
    args = get(tc, "$.function.arguments", "variant")
    parsed = F.when(F.schema_of_variant(args).startswith("STRING"), F.try_parse_json(get(tc, "$.function.arguments"))).otherwise(args)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    kept = F.to_json(F.struct(F.coalesce(get(tc, "$.function.arguments"), F.to_json(args)).alias("_raw")))
    text = F.when(args.isNull(), "{}").when(is_object, F.to_json(parsed)).otherwise(kept)
    return F.struct(first_true(get(tc, "$.id"), where).alias("id"), first_true(get(tc, "$.function.name"), get(tc, "$.name"), F.lit("unknown")).alias("name"), text.alias("arguments"))


def _call_place(sid: Column, i: Column, k: Column) -> Column:
    """A stable id for a call without one."""
    return F.concat(F.lit("call_"), F.substring(F.sha2(F.concat_ws(":", sid, i.cast("string"), k.cast("string")), 256), 1, 16))


@register_source("openai_chat")
def openai_chat(raw: Column, base: Column) -> Column:
    """Tool calls and tool messages; assistant text before calls is an event of its own."""

    def turn(m: Column, i: Column) -> Column:
        role, said, when = get(m, "$.role"), _content(m), stamp(m, base)
        raw_calls = items(m, "$.tool_calls")
        made = F.transform(raw_calls, lambda tc, k: _openai_call(tc, _call_place(session_id(raw), i, k)))
        call = event(kind="tool_call", role="assistant", event_id=_id(i), timestamp=when, tool_calls=made)
        text = event(kind="assistant", role="assistant", event_id=F.concat(_id(i), F.lit("t")), timestamp=when, content=said)
        answer = event(kind="assistant", role="assistant", event_id=_id(i), timestamp=when, content=said, finish_reason=get(m, "$.finish_reason"))
        user = event(kind="user", role="user", event_id=_id(i), timestamp=when, content=said)
        result = event(
            kind="tool_result", role="tool", event_id=_id(i), timestamp=when, content=said, tool_call_id=F.coalesce(get(m, "$.tool_call_id"), F.lit("")),
            name=first_true(get(m, "$.name"), F.lit("unknown")), is_error=F.coalesce(get(m, "$.is_error", "boolean"), F.lit(False)),
        )
        some = F.size(raw_calls) > 0
        return (
            F.when(role == "user", F.array(user))
            .when((role == "assistant") & some & (said != ""), F.array(text, call))
            .when((role == "assistant") & some, F.array(call))
            .when(role == "assistant", F.array(answer))
            .when(role == "tool", F.array(result))
            .otherwise(no_events())
        )

    return F.flatten(F.transform(messages(raw), turn))


@register_source("anthropic")
def anthropic(raw: Column, base: Column) -> Column:
    """Content blocks: joined text, one event per tool_result, one event for all tool_use blocks.

    Ids count the turns (with or without text), results and call groups.
    """
    of = lambda blocks, t: F.filter(blocks, lambda b: F.coalesce(get(b, "$.type") == t, F.lit(False)))

    def blocks_of(m: Column) -> Column:
        c = get(m, "$.content", "variant")
        plain = F.coalesce(F.schema_of_variant(c).startswith("STRING"), F.lit(False))
        return F.when(plain, F.array(F.to_variant_object(F.struct(F.lit("text").alias("type"), get(m, "$.content").alias("text"))))).otherwise(items(m, "$.content"))

    turns = F.transform(
        messages(raw),
        lambda m: F.struct(get(m, "$.role").alias("role"), stamp(m, base).alias("ts"), blocks_of(m).alias("b")),
    )

    def step(acc: Column, t: Column) -> Column:
        n = acc["n"] + 1
        text, results, uses = _joined(of(t["b"], "text")), of(t["b"], "tool_result"), of(t["b"], "tool_use")

        def result(b: Column, i: Column) -> Column:
            c = get(b, "$.content", "variant")
            said = F.when(is_array(c), _joined(items(b, "$.content"))).otherwise(F.coalesce(text_of(b, "$.content"), F.lit("")))
            return event(
                kind="tool_result", role="tool", event_id=_id(n + i + 1), timestamp=t["ts"], content=said, tool_call_id=F.coalesce(get(b, "$.tool_use_id"), F.lit("")),
                name=first_true(get(b, "$.name"), F.lit("unknown")), is_error=F.coalesce(get(b, "$.is_error", "boolean"), F.lit(False)),
            )

        made = F.transform(uses, lambda b, k: F.struct(first_true(get(b, "$.id"), _call_place(session_id(raw), n, k)).alias("id"), first_true(get(b, "$.name"), F.lit("unknown")).alias("name"), F.coalesce(F.to_json(get(b, "$.input", "variant")), F.lit("{}")).alias("arguments")))
        said = lambda kind: F.when(text != "", F.array(event(kind=kind, role=kind, event_id=_id(n), timestamp=t["ts"], content=text))).otherwise(no_events())
        call = F.when(F.size(uses) > 0, F.array(event(kind="tool_call", role="assistant", event_id=_id(n + 1), timestamp=t["ts"], tool_calls=made))).otherwise(no_events())
        user = F.struct((n + F.size(results)).alias("n"), F.concat(acc["out"], said("user"), F.transform(results, result)).alias("out"))
        agent = F.struct((n + (F.size(uses) > 0).cast("int")).alias("n"), F.concat(acc["out"], said("assistant"), call).alias("out"))
        return F.when(t["role"] == "user", user).when(t["role"] == "assistant", agent).otherwise(acc)

    return F.aggregate(turns, F.struct(F.lit(0).alias("n"), no_events().alias("out")), step, lambda a: a["out"])


@register_source("canonical")
def canonical(raw: Column, base: Column) -> Column:
    """Events as they are."""

    def one(e: Column) -> Column:
        made = F.transform(items(e, "$.tool_calls"), lambda c: F.struct(get(c, "$.id").alias("id"), get(c, "$.name").alias("name"), F.coalesce(F.to_json(get(c, "$.arguments", "variant")), F.lit("{}")).alias("arguments")))
        plain = ("kind", "role", "event_id", "finish_reason", "tool_call_id", "name", "error_type", "message", "related_event_id", "lineage_id")
        content = F.coalesce(text_of(e, "$.content"), F.when(get(e, "$.kind") == "assistant", F.lit("")))
        fields = {k: get(e, f"$.{k}") for k in plain} | {"timestamp": stamp(e, base), "content": content, "metadata": F.to_json(get(e, "$.metadata", "variant"))}
        calls = F.when(get(e, "$.kind") == "tool_call", made).otherwise(F.lit(None).cast(f"array<{CALL}>"))
        failed = F.when(get(e, "$.kind") == "tool_result", F.coalesce(get(e, "$.is_error", "boolean"), F.lit(False)))
        return event(**fields, tool_calls=calls, is_error=failed)

    return F.transform(items(raw, "$.events"), one)


def session_id(raw: Column) -> Column:
    """session_id, conversation_id or id, else a hash of the record."""
    return first_true(get(raw, "$.session_id"), get(raw, "$.conversation_id"), get(raw, "$.id"), F.concat(F.lit("sess_"), F.substring(F.sha2(F.to_json(raw), 256), 1, 32)))


def lineage_id(raw: Column) -> Column:
    """The record's own, else a hash of its key-sorted JSON."""
    return first_true(get(raw, "$.lineage_id"), F.concat(F.lit("lin_"), F.substring(F.sha2(F.to_json(raw), 256), 1, 16)))


def out_of_order(events: Column) -> Column:
    """Whether any event is earlier than the one before it."""
    pairs = F.arrays_zip(F.slice(events, F.lit(1), F.greatest(F.size(events) - 1, F.lit(0))).alias("a"), F.slice(events, F.lit(2), F.greatest(F.size(events) - 1, F.lit(0))).alias("b"))
    return F.exists(pairs, lambda p: p["b"]["timestamp"] < p["a"]["timestamp"])


def normalize(records: DataFrame, base_time: Column, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(trajectories, quarantine) of raw records; `source` forces an adapter, `base_time` stands in for missing times."""
    raw = F.col("raw")
    kind = F.lit(source) if source else detect_source(raw)
    if source:
        get_source(source)
    rows = records.withColumn("_kind", kind)
    base = stamp(raw, base_time)
    made = None
    for name in known_sources():
        events = get_source(name)(raw, base).cast(f"array<{EVENT}>")
        made = F.when(F.col("_kind") == name, events) if made is None else made.when(F.col("_kind") == name, events)
    lineage = lineage_id(raw)
    stamped = F.transform(made, lambda e: e.withField("lineage_id", F.coalesce(e["lineage_id"], lineage)))
    rows = once(rows, "events", stamped)
    bad_kind = F.exists("events", lambda e: ~F.coalesce(e["kind"].isin("user", "assistant", "tool_call", "tool_result", "error"), F.lit(False)))
    no_call = F.exists("events", lambda e: (e["kind"] == "tool_call") & (F.coalesce(F.size(e["tool_calls"]), F.lit(0)) <= 0))
    error = (
        F.when(F.col("_kind").isNull(), "no known record shape")
        .when(F.col("events").isNull(), "events could not be read")
        .when(bad_kind, "unknown event kind")
        .when(no_call, "tool call event without calls")
        .when(out_of_order(F.col("events")), "timestamps out of order")
    )
    rows = rows.withColumn("error", error)
    good = rows.where("error IS NULL").select(
        session_id(raw).alias("session_id"),
        F.coalesce(get(raw, "$.source"), F.col("_kind")).alias("source"),
        get(raw, "$.domain").alias("domain"),
        F.coalesce(get(raw, "$.schema_version"), F.lit(VERSION)).alias("schema_version"),
        lineage.alias("lineage_id"),
        F.coalesce(F.to_json(get(raw, "$.tags", "variant")), F.lit("{}")).alias("tags"),
        "events",
    )
    return good, rows.where("error IS NOT NULL").select(F.col("line").alias("record"), "error")
