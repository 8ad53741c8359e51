"""SFT messages and records, chat templates, and the template dry run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.plans.schema import CALL, MESSAGE, once

MESSAGES = f"array<{MESSAGE}>"
NO_CALLS = f"array<{CALL}>"
# a message with the position of the event it comes from (-1: the system prompt)
_AT = f"struct<role:string,content:string,tool_calls:{NO_CALLS},tool_call_id:string,name:string,pos:int>"


def message(role: str, content: Column | None = None, calls: Column | None = None, call_id: Column | None = None, name: Column | None = None, pos: Column | None = None) -> Column:
    null = lambda t: F.lit(None).cast(t)
    fields = [
        F.lit(role).alias("role"),
        (content if content is not None else null("string")).cast("string").alias("content"),
        (calls if calls is not None else null(NO_CALLS)).alias("tool_calls"),
        (call_id if call_id is not None else null("string")).alias("tool_call_id"),
        (name if name is not None else null("string")).alias("name"),
    ]
    return F.struct(*fields, *([pos.cast("int").alias("pos")] if pos is not None else []))


def messages_at(events: Column | str = "events", system_prompt: str | None = None) -> Column:
    """Messages with the position of their event.

    Error events vanish.  Assistant text directly before a tool call goes into
    the call's message; an assistant turn directly after another replaces it;
    empty assistant turns are dropped.
    """
    ev = F.col(events) if isinstance(events, str) else events
    seen = F.filter(F.transform(ev, lambda e, i: F.struct(e.alias("e"), i.alias("i"))), lambda x: x["e"]["kind"] != "error")

    def fold(all_: Column) -> Column:
        def one(x: Column, k: Column) -> Column:
            e, after, before = x["e"], F.get(all_, k + 1), F.get(all_, k - 1)
            held = F.when((before["e"]["kind"] == "assistant") & (before["e"]["content"] != ""), before["e"]["content"])
            alone = (F.coalesce(e["content"], F.lit("")) != "") & F.coalesce(~after["e"]["kind"].isin("assistant", "tool_call"), F.lit(True))
            return (
                F.when(e["kind"] == "user", message("user", e["content"], pos=x["i"]))
                .when(e["kind"] == "tool_result", message("tool", e["content"], call_id=e["tool_call_id"], name=e["name"], pos=x["i"]))
                .when(e["kind"] == "tool_call", message("assistant", held, e["tool_calls"], pos=x["i"]))
                .when((e["kind"] == "assistant") & alone, message("assistant", e["content"], pos=x["i"]))
            )

        return F.array_compact(F.transform(all_, one))

    out = F.transform(F.array(seen), fold)[0]
    if system_prompt:
        out = F.concat(F.array(message("system", F.lit(system_prompt), pos=F.lit(-1))), out)
    return out


def plain(messages: Column) -> Column:
    """Messages without positions."""
    return F.transform(messages, lambda m: F.struct(*[m[f].alias(f) for f in ("role", "content", "tool_calls", "tool_call_id", "name")]))


def to_messages(events: Column | str = "events", system_prompt: str | None = None) -> Column:
    return plain(messages_at(events, system_prompt))


def loss_weights(messages: Column, policy: str | None) -> Column:
    """1.0 for messages to train on: assistant_only, assistant_text_only, or None."""
    if policy is None:
        return F.lit(None).cast("array<double>")
    text = lambda m: (m["role"] == "assistant") & (F.coalesce(m["content"], F.lit("")) != "") & (F.coalesce(F.size(m["tool_calls"]), F.lit(0)) <= 0)
    rules = {"assistant_only": lambda m: m["role"] == "assistant", "assistant_text_only": text}
    if policy not in rules:
        raise KeyError(f"unknown loss policy {policy!r}; known: {sorted(rules)}")
    return F.transform(messages, lambda m: rules[policy](m).cast("double"))


def valid_messages(messages: Column) -> Column:
    """At least two messages; tool messages name their call, calls belong to assistants, others have content."""
    bad = F.exists(
        messages,
        lambda m: ((m["role"] == "tool") & m["tool_call_id"].isNull()) | ((m["role"] != "assistant") & (F.coalesce(F.size(m["tool_calls"]), F.lit(0)) > 0)) | ((m["role"] != "assistant") & m["content"].isNull()),
    )
    return (F.size(messages) >= 2) & ~bad


def sft_records(trajectories: DataFrame, system_prompt: str | None = None, policy: str | None = "assistant_only") -> DataFrame:
    """messages and metadata of every valid trajectory; tags never replace the core metadata."""
    rows = once(trajectories, "messages", to_messages("events", system_prompt)).where(valid_messages(F.col("messages")))
    meta = F.struct("session_id", "domain", "source", "schema_version", "lineage_id", "tags", loss_weights(F.col("messages"), policy).alias("loss_weights"), F.lit(policy).alias("loss_policy"))
    return rows.select("messages", meta.alias("metadata"))


def _call_json(c: Column, key: str, name: str = "name") -> Column:
    return F.concat(F.lit('{"' + name + '": '), F.to_json(F.array(c["name"])).substr(F.lit(2), F.length(F.to_json(F.array(c["name"]))) - 2), F.lit(f', "{key}": '), F.coalesce(c["arguments"], F.lit("{}")), F.lit("}"))


def _quoted(text: Column) -> Column:
    a = F.to_json(F.array(F.coalesce(text, F.lit(""))))
    return F.substring(a, F.lit(2), F.length(a) - 2)


def _each(m: Column, before: str, body, after: str, sep: str = "") -> Column:
    return F.array_join(F.transform(m["tool_calls"], lambda c: F.concat(F.lit(before), body(c), F.lit(after))), sep)


# fixed values: the grammars of the six named templates
def _chatml(m: Column, calls, tool) -> Column:
    head = F.concat(F.lit("<|im_start|>"), m["role"])
    said = F.concat(F.lit("\n"), m["content"])
    return F.concat(head, F.when(calls, F.concat(F.coalesce(said, F.lit("")), _each(m, "\n<tool_call>", lambda c: _call_json(c, "arguments"), "</tool_call>"))).otherwise(F.coalesce(said, F.lit("\n"))), F.lit("<|im_end|>\n"))


def _llama3(m: Column, calls, tool) -> Column:
    head = F.concat(F.lit("<|start_header_id|>"), m["role"], F.lit("<|end_header_id|>"))
    said = F.concat(F.lit("\n"), m["content"])
    return F.concat(head, F.when(calls, F.concat(F.coalesce(said, F.lit("")), _each(m, "\n<|python_tag|>", lambda c: _call_json(c, "parameters"), "<|eom_id|>"))).otherwise(F.coalesce(said, F.lit("\n"))), F.lit("<|eot_id|>\n"))


def _plain(m: Column, calls, tool) -> Column:
    one = lambda c: F.concat(c["name"], F.lit(", "), F.coalesce(c["arguments"], F.lit("{}")))
    call = F.concat(F.lit("ASSISTANT:"), F.coalesce(F.concat(F.lit(" "), m["content"]), F.lit("")), _each(m, "\nTOOL_CALL(", one, ")"))
    return F.concat(F.when(calls, call).when(tool, F.concat(F.lit("TOOL: TOOL_RESULT("), m["content"], F.lit(")"))).otherwise(F.concat(F.upper(m["role"]), F.lit(": "), F.coalesce(m["content"], F.lit("")))), F.lit("\n"))


def _qwen(m: Column, calls, tool) -> Column:
    head = F.concat(F.lit("<|im_start|>"), m["role"])
    said = F.concat(F.lit("\n"), m["content"])
    body = (
        F.when(calls, F.concat(F.coalesce(said, F.lit("")), _each(m, "\n<tool_call>\n", lambda c: _call_json(c, "arguments"), "\n</tool_call>")))
        .when(tool, F.concat(F.lit("\n<tool_response>\n"), m["content"], F.lit("\n</tool_response>")))
        .otherwise(F.coalesce(said, F.lit("\n")))
    )
    return F.concat(head, body, F.lit("<|im_end|>\n"))


def _gemma(m: Column, calls, tool) -> Column:
    role = F.when(m["role"] == "assistant", "model").otherwise(m["role"])
    said = F.concat(F.lit("\n"), m["content"])
    body = (
        F.when(calls, F.concat(F.coalesce(said, F.lit("")), _each(m, "\n```tool_code\n", lambda c: _call_json(c, "args"), "\n```")))
        .when(tool, F.concat(F.lit("\n```tool_result\n"), m["content"], F.lit("\n```")))
        .otherwise(F.coalesce(said, F.lit("\n")))
    )
    return F.concat(F.lit("<start_of_turn>"), role, body, F.lit("<end_of_turn>\n"))


def _mistral(m: Column, calls, tool) -> Column:
    call = F.concat(F.coalesce(F.concat(F.lit(" "), m["content"]), F.lit("")), F.lit("\n[TOOL_CALLS] ["), _each(m, "", lambda c: _call_json(c, "arguments"), "", ","), F.lit("]</s>\n"))
    result = F.concat(F.lit('[TOOL_RESULTS] {"content": '), _quoted(m["content"]), F.lit(', "call_id": "'), F.coalesce(m["tool_call_id"], F.lit("")), F.lit('"} [/TOOL_RESULTS]\n'))
    return F.when(calls, call).when(tool, result).when(m["role"] == "assistant", F.concat(F.coalesce(m["content"], F.lit("")), F.lit("</s>\n"))).otherwise(F.concat(F.lit("[INST] "), F.coalesce(m["content"], F.lit("")), F.lit(" [/INST]\n")))


TEMPLATES = {"chatml": _chatml, "llama3": _llama3, "plain": _plain, "qwen": _qwen, "gemma": _gemma, "mistral": _mistral}
PROMPTS = {"chatml": "<|im_start|>assistant", "llama3": "<|start_header_id|>assistant<|end_header_id|>", "plain": "ASSISTANT:", "qwen": "<|im_start|>assistant", "gemma": "<start_of_turn>model", "mistral": ""}


def render(messages: Column, template: str, add_generation_prompt: bool = False) -> Column:
    """Messages as one string in a named template."""
    if template not in TEMPLATES:
        raise KeyError(f"unknown template {template!r}; known: {sorted(TEMPLATES)}")
    form = TEMPLATES[template]
    one = lambda m: form(m, F.coalesce(F.size(m["tool_calls"]), F.lit(0)) > 0, m["role"] == "tool")
    out = F.array_join(F.transform(messages, one), "")
    return F.concat(out, F.lit(PROMPTS[template])) if add_generation_prompt else out


def whitespace_tokens(text: Column) -> Column:
    """Words times 1.3, cut to an integer."""
    return (F.regexp_count(text, F.lit(r"\S+")) * F.lit(1.3).cast("double")).cast("int")


def dry_run(records: DataFrame, template: str = "chatml", max_tokens: int = 8192, key: str | None = None, fail_fast: bool = False, tokens=whitespace_tokens) -> DataFrame:
    """Per record: code (null: passed) and n_tokens.  fail_fast returns the first failure only.

    tokens: text column -> number of tokens, words by default (plugins.token_counter() for a tokenizer).
    """
    m = F.col("messages")
    rows = records.withColumn("_text", F.when(m.isNotNull() & (F.size(m) > 0), render(m, template)))
    parse_bad = m.isNull() | F.exists(m, lambda x: ~F.coalesce(x["role"].isin("system", "user", "assistant", "tool"), F.lit(False)))
    rows = rows.withColumn("n_tokens", F.coalesce(tokens(F.col("_text")).cast("int"), F.lit(0)))
    code = (
        F.when(m.isNotNull() & (F.size(m) == 0), "EMPTY_MESSAGES")
        .when(parse_bad, "MESSAGE_PARSE")
        .when(F.col("_text").isNull(), "RENDER")
        .when(F.trim(F.col("_text")) == "", "EMPTY_RENDER")
        .when(F.col("n_tokens") > max_tokens, "CONTEXT_OVERFLOW")
    )
    rows = rows.withColumn("code", code).select(*([key] if key else []), "code", "n_tokens")
    return rows.where("code IS NOT NULL").limit(1) if fail_fast else rows


def dry_run_report(results: DataFrame) -> DataFrame:
    """n_records, n_failed, n_overflow, max_tokens."""
    return results.agg(
        F.count("*").alias("n_records"),
        F.count_if(F.col("code").isNotNull()).alias("n_failed"),
        F.count_if(F.col("code") == "CONTEXT_OVERFLOW").alias("n_overflow"),
        F.coalesce(F.max("n_tokens"), F.lit(0)).cast("long").alias("max_tokens"),
    )
