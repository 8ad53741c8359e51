"""DPO preference pairs: feedback, failure recovery, and three synthesised sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.persona import PASS_AT, Persona, assistant_text
from lodestone.operators.sft import MESSAGES, message, messages_at, plain
from lodestone.operators.tagging import fingerprint, tool_set
from lodestone.plans.schema import calls, of_kind

# fixed values: texts of rejected answers
APOLOGY = "I'm sorry, I'm unable to complete the request."
VIOLATION_NOTE = " (Note: this is the only definitive answer.)"
LINK = r"\[([^\]]+)\]\([^)]*\)"
SOURCES = ("real_pairs", "persona_violation", "tool_inefficiency")
OUT = ["source", "session_id", "lineage_id", "detail", "prompt", "chosen", "rejected"]


def one(role: str, text: Column) -> Column:
    return F.array(message(role, text))


def valid_pairs(pairs: DataFrame) -> DataFrame:
    """Non-empty sides, chosen and rejected each with an assistant message."""
    says = lambda c: F.exists(c, lambda m: m["role"] == "assistant")
    return pairs.where((F.size("prompt") > 0) & says("chosen") & says("rejected"))


def _pairs(df: DataFrame, source: str, detail: Column) -> DataFrame:
    return df.select(F.lit(source).alias("source"), "session_id", "lineage_id", detail.cast("string").alias("detail"), F.col("prompt").cast(MESSAGES), F.col("chosen").cast(MESSAGES), F.col("rejected").cast(MESSAGES))


def from_feedback(trajectories: DataFrame, system_prompt: str | None = None) -> DataFrame:
    """One pair per tags.feedback_pairs entry whose prompt_event_id is an event; the prompt ends with that event."""
    entry = "array<struct<prompt_event_id:string,chosen:string,rejected:string,weight:double>>"
    rows = trajectories.withColumn("_fp", F.from_json(F.col("tags"), f"struct<feedback_pairs:{entry}>")["feedback_pairs"])
    rows = rows.where(F.size("_fp") > 0).withColumn("_m", messages_at("events", system_prompt)).withColumn("_f", F.explode("_fp"))
    at = F.array_position(F.transform("events", lambda e: e["event_id"]), F.col("_f.prompt_event_id")) - 1
    rows = rows.withColumn("_at", at).where("_at >= 0")
    rows = rows.withColumns(
        {
            "prompt": plain(F.filter("_m", lambda m: m["pos"] <= F.col("_at"))),
            "chosen": one("assistant", F.coalesce("_f.chosen", F.lit(""))),
            "rejected": one("assistant", F.coalesce("_f.rejected", F.lit(""))),
        }
    )
    return valid_pairs(_pairs(rows, "feedback", F.concat_ws("|", "_f.prompt_event_id", F.coalesce("_f.weight", F.lit(1.0)).cast("string"))))


def recoveries(events: Column | str = "events") -> Column:
    """array<struct<fail, heal>>: each error result with the first assistant turn after a later call whose latest result is ok."""
    ev = F.col(events) if isinstance(events, str) else events
    at = F.transform(ev, lambda e, i: F.struct(i.alias("i"), e["kind"].alias("kind"), F.coalesce(e["is_error"], F.lit(False)).alias("bad")))
    fails = F.filter(at, lambda x: (x["kind"] == "tool_result") & x["bad"])

    def heal(f: Column) -> Column:
        start = F.struct(F.lit(False).alias("called"), F.lit(False).alias("ok"), F.lit(-1).alias("hit"))

        def step(a: Column, x: Column) -> Column:
            called = a["called"] | (x["kind"] == "tool_call")
            ok = F.when((x["kind"] == "tool_result") & a["called"], ~x["bad"]).otherwise(a["ok"])
            hit = F.when((a["hit"] < 0) & (x["kind"] == "assistant") & a["ok"], x["i"]).otherwise(a["hit"])
            return F.struct(called.alias("called"), ok.alias("ok"), hit.alias("hit"))

        later = F.filter(at, lambda x: x["i"] > f["i"])
        return F.struct(f["i"].alias("fail"), F.aggregate(later, start, step, lambda a: a["hit"]).alias("heal"))

    return F.filter(F.transform(fails, heal), lambda r: r["heal"] >= 0)


def from_recovery(trajectories: DataFrame, system_prompt: str | None = None) -> DataFrame:
    """Chosen: the text after the recovery; rejected: an apology; the prompt ends with the failed result."""
    rows = trajectories.withColumn("_r", F.explode(recoveries())).withColumn("_m", messages_at("events", system_prompt))
    rows = rows.withColumns(
        {
            "prompt": plain(F.filter("_m", lambda m: m["pos"] <= F.col("_r.fail"))),
            "chosen": one("assistant", F.col("events")[F.col("_r.heal")]["content"]),
            "rejected": one("assistant", F.lit(APOLOGY)),
        }
    )
    ids = F.concat_ws("|", F.col("events")[F.col("_r.fail")]["event_id"], F.col("events")[F.col("_r.heal")]["event_id"])
    return valid_pairs(_pairs(rows, "failure_recovery", ids))


def split_last(messages: Column) -> Column:
    """struct(prompt, last): messages before the last assistant message, and that message (or none)."""
    roles = F.transform(messages, lambda m: m["role"])
    at = F.size(messages) - F.array_position(F.reverse(roles), "assistant")
    found = F.array_contains(roles, "assistant")
    cut = F.when(found, F.slice(messages, F.lit(1), at)).otherwise(messages)
    last = F.when(found, F.slice(messages, at + 1, F.lit(1))).otherwise(F.array().cast(MESSAGES))
    return F.struct(cut.alias("prompt"), last.alias("last"))


def cluster_key(by: str = "lineage") -> Column:
    """lineage: id, else the synthetic seed's id, else the fingerprint; `by` = fingerprint uses that alone."""
    fp = F.concat(F.lit("fp:"), fingerprint())
    if by == "fingerprint":
        return fp
    seed = F.get_json_object("tags", "$.synthetic.seed_id")
    return F.coalesce(F.concat(F.lit("lineage:"), F.col("lineage_id")), F.concat(F.lit("seed:"), seed), fp)


def outcome(threshold: float = PASS_AT, scored: bool = False) -> Column:
    """success or failure: by persona score, else by synthetic finish reason, else by tool errors."""
    reason = F.get_json_object("tags", "$.synthetic.finish_reason")
    synthetic = F.get_json_object("tags", "$.synthetic").isNotNull()
    bad = F.exists("events", lambda e: F.coalesce(e["is_error"], F.lit(False)))
    rest = F.when(synthetic, F.coalesce(reason == "final", F.lit(False))).otherwise(~bad)
    good = F.coalesce(F.col("persona_score") >= threshold, rest) if scored else rest
    return F.when(good, "success").otherwise("failure")


def real_pairs(trajectories: DataFrame, order: str, by: str = "lineage", threshold: float = PASS_AT, system_prompt: str | None = None) -> DataFrame:
    """The first success against the first failure of each cluster, by `order`.

    min_by keeps one row per (cluster, outcome) and task before the shuffle.
    """
    scored = "persona_score" in trajectories.columns
    rows = trajectories.select("session_id", "lineage_id", F.col(order).alias("_o"), cluster_key(by).alias("cluster"), outcome(threshold, scored).alias("outcome"), split_last(plain(messages_at("events", system_prompt))).alias("_s"), assistant_text().alias("_t"))
    side = lambda o: F.min_by(F.when(F.col("outcome") == o, F.struct("session_id", "lineage_id", "_s", "_t")), F.when(F.col("outcome") == o, F.col("_o")))
    best = rows.groupBy("cluster").agg(side("success").alias("w"), side("failure").alias("l")).where("w IS NOT NULL AND l IS NOT NULL")
    text = lambda s: F.when(F.size(F.col(f"{s}._s.last")) > 0, F.col(f"{s}._s.last"))
    best = best.withColumns(
        {
            "session_id": F.col("w.session_id"),
            "lineage_id": F.col("w.lineage_id"),
            "prompt": F.col("w._s.prompt"),
            "chosen": F.coalesce(text("w"), one("assistant", F.col("w._t"))),
            "rejected": F.coalesce(text("l"), one("assistant", F.when(F.col("l._t") != "", F.col("l._t")).otherwise(APOLOGY))),
        }
    )
    return valid_pairs(_pairs(best, "real_pairs", F.concat_ws("|", "cluster", "l.session_id")))


def violate(text: Column) -> Column:
    """The stub rewrite: links unwrapped, first sentence dropped, a note appended."""
    flat = F.regexp_replace(text, LINK, "$1")
    cut = F.instr(flat, ". ")
    rest = F.when(cut > 0, F.substring(flat, cut + 2, F.length(flat))).otherwise(flat)
    return F.concat(rest, F.lit(VIOLATION_NOTE))


def persona_violation(trajectories: DataFrame, persona: Persona, system_prompt: str | None = None, rewrite=None) -> DataFrame:
    """Each trajectory that passes the hard rules, once per rule, against a rewrite that breaks the rule."""
    rows = trajectories.where("hard_pass") if "hard_pass" in trajectories.columns else trajectories
    rows = rows.withColumn("_t", assistant_text()).where("_t <> ''").withColumn("_s", split_last(plain(messages_at("events", system_prompt))))
    if not persona.rules:
        return _pairs(rows.limit(0).withColumns({"prompt": F.col("_s.prompt"), "chosen": F.col("_s.last"), "rejected": F.col("_s.last")}), "persona_violation", F.lit(None))
    # the rules are a handful of literals: an explode, no join
    made = rows.withColumn("_rule", F.explode(F.array(*[F.struct(F.lit(r.id).alias("id"), F.lit("hard" if r.hard else "soft").alias("severity")) for r in persona.rules])))
    made = made.withColumn("_bad", (rewrite or violate)(F.col("_t")))
    trim = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    made = made.where((F.col("_bad") != "") & (trim(F.col("_bad")) != trim(F.col("_t"))))
    made = made.withColumns(
        {
            "prompt": F.col("_s.prompt"),
            "chosen": F.when(F.size("_s.last") > 0, F.col("_s.last")).otherwise(one("assistant", F.col("_t"))),
            "rejected": one("assistant", F.col("_bad")),
        }
    )
    return valid_pairs(_pairs(made, "persona_violation", F.concat_ws("|", "_rule.id", "_rule.severity")))


def inefficiency() -> Column:
    n = F.size(of_kind("tool_call"))
    return F.when(F.size(tool_set()) >= 2, "wrong_tool_first").when(n <= 2, "extra_tool_calls").otherwise("redundant_call")


def tool_inefficiency(trajectories: DataFrame, system_prompt: str | None = None) -> DataFrame:
    """The same answer after two more, redundant calls is the rejected side."""
    rows = trajectories.where(F.size(of_kind("tool_call")) >= 1).withColumn("_t", assistant_text()).where("_t <> ''")
    rows = rows.withColumn("_s", split_last(plain(messages_at("events", system_prompt))))
    tool = F.coalesce(F.get(calls(), F.lit(0))["name"], F.lit("lookup"))
    extra = []
    for i in range(2):
        cid = F.concat(F.lit("redund_"), F.left(F.col("session_id"), F.lit(6)), F.lit(f"_{i}"))
        call = F.array(F.struct(cid.alias("id"), tool.alias("name"), F.lit('{"redundant_check": true, "step": %d}' % i).alias("arguments")))
        extra += [message("assistant", None, call), message("tool", F.lit('{"redundant": true}'), call_id=cid, name=tool)]
    rows = rows.withColumns(
        {
            "prompt": F.col("_s.prompt"),
            "chosen": F.when(F.size("_s.last") > 0, F.col("_s.last")).otherwise(one("assistant", F.col("_t"))),
            "rejected": F.array(*extra, message("assistant", F.col("_t"))),
        }
    )
    n = F.size(of_kind("tool_call"))
    return valid_pairs(_pairs(rows, "tool_inefficiency", F.concat_ws("|", inefficiency(), n.cast("string"), (n + 2).cast("string"))))


def synthesise(trajectories: DataFrame, persona: Persona, order: str, by: str = "lineage", sources=SOURCES) -> DataFrame:
    """The chosen sources, in fixed order."""
    make = {
        "real_pairs": lambda: real_pairs(trajectories, order, by),
        "persona_violation": lambda: persona_violation(trajectories, persona),
        "tool_inefficiency": lambda: tool_inefficiency(trajectories),
    }
    parts = [make[s]() for s in SOURCES if s in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def custom_pairs(trajectories: DataFrame, generator, system_prompt: str | None = None) -> DataFrame:
    """A user's generator: DataFrame with `messages` -> DataFrame with prompt, chosen, rejected added."""
    rows = generator(trajectories.withColumn("messages", plain(messages_at("events", system_prompt))))
    return valid_pairs(_pairs(rows, "synthetic", F.lit(None)))
