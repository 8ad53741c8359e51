"""Persona rules: parsing, compiled checks, scores."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.plans.schema import once, texts

PASS_AT = 0.6
TOOL_CALL_TEXT = r"(?is)<tool_call>.*?</tool_call>"
_TAG = re.compile(r"\[([a-zA-Z_]+)(?::\s*([^\]]+))?\]")
_HEADING = re.compile(r"(#{1,6})\s+(\S.*?)\s*")
_BULLET = re.compile(r"\s*[-*+]\s+(\S.*?)\s*")


@dataclass(frozen=True)
class PersonaRule:
    id: str
    text: str
    section: str
    hard: bool = False
    must_match: tuple[str, ...] = ()
    must_not_match: tuple[str, ...] = ()
    must_contain: tuple[str, ...] = ()
    criterion: str | None = None  # set: left to a judge


@dataclass
class Persona:
    name: str
    rules: list[PersonaRule] = field(default_factory=list)
    sections: list[str] = field(default_factory=list)


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-")[:48] or "rule"


def parse_persona(markdown: str, name: str = "persona", join_lines: bool = False) -> Persona:
    """Headings from level two down make the section, each single-line bullet is a rule.

    With join_lines, indented lines after a bullet belong to it.
    """
    out, path, taken = Persona(name), [], set()
    lines = markdown.splitlines()
    if join_lines:
        joined: list[str] = []
        for line in lines:
            if joined and re.match(r"\s{2,}\S", line) and not _BULLET.fullmatch(line) and _BULLET.fullmatch(joined[-1]):
                joined[-1] += " " + line.strip()
            else:
                joined.append(line)
        lines = joined
    for line in lines:
        if h := _HEADING.fullmatch(line):
            level = len(h[1])
            del path[max(0, level - 2) :]
            if level >= 2:
                path.append(h[2])
                where = "/".join(map(slug, path))
                if where not in out.sections:
                    out.sections.append(where)
        elif b := _BULLET.fullmatch(line):
            rule = _rule(b[1], "/".join(map(slug, path)) or "root", taken)
            if rule:
                taken.add(rule.id)
                out.rules.append(rule)
    return out


def _rule(bullet: str, section: str, taken: set[str]) -> PersonaRule | None:
    tags: dict[str, list[str]] = {}
    for m in _TAG.finditer(bullet):
        tags.setdefault(m[1].lower(), []).append((m[2] or "").strip())
    text = _TAG.sub("", bullet).strip()
    if not text:
        return None
    given = tags.get("id")
    base = slug(given[0]) if given else f"{slug(section)}--{slug(text)}"
    rule_id, n = base, 2
    while rule_id in taken:
        rule_id, n = f"{base}-{n}", n + 1
    values = lambda key: tuple(v for v in tags.get(key, []) if v)
    checks = {"must_match": values("regex"), "must_not_match": values("forbid"), "must_contain": values("contains")}
    if any(checks.values()) and "judge" not in tags:
        return PersonaRule(rule_id, text, section, "hard" in tags, **checks)
    return PersonaRule(rule_id, text, section, "hard" in tags, criterion=next(iter(values("judge")), text))


def assistant_text(events: Column | str = "events") -> Column:
    """Non-empty assistant turns without embedded tool calls, joined by newlines."""
    clean = F.transform(texts("assistant", events), lambda t: F.regexp_replace(F.regexp_replace(t, TOOL_CALL_TEXT, ""), r"^\s+|\s+$", ""))
    return F.array_join(F.filter(clean, lambda t: t != ""), "\n")


def rule_score(rule: PersonaRule, text: Column, forbidden: dict[str, tuple[str, ...]] | None = None, judge=None) -> Column:
    """1.0 if the rule holds, else 0.0; rules left to a judge use `judge(rule, text)`, or the stub: no forbidden phrase."""
    if rule.criterion is not None:
        if judge is not None:
            return judge(rule, text)
        bad = [F.contains(F.lower(text), F.lit(p.lower())) for p in (forbidden or {}).get(rule.id, ())]
    else:
        bad = [~F.rlike(text, F.lit(p)) for p in rule.must_match]
        bad += [F.rlike(text, F.lit(p)) for p in rule.must_not_match]
        bad += [~F.contains(F.lower(text), F.lit(p.lower())) for p in rule.must_contain]
    fails = F.lit(False)
    for b in bad:
        fails = fails | b
    return F.when(fails, 0.0).otherwise(1.0)


def score(trajectories: DataFrame, persona: Persona, forbidden: dict | None = None, judge=None) -> DataFrame:
    """Adds assistant_text, rule_results, hard_pass and persona_score.

    0 if a hard rule fails (a score under 0.5), else the mean of the soft rules, 1 without any.
    """
    rows = once(trajectories, "assistant_text", assistant_text())
    results = [
        F.struct(F.lit(r.id).alias("rule"), F.lit(r.hard).alias("hard"), rule_score(r, F.col("assistant_text"), forbidden, judge).alias("score")) for r in persona.rules
    ]
    empty = F.array().cast("array<struct<rule:string,hard:boolean,score:double>>")
    rows = once(rows, "rule_results", F.array(*results) if results else empty)
    soft = F.filter("rule_results", lambda r: ~r["hard"])
    mean = F.when(F.size(soft) > 0, F.aggregate(soft, F.lit(0.0), lambda a, r: a + r["score"]) / F.size(soft)).otherwise(1.0)
    rows = rows.withColumn("hard_pass", ~F.exists("rule_results", lambda r: r["hard"] & (r["score"] < 0.5)))
    return rows.withColumn("persona_score", F.when(F.col("hard_pass"), mean).otherwise(0.0))


def pass_counts(scored: DataFrame, threshold: float = PASS_AT) -> DataFrame:
    return scored.agg(F.count_if(F.col("persona_score") >= threshold).alias("n_pass"), F.count_if(F.col("persona_score") < threshold).alias("n_fail"))
