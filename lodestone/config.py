"""Configuration of a run: one frozen dataclass per stage, read from YAML.

Unknown keys are errors.  A stage that is left out keeps its defaults; paths
are relative to `build_dir`.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any, get_type_hints


@dataclass(frozen=True)
class Ingest:
    input: str = ""
    source: str | None = None


@dataclass(frozen=True)
class Redact:
    rules_file: str | None = None
    audit_rate: float = 0.05
    audit_seed: int = 0
    audit_cap: int | None = 1000
    quarantine: bool = True
    fail_on_leak: bool = False


@dataclass(frozen=True)
class Validate:
    tool_registry: str | None = None
    drop_on_error: bool = False


@dataclass(frozen=True)
class Split:
    enabled: bool = False
    fractions: tuple[float, float, float] = (0.8, 0.1, 0.1)
    seed: int = 0
    keys: tuple[str, ...] = ("complexity_band", "domain")
    near_duplicate_threshold: float = 0.85


@dataclass(frozen=True)
class Seeds:
    enabled: bool = False
    method: str = "greedy"
    n_clusters: int | None = None
    threshold: float = 0.72
    seed: int = 0


@dataclass(frozen=True)
class Generate:
    enabled: bool = False
    tool_registry: str | None = None
    drop_on_invalid_args: bool = True
    failure_config: dict[str, dict[str, float]] = field(default_factory=dict)
    seed: int = 0


@dataclass(frozen=True)
class Stratify:
    enabled: bool = False
    cap_per_bucket: int | None = None


@dataclass(frozen=True)
class Sft:
    template: str = "chatml"
    system_prompt: str | None = None
    shard_size: int = 5000
    compress: bool = False
    loss_policy: str = "assistant_only"


@dataclass(frozen=True)
class Dpo:
    strategy: str = "feedback"
    system_prompt: str | None = None
    shard_size: int = 5000
    compress: bool = False


@dataclass(frozen=True)
class Run:
    name: str = "run"
    build_dir: str = "build"
    ingest: Ingest = Ingest()
    redact: Redact = Redact()
    validate: Validate = Validate()
    split: Split = Split()
    seeds: Seeds = Seeds()
    generate: Generate = field(default_factory=Generate)
    stratify: Stratify = Stratify()
    sft: Sft = Sft()
    dpo: Dpo = Dpo()
    extra: dict[str, Any] = field(default_factory=dict)


CHOICES = {"Dpo.strategy": ("feedback", "failure_recovery", "all"), "Seeds.method": ("greedy", "kmeans"), "Sft.loss_policy": ("assistant_only", "assistant_text_only", "none")}


def build(kind: type, data: dict | None):
    """A stage from a mapping; unknown keys and values out of choice raise."""
    data = dict(data or {})
    known = {f.name for f in fields(kind)}
    if extra := set(data) - known:
        raise ValueError(f"{kind.__name__}: unknown keys {sorted(extra)}")
    hints = get_type_hints(kind)
    out = {}
    for k, v in data.items():
        if is_dataclass(hints[k]):
            v = build(hints[k], v)
        elif isinstance(v, list):
            v = tuple(v)
        choice = CHOICES.get(f"{kind.__name__}.{k}")
        if choice and v not in choice:
            raise ValueError(f"{kind.__name__}.{k}: {v!r} is none of {choice}")
        out[k] = v
    return kind(**out)


def load(path: str) -> Run:
    import yaml

    with open(path, encoding="utf-8") as f:
        return build(Run, yaml.safe_load(f))


def load_registry(path: str | None) -> dict:
    """A tool registry: {tools: [{name, required, properties}]} or {tool: {...}}."""
    if not path:
        return {}
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    tools = data.get("tools", data)
    if isinstance(tools, list):
        return {t["name"]: {"required": t.get("required") or [], "properties": t.get("properties") or {}} for t in tools}
    return {k: {"required": (v or {}).get("required") or [], "properties": (v or {}).get("properties") or {}} for k, v in tools.items()}
