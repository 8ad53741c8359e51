"""Adapters for user code that Spark cannot express: engines, models, judges, hooks.

Each takes a factory, called once per Python worker, so that models load
lazily and are shared by the worker's batches.  Data moves in Arrow batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lodestone.operators.redact import SPANS, none

_MADE: dict[str, Any] = {}


def once(factory: Callable[[], Any], key: str) -> Any:
    """The factory's product, made once per process for a key that the driver drew."""
    if key not in _MADE:
        _MADE[key] = factory()
    return _MADE[key]


def optional(module: str, make: Callable[[Any], Any]) -> Callable[[], Any | None]:
    """A factory that needs a module; gives None where it cannot be imported."""

    def factory():
        import importlib

        try:
            return make(importlib.import_module(module))
        except ImportError:
            return None

    return factory


def pii_engine(factory: Callable[[], Callable[[str, str], Iterable[tuple[str, str, int, int]]] | None], order: int = 100) -> Callable[[Column, Column], Column]:
    """An engine (text, language) -> [(rule, category, start, end)] as a spans column; an engine of None finds nothing."""

    key = uuid.uuid4().hex

    @pandas_udf("array<struct<rule:string,category:string,start:int,end:int>>")
    def find(text: pd.Series, lang: pd.Series) -> pd.Series:
        engine = once(factory, key)
        if engine is None:
            return pd.Series([[] for _ in text])
        return pd.Series([[{"rule": r, "category": c, "start": int(s), "end": int(e)} for r, c, s, e in engine(t or "", g)] for t, g in zip(text, lang, strict=True)])

    def spans(text: Column, lang: Column) -> Column:
        made = F.transform(
            find(text, lang),
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), F.lit(order).alias("ord"), s["end"].alias("end"), s["rule"].alias("rule"), s["category"].alias("category"), F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("text")),
        )
        return F.concat(none(), made).cast(SPANS)

    return spans


def union_engines(*spans: Column) -> Column:
    """Spans of several engines by (start, longer first, engine order)."""
    return F.array_sort(F.concat(*spans))


def judge(factory: Callable[[], Callable[[str, str, str], float]]) -> Callable:
    """A judge (rule id, criterion, text) -> score for persona.score(); a failing call scores 0.5."""

    key = uuid.uuid4().hex

    @pandas_udf("double")
    def run(rule: pd.Series, criterion: pd.Series, text: pd.Series) -> pd.Series:
        model = once(factory, key)

        def one(r: str, c: str, t: str) -> float:
            try:
                return float(model(r, c, t))
            except Exception:  # a judge that breaks down is no verdict
                return 0.5

        return pd.Series([one(*x) for x in zip(rule, criterion, text, strict=True)])

    return lambda rule, text: run(F.lit(rule.id), F.lit(rule.criterion), text)


def parse_verdict(answer: str) -> float:
    """1.0 if the first line of a model's answer says PASS, 0.0 for FAIL, else 0.5."""
    head = (answer or "").strip().splitlines()[:1]
    word = head[0].upper() if head else ""
    return 1.0 if word.startswith("PASS") else 0.0 if word.startswith("FAIL") else 0.5


def backend(df: DataFrame, prompt: str, factory: Callable[[], Callable[[list[str]], list[str]]], out: str = "answer") -> DataFrame:
    """Adds a model's answers to a prompt column, batch by batch."""
    from pyspark.sql.types import StringType, StructField, StructType

    key = uuid.uuid4().hex
    schema = StructType([*df.schema.fields, StructField(out, StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = once(factory, key)
        for pdf in frames:
            yield pdf.assign(**{out: model(pdf[prompt].tolist())})

    return df.mapInPandas(run, schema)


def token_counter(factory: Callable[[], Callable[[str], Iterable] | None]) -> Callable[[Column], Column]:
    """A tokenizer (text -> tokens) as a count for sft.dry_run(); one of None counts words times 1.3."""

    key = uuid.uuid4().hex

    @pandas_udf("int")
    def run(text: pd.Series) -> pd.Series:
        encode = once(factory, key) or (lambda t: range(int(len(t.split()) * 1.3)))
        return text.map(lambda t: None if t is None else len(list(encode(t)))).astype("Int32")

    return lambda text: run(text)


def tool_hook(factory: Callable[[], Callable[[str, str], str]]) -> Callable[[Column, Column], Column]:
    """A hook (tool, arguments as JSON) -> content for generate.call_tools()."""

    key = uuid.uuid4().hex

    @pandas_udf("string")
    def run(tool: pd.Series, args: pd.Series) -> pd.Series:
        hook = once(factory, key)
        return pd.Series([hook(t, a) for t, a in zip(tool, args, strict=True)])

    return lambda tool, args: run(tool, args)


def render_with(df: DataFrame, messages: str, template: Callable[[list[dict]], str], out: str = "text") -> DataFrame:
    """Adds a user's rendering of a message column, for templates that are not named ones."""
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*df.schema.fields, StructField(out, StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.assign(**{out: [template([dict(m) for m in ms]) for ms in pdf[messages]]})

    return df.mapInPandas(run, schema)
