"""Trajectories from the Parquet tables: T1 from conversations, T2 from events.

T2 reads an event log as agent sessions: view and click are tool calls,
purchase is a good result and error a bad one of the call before, anything
else is an assistant turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.plans.schema import VERSION, event, nested
from lodestone.session import table

SAID = ("I found the page", "It failed", "Noted")


def from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trajectory per conv_id, turns in order, system turns dropped."""
    turns = table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant"))
    when = F.timestamp_seconds(F.col("turn"))
    ev = event(kind=F.col("role"), role=F.col("role"), event_id=F.concat(F.lit("e_"), F.lpad(F.col("turn").cast("string"), 5, "0")), timestamp=when, content=F.col("text"))
    rows = turns.select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").alias("pos"), ev.alias("e")).select("session_id", "pos", "e.*")
    return _whole(nested(rows), "conversations", F.lit(None).cast("string"))


def from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trajectory per user_id, ordered by (ts, event_id)."""
    e = table(spark, sf_dir, "events")
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    past = w.rowsBetween(W.unboundedPreceding, -1)
    is_call = F.col("event_type").isin("view", "click")
    last = lambda c: F.last(F.when(is_call, F.col(c)), ignorenulls=True).over(past)
    rows = e.withColumns({"pos": F.row_number().over(w) - 1, "call_id": last("event_id"), "call_name": last("event_type")})
    eid, when = F.col("event_id").cast("string"), F.col("ts").cast("timestamp")
    call = F.array(F.struct(F.concat(F.lit("c"), eid).alias("id"), F.col("event_type").alias("name"), F.col("props").alias("arguments")))
    result = event(kind="tool_result", role="tool", event_id=eid, timestamp=when, tool_call_id=F.concat(F.lit("c"), F.coalesce(F.col("call_id").cast("string"), F.lit("none"))), name=F.coalesce("call_name", F.lit("unknown")), content=F.col("props"), is_error=F.col("event_type") == "error")
    said = F.element_at(F.array(*[F.lit(s) for s in SAID]), (F.col("event_id") % 3 + 1).cast("int"))
    ev = (
        F.when(is_call, event(kind="tool_call", role="assistant", event_id=eid, timestamp=when, tool_calls=call))
        .when(F.col("event_type").isin("purchase", "error"), result)
        .otherwise(event(kind="assistant", role="assistant", event_id=eid, timestamp=when, content=said))
    )
    flat = rows.select(F.col("user_id").cast("string").alias("session_id"), "pos", ev.alias("e")).select("session_id", "pos", "e.*")
    domain = F.element_at(F.array(F.lit("app"), F.lit("shop"), F.lit("web")), (F.col("session_id").cast("long") % 3 + 1).cast("int"))
    return _whole(nested(flat), "events", domain)


def _whole(rows: DataFrame, source: str, domain) -> DataFrame:
    return rows.select("session_id", F.lit(source).alias("source"), domain.alias("domain"), F.lit(VERSION).alias("schema_version"), F.lit(None).cast("string").alias("lineage_id"), F.lit("{}").alias("tags"), "events")
