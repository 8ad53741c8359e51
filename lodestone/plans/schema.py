"""The canonical nested layout: one row per trajectory.

A trajectory holds its events as an array of one wide struct with a ``kind``
discriminator; free-form maps (arguments, metadata, tags) are JSON text, parsed
where their types matter.  Row-local operators work on the array with
higher-order functions and need no shuffle; exploded() gives the flat layout
for joins and windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALL = "struct<id:string,name:string,arguments:string>"
EVENT = (
    f"struct<kind:string,role:string,event_id:string,timestamp:timestamp,content:string,finish_reason:string,tool_calls:array<{CALL}>,"
    "tool_call_id:string,name:string,is_error:boolean,error_type:string,message:string,related_event_id:string,lineage_id:string,metadata:string>"
)
EVENT_FIELDS = (
    "kind role event_id timestamp content finish_reason tool_calls tool_call_id name is_error error_type message related_event_id lineage_id metadata"
).split()
TRAJECTORY = f"session_id string, source string, domain string, schema_version string, lineage_id string, tags string, events array<{EVENT}>"
MESSAGE = f"struct<role:string,content:string,tool_calls:array<{CALL}>,tool_call_id:string,name:string>"
KINDS = ("user", "assistant", "tool_call", "tool_result", "error")
VERSION = "1.0"

_TYPES = {"timestamp": "timestamp", "tool_calls": f"array<{CALL}>", "is_error": "boolean"}


def event(**fields: Column | str | bool) -> Column:
    """An event struct; fields left out are null."""
    out = []
    for name in EVENT_FIELDS:
        v = fields.get(name)
        v = v if isinstance(v, Column) else F.lit(v)
        out.append(v.cast(_TYPES.get(name, "string")).alias(name))
    return F.struct(*out)


def no_events() -> Column:
    return F.array().cast(f"array<{EVENT}>")


def of_kind(kind: str, events: Column | str = "events") -> Column:
    """The events of one kind, in order."""
    return F.filter(events, lambda e: e["kind"] == kind)


def calls(events: Column | str = "events") -> Column:
    """All tool calls in order."""
    return F.flatten(F.transform(of_kind("tool_call", events), lambda e: F.coalesce(e["tool_calls"], F.array().cast(f"array<{CALL}>"))))


def texts(kind: str, events: Column | str = "events") -> Column:
    """Contents of the events of one kind; null is empty."""
    return F.transform(of_kind(kind, events), lambda e: F.coalesce(e["content"], F.lit("")))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column that is computed once per row.

    A filter on a plain projected column is pushed below the projection and
    repeats its expression; a generator's output holds it back.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def exploded(trajectories: DataFrame, *keep: str) -> DataFrame:
    """Flat layout: session_id, kept columns, pos, and the event's fields."""
    return trajectories.select("session_id", *keep, F.posexplode("events").alias("pos", "event")).select("session_id", *keep, "pos", "event.*")


def nested(events: DataFrame) -> DataFrame:
    """Back from (session_id, pos, event fields) to one row per session."""
    packed = F.struct("pos", F.struct(*EVENT_FIELDS).alias("event"))
    return events.groupBy("session_id").agg(F.transform(F.array_sort(F.collect_list(packed)), lambda x: x["event"]).alias("events"))
