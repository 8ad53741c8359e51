"""Small trajectories for tests, as rows of the canonical schema."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from lodestone.plans.schema import EVENT_FIELDS, TRAJECTORY

T0 = datetime(2024, 5, 1, tzinfo=timezone.utc)


def ev(kind, i=0, **kw):
    row = dict.fromkeys(EVENT_FIELDS)
    role = {"tool_call": "assistant", "tool_result": "tool"}.get(kind, kind)
    row |= {"kind": kind, "role": role, "event_id": f"e{i}", "timestamp": T0 + timedelta(seconds=i)} | kw
    return tuple(row[f] for f in EVENT_FIELDS)


def user(i, text):
    return ev("user", i, content=text)


def say(i, text):
    return ev("assistant", i, content=text)


def call(i, name, cid=None, **args):
    return ev("tool_call", i, tool_calls=[(cid or f"c{i}", name, json.dumps(args))])


def result(i, cid, name="t", content="ok", bad=False):
    return ev("tool_result", i, tool_call_id=cid, name=name, content=content, is_error=bad)


def frame(spark, *sessions, tags=None):
    rows = [(f"s{k}", "test", None, "1.0", None, json.dumps((tags or {}).get(k, {})), list(events)) for k, events in enumerate(sessions)]
    return spark.createDataFrame(rows, TRAJECTORY)
