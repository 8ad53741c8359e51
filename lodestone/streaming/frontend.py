"""Structured Streaming front ends.

Whole-trajectory logs are row-local through ingest, redaction and tagging:
stateless and safe in append mode.  Turn-by-turn logs are assembled by session
windows with a watermark; a session is emitted once its gap has passed, later
turns of it open a new session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.redact import redact_trajectories
from lodestone.operators.tagging import difficulty
from lodestone.plans.schema import VERSION, event
from lodestone.sources.adapters import normalize


def stream_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def stream_tagged(lines: DataFrame, base_time: Column) -> DataFrame:
    """Raw JSON lines to redacted, tagged trajectories."""
    rows = lines.select(F.col("value").alias("line"), F.try_parse_json("value").alias("raw")).where("raw IS NOT NULL")
    good, _ = normalize(rows, base_time)
    return difficulty(redact_trajectories(good))


def assemble(turns: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(session_id, ts, turn, role, text) to trajectories, by session windows."""
    rows = turns.withWatermark("ts", late).where(F.col("role").isin("user", "assistant"))
    one = F.struct("ts", "turn", event(kind=F.col("role"), role=F.col("role"), event_id=F.concat(F.lit("e_"), F.lpad(F.col("turn").cast("string"), 5, "0")), timestamp=F.col("ts"), content=F.col("text")).alias("e"))
    made = rows.groupBy("session_id", F.session_window("ts", gap)).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["e"]).alias("events"))
    null = F.lit(None).cast("string")
    return made.select("session_id", F.lit("stream").alias("source"), null.alias("domain"), F.lit(VERSION).alias("schema_version"), null.alias("lineage_id"), F.lit("{}").alias("tags"), "events")


def stream_counts(events: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Events and errors per tumbling window and type, late rows within the watermark included."""
    rows = events.withWatermark("ts", late)
    return rows.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("n_errors"))
