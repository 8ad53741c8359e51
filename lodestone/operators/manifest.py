"""Run manifests: content hashes of files, run ids, verification."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hash_bytes(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def hash_obj(obj) -> str:
    """SHA-256 of the key-sorted compact JSON."""
    return hash_bytes(json.dumps(obj, sort_keys=True, separators=(",", ":"), default=str).encode())


def file_entries(spark: SparkSession, path: str, role: str = "output", glob: str | None = None) -> DataFrame:
    """(path, bytes, sha256, role) of the files below a path, hashed where they are read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.lit(role).alias("role"))


def run_id(config_hash: str, started: datetime | None = None) -> str:
    started = started or datetime.now(timezone.utc)
    return f"run-{started:%Y%m%dT%H%M%SZ}-{config_hash[:8]}"


def manifest(config: dict, stages: dict[str, DataFrame], version: str, started: datetime | None = None) -> dict:
    """A manifest; `stages` maps names to file entry frames (one row per file)."""
    digest = hash_obj(config)
    return {
        "schema_version": "1.0",
        "run_id": run_id(digest, started),
        "pipeline_version": version,
        "created_at": datetime.now(timezone.utc).isoformat(),
        "config_hash": digest,
        "config_snapshot": config,
        "stages": [{"name": n, "files": [r.asDict() for r in f.orderBy("path").collect()]} for n, f in stages.items()],
    }


def recorded(spark: SparkSession, m: dict) -> DataFrame:
    rows = [(s["name"], f["path"], f["sha256"]) for s in m["stages"] for f in s["files"]]
    return spark.createDataFrame(rows, "stage string, path string, sha256 string")


def verify(known: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, problem) where a recorded file is missing or changed."""
    now = actual.select("path", F.col("sha256").alias("now"))
    problem = F.when(F.col("now").isNull(), "missing").when(F.col("now") != F.col("sha256"), "hash mismatch")
    return known.join(now, "path", "left").withColumn("problem", problem).where("problem IS NOT NULL").select("path", "problem")
