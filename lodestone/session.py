"""Session settings that the operators rely on, and the table loader."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "lodestone", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword settings use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt over all cores; larger scans stay as they are.

    For work that costs far more than moving the rows: a small file of one
    row group is one split, however much is done with each row.  What has an
    exchange in its plan gets its partitions there and is left alone.
    """
    execution = df._jdf.queryExecution()
    if "Exchange" in execution.executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if execution.toRdd().getNumPartitions() < cores else df


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint of the frame in the folder that the cluster names in spark.checkpoint.dir; cuts plan and lineage."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found:
            if not (spark.conf.get("spark.master", "") or "").startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            found = tempfile.mkdtemp(prefix="lodestone-")
        spark.sparkContext.setCheckpointDir(found)
    return df.checkpoint()
