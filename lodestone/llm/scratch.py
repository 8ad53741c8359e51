"""Intermediate tables in the folder that all executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading
it again, so a lost executor costs a re-run task and never the data.  Where
the session sets no such folder and runs in one process (tests, a laptop) one
is made under the temporary folder; on a cluster its absence is an error.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder as a URI or path, without a trailing slash."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/lodestone/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame that materialise() returned."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that no frame refers to any more; call it once the frames are deleted."""
    gc.collect()
    spark._jvm.System.gc()


def clear(spark: SparkSession) -> None:
    """Delete all that operators left in the shared folder; call it once results are written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/lodestone")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: rows of whole texts in one Arrow batch; bounds what a Python worker holds at once
TEXT_ROWS = 2000


def text_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches small enough for columns of whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


def parallelism(spark: SparkSession) -> int:
    """Partitions for an exchange: the session's setting for its data size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
