"""Files in and out: JSON records, shards, fingerprints, dataset cards.

Raw records are read as text lines and parsed to VARIANT, so a bad line is a
row with an error and never fails the scan.  `.gz` is read as is.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.operators.ranking import global_rank

GLOB = "*.{jsonl,jsonl.gz}"


def _lines(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def read_jsonl(spark: SparkSession, path: str, strict: bool = False, glob: str | None = None) -> DataFrame:
    """(file, line text, raw VARIANT) per JSON object; blank lines go, bad ones too unless `strict`, which raises."""
    rows = _lines(spark, path, glob).withColumn("value", F.trim("value")).where("value <> ''")
    parsed = F.parse_json("value") if strict else F.try_parse_json("value")
    rows = rows.select("file", F.col("value").alias("line"), parsed.alias("raw"))
    return rows.where(F.col("raw").isNotNull() & F.startswith(F.col("line"), F.lit("{")))


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """Records of whole `.json` files: the objects of an array, or the single object."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path)
    files = files.select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("body"))
    items = F.when(F.startswith("body", F.lit("[")), F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>")).otherwise(F.array(F.try_parse_json("body")))
    rows = files.select("file", F.explode(items).alias("raw")).where(F.col("raw").isNotNull())
    rows = rows.withColumn("line", F.to_json("raw"))
    return rows.where(F.startswith("line", F.lit("{"))).select("file", "line", "raw")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below a path: .jsonl, .jsonl.gz and .json.  A missing path raises."""
    if path.endswith((".jsonl", ".jsonl.gz")):
        return read_jsonl(spark, path)
    if path.endswith(".json"):
        return read_json_documents(spark, path)
    return read_jsonl(spark, path, glob=GLOB).unionByName(read_json_documents(spark, path))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", compress: bool = False) -> int:
    """JSON lines without null fields; returns the number of rows."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode(mode).option("ignoreNullFields", True).option("compression", "gzip" if compress else "none").json(path)
    return int(seen.get["n"])


def shard_ids(df: DataFrame, order: list[str], shard_size: int) -> DataFrame:
    """Adds `shard`: rows in order, `shard_size` to a shard.

    Ranks come from a range partitioning and per-partition counts, so no task
    holds more than its range.
    """
    return global_rank(df, order, "_rank").withColumn("shard", F.floor((F.col("_rank") - 1) / shard_size).cast("int")).drop("_rank")


def write_shards(df: DataFrame, path: str, order: list[str], shard_size: int = 5000, compress: bool = False) -> int:
    """Shards as JSON lines below path/shard=N, overwritten as a whole; returns the number of shards."""
    rows = shard_ids(df, order, shard_size)
    rows.repartition("shard").write.mode("overwrite").partitionBy("shard").option("ignoreNullFields", True).option("compression", "gzip" if compress else "none").json(path)
    return rows.sparkSession.read.text(path).select("shard").distinct().count()


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: n_records and a fingerprint that does not depend on row order.

    Row hashes are summed in DECIMAL(38,0) over four 15-digit words, so equal
    rows do not cancel and nothing is collected.
    """
    h = F.sha2(F.to_json(F.struct(*[F.col(c) for c in (columns or df.columns)])), 256)
    word = lambda i: F.conv(F.substring(h, 1 + 12 * i, 12), 16, 10).cast("decimal(20,0)")
    sums = [F.coalesce(F.sum(word(i)), F.lit(0).cast("decimal(38,0)")).cast("string") for i in range(4)]
    return df.agg(F.count("*").alias("n_records"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), *sums), 256).alias("fingerprint"))


def dataset_card(df: DataFrame, name: str, chat_template: str | None = None, strata: DataFrame | None = None, pii: DataFrame | None = None, version: str = "1.0", extra: dict | None = None) -> dict:
    """The card of a dataset; reports are small aggregates."""
    stats = fingerprint(df).first()
    rows = lambda d: {str(r[0]): r[1] for r in d.collect()} if d is not None else {}
    return {
        "name": name,
        "created_at": datetime.now(timezone.utc).isoformat(),
        "record_count": stats["n_records"],
        "fingerprint": stats["fingerprint"],
        "fields": df.columns,
        "chat_template": chat_template,
        "pii_report": rows(pii),
        "strata": rows(strata),
        "version": version,
        "extra": extra or {},
    }


def write_card(spark: SparkSession, path: str, card: dict) -> None:
    spark.createDataFrame([(json.dumps(card, indent=2, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row per key by `order`."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")
