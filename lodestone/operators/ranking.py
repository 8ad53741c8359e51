"""Global ranks without a single-partition window."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bits of monotonically_increasing_id() that number the rows of a partition
ROW_BITS = 33


def global_rank(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Adds the 1-based position of each row in the given order; columns of any sortable type.

    Rows are range-partitioned by the whole order and sorted within partitions,
    so equal leading columns do not share a task unless the whole order is
    equal.  A row's position is its place in the partition plus the sizes of
    the partitions before, of which one number each comes to the driver.  The
    ranged rows are kept on the executors' disks, because both passes must see
    the same ranges; a lost block is computed again with the same bounds.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).persist(StorageLevel.DISK_ONLY)
    part = F.shiftright("_at", ROW_BITS)
    before, total = {}, 0
    for r in sorted(ranged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()):
        before[r["p"]] = total
        total += r["n"]
    shift = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in before.items() for x in kv]), part) if before else F.lit(0)
    return ranged.withColumn(out, F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + shift + 1).drop("_at")
