"""Positions in a global order without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored


def with_ordinals(df: DataFrame, order: list, name: str = "ordinal", parts: int | None = None) -> DataFrame:
    """df with a 1-based position by the order's columns, whose values should be unique.

    Rows are range-partitioned and sorted; only one count for each partition meets in one place, as offsets that are joined
    back by a broadcast of as many rows as there are partitions. Ranges come from a sample that another run of the plan would
    draw anew, so rows are stored with their places before they are counted.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the id's upper bits are the partition, its lower 33 bits the place there
    ranged = ranged.withColumn("_id", F.monotonically_increasing_id())
    ranged = ranged.withColumn("_part", F.shiftright("_id", 33)).withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    ranged = stored(ranged.drop("_id"))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("_before"))
    return ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before")
