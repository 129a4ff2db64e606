"""Dense numbers in a global order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def numbered(df: DataFrame, order: list[str | Column], name: str = "number", by: tuple[str, ...] = (),
             path: str | None = None) -> DataFrame:
    """``df`` with ``name`` = 0, 1, 2, ... by ``order``, whatever its
    partitions (ties of ``order`` may take each other's): sorted by range,
    written once (so that the numbers are fixed), then numbered by the sizes
    of the ranges before.  With ``by``, the numbers start anew for each group;
    a large group is still spread over ranges.  The sizes are a row for each
    range (and each group in it).  ``path`` is a folder for what is written
    (compressed more), which the caller deletes when the numbers are read."""
    spark = df.sparkSession
    packed = {"compression": "zstd"} if path else {}
    path = path or scratch_path(spark, "numbered")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at, part, shift = (f"{name}_{c}" for c in ("at", "part", "shift"))
    order = [*by, *order]
    rows = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows.withColumn(at, F.monotonically_increasing_id()).write.options(**packed).parquet(path)
    rows = spark.read.parquet(path).withColumn(part, F.shiftright(at, 33))
    before = F.sum("size").over(Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.groupBy(part, *by).agg(F.count("*").alias("size"), F.min(at).alias("first"))
    sizes = sizes.select(part, *by, (F.coalesce(before, F.lit(0)) - F.col("first")).alias(shift))
    joined = rows.join(sizes if by else F.broadcast(sizes), [part, *by])
    return joined.select(*df.columns, (F.col(at) + F.col(shift)).alias(name))
