"""Global positions of rows in a total order, without one task that holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

_ROW_BITS = 33  # monotonically_increasing_id: the row's place in its partition


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``part`` (its range of the order) and ``pos`` (0, 1, ... over
    the whole table).  Nulls come first, strings in UTF-8 byte order.

    Rows are dealt by range, sorted inside their range and written once with
    both numbers, so nothing depends on a second sampling of the range bounds;
    the ranges' first positions come from one row per range."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    written = saved(dealt.select("*", F.spark_partition_id().alias("part"), at.alias("at")), name)
    sizes = written.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part")) - F.col("rows")
    starts = sizes.select("part", before.alias("start"))  # at most one row per shuffle partition
    return written.join(F.broadcast(starts), "part").select(
        *df.columns, "part", (F.col("start") + F.col("at")).alias("pos"))
