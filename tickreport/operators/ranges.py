"""Rows in a total order over all tasks: global positions and per-range carries.

Rows are dealt by range of the order, sorted inside their range and *written once*
with the range's number.  Range bounds are sampled anew every time a plan runs, so
everything that needs "the same" ranges twice (offsets, carries) reads the copy and
does not depend on exchange reuse.  A series that fills many ranges is spread over
as many tasks, whatever its times look like.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: the row's place in its task


def ranged(df: DataFrame, order: Sequence[str], part: str = "_part", at: str = "_at") -> DataFrame:
    """A written copy of ``df`` with the number of the row's range and its place there."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return materialize(dealt.select("*", F.spark_partition_id().alias(part), place.alias(at)))


def numbered(df: DataFrame, order: Sequence[str], out: str = "_pos") -> DataFrame:
    """``df`` with ``out`` = 0, 1, ... in ``order``.  The ranges' first numbers come
    from a table of one row per range."""
    rows = ranged(df, order)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    return rows.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_at")).alias(out))
