"""Sequence number and previous row per key, without gathering a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

C = F.col


def in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str],
             unit: str = "day", sequence: str = "sequence", previous: str = "previous"
             ) -> DataFrame:
    """Adds the row's position within its key and the ``carry`` columns of the row before it.

    ``order`` starts with a timestamp and must be unique per key. Rows are ordered inside (key,
    ``unit`` of time); one small row per such slice then links each slice to the one before. A key
    that owns a large share of all rows is thus spread over its days; choose a finer ``unit``
    where one day is too much.
    """
    sliced = df.withColumn("_slice", F.date_trunc(unit, order[0]))
    packed = F.struct(*order, *carry)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    placed = sliced.withColumns({"_pos": F.row_number().over(inside),
                                 "_prev": F.lag(packed).over(inside)})
    slices = sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"),
                                                 F.max(packed).alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_slice")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    linked = slices.select(*keys, "_slice",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.lag("_last").over(across).alias("_prev_slice"))
    joined = placed.join(linked, [*keys, "_slice"])
    return joined.withColumns({
        sequence: (C("_before") + C("_pos")).cast("bigint"),
        previous: F.coalesce("_prev", "_prev_slice"),
    }).drop("_slice", "_pos", "_prev", "_before", "_prev_slice")
