"""Running totals over ordered values without one global sort task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import settle


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """``df`` range-partitioned by ``order``, with the number of the range as ``__bucket``.

    Written to the checkpoint folder, since ranges come from a sample: a row keeps its number.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(df.repartitionByRange(parts, *order).withColumn("__bucket", F.spark_partition_id()))


def running_totals(totals: DataFrame, group: str, value: str, measures: Sequence[str]) -> DataFrame:
    """Add ``cum_<measure>`` and ``next_value`` to a table with one row per (group, value).

    Values are dealt into ranges; each is summed by itself and the offsets come from a table with
    one row per group and range. The result is exact wherever the ranges begin.
    """
    bucketed = ranged(totals, group, value)
    inner = Window.partitionBy(group, "__bucket").orderBy(value)
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    per_bucket = bucketed.groupBy(group, "__bucket").agg(
        F.min(value).alias("__first"), *[F.sum(m).alias(f"__t_{m}") for m in measures]
    )
    outer = Window.partitionBy(group).orderBy("__bucket")
    before = outer.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        F.col(group).alias("__group"),
        F.col("__bucket").alias("__of"),
        F.lead("__first").over(outer).alias("__next_first"),
        *[F.coalesce(F.sum(f"__t_{m}").over(before), F.lit(0)).alias(f"__o_{m}") for m in measures],
    )
    same = F.col(group).eqNullSafe(F.col("__group")) & (F.col("__bucket") == F.col("__of"))
    return (
        bucketed.join(offsets, same)
        .withColumns(
            {
                **{f"cum_{m}": F.sum(m).over(upto) + F.col(f"__o_{m}") for m in measures},
                "next_value": F.coalesce(F.lead(value).over(inner), F.col("__next_first")),
            }
        )
        .drop("__bucket", "__group", "__of", "__next_first", *[f"__o_{m}" for m in measures])
    )


def numbered(df: DataFrame, column: str, out: str) -> DataFrame:
    """Rows of distinct values with their rank from 0, counted range by range."""
    bucketed = ranged(df, column)
    before = Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = bucketed.groupBy(F.col("__bucket").alias("__of")).agg(F.count("*").alias("__n"))
    offsets = offsets.select("__of", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__bucket").orderBy(column)) - 1 + F.col("__before")
    joined = bucketed.join(offsets, F.col("__bucket") == F.col("__of"))
    return joined.withColumn(out, rank.cast("bigint")).drop("__bucket", "__of", "__before")
