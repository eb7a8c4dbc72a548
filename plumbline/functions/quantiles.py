"""Exact quantiles by repeated narrowing: no sort, no sketch, and no column that meets in one task.

A quantile is one or two ranks of a column (of a group). The first pass counts values in buckets of a
monotone scale (sign and logarithm), with each bucket's least and greatest value. The counts tell
which bucket holds a rank. A rank is settled when it is the first or last of its bucket or all values of
the bucket are equal. The values of the other buckets that hold a rank are kept, all others
are never looked at again. While a kept bucket has more than ``FEW`` values it is cut into ``PARTS`` even
parts between its least and greatest value, counted, and narrowed the same way: those two end in
different parts, so every pass makes progress. At last the few values that are left are counted one by one.

Each pass shuffles one row per task and bucket. The input is read once, however it is made: its numbers
are settled first, and passes after the second read what that one kept. The number of passes
grows with the logarithm of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.skew import lookup_groups
from plumbline.session import settle

FEW = 10_000
PARTS = 4_096
#: Buckets for each doubling of the absolute value, and a shift that makes their numbers positive.
STEPS, SHIFT = 64, 70_000


def long_values(df: DataFrame, columns: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, column, non-null value)."""
    wide = df.select(
        *[F.col(b) for b in by],
        *[c.cast("double").alias(f"__v{i}") for i, c in enumerate(columns.values())],
    )
    pairs = ", ".join(f"'{name}', `__v{i}`" for i, name in enumerate(columns))
    return wide.select(*by, F.expr(f"stack({len(columns)}, {pairs}) AS (column, value)")).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def scale_bucket(value: Column) -> Column:
    """Bucket of a double on a scale that never falls as the value rises."""
    size = F.abs(value)
    step = F.when(size == float("inf"), F.lit(3 * SHIFT)).otherwise((F.floor(F.log2(size) * STEPS) + SHIFT).cast("int"))
    return F.when(value > 0, step).when(value < 0, -step).otherwise(F.lit(0))


def select_ranks(values: DataFrame, keys: Sequence[str], probabilities: Sequence[float], few: int = FEW, parts: int = PARTS) -> DataFrame:
    """``(*keys, n, target, value)``: for probability ``i`` the values at the ranks below (target ``2 i``) and above (``2 i + 1``)."""
    keys = list(keys)
    bucketed = values.withColumn("bucket", scale_bucket(F.col("value")))
    found = settle(_narrowed(bucketed, keys, _targets(probabilities)))
    done = [found.where("exact IS NOT NULL").select(*keys, "n", "target", F.col("exact").alias("value"))]
    open_ = found.where("exact IS NULL")
    most, ranks_left = open_.agg(F.max("c"), F.count("*")).first()
    rest = bucketed
    while most:
        held = open_.groupBy(*keys, "bucket").agg(F.min("lo").alias("lo"), F.min("hi").alias("hi"))
        rest = lookup_groups(rest.select(*keys, "bucket", "value"), held, [*keys, "bucket"], "inner", ranks_left)
        ranks = open_.groupBy(*keys, F.col("lo").alias("of")).agg(
            F.min("n").alias("n"), F.collect_list(F.struct("target", "rank")).alias("wanted")
        )  # a few per bucket: two for each probability
        if most <= few:  # what is left is counted value by value
            inside = rest.select(*keys, F.col("lo").alias("of"), "value", F.col("value").alias("bucket"))
        else:
            rest = settle(rest)
            even = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * parts)
            inside = rest.select(*keys, F.col("lo").alias("of"), "value", F.least(even, F.lit(parts - 1)).cast("int").alias("bucket"))
        found = _narrowed(inside, [*keys, "of"], ranks, ranks_left)
        if most <= few:
            done.append(found.select(*keys, "n", "target", F.col("exact").alias("value")))
            break
        found = settle(found)
        done.append(found.where("exact IS NOT NULL").select(*keys, "n", "target", F.col("exact").alias("value")))
        # A bucket is named by its least value from here on; kept values find it by their part.
        part = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * parts), F.lit(parts - 1)).cast("int")
        open_ = found.where("exact IS NULL").withColumn("bucket", F.struct("of", "bucket"))
        rest = rest.select(*keys, F.struct(F.col("lo").alias("of"), part.alias("bucket")).alias("bucket"), "value")
        most, ranks_left = open_.agg(F.max("c"), F.count("*")).first()
    return reduce(DataFrame.unionByName, done)


def _targets(probabilities: Sequence[float]) -> Column:
    """Ranks of a column of ``n`` values: below and above each probability's position."""
    return F.array(
        *[
            F.struct(F.lit(2 * i + side).alias("target"), cut((F.col("n") - 1) * F.lit(float(p))).cast("bigint").alias("rank"))
            for i, p in enumerate(probabilities)
            for side, cut in enumerate((F.floor, F.ceil))
        ]
    )


def _narrowed(values: DataFrame, keys: Sequence[str], wanted: Column | DataFrame, counted: int = 0) -> DataFrame:
    """For each wanted rank the bucket that holds it: ``*keys, bucket, target, rank`` in the bucket, ``c, lo, hi, n`` and,
    where the rank is settled, its value as ``exact``. At most ``PARTS`` or the scale's buckets per key."""
    counts = values.groupBy(*keys, "bucket").agg(F.count("*").alias("c"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    whole = Window.partitionBy(*keys)
    order = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("end", F.sum("c").over(order))
    if isinstance(wanted, DataFrame):
        counts = lookup_groups(counts, wanted, keys, "inner", counted)
    else:
        counts = counts.withColumn("n", F.sum("c").over(whole)).withColumn("wanted", wanted)
    first = F.col("end") - F.col("c")
    inside = F.filter("wanted", lambda w: (w["rank"] >= first) & (w["rank"] < F.col("end")))
    found = counts.select(*keys, "bucket", "c", "lo", "hi", "n", first.alias("first"), F.explode(inside).alias("w"))
    rank = F.col("w.rank") - F.col("first")
    exact = F.when(rank == 0, F.col("lo")).when((rank == F.col("c") - 1) | (F.col("lo") == F.col("hi")), F.col("hi"))
    return found.select(*keys, "bucket", "c", "lo", "hi", "n", F.col("w.target").alias("target"), rank.alias("rank"), exact.alias("exact"))


def quantile_table(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    few: int = FEW,
    parts: int = PARTS,
) -> DataFrame:
    """Linear-interpolation quantiles: rows ``(*by, column, n, <one per probability>)``; nulls and NaN are left out."""
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}
    keys = [*by, "column"]
    numbers = settle(df.select(*[F.col(b) for b in by], *[c.cast("double").alias(f"__q{i}") for i, c in enumerate(columns.values())]))
    values = long_values(numbers, {name: F.col(f"__q{i}") for i, name in enumerate(columns)}, by)
    picked = select_ranks(values, keys, list(probabilities.values()), few, parts)
    row = picked.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("target") == t, F.col("value"))).alias(f"__{t}") for t in range(2 * len(probabilities))],
    )
    out = []
    for i, (name, p) in enumerate(probabilities.items()):
        position = (F.col("n") - 1) * F.lit(float(p))
        part = position - F.floor(position)
        a, b = F.col(f"__{2 * i}"), F.col(f"__{2 * i + 1}")
        out.append(F.when(part == 0, a).otherwise(a + (b - a) * part).alias(name))
    return row.select(*keys, "n", *out)


def quantile_row(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probabilities: Mapping[str, float],
    few: int = FEW,
) -> DataFrame:
    """The same quantiles as one row with columns ``<column>_<probability name>``."""
    table = quantile_table(df, columns, probabilities, few=few)
    return table.agg(
        *[
            F.max(F.when(F.col("column") == c, F.col(p))).alias(f"{c}_{p}")
            for c in columns
            for p in probabilities
        ]
    )
