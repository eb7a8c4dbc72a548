"""Connected components of a link table, and tiles that bound the work on a large group."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import settle


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; root is the smallest node reachable.

    Large-star and small-star steps: each round links a node's neighbours to the smallest of
    them, so paths halve. Each round is aggregated before its shuffle and written to the
    checkpoint folder; links stay distributed. A link of a node with itself is allowed; no links
    give no rows.
    """
    edges = settle(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.where("u <> v").distinct())
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parent, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionByName(parent.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def tiled(df: DataFrame, key: list[str], spread: str, rows: int) -> DataFrame:
    """Rows dealt into tiles of about ``rows`` rows and pairs of tiles of a group.

    Adds ``tile_a``, ``tile_b`` and ``side`` (0: tile_a's row, 1: tile_b's). A group of n rows has
    t = ceil(n / rows) tiles; each row goes to the t pairs that hold its tile, so every two rows
    of a group meet in one pair and no task gets more than two tiles. ``spread`` deals the rows.
    """
    sizes = df.groupBy(*key).agg(F.ceil(F.count("*") / F.lit(rows)).cast("int").alias("tiles"))
    large = sizes.where("tiles > 1")
    own = F.pmod(F.xxhash64(F.lit(7), F.col(spread)), F.col("tiles")).cast("int")
    dealt = df.join(large, key, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return dealt.select(
        "*",
        F.least("own", "other").alias("tile_a"),
        F.greatest("own", "other").alias("tile_b"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    ).drop("tiles", "own", "other")


def per_group(
    df: DataFrame, key: list[str], function: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str
) -> DataFrame:
    """``function`` of the rows of each group, for many small groups: a task streams its groups in order.

    None stands for no rows. Results are handed on batch by batch. Groups must have a bounded size
    (see ``tiled``): a task holds one of them beside a batch.
    """

    def run(batches):
        rest: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            new = np.zeros(len(rows), dtype=bool)
            for k in key:
                values = rows[k].to_numpy()
                new[1:] |= values[1:] != values[:-1]
            cuts = np.concatenate([[0], np.flatnonzero(new)])
            found = (function(rows.iloc[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True))
            if found := [f for f in found if f is not None]:
                yield pd.concat(found, ignore_index=True)
            rest = rows.iloc[cuts[-1] :]
        if rest is not None and len(rest) and (last := function(rest)) is not None:
            yield last

    return df.repartition(*key).sortWithinPartitions(*key).mapInPandas(run, schema)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index that each of 0..n-1 reaches over the pairs (left, right)."""
    root = np.arange(n)
    if not len(left):
        return root
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
