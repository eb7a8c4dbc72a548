"""Embedding near-duplicates: int8 tile products with a rigorous error bound.

Vectors are scaled to length one and quantised as ``u = s q + e``: q holds integers of -127 to
127, s is the vector's own step and e what is lost. For two vectors

    |u.v - s_u s_v (q_u.q_v)|  <=  |e_u| |s_v q_v| + |s_u q_u| |e_v| + |e_u| |e_v|

with the lengths measured per vector. The integer products of two tiles of vectors are one matrix
product (exact in float32 while dim * 127^2 < 2^24, else in float64). Pairs whose product plus
bound reaches the threshold are computed anew from the given numbers in double precision; no
other pair can reach it.

Vectors are compared only within a label (and length). Equal vectors are one node with a weight,
so copies cost nothing. The nodes of a label are dealt into tiles and pairs of tiles, so no task
holds more than two tiles, however large the label. A tile pair returns a count and one link per
vector, never its pairs. The products of a label grow with the square of its distinct vectors:
at a cosine of 0.98 the link distance (0.2) is wider than the spread of a coordinate of
64-dimensional vectors, so cells by pivots would send each vector nearly everywhere.

Null, zero and non-finite vectors and null labels link with nothing: no links, own component. A
null vec_id is never the smallest of a component; a component of null ids has a null id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pick
from plumbline.llm.components import components, forest, tiled
from plumbline.session import settle

THRESHOLD = 0.98
TILE_ROWS = 2048
SLACK = 1e-9  # above any rounding error of the bound's own arithmetic


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


class Quantised:
    """A tile: int8 numbers, steps, lengths of the quantised vectors and of what they lose."""

    def __init__(self, given: np.ndarray):
        exact = given.astype(np.float64)
        unit = exact / np.sqrt(np.einsum("ij,ij->i", exact, exact))[:, None]
        self.given = given
        self.step = np.abs(unit).max(axis=1) / 127
        self.numbers = np.rint(unit / self.step[:, None]).astype(np.int8)
        back = self.numbers * self.step[:, None]
        self.length = np.sqrt((back**2).sum(axis=1))
        self.lost = np.sqrt(((unit - back) ** 2).sum(axis=1))


def links(a: Quantised, b: Quantised, threshold: float, chunk: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of a, of b) with cosine of at least ``threshold``."""
    kind = np.float32 if a.numbers.shape[1] * 127**2 < 2**24 else np.float64
    right = b.numbers.astype(kind).T
    out_i, out_j = [], []
    for start in range(0, len(a.step), chunk):
        part = slice(start, start + chunk)
        product = (a.numbers[part].astype(kind) @ right).astype(np.float64)
        product *= a.step[part][:, None]
        product *= b.step[None, :]
        product += np.outer(a.lost[part], b.length + b.lost)
        product += np.outer(a.length[part], b.lost)
        i, j = np.nonzero(product >= threshold - SLACK)
        i += start
        for k in range(0, len(i), 65_536):
            own, other = i[k : k + 65_536], j[k : k + 65_536]
            keep = cosine(a.given[own], b.given[other]) >= threshold
            out_i.append(own[keep])
            out_j.append(other[keep])
    nothing = np.zeros(0, dtype=np.int64)
    return np.concatenate([nothing, *out_i]), np.concatenate([nothing, *out_j])


def tile_links(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Of one pair of tiles: per linked node, the copies it links with and the smallest node reached."""
    rows = rows.sort_values("node", kind="stable").reset_index(drop=True)
    same = rows["tile_a"].iloc[0] == rows["tile_b"].iloc[0]
    left = np.flatnonzero(rows["side"].to_numpy() == 0)
    right = left if same else np.flatnonzero(rows["side"].to_numpy() == 1)
    nothing = pd.DataFrame({"a": [], "b": [], "n": []}).astype({"a": str, "b": str, "n": np.int64})
    if not len(left) or not len(right):
        return nothing
    vectors = np.stack(rows["embedding"].to_numpy())
    of_left = Quantised(vectors[left])
    i, j = links(of_left, of_left if same else Quantised(vectors[right]), threshold)
    i, j = left[i], right[j]
    distinct = i != j
    i, j = i[distinct], j[distinct]
    weight = rows["copies"].to_numpy()
    count = np.bincount(i, weights=weight[j], minlength=len(rows)).astype(np.int64)
    if not same:
        count += np.bincount(j, weights=weight[i], minlength=len(rows)).astype(np.int64)
    root = forest(len(rows), i, j)
    some = count > 0
    node = rows["node"].to_numpy()
    return pd.DataFrame({"a": node[some], "b": node[root[some]], "n": count[some]})


def near_duplicates(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per vector."""
    taken = pick(rows, vec_id=vec_id, embedding=embedding, label=label)
    limit = float(np.finfo(np.float64).max)
    sound = (
        F.col("label").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= limit))
        & F.exists("embedding", lambda x: x != 0)
    )
    node = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(i), "label", "embedding")), 16, "0") for i in (1, 2)])
    keyed = taken.withColumn("node", F.when(F.coalesce(sound, F.lit(False)), node))
    members = settle(keyed.select("vec_id", "node"))
    nodes = settle(
        keyed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.first("embedding").alias("embedding"), F.first("label").alias("label"), F.count("*").alias("copies"),
             F.min("vec_id").alias("least"))
        .withColumn("dim", F.size("embedding"))
    )
    dealt = tiled(nodes.drop("least"), ["label", "dim"], "node", tile_rows)
    found = settle(
        dealt.groupBy("label", "dim", "tile_a", "tile_b").applyInPandas(
            lambda part: tile_links(part, threshold), "a string, b string, n bigint"
        )
    )
    roots = components(found.select("a", "b").distinct())
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    of_node = nodes.join(counts, F.col("node") == F.col("a"), "left").drop("a").join(
        roots.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left"
    )
    of_node = of_node.select("node", "least", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "node").alias("root"))
    smallest = of_node.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = settle(of_node.join(smallest, "root").select(
        F.col("node").alias("of"), (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id"
    ))  # a plain join: a hot vector can be split
    linked = members.join(labels, F.col("node") == F.col("of"), "left")
    out = linked.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
