"""Local outlier factors tile by tile: no neighbour and no distance is shuffled.

1. Rows are dealt to the boxes and tiles of :mod:`plumbline.functions.neighbours`; each row bounds its radius in its own tile.
2. Rows visit the other boxes within that radius. What comes back is no hits but the rows that were hit, once for each tile
   that needs them: they are lent to it.
3. A tile finds the exact neighbours of its rows among its own and the lent rows. Neighbours are kept as places in these two
   lists, their distances are worked out again where they are needed.
4. Only one number for each lent row travels between tiles: first its k-distance, then its density.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import neighbours
from plumbline.functions.neighbours import CROWD_ROWS, MAX_PIVOTS, QUERY_ROWS, boxed, distances, search
from plumbline.session import collected, settle, spread

TINY = 1e-10  # keeps the density of repeated rows finite


def _everything(x: np.ndarray) -> np.ndarray:
    return np.ones((len(x), 1), dtype=bool)


def _found(own: pa.Table, lent: pa.Table, features: Sequence[str]) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """Own rows by key, and the lent rows' numbers behind theirs: all numbers, all keys, and the places of the lent rows.

    A row is lent once for each part of a box that was met; the first counts.
    """
    own = own.sort_by("key")
    keys, at = np.unique(lent.column("key").to_numpy(), return_index=True)
    x = np.vstack([neighbours._numbers(own, features), neighbours._numbers(lent, features)[at]]) if features else np.empty((0, 0))
    return own, x, np.concatenate([own.column("key").to_numpy(), keys]), at


def _near(own: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (own row, place of a neighbour) of a tile."""
    lists = own.column("near").combine_chunks()
    return np.repeat(np.arange(len(own)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()


def _means(who: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.bincount(who, weights=values, minlength=rows) / np.bincount(who, minlength=rows)


def local_factors(points: DataFrame, features: Sequence[str], k: int, box_rows: int = neighbours.BOX_ROWS) -> DataFrame:
    """``(key, lof)`` of ``points`` (settled; ``key``, unique and not null, and the features). Ties go to the smaller key.

    Rows without any neighbour are left out.
    """
    features = list(features)
    spark = points.sparkSession
    source = points.select(F.col("key").cast("bigint").alias("key"), *[F.col(f).cast("double").alias(f) for f in features])
    placed = boxed(source, features, box_rows, 1)
    tree, cut = placed.trees[0], placed.cut
    pivots, pivot_keys = placed.sample[:MAX_PIVOTS], placed.sample_keys[:MAX_PIVOTS]
    columns = ", ".join(["key bigint", *[f"`{f}` double" for f in features]])

    def bound(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        x, keys = neighbours._numbers(rows, features), rows.column("key").to_numpy()
        radius = np.full(len(x), np.inf)
        box = rows.column("box")[0].as_py()
        for others, names in ((x, keys), (pivots, pivot_keys)):
            # Where the tile has too few rows the sample gives the bound.
            open_ = np.flatnonzero(np.isinf(radius))
            endless = np.full(len(open_), np.inf)
            for who, _, _, d, rank in search(x[open_], keys[open_], _everything(open_), endless, others, names, _everything(others), k, tighten=True):
                radius[open_[who[rank == k - 1]]] = d[rank == k - 1]
        visited = [(keys[:0], keys[:0])]
        for start in range(0, len(x), QUERY_ROWS):
            who, near = tree.touched(x[start : start + QUERY_ROWS], radius[start : start + QUERY_ROWS])
            open_ = (cut[near] > 0) & ((near != box) | (cut[box] > 1))
            visited.append((who[open_] + start, near[open_]))
        who, near = (np.concatenate(part) for part in zip(*visited, strict=True))
        stops = pa.array(np.searchsorted(who, np.arange(len(x) + 1)), pa.int32())
        out = {name: rows.column(name) for name in ("key", *features, "box", "tile")}
        return pa.table(out | {"radius": pa.array(radius), "boxes": pa.ListArray.from_arrays(stops, pa.array(near, pa.int32()))})

    tiled = spread(placed.tiled.drop("tiles", "mine"), "box", "tile").groupBy("box", "tile")
    seekers = settle(tiled.applyInArrow(bound, f"{columns}, box int, tile int, radius double, boxes array<int>"))
    here = [F.col("box").alias("home"), F.col("tile").alias("home_tile")]
    visits = seekers.select("key", *features, "radius", *here, F.explode("boxes").alias("box"))
    arriving, hosting = placed.meeting(visits)

    def lend(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        home, tile, at = (np.empty(0, dtype=np.int64),) * 3
        if len(guests) and len(hosts):
            q, x = neighbours._numbers(guests, features), neighbours._numbers(hosts, features)
            homes, of = np.unique(np.column_stack([guests.column(c).to_numpy() for c in ("home", "home_tile")]), axis=0, return_inverse=True)
            of, wanted = of.reshape(-1).astype(np.int64), [at]
            radius = guests.column("radius").to_numpy()
            args = (_everything(q), radius, x, hosts.column("key").to_numpy(), _everything(x), k)
            for who, _, near, _, _ in search(q, guests.column("key").to_numpy(), *args, crowd=CROWD_ROWS):
                wanted.append(np.unique(of[who] * len(x) + near))
            of, at = np.divmod(np.unique(np.concatenate(wanted)), len(x))
            home, tile = homes[of, 0], homes[of, 1]
        out = {"home": pa.array(home, pa.int32()), "home_tile": pa.array(tile, pa.int32())}
        return pa.table(out | {name: hosts.column(name).take(pa.array(at)) for name in ("key", *features)})

    met = arriving.groupBy("box", "tile", "part").cogroup(hosting.groupBy("box", "tile", "part"))
    lent = settle(met.applyInArrow(lend, f"home int, home_tile int, {columns}"))
    # What earlier steps have shuffled goes before the next one writes.
    del tiled, visits, arriving, hosting, met
    collected(spark)

    def beside(own: DataFrame, more: DataFrame):
        """The rows of a tile beside those that are lent to it."""
        mine, theirs = spread(own, "box", "tile"), spread(more, "home", "home_tile")
        return mine.groupBy("box", "tile").cogroup(theirs.groupBy("home", "home_tile"))

    def neighbourhood(own: pa.Table, guests: pa.Table) -> pa.Table:
        own, x, keys, _ = _found(own, guests, features)
        n = len(own)
        pairs, farthest = [(keys[:0], keys[:0])], np.zeros(n)
        radius = own.column("radius").to_numpy()
        for who, _, near, d, _ in search(x[:n], keys[:n], _everything(x[:n]), radius, x, keys, _everything(x), k):
            pairs.append((who, near))
            np.maximum.at(farthest, who, d)
        who, near = (np.concatenate(part) for part in zip(*pairs, strict=True))
        by = np.argsort(who, kind="stable")
        stops = pa.array(np.searchsorted(who[by], np.arange(n + 1)), pa.int32())
        out = {name: own.column(name) for name in ("key", *features, "box", "tile")}
        return pa.table(out | {"number": pa.array(farthest), "near": pa.ListArray.from_arrays(stops, pa.array(near[by], pa.int32()))})

    kept = f"{columns}, box int, tile int, number double, near array<int>"
    local = settle(beside(seekers.drop("boxes"), lent).applyInArrow(neighbourhood, kept))
    del seekers
    collected(spark)

    def numbered(own: DataFrame) -> DataFrame:
        """The lent rows with the number that their own tile has found."""
        sent = own.where(F.size("near") > 0).select(F.col("key").alias("of"), F.col("number").alias("sent"))
        return lent.join(sent, F.col("key") == F.col("of")).drop("of")

    def density(own: pa.Table, guests: pa.Table) -> pa.Table:
        own, x, _, at = _found(own, guests, features)
        who, near = _near(own)
        number = np.concatenate([own.column("number").to_numpy(), guests.column("sent").to_numpy()[at]])
        reach = np.maximum(number[near], distances(x[who], x[near]))
        out = {name: own.column(name) for name in ("key", *features, "box", "tile", "near")}
        with np.errstate(divide="ignore"):
            out["number"] = pa.array(1.0 / (_means(who, reach, len(own)) + TINY))
        return pa.table(out).select(["key", *features, "box", "tile", "number", "near"])

    dense = settle(beside(local, numbered(local)).applyInArrow(density, kept))
    del local
    collected(spark)

    def factor(own: pa.Table, guests: pa.Table) -> pa.Table:
        own, _, keys, at = _found(own, guests, ())
        who, near = _near(own)
        number = np.concatenate([own.column("number").to_numpy(), guests.column("sent").to_numpy()[at]])
        lof = _means(who, number[near], len(own)) / number[: len(own)]
        some = np.diff(own.column("near").combine_chunks().offsets.to_numpy()) > 0
        return pa.table({"key": pa.array(keys[: len(own)][some], pa.int64()), "lof": pa.array(lof[some])})

    factors = settle(beside(dense.drop(*features), numbered(dense).drop(*features)).applyInArrow(factor, "key bigint, lof double"))
    del dense, lent
    collected(spark)
    return factors
