"""Exact k nearest neighbours of every row, spread over boxes of the space.

1. A bounded sample gives a tree of boxes (a k-d tree with a branch for nulls).
   Every row falls into one box; a box with many rows is cut into tiles. Rows without a column that the tree
   often splits on would have to visit most boxes. They search a view of their own: a second tree over all rows
   that does not look at that column.
2. Each row finds its k nearest rows inside its own tile: small groups of near rows are measured against the small
   blocks of rows that come within reach, as products of matrices. The k-th distance is
   an upper bound on the true one. Where the tile has too few rows to find, the sample gives the bound.
3. The row then visits just the other boxes that come closer than this bound, and
   the best k over its own tile and all visits are kept.

The box distances are lower bounds also where a coordinate is null, so the
result is exact for the null-aware Euclidean distance
``sqrt(p / m * sum of squared differences over the m coordinates both rows have)``.
Every group handed to a Python worker has a bounded number of rows, and no pair
of rows is written out unless it is among the k best of a visit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import settle, spread

BOX_ROWS = 40_000  # rows aimed at per box
TILE_ROWS = 60_000  # most rows of a box handled by one task; boxes of an even tree stay below it
BLOCK_ROWS = 16  # most rows of a block inside one tile
GROUP_ROWS = 32  # most queries measured together
SPAN_ROWS = 128  # rows of the tile in the room of such a group
QUERY_ROWS = 1_024  # queries that go through the tree of all boxes together
VIEW_QUERIES = 64  # queries that lack a column for which the points are put into blocks without it
NEAR_ROWS, NEAR_EACH = 128, 20  # rows, and rows for each wanted neighbour, in the nearest blocks, which bound a radius first
EVEN_BLOCKS = 32  # blocks from everywhere that bound it where these do not
NARROW = 0.02  # of the widest column's mean deviation: narrower ones don't tell blocks apart
SLACK = 1e-13  # share of a row's squares by which products may be off
CROWD_ROWS = 1_024  # a visitor that would meet more rows than this has its radius bounded by some of them first
PAIRS = 50_000  # pairs measured at a time, more only where one query meets more rows
VISITOR_ROWS = 5_000  # visiting rows per task: this, or twice the rows of the box if that is more
MAX_BOXES = 16_384
SAMPLE_PER_BOX = 20
PIVOT_ROWS = 256  # least rows of the sample
BOUND_SHARE = 200  # every so many rows one that bounds radii
MAX_PIVOTS = 65_536  # rows of the sample that bound radii at most
MAX_VIEWS = 4  # trees at most; each brings all rows once more
VIEW_VISITS = 0.25  # a view pays when the visits it saves are this many for each row of the table


@dataclass(frozen=True)
class BoxTree:
    """Split nodes (``axis < 0`` marks a box) and the bounds of the boxes."""

    axis: np.ndarray
    cut: np.ndarray
    child: np.ndarray  # (nodes, 3): at or below the cut, above it, null; or the box number
    low: np.ndarray  # (boxes, p); NaN where the coordinate is null in the box
    high: np.ndarray

    def locate(self, points: np.ndarray) -> np.ndarray:
        """Box number of every point."""
        node = np.zeros(len(points), dtype=np.int64)
        rows = np.arange(len(points))
        while True:
            axis = self.axis[node]
            open_ = axis >= 0
            if not open_.any():
                return self.child[node, 0]
            at, who = node[open_], rows[open_]
            value = points[who, axis[open_]]
            side = np.where(np.isnan(value), 2, (value > self.cut[at]).astype(np.int64))
            node[open_] = self.child[at, side]

    def touched(self, points: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (point, box), sorted by point, of the boxes that may hold something within ``radius``.

        Goes down the tree for all points at once; only branches within reach are followed.
        """
        # Two rows share at most the coordinates that the point has.
        shared = np.maximum((~np.isnan(points)).sum(axis=1), 1) / points.shape[1]
        limit = (radius**2 * (1 + 1e-9) + 1e-12) * shared
        reach = np.sqrt(limit) * (1 + 1e-9)
        who, node = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
        found = [(who[:0], node[:0])]
        while len(who):
            axis = self.axis[node]
            at_box = axis < 0
            found.append((who[at_box], self.child[node[at_box], 0]))
            who, node, axis = who[~at_box], node[~at_box], axis[~at_box]
            gap, far, child = points[who, axis] - self.cut[node], reach[who], self.child[node]
            null = np.isnan(gap)
            below, above, absent = null | (gap <= far), null | (-gap <= far), child[:, 2] > 0
            who = np.concatenate([who[below], who[above], who[absent]])
            node = np.concatenate([child[below, 0], child[above, 1], child[absent, 2]])
        who, box = (np.concatenate(x) for x in zip(*found, strict=True))
        apart = np.zeros(len(who))
        for j in range(points.shape[1]):
            q = points[who, j]
            apart += np.fmax(np.fmax(self.low[box, j] - q, q - self.high[box, j]), 0.0) ** 2
        near = apart <= limit[who]
        who, box = who[near], box[near]
        order = np.lexsort((box, who))
        return who[order], box[order]


def box_tree(sample: np.ndarray, boxes: int) -> BoxTree:
    """Split a sample into about ``boxes`` boxes of equal size, widest axis first."""
    p = sample.shape[1]
    axis, cut, child, low, high = [], [], [], [], []

    def leaf(node: int, lo: np.ndarray, hi: np.ndarray) -> None:
        child[node] = [len(low)] * 3
        low.append(lo)
        high.append(hi)

    todo = [(-1, 0, np.arange(len(sample)), boxes, np.full(p, -np.inf), np.full(p, np.inf))]
    while todo:
        parent, side, rows, share, lo, hi = todo.pop()
        node = len(axis)
        axis.append(-1)
        cut.append(0.0)
        child.append([0, 0, 0])
        if parent >= 0:
            child[parent][side] = node
        split = _best_split(sample[rows], lo) if share > 1 else None
        if split is None:
            leaf(node, lo, hi)
            continue
        j, at = split
        axis[node], cut[node] = j, at
        column = sample[rows, j]
        sides = [column <= at, column > at]
        if np.isneginf(lo[j]) and np.isposinf(hi[j]):
            sides.append(np.isnan(column))  # below a first split the column is never null
        for s, mask in enumerate(sides):
            nlo, nhi = lo.copy(), hi.copy()
            if s == 0:
                nhi[j] = at
            elif s == 1:
                nlo[j] = at
            else:
                nlo[j] = nhi[j] = np.nan
            part = max(1, round(share * mask.sum() / max(len(rows), 1)))
            todo.append((node, s, rows[mask], part, nlo, nhi))
    return BoxTree(np.array(axis), np.array(cut), np.array(child), np.array(low), np.array(high))


def _best_split(points: np.ndarray, lo: np.ndarray) -> tuple[int, float] | None:
    """Widest axis and its median, or the greatest value below the top where half the values are the top."""
    if len(points) < 2:
        return None
    known = ~np.isnan(points)
    counts = known.sum(axis=0)
    value = np.where(known, points, 0.0)
    with np.errstate(invalid="ignore"):
        spread_ = np.where(known, value - value.sum(axis=0) / np.maximum(counts, 1), 0.0)
        width = (spread_**2).sum(axis=0) / np.maximum(counts, 1)
    width[np.isnan(lo) | (counts < 2) | ~np.isfinite(width)] = 0.0
    for j in np.argsort(-width, kind="stable"):
        if width[j] <= 0:
            break
        column = points[known[:, j], j]
        top = column.max()
        if top == column.min():
            continue
        at = np.median(column)
        return int(j), float(at if at < top else column[column < top].max())
    return None


def seeker_views(sample: np.ndarray, boxes: int, most: int = MAX_VIEWS) -> list[tuple[list[int], BoxTree]]:
    """Hidden columns and tree of each view; the first hides nothing.

    A row without column ``c`` must follow both sides of every split on ``c``. Where the rows that would do so are
    many enough, counted in the sample, they get a tree without ``c``.
    """
    absent = np.isnan(sample)
    views: list[tuple[list[int], BoxTree]] = []
    todo: list[list[int]] = [[]]
    while todo and len(views) < most:
        hidden = todo.pop(0)
        seen = sample.copy()
        seen[:, hidden] = np.nan
        tree = box_tree(seen, boxes)
        views.append((hidden, tree))
        for c in np.unique(tree.axis[tree.axis >= 0]):
            more = sorted([*hidden, int(c)])
            share = absent[:, more].all(axis=1).mean()
            if more not in todo and share * (tree.axis == c).sum() >= VIEW_VISITS:
                todo.append(more)
    return views


def view_of(points: np.ndarray, hidden: Sequence[Sequence[int]]) -> np.ndarray:
    """Number of the view a row searches: the one that hides most of the columns it lacks, and none that it has."""
    out, most = np.zeros(len(points), dtype=np.int64), np.zeros(len(points), dtype=np.int64)
    for v, columns in enumerate(hidden):
        better = np.isnan(points[:, list(columns)]).all(axis=1) & (len(columns) > most)
        out[better], most[better] = v, len(columns)
    return out


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Null-aware Euclidean distances, row by row; infinite where no coordinate is shared."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        gap = queries - points
        absent = np.isnan(gap)
        gap *= gap
        if not absent.any():
            return np.sqrt(gap.sum(axis=1))
        gap[absent] = 0.0
        shared = queries.shape[1] - absent.sum(axis=1)
        scaled = gap.sum(axis=1) * (queries.shape[1] / shared)
    return np.where(shared > 0, np.sqrt(scaled), np.inf)


def arranged(x: np.ndarray, rows: int) -> np.ndarray:
    """Row numbers in blocks of near rows, one line per block of at most ``rows``; -1 fills a line up.

    All blocks are halved on their widest column until they are small enough; nulls come last.
    """
    levels = max(0, math.ceil(math.log2(max(len(x), 1) / rows)))
    size = -(-len(x) // (1 << levels))
    order = np.full(size << levels, -1)
    order[: len(x)] = np.arange(len(x))
    padded = np.vstack([x, np.full((1, x.shape[1]), np.nan)])
    for level in range(levels):
        parts = order.reshape(1 << level, -1)
        held = padded[parts]
        known = np.isfinite(held)
        n = np.maximum(known.sum(axis=1), 1)
        held = np.where(known, held, 0.0)
        with np.errstate(over="ignore", invalid="ignore"):
            gap = np.where(known, held - (held.sum(axis=1) / n)[:, None], 0.0)
            width = np.einsum("smc,smc->sc", gap, gap) / n
        axis = np.argmax(np.where(np.isfinite(width), width, np.finfo(float).max), axis=1)
        value = padded[parts, axis[:, None]]
        order = np.take_along_axis(parts, np.argpartition(value, parts.shape[1] // 2, axis=1), axis=1)
    blocks = order.reshape(1 << levels, -1)
    return blocks[(blocks >= 0).any(axis=1)]


@dataclass(frozen=True)
class Factors:
    """Rows in a form whose products are squared distances.

    ``seek`` (as queries) times ``meet`` (as points) gives at most the sum of squares over the shared columns; ``size`` times
    ``SLACK`` of both rows, added, at least that. ``known`` counts shared columns, None where no column is null.
    ``plain``: numbers whose squares are no numbers are subtracted one by one instead.
    """

    x: np.ndarray
    seek: np.ndarray
    meet: np.ndarray
    size: np.ndarray
    known: np.ndarray | None
    plain: bool

    @staticmethod
    def of(x: np.ndarray, middle: np.ndarray, nulls: bool, plain: bool) -> Factors:
        known = ~np.isnan(x)
        with np.errstate(over="ignore", invalid="ignore"):
            z = np.where(known, x - middle, 0.0)
            square = z * z
            size = square.sum(axis=1)
            if nulls:
                w = known.astype(float)
                seek, meet = np.hstack([-2 * z, square * (1 - SLACK), w]), np.hstack([z, w, square * (1 - SLACK)])
                return Factors(x, seek, meet, size, w, plain)
            low, one = (size * (1 - SLACK))[:, None], np.ones((len(x), 1))
            return Factors(x, np.hstack([-2 * z, low, one]), np.hstack([z, one, low]), size, None, plain)

    def squares(self, own: np.ndarray, other: Factors, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
        """Sums of squares of ``own`` rows to ``rows`` of another, and the number of shared columns."""
        p = self.x.shape[1]
        if not self.plain:
            total = self.seek.take(own, axis=0) @ other.meet.take(rows, axis=0).T
            return total, p if self.known is None else self.known.take(own, axis=0) @ other.known.take(rows, axis=0).T
        total, shared = np.zeros((len(own), len(rows))), np.full((len(own), len(rows)), float(p))
        with np.errstate(invalid="ignore", over="ignore"):
            for c in range(p):
                gap = self.x[own, c][:, None] - other.x[rows, c]
                gap *= gap
                shared -= np.isnan(gap)
                total += np.fmax(gap, 0.0)
        return total, shared


@dataclass(frozen=True)
class Layout:
    """Points in blocks: ``line`` tells which row is at a place, ``first`` and ``filled`` the places of a block."""

    axes: np.ndarray
    line: np.ndarray
    first: np.ndarray
    filled: np.ndarray
    low: np.ndarray
    high: np.ndarray
    factors: Factors

    @staticmethod
    def of(by: np.ndarray, points: np.ndarray, axes: np.ndarray, middle: np.ndarray, nulls: bool, plain: bool) -> Layout:
        """Blocks of rows that are near in ``by``, with their bounds on the ``axes`` of ``points``."""
        blocks = arranged(by, BLOCK_ROWS)
        filled = (blocks >= 0).sum(axis=1)
        line = blocks[blocks >= 0]
        return Layout(axes, line, np.cumsum(filled) - filled, filled, *_corners(points, blocks, axes), Factors.of(points[line], middle, nulls, plain))


@dataclass(frozen=True)
class Pairs:
    """All pairs of some queries and some points."""

    queries: np.ndarray
    points: np.ndarray

    def __len__(self) -> int:
        return len(self.queries) * len(self.points)


def _near(queries: Factors, pairs: Pairs, points: Factors, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (query, point) whose squared distance may be at most ``most`` of the query, with a margin."""
    total, shared = queries.squares(pairs.queries, points, pairs.points)
    far = ((most * (1 + 1e-8) + 1e-12) / queries.x.shape[1])[:, None]
    at = np.flatnonzero(total <= far * shared)
    if isinstance(shared, np.ndarray):
        at = at[shared.ravel()[at] > 0]
    i, j = np.divmod(at, len(pairs.points))
    return pairs.queries[i], pairs.points[j]


def _reach(queries: Factors, pairs: Pairs, points: Factors, same: np.ndarray, wants: np.ndarray, offers: np.ndarray, k: int) -> np.ndarray:
    """At least the distance within which each query has k points of each wanted target (0 where unwanted); infinite where
    there are fewer. ``same``: pairs of equal keys, which don't count."""
    out = np.zeros(wants.shape)
    if len(pairs.points) < k:
        return np.where(wants, np.inf, out)
    d, shared = queries.squares(pairs.queries, points, pairs.points)
    if isinstance(shared, np.ndarray):
        d = d * (queries.x.shape[1] / shared)
        d[shared <= 0] = np.inf
    if queries.plain:
        d[np.isnan(d)] = np.inf
    d[same] = np.inf
    off = 2 * SLACK * queries.x.shape[1] * (queries.size[pairs.queries] + points.size[pairs.points].max()) if not queries.plain else np.zeros(len(d))
    for t in range(wants.shape[1]):
        asking = np.flatnonzero(wants[:, t])
        if len(asking):
            serving = d[asking] if len(asking) < len(d) else d
            if not offers[:, t].all():
                serving = np.where(offers[:, t], serving, np.inf)
            kth = np.partition(serving, k - 1, axis=1)[:, k - 1]
            out[asking, t] = np.sqrt(np.maximum(kth, 0.0) + off[asking]) * (1 + 1e-9)
    return out


def search(
    queries: np.ndarray,
    query_keys: np.ndarray,
    wants: np.ndarray,
    radius: np.ndarray,
    points: np.ndarray,
    point_keys: np.ndarray,
    offers: np.ndarray,
    k: int,
    tighten: bool = False,
    crowd: int | None = None,
) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]]:
    """The k nearest points of each query within its radius, per target; ties go to the smaller key.

    ``wants[q, t]`` and ``offers[x, t]`` tell which targets a query needs and a point can serve. ``tighten``: the blocks
    nearest to a few queries bound their radius first; ``crowd``: only that of queries with more points within reach.
    Near queries go together, and so do near points: what is measured are products of blocks.
    Yields (query numbers, target, point numbers, distances, ranks from 0), sorted by query and rank.
    """
    if not len(queries) or not len(points):
        return
    p = points.shape[1]
    wants = wants & offers.any(axis=0)  # nothing is looked for that no point has
    asking = np.flatnonzero(wants.any(axis=1))
    nulls = bool(np.isnan(points).any() or np.isnan(queries).any())
    # Squares of these are no numbers that could be added up.
    plain = bool((np.abs(points) > 1e150).any() or (np.abs(queries) > 1e150).any())
    with np.errstate(invalid="ignore", over="ignore"):
        finite = np.where(np.isfinite(points), points, 0.0)
        known = np.maximum(np.isfinite(points).sum(axis=0), 1)
        middle = finite.sum(axis=0) / known
        width = np.where(np.isfinite(points), np.abs(points - middle), 0.0).sum(axis=0) / known
    middle = np.where(np.isfinite(middle), middle, 0.0)
    # The columns that keep blocks apart; a sum over some columns is a lower bound too.
    width = np.where(np.isfinite(width), width, np.finfo(float).max)
    axes = np.flatnonzero(width >= NARROW * width.max())
    sought = Factors.of(queries, middle, nulls, plain)
    shared = np.maximum((~np.isnan(queries)).sum(axis=1), 1) / p
    found: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0
    limit = radius.astype(float)
    # A group lacks the same of these columns, so that what it lacks doesn't open all of a neighbouring group's.
    lacks = np.isnan(queries[asking][:, axes]) @ (1 << np.arange(len(axes)))
    usual, few = None, -(-(NEAR_ROWS + NEAR_EACH * k) // BLOCK_ROWS)
    for pattern in np.unique(lacks):
        some = asking[lacks == pattern]
        # Blocks that were split on a column that these queries lack would be met nearly all.
        hidden = axes[(pattern >> np.arange(len(axes))) & 1 == 1]
        if len(hidden) and len(some) >= VIEW_QUERIES:
            left = np.delete(np.arange(p), hidden)
            tell = left[width[left] >= NARROW * width[left].max(initial=0.0)]
            laid = Layout.of(points[:, left], points, tell, middle, nulls, plain)
        else:
            laid = usual = usual or Layout.of(points, points, axes, middle, nulls, plain)
        first, filled, line, met = laid.first, laid.filled, laid.line, laid.factors
        held, names, gives = met.x, point_keys[line], offers[line]
        even = np.unique(np.linspace(0, len(filled) - 1, EVEN_BLOCKS).astype(np.int64))
        together = int(min(GROUP_ROWS, max(1, round(SPAN_ROWS * len(some) / len(points)))))
        for group in arranged(queries[some][:, laid.axes], together):
            own = some[group[group >= 0]]
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                apart = _apart(queries[own][:, laid.axes], laid.low, laid.high)
                near = _within(apart, limit[own], shared[own])
                if tighten or (crowd is not None and filled[near].sum() > crowd):
                    closest = near if len(near) <= few else near[np.argpartition(apart[near], few - 1)[:few]]
                    bound = np.full((len(own), wants.shape[1]), np.inf)
                    for chosen in (closest, even):
                        rows = _lines(first, filled, chosen)
                        same = query_keys[own][:, None] == names[rows]
                        bound = np.minimum(bound, _reach(sought, Pairs(own, rows), met, same, wants[own], gives[rows], k))
                        if not np.isinf(bound).any():
                            break  # else rows from everywhere
                    limit[own] = np.minimum(limit[own], bound.max(axis=1, initial=0.0))
                    near = _within(apart, limit[own], shared[own])
                rows, ready = _lines(first, filled, near), []
                # As many whole queries as fit, one at least.
                step = max(1, PAIRS // max(len(rows), 1))
                for start in range(0, len(own), step):
                    part = own[start : start + step]
                    found.append(_near(sought, Pairs(part, rows), met, limit[part] ** 2))
                    count += len(found[-1][0])
                    if count >= PAIRS:
                        ready += _ranked(queries, query_keys, wants, limit, held, names, gives, k, found, line)
                        found, count = [], 0
            yield from ready
        if found:
            yield from _ranked(queries, query_keys, wants, limit, held, names, gives, k, found, line)
            found, count = [], 0


def _within(apart: np.ndarray, radius: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The blocks within reach of any of the queries; ``shared``: share of the columns that a query has."""
    return np.flatnonzero(apart <= ((radius**2 * (1 + 1e-9) + 1e-12) * shared).max())


def _corners(x: np.ndarray, blocks: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest values of each block, a line per axis; without bounds where a value is null."""
    low, high = np.empty((len(axes), len(blocks))), np.empty((len(axes), len(blocks)))
    for a, c in enumerate(axes):
        value = x[:, c][blocks]
        absent = blocks < 0
        low[a] = np.where(absent, np.inf, np.where(np.isnan(value), -np.inf, value)).min(axis=1)
        high[a] = np.where(absent, -np.inf, np.where(np.isnan(value), np.inf, value)).max(axis=1)
    return low, high


def _apart(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """At most the sum of squares between any of these queries and any row of each block."""
    out = np.zeros(low.shape[1])
    for a in range(len(low)):
        value = queries[:, a]
        least, most = value.min(), value.max()
        if least != least:  # a query lacks this column
            continue
        with np.errstate(invalid="ignore", over="ignore"):
            gap = np.fmax(low[a] - most, least - high[a])
            np.fmax(gap, 0.0, out=gap)
            gap *= gap
            out += gap
    return out


def _lines(first: np.ndarray, filled: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The places of the rows of some blocks."""
    size = filled[blocks]
    rows = first[blocks][:, None] + np.arange(size.max(initial=0))
    full = len(size) == 0 or size.min() == rows.shape[1]
    return rows.ravel() if full else rows[np.arange(rows.shape[1]) < size[:, None]]


def _ranked(
    queries: np.ndarray,
    query_keys: np.ndarray,
    wants: np.ndarray,
    limit: np.ndarray,
    points: np.ndarray,
    point_keys: np.ndarray,
    offers: np.ndarray,
    k: int,
    found: Sequence[tuple[np.ndarray, np.ndarray]],
    line: np.ndarray,
) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]]:
    """The k nearest of the pairs ``found`` (all of a query are among them), in the form of :func:`search`."""
    i, j = (np.concatenate(part) for part in zip(*found, strict=True))
    other = query_keys[i] != point_keys[j]
    i, j = i[other], j[other]
    d = distances(queries.take(i, axis=0), points.take(j, axis=0))
    kept = d <= limit[i] * (1 + 1e-9)
    i, j, d = i[kept], j[kept], d[kept]
    by = np.argsort(d)
    by = by[np.argsort(i[by], kind="stable")]
    level = i[by][1:], d[by][1:]
    if ((level[0] == i[by][:-1]) & (level[1] == d[by][:-1])).any():
        by = np.lexsort((point_keys[j], d, i))
    i, j, d = i[by], j[by], d[by]
    for t in range(wants.shape[1]):
        fit = wants[i, t] & offers[j, t]
        some, at, far = i[fit], j[fit], d[fit]
        rank = np.arange(len(some)) - np.searchsorted(some, some)
        best = rank < k
        yield some[best], t, line[at[best]], far[best], rank[best]


@dataclass(frozen=True)
class Boxed:
    """A table dealt to the boxes of its trees: all rows once for each tree, a box in ``cut`` tiles."""

    hidden: list[list[int]]
    trees: list[BoxTree]
    first_box: np.ndarray
    sample: np.ndarray
    sample_keys: np.ndarray
    tiled: DataFrame
    tiles: DataFrame
    filled: dict[int, int]
    cut: np.ndarray

    def meeting(self, visits: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows that visit and the rows of the visited tiles, by ``box, tile, part``; ``visits`` has a row per row and box."""
        spark = visits.sparkSession
        # A hot box is met in parts; each part brings the rows of a tile once more.
        crowd = visits.groupBy("box").agg(F.count("*").alias("n")).collect()
        sizes = [(r["box"], -(-r["n"] // max(VISITOR_ROWS, 2 * min(self.filled[r["box"]], TILE_ROWS)))) for r in crowd]
        parts = spark.createDataFrame(sizes, "box int, parts int")
        # Both tables have one row per box; inner joins leave out boxes without visitors.
        arriving = (
            visits.join(F.broadcast(self.tiles), "box")
            .join(F.broadcast(parts), "box")
            .withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
            .where((F.col("box") != F.col("home")) | (F.col("tile") != F.col("home_tile")))
            .drop("tiles", "parts")
        )
        hosting = (
            self.tiled.join(F.broadcast(parts), "box")
            .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
            .drop("tiles", "parts", "mine")
        )
        return spread(arriving, "box", "tile", "part"), spread(hosting, "box", "tile", "part")


def boxed(source: DataFrame, features: Sequence[str], box_rows: int, most_views: int) -> Boxed:
    """``source`` (settled; ``key`` and the features) dealt to boxes of about ``box_rows`` rows."""
    spark = source.sparkSession
    rows = source.count()
    # Small tables still get enough boxes to keep every core busy.
    busy = min(2 * spark.sparkContext.defaultParallelism, rows // 500)
    boxes = int(min(MAX_BOXES, max(1, rows // box_rows, busy)))
    # The sample is bounded by MAX_BOXES * SAMPLE_PER_BOX rows; it shapes the boxes and bounds radii, not the result.
    wanted = max(boxes * SAMPLE_PER_BOX, PIVOT_ROWS, min(rows // BOUND_SHARE, MAX_PIVOTS // 2))
    every = max(1, rows // wanted)
    sample = (
        source.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).limit(2 * wanted).toPandas().sort_values("key")
    )
    drawn = sample[features].to_numpy(dtype=float)
    views = seeker_views(drawn, boxes, most_views)
    hidden, trees = [h for h, _ in views], [tree for _, tree in views]
    # Boxes are numbered through all views.
    first_box = np.cumsum([0, *[len(tree.low) for tree in trees]])
    fields = [T.StructField("key", T.LongType()), *[T.StructField(f, T.DoubleType()) for f in features]]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[features].to_numpy(dtype=float)
            view = view_of(x, hidden)
            for v, tree in enumerate(trees):
                yield pdf.assign(box=(tree.locate(x) + first_box[v]).astype("int32"), mine=view == v)

    placed = source.mapInPandas(
        place, T.StructType([*fields, T.StructField("box", T.IntegerType()), T.StructField("mine", T.BooleanType())])
    )
    # At most a few times MAX_BOXES rows: one per box.
    filled = {r["box"]: r["n"] for r in placed.groupBy("box").agg(F.count("*").alias("n")).collect()}
    tiles = spark.createDataFrame([(b, -(-n // TILE_ROWS)) for b, n in filled.items()], "box int, tiles int")
    tiled = placed.join(F.broadcast(tiles), "box").withColumn("tile", F.pmod(F.xxhash64("key"), "tiles").cast("int"))
    cut = np.zeros(first_box[-1], dtype=np.int64)  # tiles of a box, 0 where it is empty
    for b, n in filled.items():
        cut[b] = -(-n // TILE_ROWS)
    return Boxed(hidden, trees, first_box, drawn, sample["key"].to_numpy(), tiled, tiles, filled, cut)


def _numbers(rows: pa.Table, features: Sequence[str]) -> np.ndarray:
    return np.column_stack([rows.column(f).to_numpy().astype(float) for f in features])


def nearest(
    points: DataFrame,
    key: str,
    features: Sequence[str],
    k: int,
    targets: Sequence[str] | None = None,
    box_rows: int = BOX_ROWS,
) -> DataFrame:
    """The k nearest other rows of every row: ``(key, target, neighbour, distance, value)``.

    Without ``targets`` all rows search and all rows can be found (``target`` is
    empty, ``value`` null). With ``targets`` a row searches once per target that
    is null in it, among the rows that have the target; ``value`` is that
    neighbour's value. ``key`` is a unique bigint; ties go to the smaller key.
    """
    features = list(features)
    source = settle(points.select(F.col(key).cast("bigint").alias("key"), *[F.col(f).cast("double") for f in features]))
    labels = list(targets) if targets is not None else [""]
    columns = [features.index(t) for t in labels] if targets is not None else None
    placed = boxed(source, features, box_rows, MAX_VIEWS if targets is not None else 1)
    trees, first_box, tiled, cut = placed.trees, placed.first_box, placed.tiled, placed.cut
    pivots, pivot_keys = placed.sample[:MAX_PIVOTS], placed.sample_keys[:MAX_PIVOTS]

    def needs(values: np.ndarray) -> np.ndarray:
        return np.isnan(values[:, columns]) if columns is not None else np.ones((len(values), 1), dtype=bool)

    def serves(values: np.ndarray) -> np.ndarray:
        return ~np.isnan(values[:, columns]) if columns is not None else np.ones((len(values), 1), dtype=bool)

    pivot_offers = serves(pivots)
    hit_types = {"t": pa.int32(), "neighbour": pa.int64(), "distance": pa.float64(), "value": pa.float64()}
    hit_names = [name for name in hit_types if columns is not None or name != "value"]

    def bound_in_tile(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        x, keys = _numbers(rows, features), rows.column("key").to_numpy()
        box, tile = rows.column("box")[0].as_py(), rows.column("tile")[0].as_py()
        view = int(np.searchsorted(first_box, box, side="right")) - 1
        want = needs(x) & rows.column("mine").to_numpy()[:, None]
        asking = np.flatnonzero(want.any(axis=1))
        q, names = x[asking], keys[asking]
        reach = np.where(want[asking], np.inf, 0.0)
        endless = np.full(len(q), np.inf)
        own = []
        for who, t, near, d, rank in search(q, names, want[asking], endless, x, keys, serves(x), k, tighten=True):
            last = rank == k - 1
            reach[who[last], t] = d[last]
            value = x[near, columns[t]] if columns is not None else d
            own.append((who, np.full(len(who), t), keys[near], d, value))
        # Rows with a target that the tile cannot serve are bounded by the sample.
        unbounded = np.isinf(reach)
        seek = np.flatnonzero(unbounded.any(axis=1))
        for who, t, _, d, rank in search(
            q[seek], names[seek], unbounded[seek], endless[seek], pivots, pivot_keys, pivot_offers, k, tighten=True
        ):
            last = rank == k - 1
            reach[seek[who[last]], t] = d[last]
        radius = reach.max(axis=1, initial=0.0)
        visited = [(asking[:0], asking[:0])]
        for start in range(0, len(q), QUERY_ROWS):
            who, near_box = trees[view].touched(q[start : start + QUERY_ROWS], radius[start : start + QUERY_ROWS])
            near_box = near_box + first_box[view]
            # The own tile is done.
            open_ = (cut[near_box] > 0) & ((near_box != box) | (cut[box] > 1))
            visited.append((who[open_] + start, near_box[open_]))
        who, near_box = (np.concatenate(part) for part in zip(*visited, strict=True))
        held = [np.concatenate(part) for part in zip(*own, strict=True)] if own else [asking[:0]] * 5
        by = np.argsort(held[0], kind="stable")
        hits = dict(zip(hit_types, held[1:], strict=True))
        every_seeker = np.arange(len(q) + 1)
        ends = pa.array(np.searchsorted(held[0][by], every_seeker), pa.int32())
        out = {"key": pa.array(names), **{f: rows.column(f).take(pa.array(asking)) for f in features}}
        out |= {"radius": pa.array(radius), "home": pa.array(np.full(len(q), box), pa.int32())}
        out |= {"home_tile": pa.array(np.full(len(q), tile), pa.int32())}
        stops = pa.array(np.searchsorted(who, every_seeker), pa.int32())
        out["boxes"] = pa.ListArray.from_arrays(stops, pa.array(near_box, pa.int32()))
        for name in hit_names:
            out[name] = pa.ListArray.from_arrays(ends, pa.array(hits[name][by], hit_types[name]))
        return pa.table(out)

    hit_schema = {"t": "int", "neighbour": "bigint", "distance": "double", "value": "double"}
    numbers_schema = ", ".join(["key bigint", *[f"`{f}` double" for f in features]])
    lists_schema = ", ".join(f"{name} array<{hit_schema[name]}>" for name in hit_names)
    seekers = settle(
        spread(tiled, "box", "tile")
        .groupBy("box", "tile")
        .applyInArrow(
            bound_in_tile,
            f"{numbers_schema}, radius double, home int, home_tile int, boxes array<int>, {lists_schema}",
        )
    )
    visits = seekers.select("key", *features, "radius", "home", "home_tile", F.explode("boxes").alias("box"))
    arriving, hosting = placed.meeting(visits)
    arriving = arriving.drop("home", "home_tile")

    def meet(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        found = [(np.empty(0, dtype=np.int64),) * 5]
        if len(guests) and len(hosts):
            hosts = hosts.sort_by("key")
            q, x = _numbers(guests, features), _numbers(hosts, features)
            qk, xk = guests.column("key").to_numpy(), hosts.column("key").to_numpy()
            radius = guests.column("radius").to_numpy()
            for who, t, near, d, _ in search(q, qk, needs(q), radius, x, xk, serves(x), k, crowd=CROWD_ROWS):
                value = x[near, columns[t]] if columns is not None else d
                found.append((qk[who], np.full(len(who), t), xk[near], d, value))
        keys, *rest = (np.concatenate(part) for part in zip(*found, strict=True))
        hits = dict(zip(hit_types, rest, strict=False))
        return pa.table({"key": pa.array(keys, pa.int64()), **{name: pa.array(hits[name], hit_types[name]) for name in hit_names}})

    met = (
        arriving.groupBy("box", "tile", "part")
        .cogroup(hosting.groupBy("box", "tile", "part"))
        .applyInArrow(meet, ", ".join(["key bigint", *[f"{name} {hit_schema[name]}" for name in hit_names]]))
    )
    inside = seekers.select("key", F.inline(F.arrays_zip(*hit_names)))
    # Also rows without visits are ranked here: a key that repeats still gets k neighbours in all.
    best = Window.partitionBy("key", "t").orderBy("distance", "neighbour")
    # Dealt by key first: a task holds few hits of a key, so a limit on its side of the shuffle would sort all rows and drop none.
    hits = spread(inside.unionByName(met), "key")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    target = F.get(F.array(*[F.lit(label) for label in labels]), F.col("t")).alias("target")
    value = (F.col("value") if columns is not None else F.lit(None).cast("double")).alias("value")
    return ranked.select("key", target, "neighbour", "distance", value, "rank")
