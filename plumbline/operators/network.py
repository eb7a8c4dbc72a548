"""A small relu network that reproduces its input, trained on all rows.

Hidden layers of ``HIDDEN`` units and a linear output. Loss and gradient of the whole table are summed by
Spark: the rows are packed into blocks of numbers once, a task goes through its blocks in batches and hands on one number per weight, which are added up before
the driver sees them. The driver takes quasi-Newton steps (limited memory, with a line search that only accepts a lower
loss), so there is one pass over the rows per evaluation and at most ``EVALUATIONS`` of them.

Weights begin as the projection on the principal axes, which the network can express: codes shifted to be positive pass
its relu units unchanged. The remaining units begin with small weights drawn by a seed. The loss therefore never
ends above that of the projection, and a fixed seed repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import settle

HIDDEN = (4, 2, 4)
EVALUATIONS = 25
MEMORY = 8
BLOCK_ROWS = 50_000  # rows of a block that a pass reads whole
BATCH_ROWS = 10_000  # rows that go through the layers together
SEED = 42

Layers = list[tuple[np.ndarray, np.ndarray]]


def shapes(inputs: int, hidden: Sequence[int] = HIDDEN) -> list[tuple[int, int]]:
    sizes = [inputs, *hidden, inputs]
    return list(zip(sizes[:-1], sizes[1:], strict=True))


def layers_of(flat: np.ndarray, sizes: Sequence[tuple[int, int]]) -> Layers:
    out, at = [], 0
    for rows, columns in sizes:
        weights = flat[at : at + rows * columns].reshape(rows, columns)
        at += rows * columns
        out.append((weights, flat[at : at + columns]))
        at += columns
    return out


def flattened(layers: Layers) -> np.ndarray:
    return np.concatenate([part.ravel() for layer in layers for part in layer])


def loss_and_gradient(x: np.ndarray, layers: Layers) -> tuple[float, np.ndarray]:
    """Sum of squared errors of the rows of ``x`` and its gradient, flat."""
    held = [x]
    for i, (weights, bias) in enumerate(layers):
        z = held[-1] @ weights + bias
        held.append(np.maximum(z, 0) if i < len(layers) - 1 else z)
    error = held[-1] - x
    back, grads = 2 * error, []
    for i in range(len(layers) - 1, -1, -1):
        grads.append((held[i].T @ back, back.sum(axis=0)))
        back = (back @ layers[i][0].T) * (held[i] > 0) if i else back
    return float((error**2).sum()), flattened(grads[::-1])


def packed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The number columns of ``rows`` as blocks of up to ``BLOCK_ROWS`` rows, each one binary cell, settled.

    A pass over them hands a task's rows to numpy without taking them apart one by one.
    """

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            count += len(held[-1])
            if count >= BLOCK_ROWS:
                yield _cell(held)
                held, count = [], 0
        if count:
            yield _cell(held)

    return settle(rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInArrow(run, "block binary"))


def _cell(held: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], names=["block"])


def _summed(blocks: DataFrame, flat: np.ndarray, sizes: Sequence[tuple[int, int]]) -> tuple[float, np.ndarray]:
    """Mean loss and gradient over all rows: one number per weight and task is shuffled."""

    def run(batches):
        total = np.zeros(len(flat) + 2)
        layers = layers_of(flat, sizes)
        for batch in batches:
            for block in batch.column(0):
                rows = np.frombuffer(block.as_buffer(), dtype=np.float64).reshape(-1, sizes[0][0])
                for start in range(0, len(rows), BATCH_ROWS):
                    x = rows[start : start + BATCH_ROWS]
                    loss, gradient = loss_and_gradient(x, layers)
                    total += np.concatenate([[len(x), loss], gradient])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["place", "value"])

    partial = blocks.mapInArrow(run, "place int, value double")
    found = {r["place"]: r["value"] for r in partial.groupBy("place").agg(F.sum("value").alias("value")).collect()}
    total = np.array([found[i] for i in range(len(found))])
    return total[1] / max(total[0], 1), total[2:] / max(total[0], 1)


def minimise(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, evaluations: int) -> np.ndarray:
    """Limited-memory quasi-Newton steps; a step that does not lower the loss is halved."""
    at, used = start, 1
    loss, gradient = evaluate(at)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    while used < evaluations and np.abs(gradient).max() > 1e-7:
        step, kept = gradient.copy(), []
        for s, y in reversed(pairs):
            kept.append(a := (s @ step) / (s @ y))
            step -= a * y
        step *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else min(1.0, 0.1 / np.abs(gradient).max())
        for (s, y), a in zip(pairs, reversed(kept), strict=True):
            step += (a - (y @ step) / (s @ y)) * s
        slope, size = gradient @ step, 1.0
        while used < evaluations:
            new, used = at - size * step, used + 1
            lower, turned = evaluate(new)
            if lower < loss - 1e-4 * size * slope:
                break
            size /= 2
            if size < 1e-6:
                return at
        else:
            return at
        s, y = new - at, turned - gradient
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-MEMORY:]
        at, loss, gradient = new, lower, turned
    return at


def from_axes(axes: np.ndarray, shift: np.ndarray, hidden: Sequence[int] = HIDDEN, seed: int = SEED) -> Layers:
    """Layers that project on ``axes`` (inputs, components); ``shift``: no code is below its negative."""
    draw = np.random.default_rng(seed)
    inputs, components = axes.shape
    layers = []
    for i, (rows, columns) in enumerate(shapes(inputs, hidden)):
        weights, bias = np.zeros((rows, columns)), np.zeros(columns)
        if i < len(hidden):
            weights[:, components:] = draw.normal(0, 0.1, (rows, columns - components))
        if i == 0:
            weights[:, :components], bias[:components] = axes, shift
        elif i < len(hidden):
            weights[:components, :components] = np.eye(components)
        else:
            weights[:components], bias = axes.T, -shift @ axes.T
        layers.append((weights, bias))
    return layers


def train(rows: DataFrame, columns: Sequence[str], axes: np.ndarray, hidden: Sequence[int] = HIDDEN, evaluations: int = EVALUATIONS, seed: int = SEED) -> Layers:
    """A network for the number columns of ``rows`` (settled, without nulls), from their principal axes."""
    codes = [sum((F.col(c) * F.lit(float(axes[i, m])) for i, c in enumerate(columns)), F.lit(0.0)) for m in range(axes.shape[1])]
    lowest = rows.agg(*[F.min(code).alias(f"m{m}") for m, code in enumerate(codes)]).first()
    start = from_axes(axes, np.array([max(0.0, -(v or 0.0)) for v in lowest]), hidden, seed)
    sizes = shapes(len(columns), hidden)
    blocks = packed(rows, columns)
    return layers_of(minimise(lambda flat: _summed(blocks, flat, sizes), flattened(start), evaluations), sizes)


def squared_error(rows: DataFrame, columns: Sequence[str], layers: Layers) -> DataFrame:
    """``rows`` with ``mse``: the mean squared difference between a row and what the network makes of it."""
    kept = list(rows.columns)
    held = [F.col(c) for c in columns]
    out = rows
    for depth, (weights, bias) in enumerate(layers):
        units: list[Column] = []
        for unit in range(weights.shape[1]):
            value = sum((h * F.lit(float(w)) for h, w in zip(held, weights[:, unit], strict=True)), F.lit(float(bias[unit])))
            units.append(F.greatest(value, F.lit(0.0)) if depth < len(layers) - 1 else value)
        out = out.select(*kept, *[u.alias(f"__h{depth}_{k}") for k, u in enumerate(units)])
        held = [F.col(f"__h{depth}_{k}") for k in range(len(units))]
    squares = [(F.col(c) - h) * (F.col(c) - h) for c, h in zip(columns, held, strict=True)]
    return out.select(*kept, (sum(squares, F.lit(0.0)) / len(columns)).alias("mse"))
