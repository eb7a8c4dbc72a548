"""Shared helpers of the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Batches = Iterator[pa.RecordBatch]

#: Lower-cases A-Z, as a table for ``bytes.translate``.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def position(columns: list[str], name: str) -> int:
    """Index of ``name``: the exact spelling first, else the only one that differs in case."""
    if name in columns:
        return columns.index(name)
    same = [i for i, c in enumerate(columns) if c.lower() == name.lower()]
    if len(same) != 1:
        raise ValueError(f"no column {name!r} among {columns}")
    return same[0]


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Columns by exact name under new names; other columns never clash, whatever their names."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{position(df.columns, old)}").alias(new) for new, old in columns.items()])


def crc_of_id(column: str) -> Column:
    return F.crc32(F.col(column).cast("string"))


def per_text(
    df: DataFrame, new: str, function: Callable[[list[str | None]], list[Any]], text: str = "text"
) -> DataFrame:
    """``df`` without ``text``, plus columns that ``function`` derives from a batch of texts.

    ``new`` names and types the added columns. ``function`` gets the texts of a batch and gives one Arrow array per new column. Rows stay
    where they are: no shuffle, and a lost executor only repeats its own partitions.
    """
    ordered = df.select(*[c for c in df.columns if c != text], text)
    kept = len(df.columns) - 1
    schema = T.StructType([*ordered.schema.fields[:kept], *T.DataType.fromDDL(new).fields])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch, kept):
                added = function(part.column(kept).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], *added], names=schema.names)

    return ordered.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: int, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that the texts of a part hold about ``limit`` bytes (one text at least)."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def filtered(df: DataFrame, text: str, keep: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """Rows of ``df`` whose text ``keep`` accepts, with all columns as they were."""
    at = position(df.columns, text)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch, at):
                yield part.filter(pa.array(keep(part.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


class Remembered(dict):
    """A cache that computes what it lacks and starts anew when full, so its memory is bounded."""

    def __init__(self, compute: Callable[[Any], Any], limit: int = 300_000, given: dict | None = None):
        super().__init__(given or {})
        self.compute, self.limit, self.given = compute, limit, given or {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
            self.update(self.given)
        value = self.compute(key)
        if len(key) <= 200:
            self[key] = value
        return value


def once(key: Any, make: Callable[[], Any], keep: int = 2) -> Any:
    """``make()`` once per Python worker and key; the last few are kept.

    Functions travel by value, with fresh globals for each task, so what a worker keeps between
    its tasks hangs on a module that stays.
    """
    kept = sys.modules.setdefault("plumbline_kept", ModuleType("plumbline_kept")).__dict__.setdefault("by_key", {})
    if key not in kept:
        while len(kept) >= keep:
            kept.pop(next(iter(kept)))
        kept[key] = make()
    return kept[key]
