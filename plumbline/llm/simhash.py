"""SimHash near-duplicates by pivot distance tables.

A fingerprint bit is 1 if it is set in over half of the XXH64 values (seed 42) of a text's word
shingles, repeats included. Two fingerprints link if at most ``links`` bits differ.

Search: for fixed reference fingerprints (pivots), the Hamming distances of two linked
fingerprints to a pivot differ by at most ``links`` (triangle inequality). The distances to the
first ``dealt`` pivots are cut in the middle; a fingerprint goes to its own side and, where the
other side begins within reach above it, also there. So of two linked fingerprints each is in
the cell of the higher sides. Inside a cell a table of the distances to all pivots discards the
pairs whose largest coordinate difference is above ``links``; Hamming distance verifies the rest.

Equal fingerprints are one node, so copies cost nothing. Large cells are cut into pairs of tiles.
A tile gives each fingerprint one link, to the smallest one it reaches there, not its pairs.

Texts without words (null, empty, blank) have fingerprint zero, linked like any other. Ties in a
bit count (exactly half) give 0. Null ids are never the smallest one of a component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LOWER, per_text, pick, position
from plumbline.llm.components import components, forest, per_group, tiled
from plumbline.session import settle

LINKS = 2
SHINGLE = 3
PIVOTS = 24
DEALT = 16  # each halves the cells and sends 1.18 times the rows: 65,536 cells, 15 times the fingerprints
MIDDLE = 32  # distances to a pivot are cut here: random ones are 32 +- 4
CELL_ROWS = 2000
BITS = 64


#: Fixed reference fingerprints, the same for all data.
REFERENCES = np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, 0) for i in range(PIVOTS)], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([1 + len(w) for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 65_536):
        bits = np.unpackbits(hashes[i : i + 65_536].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in range(BITS) if 2 * int(counts[b]) > n)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (64 bits as a signed long)."""

    return per_text(pick(docs, doc_id=doc_id, text=text), "fp bigint", lambda texts: _print_arrays(texts, shingle))


def _print_arrays(texts: list[str | None], shingle: int) -> list[pa.Array]:
    found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
    return [pa.array(found.view(np.int64), pa.int64())]


def deal(prints: np.ndarray, dealt: int = DEALT, links: int = LINKS) -> tuple[np.ndarray, np.ndarray]:
    """Cells of fingerprints and the index of the fingerprint of each: a bit for each dealt pivot."""
    index = np.arange(len(prints))
    cell = np.zeros(len(prints), dtype=np.int64)
    for pivot in REFERENCES[:dealt]:
        away = np.bitwise_count(prints ^ pivot).astype(np.int64)[index]
        far = away >= MIDDLE
        near_border = ~far & (away + links >= MIDDLE)
        cell = np.concatenate([cell * 2 + far, cell[near_border] * 2 + 1])
        index = np.concatenate([index, index[near_border]])
    return cell, index


def cells(nodes: DataFrame, dealt: int = DEALT, links: int = LINKS) -> DataFrame:
    """``cell, fp`` for every cell that a fingerprint of ``nodes (fp)`` belongs to."""

    def run(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            cell, index = deal(prints, dealt, links)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(prints[index].view(np.int64))], names=["cell", "fp"])

    return nodes.mapInArrow(run, "cell bigint, fp bigint")


def linked(a: np.ndarray, b: np.ndarray, links: int = LINKS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked fingerprints of ``a`` and ``b``, by their tables of pivot distances.

    Pivots that did not deal the cells come first, since those that did tell less inside one.
    """
    of = lambda x: np.bitwise_count(x[None, :] ^ REFERENCES[::-1, None]).astype(np.int8)
    table_a = of(a)
    table_b = table_a if a is b else of(b)
    found_a, found_b = [], []
    for start in range(0, len(a), 256):
        own = table_a[:, start : start + 256]
        close = np.abs(own[0][:, None] - table_b[0][None, :]) <= links
        close &= np.abs(own[1][:, None] - table_b[1][None, :]) <= links
        i, j = np.nonzero(close)
        for k in range(2, len(REFERENCES)):
            if not len(i):
                break
            keep = np.abs(own[k, i] - table_b[k, j]) <= links
            i, j = i[keep], j[keep]
        i = i + start
        keep = np.bitwise_count(a[i] ^ b[j]) <= links
        found_a.append(i[keep])
        found_b.append(j[keep])
    nothing = np.zeros(0, dtype=np.int64)
    return np.concatenate([nothing, *found_a]), np.concatenate([nothing, *found_b])


def tile_links(rows: pd.DataFrame, links: int = LINKS) -> pd.DataFrame | None:
    """Of one pair of tiles: each fingerprint with the smallest that it reaches, if that is another."""
    if len(rows) < 2:
        return None
    prints, side = np.sort(rows["fp"].to_numpy()), None
    if rows["tile_a"].iloc[0] != rows["tile_b"].iloc[0]:
        order = np.argsort(rows["fp"].to_numpy(), kind="stable")
        side = rows["side"].to_numpy()[order]
    unsigned = prints.view(np.uint64)
    if side is None:
        i, j = linked(unsigned, unsigned, links)
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        i, j = linked(unsigned[left], unsigned[right], links)
        i, j = left[i], right[j]
    distinct = i != j
    if not distinct.any():
        return None
    root = forest(len(prints), i[distinct], j[distinct])
    moved = np.flatnonzero(root != np.arange(len(prints)))
    return pd.DataFrame({"a": prints[moved], "b": prints[root[moved]]})


def grouped(prints: DataFrame, least: Column, links: int, cell_rows: int, dealt: int) -> DataFrame:
    """``of, first``: each fingerprint of ``prints (fp, ..)`` with the smallest ``least`` of its component."""
    nodes = settle(prints.groupBy("fp").agg(F.min(least).alias("least")))
    dealt_out = tiled(cells(nodes.select("fp"), dealt, links), ["cell"], "fp", cell_rows)
    found = per_group(dealt_out, ["cell", "tile_a", "tile_b"], lambda rows: tile_links(rows, links), "a bigint, b bigint")
    roots = components(found.distinct())
    own = nodes.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "least")
    of_root = own.groupBy("root").agg(F.min("least").alias("first"))
    moved = own.join(of_root, "root").select(F.col("fp").alias("moved"), "first")
    return nodes.join(moved, F.col("fp") == F.col("moved"), "left").select(
        F.col("fp").alias("of"), F.coalesce("first", "least").alias("first")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, links: int = LINKS,
    cell_rows: int = CELL_ROWS, dealt: int = DEALT,
) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id reachable by links; one row per document."""
    prints = settle(fingerprints(docs, doc_id, text, shingle))
    labels = settle(grouped(prints, F.col("doc_id"), links, cell_rows, dealt))  # a plain join: a hot print can be split
    return prints.join(labels, F.col("fp") == F.col("of")).select("doc_id", "fp", F.col("first").alias("component_id"))


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, links: int = LINKS,
    cell_rows: int = CELL_ROWS, dealt: int = DEALT,
) -> DataFrame:
    """Documents without the near copies of another, with all their columns.

    Of each component the row with the smallest id stays (null ids last, then by the digest of
    the text), of equal rows one. Rows are known by id and a 128-bit hash of the text, so that
    only these, not the texts, go through the search.
    """
    digests = [F.xxhash64(F.lit(i), F.col("text")) for i in (1, 2)]
    taken = pick(docs, doc_id=doc_id, text=text).select("doc_id", "text", digests[0].alias("h1"), digests[1].alias("h2"))
    prints = settle(per_text(taken, "fp bigint", lambda texts: _print_arrays(texts, shingle)))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    first = grouped(prints, key, links, cell_rows, dealt).select("first.*").distinct()
    first = first.select(F.col("doc_id").alias("id"), F.col("h1").alias("g1"), F.col("h2").alias("g2"))
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own_id, own_text = (F.col(f"c{position(names, c)}") for c in (doc_id, text))
    plain = plain.select("*", own_id.alias("own"), *[F.xxhash64(F.lit(i), own_text).alias(f"h{i}") for i in (1, 2)])
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    kept = plain.join(first, same, "left_semi").dropDuplicates(["own", "h1", "h2"])
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
