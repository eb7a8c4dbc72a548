"""Resharding by minimum-cost flow: even row counts with the fewest bytes moved.

Old shards are the files (or any column) the rows come from. The largest ``shards`` of them by bytes
continue as new shards of their own; all others are loose and move anyway. New capacities are row
counts at most one apart. The network has a node per continued old shard and one for the loose
ones, a hub, a node per new shard and one that hands out the rows left over by the division:

* old shard -> its own new shard: free;
* old shard -> hub: one arc per size class, its cost the mean bytes of the class, its capacity the
  rows in it (loose rows: free, since they move in any case);
* hub -> new shard: free, up to the shard's capacity.

Successive shortest paths solve it on the driver; the network is bounded by shards and size
classes, not by rows. The flow on an arc to the hub is a block transfer: so many rows of a class
of an old shard, smallest classes first. Rows find their block by their rank in (old shard, class),
counted in buckets with an offset table, so no class is ranked in one task.

A null text has no bytes, a size of 16 and a crc of 0; rows with equal ids and texts are separate
rows; ties in rank are settled by size, crc and id. Nulls in the old shard count as loose.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import position
from plumbline.session import settle

OVERHEAD = 16
CLASSES_PER_DOUBLING = 4
BUCKET_ROWS = 200_000
LOOSE = -1


@dataclass(frozen=True)
class Transfer:
    """Rows ``first`` to ``end`` (exclusive) by rank of a class of an old shard, to slots of a shard."""

    home: int
    size_class: int
    first: int
    end: int
    shard: int
    slot: int


class Network:
    """Minimum-cost flow by successive shortest paths with potentials."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.left: list[int] = []
        self.cost: list[float] = []

    def arc(self, a: int, b: int, capacity: int, cost: float = 0.0) -> int:
        for start, end, room, price in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.left.append(room)
            self.cost.append(price)
        return len(self.to) - 2

    def flow(self, arc: int) -> int:
        return self.left[arc ^ 1]

    def solve(self, source: int, sink: int) -> None:
        potential = [0.0] * len(self.out)
        while True:
            far = [float("inf")] * len(self.out)
            came = [-1] * len(self.out)
            far[source] = 0.0
            heap = [(0.0, source)]
            while heap:
                away, a = heapq.heappop(heap)
                if away > far[a]:
                    continue
                for arc in self.out[a]:
                    b = self.to[arc]
                    new = away + self.cost[arc] + potential[a] - potential[b]
                    if self.left[arc] and new < far[b] - 1e-9:
                        far[b], came[b] = max(new, away), arc
                        heapq.heappush(heap, (far[b], b))
            if came[sink] < 0:
                return
            potential = [p + min(f, far[sink]) for p, f in zip(potential, far, strict=True)]
            path, node = [], sink
            while node != source:
                path.append(came[node])
                node = self.to[came[node] ^ 1]
            amount = min(self.left[arc] for arc in path)
            for arc in path:
                self.left[arc] -= amount
                self.left[arc ^ 1] += amount


def plan(counts: list[tuple[int, int, int, int]], shards: int) -> list[Transfer]:
    """Transfers for ``(home, size class, rows, bytes)``; home is the new shard that continues it, or LOOSE."""
    total = sum(rows for _, _, rows, _ in counts)
    if not total:
        return []
    least, over = divmod(total, shards)
    homes = sorted({home for home, _, _, _ in counts})
    source, sink, hub, extra = range(4)
    old = {home: 4 + i for i, home in enumerate(homes)}
    new = [4 + len(homes) + j for j in range(shards)]
    net = Network(4 + len(homes) + shards)
    moves, stays = {}, {}
    for home in homes:
        net.arc(source, old[home], sum(rows for h, _, rows, _ in counts if h == home))
        if home != LOOSE:
            stays[home] = net.arc(old[home], new[home], total)
    for home, size_class, rows, size in sorted(counts):
        moves[home, size_class] = net.arc(old[home], hub, rows, 0.0 if home == LOOSE else size / rows)
    fills = [net.arc(hub, new[j], total) for j in range(shards)]
    for j in range(shards):
        net.arc(new[j], sink, least)
        net.arc(new[j], extra, 1)
    net.arc(extra, sink, over)
    net.solve(source, sink)

    slots = [0] * shards
    out: list[Transfer] = []

    def place(home: int, size_class: int, first: int, end: int, shard: int) -> None:
        if end > first:
            out.append(Transfer(home, size_class, first, end, shard, slots[shard]))
            slots[shard] += end - first

    wanted = [[j, net.flow(arc)] for j, arc in enumerate(fills) if net.flow(arc)]
    for home, size_class, rows, _ in sorted(counts):
        moved, first = net.flow(moves[home, size_class]), 0
        while first < moved:
            j, room = wanted[0]
            n = min(room, moved - first)
            place(home, size_class, first, first + n, j)
            first += n
            wanted[0][1] -= n
            if not wanted[0][1]:
                wanted.pop(0)
        if home != LOOSE:
            place(home, size_class, moved, rows, home)
    return out


def reshard(
    docs: DataFrame, old: str, shards: int, doc_id: str = "doc_id", text: str = "text", carry: bool = False
) -> tuple[DataFrame, list[Transfer]]:
    """Rows with ``size, text_crc32, home, shard, slot``, and the transfers behind them.

    ``carry`` keeps the text and all other columns as ``row`` (a struct), for ``rewrite``; else only
    ``doc_id`` and numbers are shuffled.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    whole = F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]).alias("row")
    taken = plain.select(
        *[F.col(f"c{position(names, c)}").alias(n) for n, c in (("doc_id", doc_id), ("text", text))],
        F.col(f"c{position(names, old)}").cast("string").alias("old"),
        *([whole] if carry else []),
    )
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD
    rows = settle(
        taken.withColumn("size", size)
        .withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
        .withColumn("size_class", F.floor(F.log2("size") * CLASSES_PER_DOUBLING).cast("int"))
        .drop("text")
    )
    files = rows.where("old IS NOT NULL").groupBy("old").agg(F.sum("size").alias("bytes"))
    largest = files.orderBy(F.desc("bytes"), "old").limit(shards).collect()
    continued = docs.sparkSession.createDataFrame(
        [(r.old, home) for home, r in enumerate(sorted(largest, key=lambda r: r.old))], "old string, home int"
    )
    rows = rows.join(F.broadcast(continued), rows.old == continued.old, "left").drop("old")
    rows = rows.withColumn("home", F.coalesce("home", F.lit(LOOSE)))
    counts = rows.groupBy("home", "size_class").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()
    transfers = plan([tuple(r) for r in counts], shards)

    buckets = -(-sum(r.n for r in counts) // BUCKET_ROWS) or 1
    block = ["home", "size_class", "bucket"]
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)))
    before = Window.partitionBy("home", "size_class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*block).agg(F.count("*").alias("n"))
    offsets = offsets.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*block).orderBy("size", "text_crc32", "doc_id")) - 1
    )
    ranked = ranked.join(offsets, block).withColumn("rank", F.col("rank") + F.col("offset"))
    table = docs.sparkSession.createDataFrame(
        [(t.home, t.size_class, t.first, t.end, t.shard, t.slot) for t in transfers],
        "of int, in_class int, first bigint, end bigint, shard int, start bigint",
    )  # at most (shards + 1) * classes + shards rows
    found = ranked.join(
        F.broadcast(table),
        (F.col("home") == F.col("of")) & (F.col("size_class") == F.col("in_class"))
        & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")),
    )
    kept = ["row"] if carry else []
    out = found.select(
        "doc_id", "size", "text_crc32", "home", "shard", (F.col("start") + F.col("rank") - F.col("first")).alias("slot"), *kept
    )
    return out, transfers


def rewrite(assigned: DataFrame, transfers: list[Transfer], path: str) -> list[int]:
    """Writes the shards that gained or lost rows, one folder each; gives the numbers of the others.

    A shard that only keeps rows of the file it continues is not written: its file stays as it is.
    """
    gained = {t.shard for t in transfers if t.home != t.shard}
    lost = {t.home for t in transfers if t.home not in (LOOSE, t.shard)}
    changed = sorted(gained | lost)
    rows = assigned.where(F.col("shard").isin(changed))
    ordered = rows.repartition(max(1, len(changed)), "shard").sortWithinPartitions("shard", "slot")
    ordered.select("row.*", F.col("shard").alias("__shard")).write.partitionBy("__shard").parquet(path)
    return sorted({t.shard for t in transfers} - set(changed))


def digest(assigned: DataFrame) -> DataFrame:
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
