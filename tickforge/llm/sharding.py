"""Consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NODES_PER_SHARD = 64
TURNS = 128
SPAN = 1 << 63


def ring(shards: int, nodes: int = NODES_PER_SHARD) -> list[tuple[int, int]]:
    """Sorted (position, shard); a shard's positions do not depend on the other shards."""
    return sorted(
        (xxhash.xxh64_intdigest(f"shard-{s}/{v}", seed=0) >> 1, s) for s in range(shards) for v in range(nodes)
    )


def walk(points: list[tuple[int, int]], arc: int, shards: int) -> list[int]:
    """Shards met clockwise from an arc's end, each once."""
    seen: list[int] = []
    for i in range(len(points)):
        s = points[(arc + i) % len(points)][1]
        if s not in seen:
            seen.append(s)
            if len(seen) == shards:
                break
    return seen


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows per shard; without slack the sizes are at most one apart and sum to ``rows``."""
    if slack:
        return [-(-int(rows * (1 + slack)) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def fill(cells: list[tuple[int, int, int]], points, shards: int, slack: float = 0.0) -> list[tuple]:
    """Where each cell's keys go: (turn, arc, first, last, shard, slot of the first).

    ``cells`` holds (turn, arc, keys).  Keys arrive turn by turn, within a turn clockwise, and
    each takes the first shard clockwise with room.  Only cells in which a shard fills up are split.
    """
    left = capacities(sum(n for _, _, n in cells), shards, slack)
    used = [0] * shards
    route = {arc: walk(points, arc, shards) for arc in {a for _, a, _ in cells}}
    plan = []
    for turn, arc, n in sorted(cells):
        at = 0
        for s in route[arc]:
            take = min(n - at, left[s])
            if take:
                plan.append((turn, arc, at, at + take - 1, s, used[s]))
                at, left[s], used[s] = at + take, left[s] - take, used[s] + take
            if at == n:
                break
    return plan


def ring_position(key: Column, text: Column) -> Column:
    """Position of a key on the ring; rows without a key are placed by their text."""
    return F.shiftrightunsigned(F.coalesce(F.xxhash64(key) + F.when(key.isNotNull(), 0), F.xxhash64(text)), 1)


def assign_shards(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slack: float = 0.0,
    nodes: int = NODES_PER_SHARD, turns: int = TURNS,
) -> DataFrame:
    """Puts every row into one of ``shards`` shards, with a gapless slot in it.

    A key goes to the shard of the next virtual node clockwise; once that shard holds its
    capacity, later keys continue clockwise.  Keys arrive in an order fixed by their hash, so
    the result depends on the rows alone.  With ``slack`` 0 shard counts are at most one apart;
    with more, a shard holds at most (1 + slack) times the mean plus one, and fewer keys move
    when shards are added.

    Distributed form: the ring's arcs and ``turns`` arrival turns divide the keys into cells.  A
    count per cell (at most shards * nodes * turns numbers, whatever the input) is all the
    driver needs to find which cells go where; rows of a cell are ranked on executors.

    Result: doc_id, size (UTF-8 bytes plus one), text_crc32, shard, slot.  A null text counts as
    empty, a null key is placed by its text, repeated rows each get a slot.  Other columns are
    dropped; an empty table gives no rows.
    """
    spark = docs.sparkSession
    points = ring(shards, nodes)
    position = F.col("position")
    # The arc is found by position in the sorted list of nodes, written as one array lookup.
    nodes_at = [p for p, _ in points]
    placed = docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        ring_position(F.col(key), F.coalesce(F.col(text), F.lit(""))).alias("position"),
    ).withColumns({
        "arc": _arc(position, nodes_at),
        "turn": F.pmod(F.xxhash64("position"), F.lit(turns)).cast("int"),
    })
    cells = [(r[0], r[1], r[2]) for r in placed.groupBy("turn", "arc").count().collect()]
    plan = spark.createDataFrame(
        fill(cells, points, shards, slack), "turn int, arc int, first long, last long, shard int, start long")
    in_cell = Window.partitionBy("turn", "arc").orderBy("position", "doc_id", "text_crc32", "size")
    ranked = placed.withColumn("place", (F.row_number().over(in_cell) - 1).cast("long"))
    # The plan has one row per cell and split, a number fixed by the ring and not by the input.
    return ranked.join(F.broadcast(plan), ["turn", "arc"]).filter("place BETWEEN first AND last").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place") - F.col("first")).alias("slot"))


def _arc(position: Column, nodes_at: list[int]) -> Column:
    """Index of the first node at or after the position, as a balanced tree of comparisons.

    The tree is cut at coarse steps: the top bits pick a slot of a lookup table with the first
    candidate, and the few nodes within the slot are counted.
    """
    bits = 12
    shift = 63 - bits
    first = [bisect.bisect_left(nodes_at, s << shift) for s in range(1 << bits)]
    inside = max(b - a for a, b in zip(first, [*first[1:], len(nodes_at)]))
    slot = F.shiftrightunsigned(position, shift).cast("int") + 1
    start = F.element_at(F.lit(first), slot)
    padded = F.lit([*nodes_at, *[SPAN - 1] * (inside + 1)])
    arc = start
    for i in range(inside):
        arc = arc + F.when(F.element_at(padded, start + i + 1) < position, 1).otherwise(0)
    return (arc % len(nodes_at)).cast("int")
