"""Sharding by histogram sort: exact counts below probes refine splitters, then one exchange.

Rows are ordered by a key, with a hash of the row and its scan position as
tie-breaks, so that even a key held by a third of all rows is cut. A splitter
is searched in a histogram of 1,024 cells: one aggregate pass counts the exact
weight of every cell, the cell that holds the splitter is cut into 1,024 finer
cells in the next pass, until a cell edge meets the tolerance. Where one key
alone is heavier than that, the search goes on in its tie-breaks. The driver
holds cells of the open intervals only (at most 1,024 per splitter). Then the
rows are exchanged once, by range.

Everything here is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from emporia.llm.common import materialise

CELL_BITS = 10
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
ORDER = ["_k0", "_k1", "_k2"]
# Bits that monotonically_increasing_id gives the row number inside a partition.
ROW_BITS = 33


@dataclass(frozen=True)
class Interval:
    """Rows whose first coordinates equal ``prefix`` and whose next one, shifted right by ``shift``, is ``cell``."""

    prefix: tuple[int, ...]
    shift: int | None = None
    cell: int | None = None

    @property
    def column(self) -> str:
        return ORDER[len(self.prefix)]

    def holds(self) -> Column:
        cond = F.lit(True)
        for name, value in zip(ORDER, self.prefix):
            cond = cond & (F.col(name) == F.lit(value))
        if self.shift is not None:
            cond = cond & (F.shiftright(self.column, self.shift) == F.lit(self.cell))
        return cond


def _below(splitter: tuple[int, ...]) -> Column:
    """Is the row below the splitter in the order of the coordinates?"""
    cond = F.lit(False)
    for name, value in reversed(list(zip(ORDER, splitter))):
        cond = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & cond)
    return cond


def _root_shift(rows: DataFrame, interval: Interval) -> int:
    low, high = rows.filter(interval.holds()).agg(F.min(interval.column), F.max(interval.column)).first()
    shift = 0
    while (high >> shift) - (low >> shift) >= 1 << CELL_BITS:
        shift += 1
    return shift


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[tuple[int, ...]]:
    """``shards - 1`` splitters of ``rows`` (coordinates ORDER, long ``_weight``) into equal weights.

    A splitter is accepted when the exact weight below it is within
    ``tolerance`` times a shard's weight of its target; with 0 it is the
    nearest edge between two rows.
    """
    total = rows.agg(F.sum("_weight")).first()[0]
    if not total:
        return []
    slack = tolerance * total / shards
    # splitter number -> (interval still open, exact weight below the interval)
    open_ = {i: (Interval(()), 0) for i in range(1, shards)}
    found: dict[int, tuple[int, ...]] = {}
    shifts: dict[Interval, int] = {}
    while open_:
        intervals = list(dict.fromkeys(interval for interval, _ in open_.values()))
        for x in intervals:
            if x not in shifts:
                shifts[x] = _root_shift(rows, x) if x.shift is None else max(0, x.shift - CELL_BITS)
        which, cell = F.lit(None).cast("int"), F.lit(None).cast("long")
        for j, x in enumerate(intervals):
            which = F.when(x.holds(), F.lit(j)).otherwise(which)
            cell = F.when(x.holds(), F.shiftright(x.column, shifts[x])).otherwise(cell)
        counted = (
            rows.select(which.alias("i"), cell.alias("cell"), "_weight")
            .filter("i IS NOT NULL")
            .groupBy("i", "cell")
            .agg(F.sum("_weight").alias("weight"))
            .collect()
        )
        cells: dict[int, list[tuple[int, int]]] = {}
        for row in sorted(counted):
            cells.setdefault(row["i"], []).append((row["cell"], row["weight"]))
        for i, (interval, below) in list(open_.items()):
            # integer targets, so that equal weights of 1 give counts at most one apart
            target, shift = i * total // shards, shifts[interval]
            for c, weight in cells[intervals.index(interval)]:
                if below + weight >= target:
                    break
                below += weight
            start, end = c << shift, min((c + 1) << shift, HIGHEST)
            near_start = target - below <= below + weight - target
            if min(target - below, below + weight - target) <= slack or (shift == 0 and len(interval.prefix) == len(ORDER) - 1):
                found[i] = interval.prefix + (start if near_start else end,)
                del open_[i]
            elif shift:
                open_[i] = (Interval(interval.prefix, shift, c), below)
            else:
                open_[i] = (Interval(interval.prefix + (c,)), below)
    return sorted(found.values())


def shard(
    docs: DataFrame,
    key: str = "doc_id",
    weight: str | None = "size",
    shards: int = 16,
    tolerance: float = 0.001,
) -> DataFrame:
    """All rows of ``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in its shard).

    ``weight`` names a long column whose sums the shards share equally (the
    law "bytes"); None counts rows, and with ``tolerance`` 0 the counts are at
    most one apart (the law "rows"). Shards are ranges of ``key`` (a long;
    null sorts first). Equal keys are ordered by a hash of the row and then by
    scan position, so copies may be parted. An empty table gives no rows; an
    input column called ``shard`` or ``slot`` is replaced.
    """
    docs = docs.drop("shard", "slot")
    rows = materialise(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
            F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)).alias("_k0"),
            F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("_k1"),
            F.monotonically_increasing_id().alias("_k2"),
            (F.col(weight) if weight else F.lit(1)).cast("long").alias("_weight"),
        ),
        "shard-keys",
    )
    number = F.lit(0)
    for i, splitter in enumerate(splitters(rows.select(*ORDER, "_weight"), shards, tolerance), 1):
        number = F.when(~_below(splitter), F.lit(i)).otherwise(number)
    placed = materialise(
        rows.repartitionByRange(*ORDER)
        .sortWithinPartitions(*ORDER)
        .select("_row", number.cast("int").alias("shard"), F.monotonically_increasing_id().alias("_at")),
        "shard-rows",
    )
    run = F.shiftright("_at", ROW_BITS)
    # One row per partition of the exchange and shard: bounded by partitions + shards.
    runs = placed.groupBy(run.alias("_run"), "shard").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("shard").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (
        placed.withColumn("_run", run)
        .join(F.broadcast(runs.drop("_n")), ["_run", "shard"])
        .select("_row.*", "shard", (F.col("_at") - F.col("_first") + F.col("_offset")).alias("slot"))
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the result of :func:`shard` as one folder per shard."""
    sharded.write.partitionBy("shard").parquet(path)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1; null text: 1) and text_crc32 (null text: that of an empty text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
