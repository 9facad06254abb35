"""Positions in a global order, and what follows from them: row numbers within a group and dense ranks.

``row_number() over (partition by key order by ...)`` sends every row of a
key to one task, and ``dense_rank() over (order by ...)`` sends every row to
one. Both can be read off the positions of the rows in one global order, which
Spark can find without gathering anything:

1. ``repartitionByRange`` cuts the sorted data into ranges of similar size; a hot
   key simply spans several of them. Each range is sorted on its own, and
   ``monotonically_increasing_id`` gives every row its range and its place in it.
   The result is written as Parquet in the shared folder, which fixes both.
2. The number of rows of each range, added up, is the position at which the
   next one begins: a table of one row per range, whatever the data.

All of it is built-in expressions; no row passes through Python.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.session import shared_dir

_PLACE_BITS = 33  # of monotonically_increasing_id: the range above, the row's place in it below


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back."""
    path = f"{shared_dir(df.sparkSession)}/emporia/{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positions(df: DataFrame, order: Sequence[Column], name: str = "_position", num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name``, each row's position from 0 under ``order`` (ties in any order, but each its own position)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = written(placed, "positions")
    part = F.shiftright("_id", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over ranges, at most n of them
    begins = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_begin"))
    place = F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1)
    joined = placed.join(F.broadcast(begins), part == begins["_part"])
    return joined.select(*[placed[c] for c in df.columns], (F.col("_begin") + place).alias(name))


def sequence_within(df: DataFrame, key: str, order: Sequence[Column], name: str = "seq",
                    num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name`` = 1-based position of the row within its ``key``
    group under ``order`` (same numbers as ``row_number``; ties in ``order``
    are numbered arbitrarily, as with ``row_number``).

    A group's rows stand together in the global order, so a row's number is its
    position less the group's first one: a map-side minimum per key and a join,
    in which Spark splits a hot key.
    """
    at = written(positions(df, [F.col(key).asc_nulls_first(), *order], "_position", num_partitions), "sequence")
    first = at.groupBy(F.col(key).alias("_key")).agg(F.min("_position").alias("_first"))
    first = written(first, "sequence-first")  # both sides plain scans, so that a hot key can be split
    numbered = (F.col("_position") - F.col("_first") + 1).cast("int").alias(name)
    cols = [at[c] for c in df.columns]
    known = at.filter(F.col(key).isNotNull()).join(first, at[key] == first["_key"]).select(*cols, numbered)
    # rows without a key come first of all
    without = at.filter(F.col(key).isNull()).select(*cols, (F.col("_position") + 1).cast("int").alias(name))
    return known.union(without)


def dense_ranks(df: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """``df`` plus a dense rank (1 = largest) for each metric: ``metrics`` maps its column to the rank's name.

    NULL has no rank. Only distinct values are ordered, all metrics in one
    pass, so ties cannot stand in two ranges; a value's rank is its position
    less that of the metric's first value, and reaches the rows by a join on the
    value. Metrics are compared as doubles.
    """
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("metric"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(metrics)]))
    values = df.select(stacked.alias("x")).select("x.metric", "x.value").filter("value IS NOT NULL").distinct()
    at = written(positions(values, [F.asc("metric"), F.desc("value")]), "ranks")
    first = at.groupBy("metric").agg(F.min("_position").alias("_first"))  # a row per metric
    ranks = at.join(F.broadcast(first), "metric").select(
        "metric", "value", (F.col("_position") - F.col("_first") + 1).cast("int").alias("rank"))
    out = df
    for i, (column, name) in enumerate(metrics.items()):
        own = ranks.filter(F.col("metric") == i).select(F.col("value").alias(f"_value_{i}"), F.col("rank").alias(name))
        out = out.join(own, F.col(f"`{column}`").cast("double") == F.col(f"_value_{i}"), "left").drop(f"_value_{i}")
    return out
