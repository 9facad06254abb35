"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule, a piecewise linear density over
training progress t in [0, 1]. The weights give each source its number of
words (its target); the integral of the schedule, scaled to the target, is the
source's cumulative demand D(t). The documents of a source stand in a fixed
pseudo-random order; a document that begins after u words of its source is
needed when D(t) = u, so its training position is the inverse of D at u. Rows
are then range-sorted by position. A source whose target is above its size is
passed more than once, and its last document is cut where the target is met.

Everything here is DataFrame code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from emporia.llm.common import n_space_words

# Curricula, given to the sources in turn: (progress, density) knots.
RISING = ((0.0, 0.5), (1.0, 1.5))
FALLING = ((0.0, 1.5), (1.0, 0.5))
LATE_PEAK = ((0.0, 0.75), (0.5, 0.75), (0.75, 1.5), (1.0, 1.0))
SCHEDULES = (FALLING, RISING, LATE_PEAK)
WEIGHTS = (3.0, 1.0, 2.0)


def slim(docs: DataFrame, row: bool = False) -> DataFrame:
    """What :func:`mix` needs of documents: doc_id, source, size in words, and a hash that orders a source.

    With ``row`` also the whole row as the struct ``row``.
    """
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if row else []
    return docs.select("doc_id", "source", n_space_words("text").alias("size"), F.xxhash64("doc_id", "text").alias("order"), *whole)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target words per source: ``source``, ``source_size`` -> also ``rank`` and ``target``.

    Sources in code point order (null last) get ``weights`` in turn and share
    ``share`` times all sizes; a target stops at ``most`` times its source's
    size and the excess goes to the others by weight. With the sources sorted
    by size per weight the stopped ones come first, and the level of the
    others is what is left per weight. One row per source, so these windows
    are over the list of sources, not over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("_room", "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    level = (F.col("_all") - F.col("_stopped")) / F.col("_weights")
    return (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("_w", w)
        .withColumn("_cap", most * F.col("source_size"))
        .withColumn("_room", F.col("_cap") / F.col("_w"))
        .withColumn("_all", share * F.sum("source_size").over(everything))
        .withColumn("_stopped", F.coalesce(F.sum("_cap").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_weights", F.sum("_w").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", F.when(F.col("_room") > level, level))
        .withColumn("_water", F.max("_level").over(everything))
        .select(
            "source",
            "source_size",
            "rank",
            F.when(F.col("_level").isNull(), F.col("_cap")).otherwise(F.col("_water") * F.col("_w")).alias("target"),
        )
    )


def demand_inverse(x: Column, knots) -> Column:
    """Progress t at which the schedule's integral reaches the fraction ``x`` of its whole."""
    areas = [(t1 - t0) * (f0 + f1) / 2 for (t0, f0), (t1, f1) in zip(knots, knots[1:])]
    whole, below, out = sum(areas), 0.0, None
    pieces = []
    for ((t0, f0), (t1, f1)), area in zip(zip(knots, knots[1:]), areas):
        slope, need = (f1 - f0) / (t1 - t0), x * whole - below
        root = F.sqrt(F.greatest(F.lit(0.0), f0 * f0 + 2 * slope * need))
        pieces.append((below + area, F.least(F.lit(t1), t0 + F.when(need <= 0, 0.0).otherwise(2 * need / (f0 + root)))))
        below += area
    for upto, t in reversed(pieces):
        out = t if out is None else F.when(x * whole <= upto, t).otherwise(out)
    return out


def mix(
    rows: DataFrame,
    weights=WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    schedules=SCHEDULES,
) -> DataFrame:
    """Which words of each row the mix takes, and when.

    ``rows`` has doc_id, source, size and order (see :func:`slim`, which puts
    all other columns of a table into one). Adds ``source_size``, ``target``, ``taken`` (words
    of all copies), ``copies`` (array of words taken by each pass) and
    ``positions`` (training progress in [0, 1) of each pass, null where it
    takes nothing). A row takes at most ``most`` times its size; rows of size 0
    take nothing; a null source is a source of its own.

    Running sums inside a source are made in buckets of ``order``: as many
    buckets as the square root of the row count, so that neither a bucket of
    the largest source nor the list of buckets grows beyond the root of the
    table. Ties in ``order`` are cut by doc_id, and rows equal in both are
    interchangeable.
    """
    keep = rows.columns
    buckets = max(1, math.isqrt(rows.count()))
    # "_none" and "_name" stand for the source without nulls, so that the running sum and the join need one exchange
    key = ["_none", "_name"]
    rows = rows.withColumns(
        {"_none": F.col("source").isNull(), "_name": F.coalesce("source", F.lit("")), "_bucket": F.pmod("order", F.lit(buckets))}
    )
    groups = rows.groupBy(*key, "_bucket").agg(F.sum("size").alias("_in_bucket"))
    sizes = groups.groupBy(*key).agg(F.sum("_in_bucket").alias("source_size"))
    sizes = sizes.withColumn("source", F.when(~F.col("_none"), F.col("_name")))
    plan = targets(sizes, weights, share, most).select(
        F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name"), "source_size", "rank", "target"
    )
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_offset", F.coalesce(F.sum("_in_bucket").over(before), F.lit(0))).drop("_in_bucket").join(plan, key)
    inside = Window.partitionBy(*key, "_bucket").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(groups.hint("merge"), [*key, "_bucket"])
    goal = F.round("target").cast("long")
    begins = [F.col("_offset") + F.col("_before") + n * F.col("source_size") for n in range(math.ceil(most))]
    copies = [F.greatest(F.lit(0), F.least(F.col("size"), goal - b)).cast("long") for b in begins]

    def when(begin: Column) -> Column:
        out = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            out = F.when(F.col("rank") % len(schedules) == i, demand_inverse(begin / goal, knots)).otherwise(out)
        return out

    return rows.select(
        *[F.col(f"`{c}`") for c in keep],
        "source_size",
        "target",
        sum(copies[1:], copies[0]).alias("taken"),
        F.array(*copies).alias("copies"),
        F.array(*[F.when(c > 0, when(b)) for c, b in zip(copies, begins)]).alias("positions"),
    )


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The mix as documents: one row of ``docs`` per copy, range-sorted by training position.

    Rows are whole documents: the copy that a target cuts is in the mix if at
    least half of its words are. Takes the options of :func:`mix`.
    """
    mixed = mix(slim(docs, row=True), **how)
    each = mixed.select("doc_id", "order", "size", "row", F.explode(F.arrays_zip("copies", "positions")).alias("copy"))
    each = each.filter((F.col("copy.copies") > 0) & (F.col("copy.copies") * 2 >= F.col("size")))
    return each.orderBy("copy.positions", "order", "doc_id").select("row.*")
