"""Column-level building blocks. All of them are built-in Spark expressions,
so they stay inside whole-stage codegen; none is a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Mean earth radius used by the distance model (kilometres). Fixed value.
EARTH_RADIUS_KM = 6371.0


def first_of(df: DataFrame, names: Sequence[str], dtype: DataType | str, default=None) -> Column:
    """First non-null value among alternative source column names.

    Source schemas differ between data sets (``order_status`` vs ``status``),
    so names that the frame does not have are skipped instead of failing the
    analysis. Each candidate is cast to ``dtype`` before the coalesce, and
    ``default`` (a Python literal) closes the list. With no candidate present
    and no default, the result is a typed NULL.
    """
    present = {c.lower(): c for c in df.columns}
    parts = [F.col(f"`{present[n.lower()]}`").cast(dtype) for n in names if n.lower() in present]
    parts.append(F.lit(default).cast(dtype))
    return parts[0] if len(parts) == 1 else F.coalesce(*parts)


# Money is summed as decimal(38, 6): each value rounded to 6 decimals, then
# added exactly, so a total does not depend on the order of addition (how the
# data is partitioned, or which engine adds it).
MONEY = "decimal(38,6)"


def money_sum(c) -> Column:
    """Exact, order-independent sum of a money column (returned as double)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(MONEY)).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` when ``den > 0``, else NULL (ANSI mode raises on zero)."""
    return F.when(den > 0, num / den)


def zero_pad(value: Column, width: int = 3) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole (no truncation)."""
    s = value.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in km; NULL when any coordinate is NULL.

    The square-root argument is clamped to 1 so that rounding error on nearly
    antipodal points cannot push ``asin`` out of its domain.
    """
    h = (
        F.pow(F.sin(F.radians((lat1 - lat2) / 2.0)), 2)
        + F.cos(F.radians(lat2)) * F.cos(F.radians(lat1)) * F.pow(F.sin(F.radians((lng1 - lng2) / 2.0)), 2)
    )
    dist = F.lit(2.0) * F.asin(F.sqrt(F.least(F.lit(1.0), h))) * EARTH_RADIUS_KM
    return F.when(lat1.isNull() | lng1.isNull() | lat2.isNull() | lng2.isNull(), F.lit(None).cast("double")).otherwise(dist)


def as_of_date(as_of, frame: DataFrame, date_col: str) -> Column:
    """The reference date of a look-back window.

    An explicit ``as_of`` (date or 'YYYY-MM-DD') wins; otherwise the newest
    ``date_col`` of ``frame``, as a scalar subquery (one aggregate, evaluated
    once, no driver round trip). Using the data's own maximum instead of
    ``current_date`` keeps windows reproducible on historic data. Of orders
    stored by month only the newest month's dates are read.
    """
    if as_of is None:
        if date_col == "order_date" and is_partition(frame, "order_ym"):
            newest = frame.select(F.max("order_ym")).scalar()  # from partition values: no column is read
            return frame.filter(F.col("order_ym") == newest).select(F.max(date_col)).scalar()
        return frame.select(F.max(date_col)).scalar()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


#: Metadata of a column that a stored table is partitioned by.
PARTITION = {"partition": True}


def is_partition(frame: DataFrame, column: str) -> bool:
    """Is ``column`` marked as one by which the stored ``frame`` is partitioned?"""
    return any(f.name == column and f.metadata.get("partition") for f in frame.schema.fields)


def between_days(ts: Column, days: int, as_of: Column) -> Column:
    """``since`` for a timestamp, compared as one, so that the bound reaches the scan's filters."""
    first, end = F.date_sub(as_of, int(days)), F.date_add(as_of, 1)
    return (ts >= first.cast("timestamp_ntz")) & (ts < end.cast("timestamp_ntz"))


def since(date_col: Column, days: int, as_of: Column) -> Column:
    """The closed window ``as_of - days <= date_col <= as_of``."""
    return date_col.between(F.date_sub(as_of, int(days)), as_of)


def rounded(c: Column, digits: int) -> Column:
    """Half up to ``digits`` decimals in plain double arithmetic, by one rule at all magnitudes.

    ``round`` differs between engines on halves such as 1037.0821875; sums,
    products and remainders of doubles do not.
    """
    return floor_half_up(c, digits) / F.lit(float(10**digits))


def floor_half_up(c: Column, digits: int) -> Column:
    """``rounded`` in units of its last digit: a whole number, still a double."""
    scaled = c * F.lit(float(10**digits)) + F.lit(0.5)
    rest = scaled % F.lit(1.0)
    return scaled - F.when(rest < 0, rest + F.lit(1.0)).otherwise(rest)


def order_window(orders: DataFrame, days: int, as_of: Column) -> Column:
    """``order_date`` inside the look-back window. When the frame carries the
    month key ``order_ym`` (the partition column of the persisted orders), the
    equivalent month bound is added so the scan prunes whole partitions."""
    return since(F.col("order_date"), days, as_of) & month_bound(orders, days, as_of)


def month_bound(frame: DataFrame, days: int, as_of: Column) -> Column:
    """``order_ym`` of ``frame`` between the window's first and last month
    (TRUE when the frame has no month column). Redundant with the date bound; it
    exists so that scans of month-partitioned tables prune partitions."""
    if "order_ym" not in frame.columns:
        return F.lit(True)
    first = F.date_format(F.date_sub(as_of, int(days)), "yyyy-MM")
    return F.col("order_ym").between(first, F.date_format(as_of, "yyyy-MM"))
