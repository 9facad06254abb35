"""Sinks: CSV export, column documentation, order-insensitive fingerprint."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType, TimestampType

from emporia.functions.columns import floor_half_up


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Headered CSV (a folder of part files, one per partition)."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def with_comments(df: DataFrame, docs: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions as field metadata (kept in Parquet and catalogs)."""
    for col, text in docs.items():
        if col in df.columns:
            df = df.withMetadata(col, {"comment": text})
    return df


def canonical_text(c: Column, kind: DataType) -> Column:
    """One text per value: doubles in whole millionths, ISO dates, JSON for nested values; NULL stays NULL."""
    if isinstance(kind, (DoubleType, FloatType)):
        c = c.cast("double")
        millionths = floor_half_up(c, 6).try_cast("decimal(38,0)")  # NULL where 38 digits cannot hold it, or not a number
        return F.coalesce(millionths.cast("string"), c.cast("string"))
    if isinstance(kind, TimestampType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.to_json(c)
    return c.cast("string")


def fingerprint(df: DataFrame) -> DataFrame:
    """One row ``(rows, fingerprint)`` that does not depend on row order or partitioning.

    A row's text is, column by column, ``N`` for NULL or ``V<length>:<text>``, so a value that moves to
    another column changes it. The first 60 bits of the texts' MD5 are summed exactly.
    """
    parts = []
    for f in df.schema.fields:
        text = canonical_text(F.col(f"`{f.name}`"), f.dataType)
        parts.append(F.coalesce(F.concat(F.lit("V"), F.length(text), F.lit(":"), text), F.lit("N")))
    head = F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 15)
    h = F.conv(head, 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).cast("string").alias("fingerprint"))
