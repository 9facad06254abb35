"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emporia.session import configure, shared_dir

# Rows and bytes of one Arrow batch: whole texts travel in batches, so a batch is kept short.
ARROW_ROWS = 256
ARROW_BYTES = 4 << 20
# A run of non-space characters; the white space is U+0020 and U+0009 to U+000D.
SPACE_WORD = "[^\\x20\\x09-\\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the corpus operators: short Arrow batches bound a worker's memory."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for a new folder in the storage that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage at a place that outlives executors, and makes later
    passes read the same rows in the same files.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))) % modulus


def n_space_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def slices(texts: list[bytes], most: int):
    """Index ranges of ``texts`` holding about ``most`` bytes each (one longer text alone)."""
    first = held = 0
    for i, x in enumerate(texts):
        if held and held + len(x) > most:
            yield first, i
            first, held = i, 0
        held += len(x) + 1
    if first < len(texts):
        yield first, len(texts)


def set_aside(df: DataFrame, names) -> tuple[DataFrame, list[Column]]:
    """``df`` with its columns called like ``names`` renamed, and the columns that give its own names back."""
    taken = {x.lower() for x in names}
    aside = {c: f"_aside_{i}" for i, c in enumerate(df.columns) if c.lower() in taken}
    back = [F.col(f"`{aside.get(c, c)}`").alias(c) for c in df.columns]
    return df.withColumnsRenamed(aside), back


def map_batches(
    df: DataFrame,
    fn: Callable[..., list[pa.Array]],
    new: dict[str, str],
    keep: list[str],
    setup: Callable[[], object] | None = None,
) -> DataFrame:
    """``keep`` columns of ``df`` and the ``new`` ones (name -> type) that ``fn`` makes of each Arrow batch.

    ``setup`` is called once per task; ``fn`` then gets what it returns as its second argument.
    """
    fields = {f.name: f for f in df.schema.fields}
    made = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in new.items()))
    schema = StructType([*[fields[c] for c in keep], *made.fields])
    names = [*keep, *new]

    def each(batches):
        more = () if setup is None else (setup(),)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *fn(batch, *more)], names=names)
        pa.default_memory_pool().release_unused()  # workers are used again; the executor's memory is not theirs to keep

    return df.mapInArrow(each, schema)
