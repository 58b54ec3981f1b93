"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import shared_dir as shared_dir
from ..sources.shared import written as written

#: The words of every operator here: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Most bytes of an Arrow batch of texts, whatever their lengths (one row at least).
BATCH = "8m"
#: Bits of a filter of hashes; a fixed size, so a fuller filter only spares fewer.
MAX_FILTER_BITS = 1 << 28


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def filter_of(hs: DataFrame) -> tuple[np.ndarray, int]:
    """63 bits to a word, one for each h & mask of hs (h); and the mask. No h is missed, and few others pass."""
    n = hs.count()
    bits = int(min(MAX_FILTER_BITS, max(1 << 16, 1 << int(np.ceil(np.log2(16 * n + 1))))))
    words = hs.select(F.expr(f"h & {bits - 1}L").alias("bit")).groupBy(F.expr("bit div 63").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 63 as int))")).alias("b"))
    found = np.zeros(bits // 63 + 1, np.int64)
    got = words.toPandas()
    found[got.w.to_numpy()] = got.b.to_numpy()
    return found, bits - 1


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that tasks exchange with Python, unless the session names a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def strings_of(column: pa.Array, step: int = 512) -> Iterator[str | None]:
    """The strings of an Arrow column, of which `step` at a time are held as Python objects."""
    for at in range(0, len(column), step):
        yield from column.slice(at, step).to_pylist()


def running_start(df: DataFrame, group: list[str], chunk: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Adds `name`: the sum of `amount` over all earlier rows of `group`.

    A group may hold any share of the rows. `chunk` is an integer column that splits a
    group into ordered pieces; only sums per piece pass through a window over the whole
    group, and rows are ranked inside their piece alone.
    """
    piece = df.groupBy(*group, chunk).agg(F.sum(amount).alias("_piece"))
    before = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    piece = piece.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col(chunk).alias("_c"),
        F.coalesce(F.sum("_piece").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = df.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    on = F.col(chunk).eqNullSafe(F.col("_c"))
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return ranked.join(piece, on).withColumn(name, F.col("_inside") + F.col("_before")).drop(
        "_inside", "_before", "_c", *[f"_g{i}" for i in range(len(group))]
    )
