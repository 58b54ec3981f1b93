"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, running_start, table, words_of

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
#: Words in a block: the corpus is cut into about SLOTS blocks, none above MAX_BLOCK words.
SLOTS, MAX_BLOCK = 2**16, 4096
GOLDEN = 0.6180339887498949


class Plan(NamedTuple):
    """sources: (source, source_size, source_no, target, low, high), the last two being the source's part of the unit interval."""

    sources: DataFrame
    n_sources: int
    block: int
    slots: int


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    return docs.select(
        *keep, F.col("source").cast("string").alias("source"), F.size(words_of(F.col("text").cast("string"))).cast("long").alias("size")
    )


def water_level(sources: DataFrame, total: float, max_repeat: float) -> float:
    """The target of a unit of weight, so that min(weight * level, max_repeat * size) over (weight, source_size) comes to total.

    Each round shares out what the sources that are full leave to the others; the level
    only rises, so each round fills at least one source or is the last.
    """
    cap = F.col("source_size") * float(max_repeat)
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * level > cap
        n, used, open_ = sources.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if n == full or not open_:
            return level
        level, full = (total - used) / open_, n


def plan_of(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> Plan:
    """The plan for rows of (source, size). Sources may be any number: only sums over them reach the driver."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = cut(sums.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    sums = cut(sums.select("*", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("at")))
    numbered = running_start(sums, [], "piece", [F.col("at")], F.lit(1), "source_no")
    weight = F.element_at(F.lit([float(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    numbered = cut(numbered.withColumn("weight", weight))
    total, n = numbered.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count("*")).first()
    level = water_level(numbered, float(total), max_repeat)
    target = F.least(F.col("weight") * level, F.col("source_size") * float(max_repeat))
    placed = running_start(numbered.withColumn("target", target), [], "piece", [F.col("at")], F.col("target"), "low")
    placed = cut(placed.select("source", "source_size", F.col("source_no").cast("int").alias("source_no"), "target", "low"))
    whole = float(placed.agg(F.sum("target")).first()[0] or 0.0)
    share = lambda c: F.try_divide(c, F.lit(whole))
    block = int(np.clip(total // SLOTS, 16, MAX_BLOCK))
    sources = placed.select("source", "source_size", "source_no", "target", share(F.col("low")).alias("low"), share(F.col("low") + F.col("target")).alias("high"))
    return Plan(sources, n, block, int(np.ceil(whole / block)))


def schedule(spark: SparkSession, plan: Plan, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(slot, source_no, nth, block, epoch): which block of which source fills each slot of the mix.

    Slot i stands at frac((i + 1) * golden ratio) and belongs to the source whose part of
    the cumulative targets holds that point, so every stretch of slots has the sources
    near their shares. The nth slot of a source takes its nth block, round and round, in
    the source's shuffled order; slots past max_repeat rounds are left out. Slots meet
    sources by cells of the unit interval, as many as there are sources.
    """
    if plan.slots <= 0:
        return spark.createDataFrame([], "slot long, source_no int, nth long, block long, epoch long")
    cells = max(plan.n_sources, 1)

    @F.pandas_udf("double")
    def point(slot: pd.Series) -> pd.Series:
        return pd.Series(np.modf((slot.to_numpy(np.float64) + 1) * GOLDEN)[0])

    cell = lambda c: F.least(F.floor(c * cells), F.lit(cells - 1)).cast("long")
    slots = spark.range(plan.slots).select(F.col("id").alias("slot"), point("id").alias("point")).withColumn("cell", cell(F.col("point")))
    blocks = F.ceil(F.col("source_size") / plan.block)
    spans = plan.sources.filter("target > 0").select("source_no", "low", "high", blocks.cast("long").alias("_blocks"), F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))).alias("cell"))
    # the last part ends at 1 but for rounding
    inside = (F.col("point") >= F.col("low")) & ((F.col("point") < F.col("high")) | (F.col("high") > 1 - 1e-12))
    slots = slots.join(spans, "cell").filter(inside).groupBy("slot").agg(F.max(F.struct("source_no", "_blocks")).alias("own"))
    slots = slots.select("slot", "own.*", F.expr("slot div 16384").alias("_chunk"))
    slots = running_start(slots, ["source_no"], "_chunk", [F.col("slot")], F.lit(1), "nth")
    return slots.filter(F.col("nth") < F.col("_blocks") * F.lit(max_repeat)).select(
        "slot", "source_no", "nth", F.expr("nth % _blocks").alias("block"), F.expr("nth div _blocks").alias("epoch")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(doc_id, text, source) -> (doc_id, size, source_size, target, taken), one row per row of docs.

    Sources weigh `weights` in turn, by code point, null (a source of its own) last, and
    share the size of all documents in words; none is given more than max_repeat times
    its size. Each source is shuffled by a hash, laid end to end and cut into blocks of
    equal size; the schedule says how often each block is taken, and `taken` counts a
    document's words in these blocks. Empty and null texts have size and taken 0. Rows
    that repeat and null ids are separate rows; texts of any length count whole; an empty
    table gives an empty one; other columns of docs, whatever their names, take no part.
    The order of rows that agree in id and text doesn't matter to the result as a whole,
    so reruns agree.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = sized(docs, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("_h"))
    rows = cut(rows.repartition(n))
    plan = plan_of(rows, weights, max_repeat)
    known = plan.sources.select(F.col("source").alias("_source"), "source_no", "source_size", "target")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    rows = rows.withColumn("_chunk", F.shiftrightunsigned(F.xxhash64("_h"), 54).cast("int"))
    rows = running_start(rows, ["source_no"], "_chunk", [F.col("_h"), F.col("doc_id"), F.col("size")], F.col("size"), "start")
    b = plan.block
    rows = rows.withColumn("_row", F.struct("doc_id", "size", "source_size", "target", "start"))
    empty = rows.filter("size = 0").select("_row", F.lit(0).cast("long").alias("taken"))
    parts = rows.filter("size > 0").select(
        "_row", "source_no", "start", "size", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")).alias("block")
    )
    times = schedule(spark, plan, max_repeat).groupBy("source_no", "block").agg(F.count("*").alias("times"))
    overlap = F.expr(f"least(start + size, (block + 1) * {b}) - greatest(start, block * {b})")
    taken = (
        parts.join(times, ["source_no", "block"], "left")
        .groupBy("source_no", "_row")
        .agg(F.sum(overlap * F.coalesce("times", F.lit(0))).alias("taken"))
        .select("_row", "taken")
    )
    return taken.unionByName(empty).select("_row.doc_id", "_row.size", "_row.source_size", "_row.target", "taken")


def remix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """docs with each row as often as the mix takes it, rounded half up to whole documents.

    Documents without words cost nothing and stay once. All columns are kept, whatever
    their names. Ids are taken as unique; rows with the same id, and those with none, are
    mixed as one. An empty table gives an empty one.
    """
    took = mix(docs, weights, max_repeat).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    n = F.expr(f"if(size = 0, 1, least({int(max_repeat)}, (2 * taken + size) div (2 * size)))").cast("int")
    copies = took.select("doc_id", n.alias("n")).filter("n > 0")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("_id"))
    # rows without an id are mixed as one, so there is one number for them, which goes to where they are
    none = rows.filter("_id IS NULL").join(F.broadcast(copies.filter("doc_id IS NULL")), F.col("_id").eqNullSafe(F.col("doc_id")))
    many = rows.join(copies, F.col("_id") == F.col("doc_id")).unionByName(none).withColumn("k", F.explode(F.expr("sequence(1, n)")))
    return many.select("row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
