"""Segmentation metrics, losses and intensity scaling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(rows: DataFrame, truth: str, pred: str) -> DataFrame:
    """Counts by (truth, pred) of labelled rows; label -1 and nulls are unlabelled."""
    return rows.filter((F.col(truth) != -1) & F.col(pred).isNotNull()).groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def segmentation_metrics(matrix: DataFrame, background: int = 0) -> DataFrame:
    """Accuracy, precision, recall, IoU and Dice of a confusion table, sums over all classes but the background's; null where nothing divides."""
    t, p, n = F.col("truth"), F.col("pred"), F.col("n")
    s = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    sums = matrix.agg(
        F.sum(n).alias("total"),
        s(t == p).alias("hit"),
        s((t == p) & (t == background)).alias("tn"),
        s((t == p) & (t != background)).alias("tp"),
        s((t != p) & (t != background)).alias("fn"),
        s((t != p) & (p != background)).alias("fp"),
    )
    d = lambda a: F.col(a).cast("double")
    return sums.select(
        F.try_divide(d("hit"), d("total")).alias("accuracy"),
        F.try_divide(d("tp"), d("tp") + d("fp")).alias("precision"),
        F.try_divide(d("tp"), d("tp") + d("fn")).alias("recall"),
        F.try_divide(d("tp"), d("total") - d("tn")).alias("iou"),
        F.try_divide(2 * d("tp"), 2 * d("tp") + d("fp") + d("fn")).alias("dice"),
    )


def iou_per_class(matrix: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("truth").alias("cls")), F.struct(F.col("pred").alias("cls")))
    rows = matrix.select(F.explode(F.array_distinct(ends)).alias("e"), "truth", "pred", "n").select("e.cls", "truth", "pred", "n")
    tp = F.sum(F.when((F.col("truth") == F.col("cls")) & (F.col("pred") == F.col("cls")), F.col("n")).otherwise(0))
    return rows.groupBy("cls").agg((tp.cast("double") / F.sum("n")).alias("iou"))


def focal(p_true: Column, weight: Column, gamma: float = 2.0) -> Column:
    return -weight * F.pow(1 - p_true, gamma) * F.log(p_true)


def losses(pixels: DataFrame, keys: list[str], weights: tuple[float, float], alpha: float = 0.6, beta: float = 0.4, smooth: float = 1e-5) -> DataFrame:
    """(keys, p1, y[, weight]) of two-class pixels -> focal, tversky and their mean per key.

    p1 is the probability of class 1, the only foreground; weight is a pixel's weight, 1
    if there is no such column.
    """
    y = F.col("y")
    p = F.when(y == 1, F.col("p1")).otherwise(1 - F.col("p1"))
    own = F.coalesce("weight", F.lit(1.0)) if "weight" in pixels.columns else F.lit(1.0)
    sums = pixels.groupBy(*keys).agg(
        F.avg(focal(p, F.when(y == 1, weights[1]).otherwise(weights[0])) * own).alias("focal"),
        F.sum(F.col("p1") * y).alias("tp"),
        F.sum(F.col("p1") * (1 - y)).alias("fp"),
        F.sum((1 - F.col("p1")) * y).alias("fn"),
    )
    tversky = 1 - (F.col("tp") + smooth) / (F.col("tp") + alpha * F.col("fp") + beta * F.col("fn") + smooth)
    return sums.select(*keys, "focal", tversky.alias("tversky"), (0.5 * F.col("focal") + 0.5 * tversky).alias("loss"))


def dynamic_scale(pixels: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Adds scaled: value within the range of its group, 0 to 1; 0 where the range is empty."""
    ends = pixels.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    x = (F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    return pixels.join(ends, keys).withColumn("scaled", F.when(F.col("_hi") > F.col("_lo"), F.greatest(F.lit(0.0), F.least(x, F.lit(1.0)))).otherwise(0.0)).drop("_lo", "_hi")


def label_counts(pixels: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """Per key the labelled pixels (label other than -1) and those in the foreground (above 0)."""
    known = pixels.filter(F.col(label) != -1)
    return known.groupBy(*keys).agg(F.count("*").alias("labelled"), F.sum((F.col(label) > 0).cast("int")).alias("foreground"))


def _by_tile(tiles: DataFrame, columns: list[str], schema: str, sums: Callable[[object], list[tuple]]) -> DataFrame:
    """The rows that `sums` makes of each tile, with the tile's slide."""
    types = dict(tiles.dtypes)
    names = ["slide", *[c.split()[0] for c in schema.split(", ")]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(t.slide, *row) for t in frame.itertuples() for row in sums(t)], columns=names)

    return tiles.select("slide", *columns).mapInPandas(run, f"slide {types['slide']}, {schema}")


def tile_confusion(tiles: DataFrame, classes: int) -> DataFrame:
    """(slide, truth binary, pred binary), a byte a pixel -> (truth, pred, n): confusion() counted tile by tile; labels of `classes` or more are unlabelled."""

    def count(t) -> list[tuple]:
        if t.truth is None or t.pred is None:
            return []
        y, p = np.frombuffer(t.truth, np.uint8).astype(np.int64), np.frombuffer(t.pred, np.uint8)
        known = y < classes
        n = np.bincount(y[known] * 256 + p[known])
        return [(int(k // 256), int(k % 256), int(n[k])) for k in np.flatnonzero(n)]

    return _by_tile(tiles, ["truth", "pred"], "truth int, pred int, n long", count).groupBy("truth", "pred").agg(F.sum("n").alias("n"))


def tile_losses(tiles: DataFrame, weights: tuple[float, ...], alpha: float = 0.6, beta: float = 0.4, smooth: float = 1e-5, gamma: float = 2.0, dtype: str = "<f4") -> DataFrame:
    """(slide, truth binary, probs binary[, weight binary]) -> (slide, focal, tversky, loss), as losses(), for any number of classes.

    probs holds a plane of `dtype` for each of the weights' classes, weight one for the
    pixels (1 if null or missing), truth a byte a pixel. Tversky's index is the mean over
    all classes but 0. A tile is summed up where it is and yields a row a class.
    """
    k = len(weights)

    def sums(t) -> list[tuple]:
        y = np.frombuffer(t.truth, np.uint8)
        p = np.frombuffer(t.probs, dtype).astype(np.float64).reshape(k, -1)
        own = np.frombuffer(t.weight, dtype).astype(np.float64) if t.weight is not None else 1.0
        true = p[y, np.arange(len(y))]
        focal_sum = float((-np.asarray(weights)[y] * (1 - true) ** gamma * np.log(true) * own).sum())
        is_class = y[None] == np.arange(k)[:, None]
        tp, every, there = (p * is_class).sum(axis=1), p.sum(axis=1), is_class.sum(axis=1)
        return [(c, focal_sum if c == 0 else 0.0, len(y) if c == 0 else 0, float(tp[c]), float(every[c] - tp[c]), float(there[c] - tp[c])) for c in range(k)]

    rows = tiles if "weight" in tiles.columns else tiles.withColumn("weight", F.lit(None).cast("binary"))
    each = _by_tile(rows, ["truth", "probs", "weight"], "cls int, focal double, n long, tp double, fp double, fn double", sums)
    by_class = each.groupBy("slide", "cls").agg(*[F.sum(c).alias(c) for c in ("focal", "n", "tp", "fp", "fn")])
    miss = 1 - (F.col("tp") + smooth) / (F.col("tp") + alpha * F.col("fp") + beta * F.col("fn") + smooth)
    out = by_class.groupBy("slide").agg((F.sum("focal") / F.sum("n")).alias("focal"), F.avg(F.when(F.col("cls") > 0, miss)).alias("tversky"))
    return out.withColumn("loss", 0.5 * F.col("focal") + 0.5 * F.col("tversky"))


def write_metrics(metrics: DataFrame, folder: str) -> None:
    """The one row of segmentation_metrics() as a CSV file with a header, below folder."""
    names = {"accuracy": "acc", "precision": "prec", "recall": "recall", "iou": "iou", "dice": "dice"}
    metrics.select(*[F.col(a).alias(b) for a, b in names.items()]).coalesce(1).write.mode("overwrite").option("header", True).csv(folder)
