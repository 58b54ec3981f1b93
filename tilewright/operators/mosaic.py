"""Projections of Z-stacks and mosaics of scenes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def max_projection(samples: DataFrame, keep: list[str]) -> DataFrame:
    """The greatest v over all axes but those in keep."""
    return samples.groupBy(*keep).agg(F.max("v").alias("v"))


def mosaic(scenes: DataFrame) -> DataFrame:
    """(slide, scene, y, x, v): the value of the last scene that is above 0 there, else 0."""
    return scenes.groupBy("slide", "y", "x").agg(F.coalesce(F.max_by("v", F.when(F.col("v") > 0, F.col("scene"))), F.lit(0)).alias("v"))


def stitch(scenes: DataFrame) -> DataFrame:
    """The value of the last scene, zeros included."""
    return scenes.groupBy("slide", "y", "x").agg(F.max_by("v", "scene").alias("v"))


def canvas(parts: DataFrame, itemsize: int = 1) -> DataFrame:
    """(slide, y0, x0, h, w, channels) -> origin, height, width and bytes of the canvas that holds all parts."""
    ext = parts.groupBy("slide").agg(
        F.min("y0").alias("y0"), F.min("x0").alias("x0"), F.max(F.col("y0") + F.col("h")).alias("y1"), F.max(F.col("x0") + F.col("w")).alias("x1"), F.max("channels").alias("ch")
    )
    h, w = F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
    return ext.select("slide", "y0", "x0", h.alias("height"), w.alias("width"), (h.cast("bigint") * w * F.col("ch") * itemsize).alias("bytes"))


def positions(scenes: DataFrame) -> DataFrame:
    """(slide, scene, pos_x, pos_y, scale_x[, scale_y]) in metres -> x0, y0 in pixels, cut towards zero; scale_y is scale_x if null."""
    sy = F.coalesce("scale_y", "scale_x") if "scale_y" in scenes.columns else F.col("scale_x")
    return scenes.withColumn("x0", (F.col("pos_x") / F.col("scale_x")).cast("int")).withColumn("y0", (F.col("pos_y") / sy).cast("int"))


def with_positions(scenes: DataFrame, places: DataFrame) -> DataFrame:
    """scenes (slide, ...) with the positions (slide, pos_x, pos_y, scale_x[, scale_y]) that have the same place in their slide.

    Both are counted from 0 in the order of their own `ordinal` columns, which may have
    gaps; x0 and y0 count from the leftmost and topmost position of the slide. A scene
    without a position stays, with nulls.
    """
    nth = F.row_number().over(Window.partitionBy("slide").orderBy("ordinal")) - 1
    at = positions(places.withColumn("_nth", nth))
    least = at.groupBy("slide").agg(F.min("x0").alias("_x"), F.min("y0").alias("_y"))
    at = at.join(least, "slide").select("slide", "_nth", (F.col("x0") - F.col("_x")).alias("x0"), (F.col("y0") - F.col("_y")).alias("y0"))
    return scenes.withColumn("_nth", nth).join(at, ["slide", "_nth"], "left").drop("_nth")
