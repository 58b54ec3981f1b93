"""Tile grids, coordinates, sanity checks and neighbours of slides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g

TILE_PX = 2890


def grid(slides: DataFrame, tile_px: int = TILE_PX) -> DataFrame:
    """Adds grid_rows and grid_cols to slides (h, w). Slides without height or width go."""
    return slides.filter("h > 0 AND w > 0").withColumn("grid_rows", g.cells(F.col("h"), tile_px)).withColumn("grid_cols", g.cells(F.col("w"), tile_px))


def with_stored_grid(slides: DataFrame, stored: DataFrame, tile_px: int = TILE_PX) -> DataFrame:
    """Grids as stored (slide_id, s_rows, s_cols, s_h, s_w) where known, else computed; size_differs flags a stored size other than the slide's."""
    both = grid(slides, tile_px).join(stored, "slide_id", "left")
    return both.select(
        "slide_id",
        F.coalesce("s_rows", "grid_rows").alias("grid_rows"),
        F.coalesce("s_cols", "grid_cols").alias("grid_cols"),
        F.coalesce((F.col("s_h") != F.col("h")) | (F.col("s_w") != F.col("w")), F.lit(False)).alias("size_differs"),
    )


def coordinates(slides: DataFrame) -> DataFrame:
    """One row per tile of slides with a grid: half-open row_up, col_up, row_low, col_low of an even split."""
    t = slides.withColumn("tile_id", F.explode(F.expr("sequence(0, grid_rows * grid_cols - 1)")))
    t = t.withColumn("gr", F.expr("cast(tile_id div grid_cols as int)")).withColumn("gc", F.expr("tile_id % grid_cols"))
    at = [
        g.cut_at(F.col(i) + k, F.col(s), F.col(n)).alias(name)
        for name, i, k, s, n in (("row_up", "gr", 0, "h", "grid_rows"), ("col_up", "gc", 0, "w", "grid_cols"), ("row_low", "gr", 1, "h", "grid_rows"), ("col_low", "gc", 1, "w", "grid_cols"))
    ]
    return t.select("slide_id", "tile_id", "gr", "gc", *at)


def sanity(slides: DataFrame, tiles: DataFrame) -> DataFrame:
    """Per slide: tiles found and expected, their area and the image's, and whether both agree."""
    area = (F.col("row_low") - F.col("row_up")).cast("bigint") * (F.col("col_low") - F.col("col_up"))
    sums = tiles.groupBy("slide_id").agg(F.count("*").alias("n_tiles"), F.sum(area).alias("tile_area"))
    both = slides.select(
        "slide_id", (F.col("grid_rows") * F.col("grid_cols")).alias("n_expected"), (F.col("h").cast("bigint") * F.col("w")).alias("image_area")
    ).join(sums, "slide_id", "left")
    n, a = F.coalesce("n_tiles", F.lit(0)), F.coalesce("tile_area", F.lit(0))
    return both.select("slide_id", n.alias("n_tiles"), "n_expected", a.alias("tile_area"), "image_area", ((n == F.col("n_expected")) & (a == F.col("image_area"))).alias("ok"))


def adjacency(slides: DataFrame, wrap: bool = False) -> DataFrame:
    """Neighbours of each tile, null at the border; with wrap, south and east run past the last row and column."""
    t = slides.withColumn("tile_id", F.explode(F.expr("sequence(0, grid_rows * grid_cols - 1)")))
    t = t.withColumn("gr", F.expr("cast(tile_id div grid_cols as int)")).withColumn("gc", F.expr("tile_id % grid_cols"))
    rows, cols = (F.lit(True), F.lit(True)) if wrap else (F.col("gr") < F.col("grid_rows") - 1, F.col("gc") < F.col("grid_cols") - 1)
    return t.select(
        "slide_id",
        "tile_id",
        F.when(F.col("gr") > 0, F.col("tile_id") - F.col("grid_cols")).alias("north"),
        F.when(rows, F.col("tile_id") + F.col("grid_cols")).alias("south"),
        F.when(cols, F.col("tile_id") + 1).alias("east"),
        F.when(F.col("gc") > 0, F.col("tile_id") - 1).alias("west"),
    )
