"""Tissue masks: blacking out, cleaning predictions, erosion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK_VAL = 255


def segment(pixels: DataFrame, mask_val: int = MASK_VAL) -> DataFrame:
    """red, green and blue become 0 where mask is below mask_val."""
    return pixels.withColumns({c: F.when(F.col("mask") >= mask_val, F.col(c)).otherwise(0) for c in ("red", "green", "blue")})


def masking_applied(pixels: DataFrame, mask_val: int = MASK_VAL) -> DataFrame:
    """Per slide the pixels whose channel sum segment() changes, and whether there are any."""
    total = F.col("red") + F.col("green") + F.col("blue")
    changed = segment(pixels.withColumn("_before", total), mask_val).withColumn("_changed", total != F.col("_before"))
    return changed.groupBy("slide").agg(F.count_if("_changed").alias("n_changed"), (F.count_if("_changed") > 0).alias("applied"))


def clean(pixels: DataFrame, threshold: int = 0) -> DataFrame:
    """pred becomes 0 where red + green + blue is not above threshold; `removed` flags where it was not 0 before."""
    tissue = F.col("red") + F.col("green") + F.col("blue") > threshold
    return pixels.withColumn("removed", (F.col("pred") > 0) & ~tissue).withColumn("pred", F.when(tissue, F.col("pred")).otherwise(0))


def clean_stats(tiles: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Per slide of predictions' tiles (slide, tile) against cleaned pixels of tiles that have a segmented tile."""
    by_tile = cleaned.groupBy("slide", "tile").agg(F.count_if("removed").alias("gone"))
    return tiles.join(by_tile, ["slide", "tile"], "left").groupBy("slide").agg(
        F.count("*").alias("total"),
        F.count("gone").alias("processed"),
        F.count_if(F.col("gone").isNull()).alias("skipped"),
        F.sum(F.coalesce("gone", F.lit(0))).alias("pixels_removed"),
        F.count_if(F.col("gone") > 0).alias("tiles_with_background"),
    )


def join_status(images: DataFrame, masks: DataFrame) -> DataFrame:
    """Per slide: image and mask tiles (slide, tile), how many meet, how many lack the other; slides with unequal counts are excluded and count as errors."""
    both = images.withColumn("i", F.lit(1)).join(masks.withColumn("m", F.lit(1)), ["slide", "tile"], "full")
    sums = both.groupBy("slide").agg(F.count("i").alias("n_images"), F.count("m").alias("n_masks"), F.count_if(F.col("i").isNotNull() & F.col("m").isNotNull()).alias("n_joined"))
    return sums.withColumn("excluded", F.col("n_images") != F.col("n_masks")).withColumn(
        "n_errors", F.when(F.col("excluded"), 1).otherwise(F.col("n_images") - F.col("n_joined")).cast("bigint")
    )


def disk(radius: int) -> list[tuple[int, int]]:
    return [(y, x) for y in range(-radius, radius + 1) for x in range(-radius, radius + 1) if y * y + x * x <= radius * radius]


def eroded(raster: DataFrame, keys: list[str], foreground: Column, radius: int) -> DataFrame:
    """The pixels (keys, r, c) whose whole disk of that radius is foreground; outside counts as background.

    Every foreground pixel votes for the pixels around it; a pixel survives with a vote
    from each place of the disk. Votes are counted before the shuffle, and a raster may
    spread over any number of tasks.
    """
    places = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y, x in disk(radius)])
    votes = raster.filter(foreground).select(*keys, "r", "c", F.explode(places).alias("d"))
    votes = votes.select(*keys, (F.col("r") + F.col("d.y")).alias("r"), (F.col("c") + F.col("d.x")).alias("c"))
    return votes.groupBy(*keys, "r", "c").count().filter(F.col("count") == len(disk(radius))).drop("count")


def erosion_radius(erosion_pixels: int, mask_scale: int = 10) -> int:
    return max(1, erosion_pixels // mask_scale)


def erode(raster: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """mask keeps its value where it survives erosion and is 0 elsewhere."""
    alive = eroded(raster, keys, F.col("mask") > 0, radius).withColumn("_alive", F.lit(True))
    return raster.join(alive, [*keys, "r", "c"], "left").withColumn("mask", F.when(F.col("_alive"), F.col("mask")).otherwise(0)).drop("_alive")
