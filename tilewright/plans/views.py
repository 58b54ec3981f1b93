"""Raster views over the driver's tables, the inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NPIX = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 tiles of embeddings, a row per pixel: slide = label, tile = vec_id."""
    e = table(spark, sf_dir, "embeddings").filter(F.size("embedding") == 64)
    e = e.select(F.col("label").alias("slide"), F.col("vec_id").alias("tile"), F.posexplode("embedding").alias("pos", "e"))
    x = F.col("e").cast("double")
    rows = e.select("slide", "tile", F.floor(F.col("pos") / 8).cast("int").alias("r"), (F.col("pos") % 8).alias("c"), F.lit(8).alias("h"), F.lit(8).alias("w"), x.alias("x"))
    rows = rows.withColumn("red", F.greatest(F.lit(0), F.least(F.lit(255), F.floor(F.col("x") * 1024).cast("int"))))
    rows = rows.withColumn("green", F.expr("cast(red div 2 as int)")).withColumn("blue", F.expr("cast(red div 4 as int)"))
    rows = rows.withColumn("mask", F.expr("case when x > -0.05D then 255 when x > -0.1D then 127 else 0 end"))
    return rows.withColumn("pred", F.expr("if(x > 0.12D or x < -0.25D, 255, 0)"))


def _bytes(values: Column, each) -> Column:
    return F.unhex(F.array_join(F.transform(values, lambda v: each(v)), ""))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tiles with their pixels as bytes: (slide, tile, h, w, rgb, mask, pred)."""
    e = table(spark, sf_dir, "embeddings").select(F.col("label").alias("slide"), F.col("vec_id").alias("tile"), F.col("embedding").cast("array<double>").alias("v"))
    two = lambda x: F.lpad(F.hex(x), 2, "0")
    red = lambda v: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(v * 1024).cast("int")))
    rgb = lambda v: F.concat(two(red(v)), two(F.shiftright(red(v), 1)), two(F.shiftright(red(v), 2)))
    mask = lambda v: F.when(v > -0.05, "FF").when(v > -0.1, "7F").otherwise("00")
    pred = lambda v: F.when((v > 0.12) | (v < -0.25), "FF").otherwise("00")
    return e.filter(F.size("v") == 64).select(
        "slide", "tile", F.lit(8).alias("h"), F.lit(8).alias("w"), _bytes(F.col("v"), rgb).alias("rgb"), _bytes(F.col("v"), mask).alias("mask"), _bytes(F.col("v"), pred).alias("pred")
    )


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of tiles() on a grid of 20 tiles in a row for each slide: (slide, tile, gr, gc, h, w, mask)."""
    at = [F.expr("cast(tile div 20 as int)").alias("gr"), F.expr("cast(tile % 20 as int)").alias("gc")]
    return tiles(spark, sf_dir).select("slide", "tile", *at, "h", "w", "mask")


def tissue_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tissue of placed() at half size as parts of slides: (slide, seq, y0, x0, h, w, pixels), every second pixel of every second row."""
    t = tiles(spark, sf_dir)
    second = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.substring(F.hex("mask"), (F.floor(k / 4) * 32 + k % 4 * 4 + 19).cast("int"), F.lit(2))), ""))
    at = [F.expr("cast(tile div 20 * 4 as int)").alias("y0"), F.expr("cast(tile % 20 * 4 as int)").alias("x0")]
    return t.select("slide", F.col("tile").alias("seq"), *at, F.lit(4).alias("h"), F.lit(4).alias("w"), second.alias("pixels"))


def _byte(column: Column, i: Column) -> Column:
    return F.conv(F.hex(F.substring(column, i + 1, F.lit(1))), 16, 10).cast("int")


def pixels_of(tiles_: DataFrame, column: str) -> DataFrame:
    """(slide, tile, h, w, column binary) -> (slide, tile, r, c, column): a row for each byte."""
    rows = tiles_.select("slide", "tile", "w", F.col(column).alias("_b"), F.explode(F.expr("sequence(0, h * w - 1)")).alias("i"))
    return rows.select("slide", "tile", F.expr("cast(i div w as int)").alias("r"), F.expr("cast(i % w as int)").alias("c"), _byte(F.col("_b"), F.col("i")).alias(column))


def thinned(mask: Column) -> Column:
    """Every second pixel of every second row of an 8 x 8 raster's bytes."""
    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.substring(F.hex(mask), (F.floor(k / 4) * 32 + k % 4 * 4 + 1).cast("int"), F.lit(2))), ""))


def bytes_set(pixels_: Column) -> Column:
    return F.size(F.filter(F.sequence(F.lit(0), F.octet_length(pixels_) - 1), lambda i: _byte(pixels_, i) > 0))


def byte_sum(pixels_: Column) -> Column:
    n = F.octet_length(pixels_)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + _byte(pixels_, i))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3 x 2 parts of one value each on a canvas per supplier; some begin above or left of it."""
    q = F.floor(F.col("l_quantity") * 5).cast("int")
    value = F.when(F.col("l_quantity") < 20, 0).otherwise(q)
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 5).alias("slide"), F.expr("(l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey * 50 + cast(l_quantity as int)").alias("seq"), (F.col("l_partkey") % 40 - 1).cast("int").alias("y0"),
        (F.col("l_orderkey") % 50 - 1).cast("int").alias("x0"), F.lit(3).alias("h"), F.lit(2).alias("w"), F.unhex(F.repeat(F.lpad(F.hex(value), 2, "0"), 6)).alias("pixels"),
    )


def canvas_pixels(blocks: DataFrame, block: int) -> DataFrame:
    """(slide, by, bx, pixels) -> (slide, y, x, v) of the pixels above 0."""
    rows = blocks.select("slide", "by", "bx", F.hex("pixels").alias("_h"), F.explode(F.sequence(F.lit(0), F.lit(block * block - 1))).alias("i"))
    value = F.conv(F.substring("_h", F.col("i") * 2 + 1, F.lit(2)), 16, 10).cast("int")
    rows = rows.select("slide", (F.col("by") * block + F.expr(f"i div {block}")).cast("int").alias("y"), (F.col("bx") * block + F.col("i") % block).cast("int").alias("x"), value.alias("v"))
    return rows.filter("v > 0")


def slide_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path) of files of each slide(): images, reduced images, masks and segmented tiles."""
    ends = ("output/RES/a.tiff", "output/RES/a_res10.tiff", "output/RES_2/b000000.tif", "mask/final_mask/x_mask.tif", "mask/final_mask/y_mask.tiff", "mask/final_mask/z_WM_mask.tif", "heatmap/seg_tiles/tile_0001.tif", "heatmap/seg_tiles/tile_0000.tif")
    # small parts have no mask
    rows = slides(spark, sf_dir).select("name", "p_size", F.explode(F.array(*map(F.lit, ends))).alias("e")).filter("p_size > 5 OR e NOT LIKE 'mask/%'")
    return rows.select(F.concat(F.lit("/data/"), "name", F.lit("/"), "e").alias("path"))


def tile_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tiles of pixels() and the 4 x 4 size they have at reduced scale."""
    e = table(spark, sf_dir, "embeddings").filter(F.size("embedding") == 64)
    return e.select(F.col("label").alias("slide"), F.col("vec_id").alias("tile"), *[F.lit(n).alias(k) for k, n in (("h", 8), ("w", 8), ("out_h", 4), ("out_w", 4))])


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-class logits per pixel: elements i and i + 32 of a vector; y labels every third pixel."""
    e = table(spark, sf_dir, "embeddings").select(F.col("label").alias("slide"), F.col("vec_id").alias("tile"), F.col("embedding").cast("array<double>").alias("v"))
    rows = e.filter(F.size("v") == 64).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(31))))
    return rows.select("slide", "tile", "i", F.array(F.col("v")[F.col("i")], F.col("v")[F.col("i") + 32]).alias("logits"), F.expr("if((tile + i) % 3 = 0, 1, 0)").alias("y"))


def z_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 5).alias("slide"), (F.col("l_orderkey") % 32).alias("y"), (F.col("l_partkey") % 32).alias("x"), F.col("l_linenumber").alias("z"),
        F.floor(F.col("l_quantity") * 5).cast("int").alias("v"),
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per (slide, scene, y, x); 0 where the quantity is under 40."""
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 5).alias("slide"), F.col("l_linenumber").alias("scene"), (F.col("l_orderkey") % 32).alias("y"), (F.col("l_partkey") % 32).alias("x"),
        F.when(F.col("l_quantity") < 40, 0).otherwise(F.floor(F.col("l_quantity") * 5)).cast("int").alias("v"),
    )
    return rows.groupBy("slide", "scene", "y", "x").agg(F.max("v").alias("v"))


def slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slide per part: sizes, and a name whose stain and region change places on every fifth key."""
    key = F.col("p_partkey")
    region = F.element_at(F.array(*map(F.lit, ("MFG", "PUT", "BS"))), (key % 3 + 1).cast("int"))
    stain = F.element_at(F.array(*map(F.lit, ("CP13", "Iron", "Amyloid"))), F.expr("cast(p_partkey div 3 % 3 + 1 as int)"))
    first, second = (F.when(key % 5 == 0, a).otherwise(b) for a, b in ((stain, region), (region, stain)))
    rows = table(spark, sf_dir, "part").select(
        key.alias("slide_id"), (F.lit(3000) + key * 37 % 20000).cast("int").alias("h"), (F.lit(2000) + key * 91 % 30000).cast("int").alias("w"),
        F.concat(key.cast("string"), F.lit("_22_#"), F.col("p_size").cast("string"), F.lit("_"), first, F.lit("_"), second).alias("name"), "p_size", "p_retailprice",
    )
    # a small file is one split, but each slide becomes many tiles and files
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "slide_id")


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of slides: the code and stage of each entry, and the slide's stain."""
    e = table(spark, sf_dir, "events")
    code = F.when(F.col("event_type") == "error", "STAGE1_FAILED").when(F.col("event_type") == "click", "STAGE2_EMPTY").when(F.col("event_type") == "view", "STAGE3_ABNORMAL").otherwise("OK")
    stain = F.when(F.col("user_id") % 3 == 0, "amyloid").when(F.col("user_id") % 3 == 1, "tau").otherwise("iron")
    return e.select(F.col("user_id").alias("slide"), code.alias("code"), F.col("event_type").alias("stage"), "ts", F.col("event_id").alias("seq"), stain.alias("stain"))
