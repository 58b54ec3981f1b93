"""Which files of a listing are images, masks and tiles, as filters over paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.naming import excluded

#: A path's parts: folder, the folder's own name, file name. All are empty for a path without a folder but the name.
FOLDER, PARENT, NAME = "folder", "parent", "name"


def _part(part: str, path: str = "path") -> Column:
    """By places of slashes, so the work is linear in the path's length."""
    name = F.substring_index(path, "/", -1)
    if part == NAME:
        return name
    inside = F.contains(path, F.lit("/"))
    folder = F.when(inside, F.left(path, F.length(path) - F.length(name) - 1)).otherwise("")
    return folder if part == FOLDER else F.substring_index(folder, "/", -1)


def full_res(files: DataFrame) -> DataFrame:
    """Images in folders named RES, .tif or .tiff, but reduced ones."""
    return files.filter((_part(PARENT) == "RES") & _part(NAME).rlike(r"\.tiff?$") & ~F.contains(_part(NAME), F.lit("res10")))


def iron_images(files: DataFrame) -> DataFrame:
    """Images *000000.tif in folders whose names begin with RES, but reduced ones."""
    return files.filter(_part(PARENT).startswith("RES") & _part(NAME).endswith("000000.tif") & ~F.contains(_part(NAME), F.lit("res10")))


def masks(files: DataFrame) -> DataFrame:
    """(slide_dir, mask): the last mask by name under mask/final_mask of each slide's folder, without those of brain or white matter."""
    found = files.filter(_part(FOLDER).endswith("/mask/final_mask") & _part(NAME).rlike(r"mask\.tiff?$") & ~excluded(_part(NAME)))
    return found.groupBy(F.left(_part(FOLDER), F.length(_part(FOLDER)) - len("/mask/final_mask")).alias("slide_dir")).agg(F.max("path").alias("mask"))


def with_masks(images: DataFrame, files: DataFrame) -> DataFrame:
    """images (path) with the mask of the folder two levels up; images without a mask go."""
    own = images.withColumn("slide_dir", F.left("path", F.length("path") - F.length(F.substring_index("path", "/", -3)) - 1))
    return own.join(masks(files), "slide_dir")


def res_dirs(files: DataFrame) -> DataFrame:
    """(slide_dir, res_dir, small): of each slide's folder the first folder RES*, and the last reduced .tif or .tiff in it."""
    found = files.filter(_part(PARENT).startswith("RES")).withColumn("res_dir", _part(FOLDER)).withColumn("slide_dir", _part(FOLDER, "res_dir"))
    first = found.withColumn("_first", F.min("res_dir").over(Window.partitionBy("slide_dir"))).filter(F.col("res_dir") == F.col("_first"))
    reduced = F.contains(_part(NAME), F.lit("res10")) & _part(NAME).rlike(r"\.tiff?$")
    return first.groupBy("slide_dir", "res_dir").agg(F.max(F.when(reduced, F.col("path"))).alias("small"))


def tiling_infos(files: DataFrame) -> DataFrame:
    """(slide_dir, info): the first RES(* folder of each slide's folder that has tiles/tiling_info.xml."""
    found = files.filter(F.col("path").rlike(r"/RES\([^/]*/tiles/tiling_info\.xml$"))
    return found.groupBy(F.regexp_extract("path", r"^(.*)/RES\([^/]*/tiles/tiling_info\.xml$", 1).alias("slide_dir")).agg(F.min("path").alias("info"))


def seg_tiles(files: DataFrame) -> DataFrame:
    """(path, name, no) of the .tif files in folders whose names hold seg_tiles, numbered by name in each."""
    found = files.filter(F.contains(_part(PARENT), F.lit("seg_tiles")) & _part(NAME).endswith(".tif"))
    no = F.row_number().over(Window.partitionBy(_part(FOLDER)).orderBy(_part(NAME)))
    return found.select("path", _part(NAME).alias("name"), no.alias("no"))


def slice_dirs(files: DataFrame, root: str, marker: str = "heatmap/seg_tiles", skip: tuple[str, ...] = ("magick_tmp",)) -> DataFrame:
    """(slide_dir): root alone if it has the marker's folder, else all its folders but those to skip."""
    inside = files.filter(F.col("path").startswith(root + "/")).select(F.substring("path", F.lit(len(root) + 2), F.length("path")).alias("rest"))
    one = inside.filter(F.col("rest").startswith(marker + "/")).limit(1).select(F.lit(root).alias("slide_dir"))
    subs = inside.filter(F.contains("rest", F.lit("/"))).select(F.substring_index("rest", "/", 1).alias("d")).distinct().filter(~F.col("d").isin(*skip))
    subs = subs.select(F.concat(F.lit(root + "/"), "d").alias("slide_dir")).join(one.select(F.lit(1)), how="left_anti")
    return one.unionByName(subs)


def tile_sources(tiles: DataFrame, predictions: DataFrame, images: DataFrame) -> DataFrame:
    """tiles (slide, tile) with the file of its prediction, else of its image (slide, tile, path each); found is none, image or prediction."""
    both = tiles.join(predictions.withColumnRenamed("path", "_p"), ["slide", "tile"], "left").join(images.withColumnRenamed("path", "_i"), ["slide", "tile"], "left")
    found = F.when(F.col("_p").isNotNull(), "prediction").when(F.col("_i").isNotNull(), "image").otherwise("none")
    return both.select("slide", "tile", F.coalesce("_p", "_i").alias("path"), found.alias("found"))
