"""Files of rasters: discovery, slide lists and NIfTI-1 export."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def discover(spark: SparkSession, folder: str, pattern: str = "*.czi") -> DataFrame:
    """(path, name, bytes) of files below folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("bytes"))


def slide_list(spark: SparkSession, path: str) -> DataFrame:
    """(slide) of a text file with a slide per line; blank lines go."""
    return spark.read.text(path).select(F.trim("value").alias("slide")).filter("slide <> ''")


def nifti_head(shape: tuple[int, ...], scale: tuple[float, float, float]) -> bytes:
    """The 352 bytes before the values (float64, first axis fastest) of a NIfTI-1 image with the affine diag(scale, 1)."""
    if max(shape) > 32767:
        raise ValueError("NIfTI-1 images have at most 32767 pixels a side")
    head = bytearray(352)
    dims = [len(shape), *shape, *[1] * (7 - len(shape))]
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, *dims)
    struct.pack_into("<2h", head, 70, 64, 64)  # float64
    struct.pack_into("<8f", head, 76, 1.0, *scale, 0, 0, 0, 0)
    struct.pack_into("<f", head, 108, 352.0)
    struct.pack_into("<2h", head, 252, 0, 2)  # sform: aligned
    for row in range(3):
        struct.pack_into("<4f", head, 280 + 16 * row, *[scale[row] if k == row else 0.0 for k in range(4)])
    head[344:348] = b"n+1\0"
    return bytes(head)


def nifti(data: np.ndarray, scale: tuple[float, float, float]) -> bytes:
    """A single-file NIfTI-1 image of float64 values with the affine diag(scale, 1)."""
    return nifti_head(data.shape, scale) + data.astype("<f8").tobytes(order="F")


def nifti_tiles(heatmap: DataFrame, scale: tuple[float, float, float] = (0.0123, 0.0123, 0.24)) -> DataFrame:
    """(slide, tile, r, c, value) -> (slide, tile, nifti binary): an image per tile, so none holds a whole slide."""

    def image(frame: pd.DataFrame) -> pd.DataFrame:
        data = np.zeros((frame.r.max() + 1, frame.c.max() + 1))
        data[frame.r, frame.c] = frame.value
        return pd.DataFrame({"slide": [frame.slide.iloc[0]], "tile": [frame.tile.iloc[0]], "nifti": [nifti(data, scale)]})

    types = dict(heatmap.dtypes)
    return heatmap.groupBy("slide", "tile").applyInPandas(image, f"slide {types['slide']}, tile {types['tile']}, nifti binary")
