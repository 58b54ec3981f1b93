"""Segmentation of tiles: class choice, padding, inference and test-time augmentation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Takes (3, H, W) floats in [0, 1], sides multiples of 32; returns (classes, H, W) logits.
Segmenter = Callable[[np.ndarray], np.ndarray]


def softmax_argmax(logits: DataFrame, column: str = "logits") -> DataFrame:
    """Adds probs and cls of an array of logits; the lowest class of equal ones."""
    top = F.array_max(column)
    e = F.transform(column, lambda x: F.exp(x - top))
    rows = logits.withColumn("_e", e).withColumn("_s", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x))
    rows = rows.withColumn("probs", F.transform("_e", lambda x: x / F.col("_s")))
    return rows.withColumn("cls", (F.array_position(column, F.array_max(column)) - 1).cast("int")).drop("_e", "_s")


def bright(image: np.ndarray) -> np.ndarray:
    """A segmenter without weights: class 1 where the mean channel is above a half."""
    level = image.mean(axis=0)
    return np.stack([np.full_like(level, 0.5), level])


def ramp(image: np.ndarray) -> np.ndarray:
    """A segmenter without weights whose answer depends on a pixel's place, so that turned tiles give other answers."""
    level = np.rint(image.astype(np.float64) * 255).sum(axis=0) / 765
    r, c = np.indices(level.shape)
    return np.stack([np.full_like(level, 0.5), level + 0.01 * r - 0.02 * c])


def as_rgb(pixels: bytes, h: int, w: int, channels_first: bool = False) -> np.ndarray:
    """A tile's bytes as (h, w, 3): one channel is repeated, a fourth is left out."""
    n = len(pixels) // max(h * w, 1)
    if n not in (1, 3, 4) or n * h * w != len(pixels):
        raise ValueError(f"{len(pixels)} bytes aren't 1, 3 or 4 channels of {h} x {w}")
    x = np.frombuffer(pixels, np.uint8)
    x = x.reshape(n, h, w).transpose(1, 2, 0) if channels_first else x.reshape(h, w, n)
    return np.repeat(x, 3, axis=2) if n == 1 else x[:, :, :3]


def infer(tiles: DataFrame, load: Callable[[], Segmenter], divisor: int = 32, fg: int = 255, channels_first: bool = False) -> DataFrame:
    """(slide, tile, h, w, rgb binary) -> (slide, tile, pred binary, error): whole-tile inference; load runs once per task.

    Tiles of 1, 3 or 4 channels become RGB, are scaled to [0, 1], padded below and right by reflection to multiples of
    divisor and cut back. A tile that fails has a null pred and its error.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            pred, errors = [], []
            for t in frame.itertuples():
                try:
                    x = as_rgb(t.rgb, int(t.h), int(t.w), channels_first).transpose(2, 0, 1).astype(np.float32) / 255
                    down, right = -int(t.h) % divisor, -int(t.w) % divisor
                    mode = "reflect" if min(t.h, t.w) > 1 else "edge"
                    cls = model(np.pad(x, ((0, 0), (0, down), (0, right)), mode=mode)).argmax(axis=0)[: int(t.h), : int(t.w)]
                    pred.append(np.where(cls > 0, fg, 0).astype(np.uint8).tobytes())
                    errors.append(None)
                except Exception as e:  # one broken tile mustn't end the slide
                    pred.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:200])
            yield pd.DataFrame({"slide": frame.slide, "tile": frame.tile, "pred": pred, "error": errors})

    types = dict(tiles.dtypes)
    return tiles.select("slide", "tile", "h", "w", "rgb").mapInPandas(run, f"slide {types['slide']}, tile {types['tile']}, pred binary, error string")


def infer_stats(tiles: DataFrame, results: DataFrame) -> DataFrame:
    """Per slide of tiles (slide, tile): tiles processed, skipped (no result) and failed, with the first failed tile's error."""
    both = tiles.select("slide", "tile").join(results.select("slide", "tile", "error", F.lit(True).alias("_done")), ["slide", "tile"], "left")
    return both.groupBy("slide").agg(
        F.count_if(F.col("_done") & F.col("error").isNull()).alias("processed"), F.count_if(F.col("_done").isNull()).alias("skipped"),
        F.count("error").alias("errors"), F.min_by("error", F.when(F.col("error").isNotNull(), F.col("tile"))).alias("first_error"),
    )


def unit_channels(pixels: DataFrame) -> DataFrame:
    """red, green and blue from 0 to 1."""
    return pixels.withColumns({c: F.col(c) / 255.0 for c in ("red", "green", "blue")})


#: name -> (row, column) in the augmented n x n tile of pixel (r, c); rotations are counter-clockwise.
AUGMENTATIONS = {
    "identity": ("r", "c"),
    "hflip": ("r", "n - 1 - c"),
    "vflip": ("n - 1 - r", "c"),
    "rot90": ("n - 1 - c", "r"),
    "rot180": ("n - 1 - r", "n - 1 - c"),
    "rot270": ("c", "n - 1 - r"),
}


def augment(pixels: DataFrame) -> DataFrame:
    """Pixels (r, c, n = side) of square tiles under each augmentation: aug, ar, ac."""
    each = F.array(*[F.struct(F.lit(k).alias("aug"), F.expr(a).cast("int").alias("ar"), F.expr(b).cast("int").alias("ac")) for k, (a, b) in AUGMENTATIONS.items()])
    return pixels.withColumn("_a", F.explode(each)).select(*pixels.columns, "_a.*")


def tta_mean(predicted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, r, c, p) over augmentations, back in the tile's own coordinates -> mean p and class (1 if above a half)."""
    mean = predicted.groupBy(*keys, "r", "c").agg(F.avg("p").alias("p"))
    return mean.withColumn("cls", (F.col("p") > 0.5).cast("int"))
