"""Inference by overlapping windows over whole slides, with their outputs added up block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import canvas
from .infer import Segmenter


def infer_sliding(blocks: DataFrame, block: int, sizes: DataFrame, load: Callable[[], Segmenter], roi: int = 128, overlap: float = 0.25, classes: int = 2, fg: int = 255) -> DataFrame:
    """RGB slides in blocks (slide, by, bx, pixels) of sizes (slide, h, w) -> (slide, by, bx, pred binary, p binary).

    Windows of roi x roi begin every roi * (1 - overlap) pixels, the last at the border; a
    smaller slide is filled up with 0. Where windows overlap, the mean of their class
    scores counts; pred is fg where the best class isn't 0 (the lowest of equal ones), p
    the probability (float32) of all but class 0. Windows take what they need from the
    blocks they overlap, and hand on a part of their scores to each block, where the parts
    are added in order; no row exceeds a block's scores.
    """
    step = max(1, int(roi * (1 - overlap)))
    starts = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(0), F.ceil(F.greatest(F.col(c) - roi, F.lit(0)) / step).cast("int")), lambda i: F.least(i * step, F.greatest(F.col(c) - roi, F.lit(0)).cast("int"))))
    wanted = sizes.select("slide", "h", "w").withColumn("up", F.explode(starts("h"))).withColumn("left", F.explode(starts("w")))
    wanted = wanted.select("slide", (F.col("up").cast("long") * (1 << 31) + F.col("left")).alias("tile"), "up", "left", F.lit(roi).alias("h"), F.lit(roi).alias("w"))
    found = canvas.windows(blocks, block, wanted, 3)
    kind = dict(blocks.dtypes)["slide"]

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for f in frames:
            for t in f.itertuples():
                out = []
                up, left = divmod(int(t.tile), 1 << 31)
                x = np.frombuffer(t.pixels, np.uint8).reshape(roi, roi, 3).transpose(2, 0, 1).astype(np.float32) / 255
                logits = np.asarray(model(x), np.float32)
                for by in range(up // block, (up + roi - 1) // block + 1):
                    top, low = max(up, by * block), min(up + roi, (by + 1) * block)
                    for bx in range(left // block, (left + roi - 1) // block + 1):
                        side, right = max(left, bx * block), min(left + roi, (bx + 1) * block)
                        part = logits[:, top - up : low - up, side - left : right - left]
                        out.append((t.slide, by, bx, t.tile, top - by * block, side - bx * block, *part.shape[1:], part.tobytes()))
                yield pd.DataFrame(out, columns=["slide", "by", "bx", "tile", "y", "x", "ph", "pw", "scores"])

    def whole(key: tuple, total: np.ndarray, n: np.ndarray) -> tuple:
        mean = total / np.maximum(n, 1)
        e = np.exp(mean - mean.max(axis=0))
        pred = np.where((mean.argmax(axis=0) > 0) & (n > 0), fg, 0).astype(np.uint8)
        return *key, pred.tobytes(), np.where(n > 0, 1 - e[0] / e.sum(axis=0), 0).astype(np.float32).tobytes()

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, key, total, n = ["slide", "by", "bx", "pred", "p"], None, None, None
        for f in frames:
            out = []
            for t in f.itertuples():
                if (t.slide, t.by, t.bx) != key:
                    if key:
                        out.append(whole(key, total, n))
                    key, total, n = (t.slide, t.by, t.bx), np.zeros((classes, block, block)), np.zeros((block, block), np.int32)
                total[:, t.y : t.y + t.ph, t.x : t.x + t.pw] += np.frombuffer(t.scores, np.float32).reshape(classes, t.ph, t.pw)
                n[t.y : t.y + t.ph, t.x : t.x + t.pw] += 1
            yield pd.DataFrame(out, columns=names)
        if key:
            yield pd.DataFrame([whole(key, total, n)], columns=names)

    parts = found.mapInPandas(scored, f"slide {kind}, by int, bx int, tile long, y int, x int, ph int, pw int, scores binary")
    many = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = parts.repartition(many, "slide", "by", "bx").sortWithinPartitions("slide", "by", "bx", "tile")
    return ordered.mapInPandas(added, f"slide {kind}, by int, bx int, pred binary, p binary")
