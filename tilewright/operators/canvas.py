"""Parts of images pasted onto a slide's canvas, kept as square blocks of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("last", "last_set", "max")


def paste(parts: DataFrame, block: int = 1024, mode: str = "max", dtype: str = "u1", channels: int = 1) -> DataFrame:
    """(slide, seq, y0, x0, h, w, pixels binary) -> (slide, by, bx, pixels binary): the canvas in blocks of block x block pixels, of `channels` values of dtype each.

    A pixel takes the greatest value of all parts there (mode "max": Z-stacks and other
    axes), that of the part with the highest seq ("last": stitching), or of the last that
    is above 0 ("last_set": mosaics). Pixels that no part covers are 0; what lies above
    or left of the canvas' origin is cut off; blocks without parts have no row.

    Parts are cut at the blocks' borders where they are. A task then lays the parts of a
    block on it one by one, so it holds one block however many planes there are; for
    "max", a task lays what it has on blocks of its own before anything is sent.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    types = dict(parts.dtypes)
    names = ["slide", "by", "bx", "seq", "y", "x", "h", "w", "pixels"]
    schema = f"slide {types['slide']}, by int, bx int, seq {types['seq']}, y int, x int, h int, w int, pixels binary"

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for t in frame.itertuples():
                m = np.frombuffer(t.pixels, dtype).reshape(int(t.h), int(t.w), channels)
                for by in range(max(t.y0, 0) // block, (t.y0 + t.h - 1) // block + 1):
                    top, low = max(t.y0, by * block), min(t.y0 + t.h, (by + 1) * block)
                    for bx in range(max(t.x0, 0) // block, (t.x0 + t.w - 1) // block + 1):
                        left, right = max(t.x0, bx * block), min(t.x0 + t.w, (bx + 1) * block)
                        if low > top and right > left:
                            part = m[top - t.y0 : low - t.y0, left - t.x0 : right - t.x0]
                            out.append((t.slide, by, bx, t.seq, top - by * block, left - bx * block, *part.shape[:2], part.tobytes()))
            if mode == "max" and out:
                held: dict[tuple, np.ndarray] = {}
                for slide, by, bx, _, y, x, h, w, pixels in out:
                    lay(held.setdefault((slide, by, bx), np.zeros((block, block, channels), dtype)), y, x, h, w, pixels)
                if len(held) * block * block * channels * np.dtype(dtype).itemsize < sum(len(o[-1]) for o in out):
                    out = [(*k, out[0][3], 0, 0, block, block, v.tobytes()) for k, v in held.items()]
            yield pd.DataFrame(out, columns=names)

    def lay(canvas: np.ndarray, y: int, x: int, h: int, w: int, pixels: bytes) -> None:
        part, at = np.frombuffer(pixels, dtype).reshape(h, w, channels), canvas[y : y + h, x : x + w]
        if mode == "max":
            np.maximum(at, part, out=at)
        elif mode == "last":
            at[:] = part
        else:
            np.copyto(at, part, where=part > 0)

    def laid(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, canvas = None, None
        for frame in frames:
            out = []
            for t in frame.itertuples():
                if (t.slide, t.by, t.bx) != key:
                    if key:
                        out.append((*key, canvas.tobytes()))
                    key, canvas = (t.slide, t.by, t.bx), np.zeros((block, block, channels), dtype)
                lay(canvas, t.y, t.x, t.h, t.w, t.pixels)
            yield pd.DataFrame(out, columns=["slide", "by", "bx", "pixels"])
        if key:
            yield pd.DataFrame([(*key, canvas.tobytes())], columns=["slide", "by", "bx", "pixels"])

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = parts.select("slide", "seq", "y0", "x0", "h", "w", "pixels").mapInPandas(pieces, schema)
    ordered = cut.repartition(n, "slide", "by", "bx").sortWithinPartitions("slide", "by", "bx", "seq")
    return ordered.mapInPandas(laid, f"slide {types['slide']}, by int, bx int, pixels binary")


def windows(blocks: DataFrame, block: int, wanted: DataFrame, channels: int = 1) -> DataFrame:
    """Windows (slide, tile, up, left, h, w) of canvases in blocks (slide, by, bx, pixels) -> (slide, tile, h, w, pixels binary).

    A window meets the blocks that it overlaps by their places; each hands on the part it
    shares, and a task lays the parts of a window together, so no row is larger than a
    block or a window. What no block covers is 0, left of and above the canvas as well.
    """
    types = dict(wanted.dtypes)
    keys = f"slide {types['slide']}, tile {types['tile']}"
    last = lambda at, size: F.floor((F.col(at) + F.col(size) - 1) / block).cast("int")
    first = lambda at: F.floor(F.col(at) / block).cast("int")
    each = wanted.select("slide", "tile", *[F.col(c).cast("int").alias(c) for c in ("up", "left", "h", "w")])
    met = each.withColumn("by", F.explode(F.sequence(first("up"), last("up", "h")))).withColumn("bx", F.explode(F.sequence(first("left"), last("left", "w"))))
    met = met.join(blocks.select("slide", "by", "bx", "pixels"), ["slide", "by", "bx"])
    parts_ = "y int, x int, ph int, pw int, pixels binary"

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for t in f.itertuples():
                m = np.frombuffer(t.pixels, np.uint8).reshape(block, block, channels)
                top, low = max(t.up, t.by * block), min(t.up + t.h, (t.by + 1) * block)
                side, right = max(t.left, t.bx * block), min(t.left + t.w, (t.bx + 1) * block)
                part = m[top - t.by * block : low - t.by * block, side - t.bx * block : right - t.bx * block]
                out.append((t.slide, t.tile, t.h, t.w, top - t.up, side - t.left, *part.shape[:2], part.tobytes()))
            yield pd.DataFrame(out, columns=["slide", "tile", "h", "w", "y", "x", "ph", "pw", "pixels"])

    def whole(key: tuple, h: int, w: int, parts: list) -> tuple:
        out = np.zeros((h, w, channels), np.uint8)
        for t in parts:
            if t.pixels is not None:
                out[t.y : t.y + t.ph, t.x : t.x + t.pw] = np.frombuffer(t.pixels, np.uint8).reshape(t.ph, t.pw, channels)
        return *key, h, w, out.tobytes()

    def laid(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, key, size, parts = ["slide", "tile", "h", "w", "pixels"], None, (0, 0), []
        for f in frames:
            out = []
            for t in f.itertuples():
                if (t.slide, t.tile) != key:
                    if key:
                        out.append(whole(key, *size, parts))
                    key, size, parts = (t.slide, t.tile), (t.h, t.w), []
                parts.append(t)
            yield pd.DataFrame(out, columns=names)
        if key:
            yield pd.DataFrame([whole(key, *size, parts)], columns=names)

    n = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = met.mapInPandas(cut, f"{keys}, h int, w int, {parts_}")
    # every window has a row of its own, so that one without blocks is there too
    none = each.select("slide", "tile", "h", "w", *[F.lit(0).alias(c) for c in ("y", "x", "ph", "pw")], F.lit(None).cast("binary").alias("pixels"))
    ordered = pieces.unionByName(none).repartition(n, "slide", "tile").sortWithinPartitions("slide", "tile")
    return ordered.mapInPandas(laid, f"{keys}, h int, w int, pixels binary")
