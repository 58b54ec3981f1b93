"""Erosion of whole slides by an exact Euclidean distance transform over canvas blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lower_envelope(f: np.ndarray) -> np.ndarray:
    """For each column and row q the least f[p] + (q - p)^2 over all rows p.

    The parabolas of a column that are lowest somewhere are kept on a stack, for all
    columns at once, so the cost doesn't depend on how far values reach.
    """
    n, m = f.shape
    f = f.astype(np.float64)
    place, start, top = np.zeros((n, m), np.int64), np.full((n + 1, m), np.inf), np.zeros(m, np.int64)
    start[0] = -np.inf
    for q in range(1, n):
        open_ = np.arange(m)
        while len(open_):
            p = place[top[open_], open_]
            meet = (f[q, open_] + q * q - f[p, open_] - p * p) / (2 * (q - p))
            hidden = meet <= start[top[open_], open_]
            done = open_[~hidden]
            top[done] += 1
            place[top[done], done], start[top[done], done], start[top[done] + 1, done] = q, meet[~hidden], np.inf
            open_ = open_[hidden]
            top[open_] -= 1
    out, at, every = np.empty((n, m)), np.zeros(m, np.int64), np.arange(m)
    for q in range(n):
        while (go := start[at + 1, every] < q).any():
            at += go
        p = place[at, every]
        out[q] = f[p, every] + (q - p) ** 2
    return out


def _sides(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distance of each pixel to the nearest unset one of its row; left and right are the nearest beyond the array, as columns of it."""
    h, w = mask.shape
    at = np.arange(w)
    before = np.maximum.accumulate(np.hstack([left[:, None], np.where(mask, np.iinfo(np.int64).min, at)]), axis=1)[:, 1:]
    after = np.minimum.accumulate(np.hstack([np.where(mask, np.iinfo(np.int64).max, at), right[:, None]])[:, ::-1], axis=1)[:, ::-1][:, :-1]
    return np.minimum(at - before, after - at)


def distances(blocks: DataFrame, block: int, reach: int) -> DataFrame:
    """(slide, by, bx, pixels binary) -> the same with `distance` binary: per pixel the squared distance (int64) to the nearest pixel that is 0.

    Exact up to reach * reach, and above that where the nearest lies further. Blocks that
    are missing, and all outside the canvas, are 0. Rows first: of each block only the
    first and last unset pixel of every row go along the block's row, so runs of any
    length are measured. Then columns: a block gets the rows within reach from the blocks
    above and below, and takes the lower envelope of the parabolas of each column.
    """
    spark = blocks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(blocks.dtypes)["slide"]
    span = -(-reach // block)
    far = np.iinfo(np.int32).max

    def ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for t in f.itertuples():
                empty = np.frombuffer(t.pixels, np.uint8).reshape(block, block) == 0
                none = ~empty.any(axis=1)
                first, last = np.where(none, far, empty.argmax(axis=1)), np.where(none, -1, block - 1 - empty[:, ::-1].argmax(axis=1))
                out.append((t.slide, t.by, t.bx, first.astype("<i4").tobytes(), last.astype("<i4").tobytes()))
            yield pd.DataFrame(out, columns=["slide", "by", "bx", "first", "last"])

    def carried(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("bx", kind="stable")
        bx = f.bx.to_numpy()
        first, last = (np.stack([np.frombuffer(x, "<i4") for x in f[c]]).astype(np.int64) for c in ("first", "last"))
        left, right = np.empty_like(last), np.empty_like(first)
        for i in range(len(f)):
            near = i > 0 and bx[i - 1] == bx[i] - 1
            left[i] = np.where(last[i - 1] >= 0, last[i - 1] - block, left[i - 1] - block) if near else -1
        for i in reversed(range(len(f))):
            near = i + 1 < len(f) and bx[i + 1] == bx[i] + 1
            right[i] = np.where(first[i + 1] < far, first[i + 1] + block, right[i + 1] + block) if near else block
        return pd.DataFrame({"slide": f.slide, "by": f.by, "bx": f.bx, "left": [x.tobytes() for x in left], "right": [x.tobytes() for x in right]})

    edges = blocks.select("slide", "by", "bx", "pixels").mapInPandas(ends, f"slide {kind}, by int, bx int, first binary, last binary")
    # of a row of blocks, eight bytes a pixel row and block
    carries = edges.groupBy("slide", "by").applyInPandas(carried, f"slide {kind}, by int, bx int, left binary, right binary")

    def strips(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for t in f.itertuples():
                for dy in range(-span, span + 1):
                    # rows of this block within reach of the block dy further down
                    first, stop = max(0, dy * block - reach), min(block, (dy + 1) * block + reach)
                    if first < stop:
                        cut = lambda raw, each, a=first, b=stop: None if raw is None else raw[a * each : b * each]
                        out.append((t.slide, t.by + dy, t.bx, -dy, first, cut(t.pixels, block), cut(t.left, 8), cut(t.right, 8)))
            yield pd.DataFrame(out, columns=["slide", "by", "bx", "dy", "first", "pixels", "left", "right"])

    def joined(rows: list) -> tuple | None:
        if not any(t.dy == 0 and t.pixels is not None for t in rows):
            return None
        mask, whole = np.zeros((block + 2 * reach, block), bool), b""
        left, right = np.full(len(mask), -1), np.full(len(mask), block)
        for t in rows:
            at = reach + t.dy * block + t.first
            if t.pixels is not None:
                part = np.frombuffer(t.pixels, np.uint8).reshape(-1, block)
                mask[at : at + len(part)] = part != 0
                whole = t.pixels if t.dy == 0 else whole
            else:
                n = len(t.left) // 8
                left[at : at + n], right[at : at + n] = np.frombuffer(t.left, np.int64), np.frombuffer(t.right, np.int64)
        side = np.minimum(_sides(mask, left, right), reach + 1)
        near = lower_envelope(side.astype(np.float64) ** 2)[reach : reach + block].astype("<i8")
        return rows[0].slide, rows[0].by, rows[0].bx, whole, near.tobytes()

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, rows, key = ["slide", "by", "bx", "pixels", "distance"], [], None
        for f in frames:
            out = []
            for t in f.itertuples():
                if rows and (t.slide, t.by, t.bx) != key:
                    out.append(joined(rows))
                    rows = []
                key = t.slide, t.by, t.bx
                rows.append(t)
            yield pd.DataFrame([x for x in out if x], columns=names)
        yield pd.DataFrame([x for x in ([joined(rows)] if rows else []) if x], columns=names)

    none = F.lit(None).cast("binary")
    both = blocks.select("slide", "by", "bx", "pixels", none.alias("left"), none.alias("right")).unionByName(carries.select("slide", "by", "bx", none.alias("pixels"), "left", "right"))
    spread = both.mapInPandas(strips, f"slide {kind}, by int, bx int, dy int, first int, pixels binary, left binary, right binary")
    ordered = spread.repartition(parts, "slide", "by", "bx").sortWithinPartitions("slide", "by", "bx")
    return ordered.mapInPandas(solve, f"slide {kind}, by int, bx int, pixels binary, distance binary")


def erode(blocks: DataFrame, block: int, radius: int) -> DataFrame:
    """(slide, by, bx, pixels binary) -> the same with 0 where not the whole disk of that radius around a pixel is set, over all the slide."""
    kind = dict(blocks.dtypes)["slide"]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            kept = [np.where(np.frombuffer(d, "<i8") > radius * radius, np.frombuffer(p, np.uint8), 0).astype(np.uint8).tobytes() for p, d in zip(f.pixels, f.distance, strict=True)]
            yield f[["slide", "by", "bx"]].assign(pixels=kept)

    return distances(blocks, block, radius).mapInPandas(cut, f"slide {kind}, by int, bx int, pixels binary")
