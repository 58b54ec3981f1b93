"""Scenes with any axes, brought to planes of Y and X, with channels or without."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Of three axes without a Y or an X, one of at most CHANNELS entries beside two of more than WIDE has the channels.
CHANNELS, WIDE = 4, 16


def plane_of(data: np.ndarray, axes: str) -> tuple[np.ndarray, str]:
    """The greatest values over all axes but channels (C, else 0), Y and X: (array, "CYX" or "YX").

    Axes of length 1 go first. Without a Y or an X, the last two axes are they, and what is
    named channels counts as such only if the sizes agree; otherwise it is reduced too. A
    plane without channels keeps the order of its axes.
    """
    if len(axes) != data.ndim:
        raise ValueError(f"{axes} doesn't name the axes of {data.shape}")
    names = [a for a, n in zip(axes, data.shape, strict=True) if n > 1]
    data = data.reshape([n for n in data.shape if n > 1])
    if data.ndim < 2:
        raise ValueError(f"no plane in {data.shape}")
    named = "Y" in names and "X" in names
    y, x = (names.index("Y"), names.index("X")) if named else (data.ndim - 2, data.ndim - 1)
    c = next((names.index(a) for a in "C0" if a in names), None)
    kept = {y, x} | ({c} if c is not None else set())
    for axis in sorted(set(range(data.ndim)) - kept, reverse=True):
        data = data.max(axis=axis)  # one axis after the other, so that only the first pass reads all
    order = sorted(kept)
    if len(order) == 2:
        return data, "YX"
    if not named:
        a, b, d = data.shape
        if a > CHANNELS or min(b, d) <= WIDE:
            return (data.transpose(2, 0, 1), "CYX") if d <= CHANNELS and min(a, b) > WIDE else (data.max(axis=0), "YX")
    return data.transpose([order.index(a) for a in (c, y, x)]), "CYX"


def normalise_scenes(scenes: DataFrame) -> DataFrame:
    """(slide, scene, axes string, shape array<int>, pixels binary) -> (slide, scene, axes, c, h, w, pixels, error): each scene's plane.

    A scene's bytes are viewed by their shape and reduced axis by axis, never a row a
    sample. Channels come first (c is 1 without). A scene that can't be read has its error.
    """
    types = dict(scenes.dtypes)
    schema = f"slide {types['slide']}, scene {types['scene']}, axes string, c int, h int, w int, pixels binary, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for t in f.itertuples():
                try:
                    plane, axes = plane_of(np.frombuffer(t.pixels, np.uint8).reshape([int(n) for n in t.shape]), t.axes)
                    out.append((t.slide, t.scene, axes, plane.shape[0] if axes == "CYX" else 1, *plane.shape[-2:], np.ascontiguousarray(plane).tobytes(), None))
                except (ValueError, TypeError) as e:
                    out.append((t.slide, t.scene, None, None, None, None, None, str(e)[:200]))
            yield pd.DataFrame(out, columns=["slide", "scene", "axes", "c", "h", "w", "pixels", "error"]).astype({n: "Int32" for n in "chw"})

    return scenes.select("slide", "scene", "axes", "shape", "pixels").mapInPandas(run, schema)
