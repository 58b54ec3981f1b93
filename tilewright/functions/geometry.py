"""Grids, blocks and neighbours as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cells(size: Column, tile_px: int) -> Column:
    return F.ceil(size / F.lit(float(tile_px))).cast("int")


def cut_at(i: Column, size: Column, n: Column) -> Column:
    """Start of part i when size pixels are cut evenly into n."""
    return F.floor(i.cast("bigint") * size / n).cast("int")


def block_count(size: Column, npix: int) -> Column:
    """Blocks along a side: half to even, so a side under half a block has none."""
    return F.rint(size / F.lit(float(npix))).cast("int")


def block_of(at: Column, size: Column, npix: int) -> Column:
    """The block of pixel `at`; the last block takes what is left over."""
    return F.least(F.floor(at / F.lit(float(npix))).cast("int"), block_count(size, npix) - 1)


def nearest_source(o: Column, n_in: Column, n_out: Column) -> Column:
    """The source pixel of output pixel o under nearest sampling."""
    return F.least(F.floor((o + 0.5) * n_in / n_out).cast("int"), n_in - 1)


def padded(size: Column, divisor: int = 32) -> Column:
    return (F.ceil(size / F.lit(float(divisor))) * divisor).cast("int")
