"""Loaders of segmenters that need no weights, to be named in settings and on the command line; others are named alike."""

from __future__ import annotations

from .operators import infer


def bright() -> infer.Segmenter:
    return infer.bright


def ramp() -> infer.Segmenter:
    return infer.ramp
