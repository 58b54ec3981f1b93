"""Command line: python -m tilewright COMMAND, by spark-submit or on this machine."""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import infer
from .plans import slides
from .sources import config, tiff, windows


def settings_of(path: str | None) -> config.Settings:
    """Settings of an INI or JSON file, or the defaults."""
    if path is None:
        return config.Settings()
    with open(path) as f:
        text = f.read()
    return config.from_json(text) if path.endswith(".json") else config.from_ini(text)


def segmenter_of(spec: str) -> Callable[[], infer.Segmenter]:
    """The loader that MODULE:NAME names; it is called once a task and returns the segmenter."""
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def inspect(spark: SparkSession, args: argparse.Namespace) -> None:
    tiff.inspect_tiffs(spark, args.images).show(args.rows, truncate=False)


def tile(spark: SparkSession, args: argparse.Namespace) -> None:
    """Windows of all images below a folder, as a Parquet table of tiles."""
    px = args.tile_px or settings_of(args.config).pix_1mm
    windows.read_windows(spark, args.images, px).write.mode(args.mode).parquet(args.out)


def predict(spark: SparkSession, args: argparse.Namespace) -> None:
    """Predictions of tiles (slide, tile, h, w, rgb) by the segmenter that the options or else the JSON configuration name."""
    with open(args.config) as f:
        known = json.load(f)
    spec = args.segmenter or known["segmenter"]
    infer.infer(spark.read.parquet(args.tiles), segmenter_of(spec), known.get("divisor", 32), known.get("frg_class", 255)).write.mode(args.mode).parquet(args.out)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """The stages over tables of tiles and slides; the tables of the last stages, and files of the heatmaps where sizes are given."""
    settings = settings_of(args.config)
    state = {n: spark.read.parquet(getattr(args, n)) for n in ("tiles", "slides", "masks", "mask_sizes", "tissue", "sizes") if getattr(args, n)}
    if "slides" not in state:
        state["slides"] = state["tiles"].groupBy("slide").agg(F.count("*").alias("n_tiles"))
    stages = [slides.prediction(segmenter_of(args.segmenter)) if s.name == "prediction" and args.segmenter else s for s in slides.STAGES]
    state = slides.run_stages(state, stages, settings, args.stages)
    for name in ("blocks", "heatmap", "colormap", "report"):
        if name in state:
            state[name].write.mode(args.mode).parquet(f"{args.out}/{name}")
    if args.sizes and {"heatmap", "colormap"} <= set(state):
        slides.write_heatmaps(state, f"{args.out}/files", settings)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tilewright", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, f: Callable, *needed: str, **options: dict) -> None:
        p = commands.add_parser(name, help=(f.__doc__ or "").split("\n")[0])
        for n in needed:
            p.add_argument(f"--{n}", required=True)
        for n, kw in options.items():
            p.add_argument(f"--{n.replace('_', '-')}", **kw)
        p.set_defaults(run=f)

    mode = {"choices": ["error", "append", "overwrite"], "default": "error"}
    command("inspect", inspect, "images", rows={"type": int, "default": 100})
    command("tile", tile, "images", "out", config={}, tile_px={"type": int}, mode=mode)
    command("predict", predict, "tiles", "out", "config", segmenter={}, mode=mode)
    command(
        "run", run, "tiles", "out", slides={}, config={}, masks={}, mask_sizes={}, tissue={}, sizes={}, segmenter={},
        stages={"nargs": "+", "choices": [s.name for s in slides.STAGES]}, mode=mode,
    )
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("tilewright").getOrCreate(), args)


if __name__ == "__main__":
    main()
