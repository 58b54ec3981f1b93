"""Run settings from INI or JSON files."""

from __future__ import annotations

import configparser
import json
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Settings:
    pix_1mm: int = 2890
    pix_5mm: int = 14450
    mask_val: int = 255
    erosion_pixels: int = 0
    mask_scale: int = 10
    hmap_res: float = 0.1
    scale_factor: float = 1000.0
    x_dim: float = 0.0123
    y_dim: float = 0.0123
    z_dim: float = 0.122
    heatmap_erosion_pixels: int = 0
    #: Pixels along a side of the blocks that whole slides are kept in.
    block: int = 1024

    @property
    def npix(self) -> int:
        """Pixels along a block's side."""
        return round(self.hmap_res * self.pix_1mm)


def _with(settings: Settings, found: dict[str, str]) -> Settings:
    kinds = {f.name: type(f.default) for f in fields(Settings)}
    return replace(settings, **{k.lower(): kinds[k.lower()](v) for k, v in found.items() if k.lower() in kinds})


def from_ini(text: str, settings: Settings = Settings()) -> Settings:
    """Settings of all sections of INI text; heat_map's EROSION_PIXELS is heatmap_erosion_pixels; unknown keys are left out."""
    parser = configparser.RawConfigParser()
    parser.read_string(text)
    for section in parser.sections():
        found = dict(parser.items(section))
        if section == "heat_map" and "erosion_pixels" in found:
            found["heatmap_erosion_pixels"] = found.pop("erosion_pixels")
        settings = _with(settings, found)
    return settings


def from_json(text: str, overrides: dict | None = None, settings: Settings = Settings()) -> Settings:
    """Settings of JSON text; overrides come before it, and it before the defaults."""
    return _with(settings, {k: v for k, v in {**json.loads(text), **(overrides or {})}.items() if v is not None})
