"""Slide names: case, stain, region and tile names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAINS = ["amyloid", "tau", "iron"]
REGIONS = ["mfg", "put", "bs"]
#: Stains by the word that names them in a slide's name.
KEYWORDS = {"amyloid": "amyloid", "tau": "cp13", "iron": "iron"}


def case_id(name: Column) -> Column:
    """The two leading numbers of a name; null if it has none."""
    found = F.regexp_extract(name, r"^(\d+_\d+)", 1)
    return F.when(found != "", found)


def normalised(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), r"[-\s]+", "_")


def _token(name: Column, words: list[str]) -> Column:
    """The first of words that stands between underscores in the normalised name."""
    framed = F.concat(F.lit("_"), normalised(name), F.lit("_"))
    return F.coalesce(*[F.when(F.contains(framed, F.lit(f"_{w}_")), F.lit(w)) for w in words])


def stain(name: Column) -> Column:
    """tau for any cp13; else the stain named as a token; else null."""
    return F.when(F.contains(normalised(name), F.lit("cp13")), "tau").otherwise(_token(name, STAINS))


def region(name: Column) -> Column:
    return _token(name, REGIONS)


def ordered(name: Column) -> Column:
    """The name with its stain and region tokens exchanged if the stain comes first."""
    parts = F.split(name, "_")
    lower = F.transform(parts, lambda p: F.lower(p))
    keyword = F.coalesce(*[F.when(stain(name) == s, F.lit(k)) for s, k in KEYWORDS.items()])
    a, b = F.array_position(lower, keyword), F.array_position(lower, region(name))
    swap = lambda p, i: F.when(i == a - 1, F.element_at(parts, b.cast("int"))).when(i == b - 1, F.element_at(parts, a.cast("int"))).otherwise(p)
    return F.when((a > 0) & (b > 0) & (a < b), F.array_join(F.transform(parts, swap), "_")).otherwise(name)


#: Folders of segmented tiles by stain.
SEG_FOLDERS = {"amyloid": "Amyloid_seg_tiles", "tau": "Tau_seg_tiles", "iron": "Iron_seg_tiles"}


def seg_folder(stain_name: Column) -> Column:
    """The folder of a stain's segmented tiles; null for other stains."""
    return F.coalesce(*[F.when(stain_name == s, F.lit(f)) for s, f in SEG_FOLDERS.items()])


def tile_name(tile: Column, mask: bool = False) -> Column:
    return F.format_string("tile_%04d_mask.tif" if mask else "tile_%04d.tif", tile)


def tile_number(name: Column) -> Column:
    found = F.regexp_extract(name, r"^tile_(\d+)(_mask)?\.tif$", 1)
    return F.when(found != "", found.cast("int"))


def ascii_only(text: Column) -> Column:
    """Micro signs before m become u; other characters outside ASCII become ?."""
    return F.regexp_replace(F.regexp_replace(text, "µm", "um"), r"[^\x00-\x7F]", "?")


def matches_any(name: Column, patterns: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(p) for p in patterns]).cast("array<string>"), lambda p: F.contains(name, p))


def excluded(name: Column) -> Column:
    """Names of brain and white-matter masks and of downsampled images."""
    lower = F.lower(name)
    return lower.contains("brain") | lower.contains("wm") | lower.contains("res10") | lower.contains("magick_tmp")


def without_stain(name: Column) -> Column:
    """The name without its stain's token."""
    keyword = F.coalesce(*[F.when(stain(name) == s, F.lit(k)) for s, k in KEYWORDS.items()])
    kept = F.filter(F.split(name, "_"), lambda p: F.lower(p) != keyword)
    return F.when(keyword.isNotNull(), F.array_join(kept, "_")).otherwise(name)


def same_colour(stain_name: Column) -> Column:
    """A stain as settings and folders write it (TAU, Tau) in the one form used here."""
    return F.lower(F.trim(stain_name))


def class_numbers(label: Column, values: list[int]) -> Column:
    """The place of each label in values; null for others."""
    return (F.nullif(F.array_position(F.lit(values).cast("array<int>"), label.cast("int")), F.lit(0)) - 1).cast("int")


def wanted_files(files: DataFrame, skip: DataFrame | None = None, max_bytes: int = 300 << 30) -> DataFrame:
    """files (name, bytes) of at most max_bytes that excluded() doesn't name and skip (name) doesn't list."""
    kept = files.filter(~excluded(F.col("name")) & (F.col("bytes") <= max_bytes))
    return kept if skip is None else kept.join(skip.select("name"), "name", "left_anti")
