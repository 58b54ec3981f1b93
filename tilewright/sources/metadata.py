"""XML of tilings, neighbours and microscopes, written and read by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import ascii_only


#: XML is parsed once a row, values are taken as they are, and what is no XML is an error.
AS_IS = {"ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}


def escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _tag(name: str, **attributes: Column) -> Column:
    parts = [F.lit(f"<{name}")]
    for k, v in attributes.items():
        parts += [F.lit(f' {k}="'), escaped(v.cast("string")), F.lit('"')]
    return F.concat(*parts)


def tiling_xml(slides: DataFrame, tiles_found: DataFrame | None = None) -> DataFrame:
    """(slide_id, h, w, grid_rows, grid_cols, home, file) -> (slide_id, xml). With tiles_found (slide_id, n_tiles), only slides whose tiles are all there."""
    xml = F.concat(
        _tag("Image", rows=F.col("h"), cols=F.col("w"), file=F.col("file"), home=F.col("home")), F.lit(">"),
        _tag("Tiles", grid_rows=F.col("grid_rows"), grid_cols=F.col("grid_cols")), F.lit("/></Image>"),
    )
    if tiles_found is not None:
        slides = slides.join(tiles_found.select("slide_id", "n_tiles"), "slide_id").filter(F.col("n_tiles") == F.col("grid_rows") * F.col("grid_cols"))
    return slides.select("slide_id", xml.alias("xml"))


def parse_tiling(files: DataFrame, column: str = "xml") -> DataFrame:
    """Adds h, w, file, home, grid_rows and grid_cols of a tiling's XML."""
    schema = "_rows string, _cols string, _file string, _home string, Tiles array<struct<_grid_rows: string, _grid_cols: string>>"
    image = F.from_xml(F.col(column), schema, AS_IS)
    return files.withColumn("_image", image).select(
        *files.columns, F.col("_image._rows").cast("int").alias("h"), F.col("_image._cols").cast("int").alias("w"), F.col("_image._file").alias("file"), F.col("_image._home").alias("home"),
        F.get("_image.Tiles._grid_rows", F.lit(0)).cast("int").alias("grid_rows"), F.get("_image.Tiles._grid_cols", F.lit(0)).cast("int").alias("grid_cols"),
    )


def parse_adjacency(files: DataFrame, column: str = "xml") -> DataFrame:
    """Adds tiles, array<(id, neighbours array<(side, tile)>)>, of the XML that adjacency_xml makes."""
    schema = "Tile array<struct<_id: string, Neighbor: array<struct<_side: string, _tile: string>>>>"
    near = lambda t: F.transform(F.coalesce(t["Neighbor"], F.array()), lambda n: F.struct(n["_side"].alias("side"), n["_tile"].cast("int").alias("tile")))
    tiles = F.transform(F.from_xml(F.col(column), schema, AS_IS)["Tile"], lambda t: F.struct(t["_id"].cast("int").alias("id"), near(t).alias("neighbours")))
    return files.withColumn("tiles", tiles)


SIDES = ("north", "south", "east", "west")


def adjacency_xml(adjacency: DataFrame) -> DataFrame:
    """(slide_id, tile_id, north, south, east, west) -> (slide_id, xml), a Tile for each tile in order and a Neighbor for each that it has."""
    whole = lambda n: n.cast("string")
    side = lambda t, s: F.when(t[s].isNotNull(), F.concat(F.lit(f'<Neighbor side="{s}" tile="'), whole(t[s]), F.lit('"/>')))
    tile = lambda t: F.concat(F.lit('<Tile id="'), whole(t["tile_id"]), F.lit('">'), F.concat_ws("", *[side(t, s) for s in SIDES]), F.lit("</Tile>"))
    # numbers are grouped, not texts of ten times their size
    each = adjacency.groupBy("slide_id").agg(F.sort_array(F.collect_list(F.struct("tile_id", *SIDES))).alias("t"))
    return each.select("slide_id", F.concat(F.lit("<Tiles>"), F.array_join(F.transform("t", tile), ""), F.lit("</Tiles>")).alias("xml"))


def micrometres(metres: Column) -> Column:
    return metres * 1e6


def ome_metadata(slides: DataFrame) -> DataFrame:
    """(slide_id, scale_x, scale_y, scale_z in metres, channels array<string>) -> (slide_id, ome): sizes in micrometres and channel names in ASCII.

    A scale or list of channels that is null or not above zero stays null.
    """
    size = lambda c: F.when(F.col(c) > 0, micrometres(F.col(c)))
    names = F.when(F.size("channels") > 0, F.transform("channels", lambda c: ascii_only(c)))
    unit = lambda c: F.when(F.col(c) > 0, F.lit("um"))
    fields = [f(c).alias(n + s) for c, n in (("scale_x", "PhysicalSizeX"), ("scale_y", "PhysicalSizeY"), ("scale_z", "PhysicalSizeZ")) for f, s in ((size, ""), (unit, "Unit"))]
    return slides.select("slide_id", F.struct(*fields, names.alias("ChannelNames")).alias("ome"))
