"""tilewright: tiled-raster analytics expressed as PySpark DataFrame jobs."""
