"""Tiles as they arrive: block densities by Structured Streaming (an extension of the batch job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.density import tile_density

TILES = "slide int, tile long, h int, w int, rgb binary, mask binary, pred binary"


def stream_blocks(spark: SparkSession, tiles_dir: str, blocks_dir: str, checkpoint_dir: str, npix: int, files_per_batch: int = 64) -> StreamingQuery:
    """Appends the blocks of new Parquet files of tiles under tiles_dir to blocks_dir, until what is there is done.

    The checkpoint remembers the files that are done, so a run resumes where the last one
    ended; each batch overwrites its own part, so a batch that runs again adds nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        tile_density(batch, npix).write.mode("overwrite").parquet(f"{blocks_dir}/batch={number}")

    tiles = spark.readStream.schema(TILES).option("maxFilesPerTrigger", files_per_batch).parquet(tiles_dir)
    return tiles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
