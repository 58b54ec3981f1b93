"""Slides that are complete, as their tiles arrive: state by slide in Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

SCHEMA = "slide string, n_tiles long, n_expected long, n_repeats long, status string"
#: The state store that keeps state by slide outside the JVM's heap.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Completion(StatefulProcessor):
    """Counts a slide's distinct tiles against its grid; tells of the slide once, when all are there or its time is over."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tiles = handle.getMapState("tiles", "tile long", "seen boolean")
        # tiles and repeats so far, tiles expected, whether the slide was told of, and when it times out
        self.sums = handle.getValueState("sums", "n long, repeats long, expected long, told boolean, until long")

    def _row(self, slide: str, n: int, expected: int, repeats: int, status: str) -> pd.DataFrame:
        return pd.DataFrame({"slide": [slide], "n_tiles": [n], "n_expected": [expected], "n_repeats": [repeats], "status": [status]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        n, repeats, expected, told, until = self.sums.get() if self.sums.exists() else (0, 0, 0, False, 0)
        for frame in rows:
            expected = max(expected, int(frame.n_expected.max()))
            for tile in frame.tile.tolist():
                if told or self.tiles.containsKey((tile,)):
                    repeats += 1
                else:
                    self.tiles.updateValue((tile,), (True,))
                    n += 1
        whole = not told and 0 < expected <= n
        if whole:
            self.tiles.clear()
        if until:
            self.handle.deleteTimer(until)
            until = 0
        if not told and not whole:
            until = timerValues.getCurrentProcessingTimeInMs() + self.patience_ms
            self.handle.registerTimer(until)
        self.sums.update((n, repeats, expected, told or whole, until))
        if whole:
            yield self._row(key[0], n, expected, repeats, "complete")

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, repeats, expected, told, _ = self.sums.get()
        if not told:
            self.tiles.clear()
            self.sums.update((n, repeats, expected, True, 0))
            yield self._row(key[0], n, expected, repeats, "incomplete")

    def close(self) -> None:
        pass


def complete_slides(tiles: DataFrame, patience_ms: int = 3_600_000) -> DataFrame:
    """A stream of tiles (slide, tile, n_expected) -> (slide, n_tiles, n_expected, n_repeats, status), one row a slide.

    A slide is told of once: as complete when as many distinct tiles as its grid has have
    come, in whichever batches, or as incomplete when no tile of it has come for
    patience_ms of processing time. Tiles that come again count as repeats, tiles of
    slides that were told of as well. Time is looked at with each batch; as long as slides
    are open, batches without data follow, so a run that should end with its input sets
    spark.sql.streaming.noDataMicroBatches.enabled to false. State holds the tiles of open slides alone; a query
    that resumes from its checkpoint goes on where it was. The session needs the state
    store PROVIDER.
    """
    rows = tiles.select(F.col("slide").cast("string").alias("slide"), F.col("tile").cast("long").alias("tile"), F.col("n_expected").cast("long").alias("n_expected"))
    return rows.groupBy("slide").transformWithStateInPandas(Completion(patience_ms), SCHEMA, "Append", "ProcessingTime")
