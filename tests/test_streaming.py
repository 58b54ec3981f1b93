"""Slides that complete while their tiles arrive."""

import time

import pandas as pd
import pytest

from tilewright.streaming import complete

TILES = "slide string, tile long, n_expected long"


@pytest.fixture
def stateful(spark):
    """A session with the state store that the operator needs; batches without data are left out where a run should end."""
    keys = {"spark.sql.streaming.stateStore.providerClass": complete.PROVIDER, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k in keys:
        spark.conf.unset(k)


def put(folder, n, rows):
    pd.DataFrame(rows, columns=["slide", "tile", "n_expected"]).to_parquet(folder / f"{n:03d}.parquet")


def test_tiles_over_batches_repeats_and_a_restart(stateful, tmp_path):
    tiles, told = tmp_path / "tiles", []
    tiles.mkdir()

    def run():
        stream = stateful.readStream.schema(TILES).option("maxFilesPerTrigger", 1).parquet(str(tiles))
        query = complete.complete_slides(stream).writeStream.foreachBatch(lambda b, i: told.extend(map(tuple, b.collect())))
        query = query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(240)

    put(tiles, 0, [("a", 0, 3), ("a", 1, 3), ("b", 0, 2)])
    put(tiles, 1, [("a", 1, 3), ("c", 0, 1)])
    run()
    assert sorted(told) == [("c", 1, 1, 0, "complete")]
    put(tiles, 2, [("a", 2, 3), ("b", 0, 2)])
    put(tiles, 3, [("a", 2, 3), ("c", 0, 1), ("b", 1, 2)])
    run()  # a new query on the same checkpoint
    assert sorted(told) == [("a", 3, 3, 1, "complete"), ("b", 2, 2, 1, "complete"), ("c", 1, 1, 0, "complete")]
    run()
    assert len(told) == 3


def test_slide_that_stays_away(stateful, tmp_path):
    tiles, told = tmp_path / "tiles", []
    tiles.mkdir()
    put(tiles, 0, [("a", 0, 3), ("a", 1, 3), ("b", 0, 1)])
    stateful.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    stream = stateful.readStream.schema(TILES).parquet(str(tiles))
    query = complete.complete_slides(stream, patience_ms=1000).writeStream.foreachBatch(lambda b, i: told.extend(map(tuple, b.collect())))
    query = query.option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="1 second").start()
    try:
        until = time.time() + 120
        while len(told) < 2 and time.time() < until:
            time.sleep(1)
    finally:
        query.stop()
    assert sorted(told) == [("a", 2, 3, 0, "incomplete"), ("b", 1, 1, 0, "complete")]
