"""Token counts of flat token files by a separator scan."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.fs as pafs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, small_batches, table, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The end-of-document id: the vocabulary's free one. Ids take two bytes, little-endian.
END = 50256
DTYPE = "<u2"
#: Bytes of a token file that a task scans at a time.
BLOCK = 1 << 22


@lru_cache(maxsize=1)
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, path: str = VOCABULARY) -> DataFrame:
    """Writes the tokens of docs (doc_id, text) to flat files under folder, a file per task; returns (file, ordinal, doc_id).

    A file is ids alone: the tokens of each whole text (null: none) and the end-of-document
    id, again and again, with no index beside it. The returned rows say which document is
    the nth of a file; they are stored as Parquet under folder too. A file is written under
    another name and moved when complete, so a task that runs again replaces it by its like.
    Null and repeated ids and repeated rows have their place in a file like others; texts
    of any length are encoded whole; an empty table makes files without tokens or none.
    """
    small_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}.bin"
        fs, base = _opened(folder)
        draft = f"{base}/_draft-{name}-{task.taskAttemptId()}"
        enc, n = encoder(path), 0
        with fs.open_output_stream(draft) as out:
            for frame in frames:
                for text in frame.text:
                    ids = enc.encode_ordinary((text or "").encode("utf-8", "replace").decode())
                    out.write(np.array([*ids, END], DTYPE).tobytes())
                yield pd.DataFrame({"file": name, "ordinal": np.arange(n, n + len(frame)), "doc_id": frame.doc_id.astype("Int64")})
                n += len(frame)
        fs.move(draft, f"{base}/{name}")

    fs, base = _opened(folder)
    fs.create_dir(base, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows.mapInPandas(run, "file string, ordinal long, doc_id long").write.parquet(f"{folder}/documents")
    return docs.sparkSession.read.parquet(f"{folder}/documents")


def count_tokens(spark: SparkSession, folder: str, end: int = END, dtype: str = DTYPE, block: int = BLOCK) -> DataFrame:
    """(file, ordinal, n_tokens) of the documents in the flat token files folder/*.bin, separators not counted.

    Files are cut into blocks of `block` bytes whatever the documents' bounds. A task
    finds a block's separators by one vectorised comparison and returns the lengths they
    close; the first counts from the block's start. A prefix scan over the blocks of each
    file then numbers the documents and adds what earlier blocks left open. Tokens after
    a file's last separator are a document too; an empty file has none.
    """
    width = np.dtype(dtype).itemsize
    if block % width:
        raise ValueError("block is no multiple of the width of an id")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")
    blocks = files.filter("length > 0").select("path", "length", F.explode(F.expr(f"sequence(0L, (length - 1) div {block})")).alias("block"))
    blocks = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "block")

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p, length, b in zip(frame.path, frame.length, frame.block, strict=True):
                fs, at = _opened(p)
                with fs.open_input_file(at) as f:
                    f.seek(int(b) * block)
                    ids = np.frombuffer(f.read(int(min(block, length - b * block))), dtype)
                ends = np.flatnonzero(ids == end)
                closed = np.diff(ends, prepend=-1) - 1
                left = len(ids) - (ends[-1] + 1 if len(ends) else 0)
                yield pd.DataFrame({"path": [p], "block": [b], "closed": [closed], "n_closed": [len(ends)], "open": [left], "last": [(b + 1) * block >= length]})

    found = blocks.mapInPandas(scan, "path string, block long, closed array<long>, n_closed long, open long, last boolean")
    found = written(found)
    # the prefix scan takes a few numbers of each block; the lengths stay where they are
    sums = found.select("path", "block", "n_closed", "open", "last")
    by_file = Window.partitionBy("path").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("first", F.coalesce(F.sum("n_closed").over(before), F.lit(0)))
    # all blocks since the last one with a separator, that one included, left tokens open
    sums = sums.withColumn("run", F.coalesce(F.sum((F.col("n_closed") > 0).cast("int")).over(before), F.lit(0)))
    in_run = Window.partitionBy("path", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    closer = F.last(F.when(F.col("n_closed") > 0, F.col("open")), ignorenulls=True).over(before)
    sums = sums.withColumn("carried", F.coalesce(closer, F.lit(0)) + F.coalesce(F.sum("open").over(in_run), F.lit(0)))
    tail = F.when(F.col("last"), F.col("open") + F.when(F.col("n_closed") == 0, F.col("carried")).otherwise(0)).otherwise(0)
    sums = sums.select("path", "block", "first", "carried", tail.alias("tail"))
    found = found.select("path", "block", "closed").join(sums, ["path", "block"])
    none = F.array().cast("array<long>")
    lengths = F.when(
        F.size("closed") > 0,
        F.concat(F.array(F.element_at("closed", 1) + F.col("carried")), F.slice("closed", 2, F.greatest(F.size("closed") - 1, F.lit(0)))),
    ).otherwise(none)
    lengths = F.concat(lengths, F.when(F.col("tail") > 0, F.array("tail")).otherwise(none))
    name = F.substring_index("path", "/", -1)
    rows = found.select(name.alias("file"), "first", F.posexplode(lengths).alias("k", "n_tokens"))
    return rows.select("file", (F.col("first") + F.col("k")).alias("ordinal"), "n_tokens")


def op6_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens): documents' tokens are written to flat files, whose separators are then scanned."""
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    named = write_token_files(table(spark, sf_dir, "documents"), folder)
    return count_tokens(spark, folder).join(named.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")
