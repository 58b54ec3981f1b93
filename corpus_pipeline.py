"""From raw documents to token ids: quality, line and near-duplicate filters, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and the rows that the stage before it kept. All
but the last return the columns of documents, and other columns that docs has, whatever
their names. Null ids, repeated ids and repeated rows are rows like others, null texts
count as empty, texts of any length are taken whole, and an empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import bpe, lines, mixing, neardups, quality
from tilewright.llm.common import shared_dir, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or above; repeated rows score alike."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document or line has; n_chars follows.

    Documents that lose all they had are gone; documents without text to begin with stay.
    Of equal lines the one of the smallest id stays, null ids last; rows that repeat an id
    and text lose the same lines.
    """
    found = lines.dedup_lines(docs)
    emptied = (F.col("n_copies") + F.col("n_near") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return found.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row by id (null last) of each group of near duplicates: five-word shingles, similarity 0.8 or more.

    Covering SimHash links what differs in 11 of 64 bits or fewer; similar sets whose
    fingerprints lie further apart meet by MinHash bands, and all pairs are compared
    exactly. Texts without words are one group.
    """
    return neardups.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; rows of one id, and those without, are mixed as one."""
    return mixing.remix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids of each row."""
    return bpe.encode(docs, decoded=False)


STAGES = [("quality", keep_good), ("lines", drop_lines), ("near duplicates", one_of_each), ("mix", mix), ("encode", encode)]

#: The classifier and the fingerprints can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
