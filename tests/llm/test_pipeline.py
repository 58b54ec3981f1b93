"""The corpus pipeline, stage by stage, and the SQL of its operators."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tilewright.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        n.append(docs.count())
        if name != "encode":
            assert docs.columns == columns
            docs = docs.cache()
    assert n[0] <= 200 and n[1] <= n[0] and n[2] <= n[1] and n[4] == n[3]


def test_run_and_empty(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_stages_take_any_rows(spark):
    """Nulls in each column, empty and very long texts, ties, repeated rows, and columns that the operators use themselves."""
    own = ["_key", "_d", "_gone", "_copies", "_near", "_k", "_id", "_n", "_row", "_h", "key", "dkey", "row", "h", "n", "k", "kept", "_kept", "copies", "near", "taken", "size", "rank", "cell", "Text2"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = [tuple(x) for x in docs.limit(60).collect()]
    at = columns.index("text")
    long_ = " ".join(f"{r[at]}" for r in rows)[:400_000] * 3
    base = dict(zip(columns, rows[0], strict=True))
    for change in ({"doc_id": None}, {"text": None}, {"source": None}, {"lang": None}, {"n_chars": None}, {"text": ""}, {"text": " \n\t\n"}, {"text": long_, "doc_id": 99_991}, {"text": long_.replace(" ", ""), "doc_id": 99_992}, {"doc_id": None, "text": None}, {}, {}):
        rows.append(tuple((base | change)[c] for c in columns))
    docs = spark.createDataFrame(rows, docs.schema)
    for i, name in enumerate(own):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        assert stage(spark, docs.filter("false"), SF).count() == 0
        if name == "encode":
            assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(r.doc_id) for r in docs.collect())
            continue
        assert got.columns == docs.columns
        for r in got.collect():
            assert all(r[c] == f"{i}:{'none' if r.doc_id is None else r.doc_id}" for i, c in enumerate(own)), name


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).iterdir():
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    a, b = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    rows = lambda f: sorted(map(str, f[cols].map(lambda v: None if v is None or v != v else v).itertuples(index=False, name=None)))
    assert rows(a) == rows(b)
