"""Each query with SQL against a second engine, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire import book_queries, queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def cells(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    show = lambda v: "~" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)
    return [cols, sorted(tuple(map(show, r)) for r in df[cols].astype(object).itertuples(index=False, name=None))]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, duck, name):
    assert cells(queries.QUERIES[name](spark, DATA).toPandas()) == cells(duck.execute(queries.SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_without_sql(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())


def test_summary_and_tokens_of_all_categories(spark, tmp_path):
    texts = ["Giảm 5% và 3.25 ở NASA, giá $40 hay 1/2 của 16GB", "NASA < S&P 500 quan trong", "Warren Buffett nói 401(k), IBM và 3.25", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {
        "percent": {(0, "5%")}, "decimal": {(0, "3.25"), (2, "3.25")}, "currency": {(0, "$40")}, "slash_expression": {(0, "1/2")}, "attached_unit": {(0, "16GB")},
        "acronym": {(0, "NASA"), (0, "GB"), (1, "NASA"), (1, "S&P 500"), (2, "401(k)"), (2, "IBM")}, "unusual_symbol": {(1, "<")}, "suspicious_source_text": {(1, "quan trong")}, "unmapped_foreign_token": {(2, "Warren Buffett")},
    }
    assert book_queries.query is queries.query
    for f in (queries.audit_summary, queries.entry):
        got = f(spark, str(tmp_path)).collect()
        assert len(got) == 10 and {r.category: r.issues for r in got if r.issues} == {c: len(t) for c, t in want.items()}
    got = queries.audit_distinct_tokens(spark, str(tmp_path)).collect()
    assert sorted(r.token for r in got) == sorted({t for c in ("acronym", "unmapped_foreign_token") for _, t in want[c]})


def test_streamed_units_equal_batch(spark, tmp_path):
    from quire.streaming.units import spoken, token_stream

    rows = spark.createDataFrame([("a", "paragraph", "Giảm 5% ở NASA"), ("b", "heading", "TIỀN")], "id string, type string, display_text string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = token_stream(spoken(stream)).writeStream.format("memory").queryName("tokens").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(map(tuple, spark.table("tokens").collect())) == sorted(map(tuple, token_stream(spoken(rows)).collect()))


def test_first_tokens_come_once_within_the_watermark(spark, tmp_path):
    from quire.streaming.units import first_tokens, spoken

    rows = [("a", "paragraph", "Giảm 5% ở NASA", "2024-01-01 00:00:00"), ("a", "paragraph", "NASA giảm 5%", "2024-01-01 00:10:00"), ("b", "paragraph", "NASA", "2024-01-01 00:20:00")]
    df = spark.createDataFrame(rows, "id string, type string, display_text string, t string").withColumn("t", F.col("t").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = first_tokens(spoken(stream), "t").writeStream.format("memory").queryName("first_tokens").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.id, r.category, r.token) for r in spark.table("first_tokens").collect())
    assert got == [("a", "acronym", "NASA"), ("a", "percent", "5%"), ("b", "acronym", "NASA")]
