"""A corpus pipeline in five stages over the table `documents`.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and
returns a DataFrame. The first four return the columns of documents. The last adds
`copy`, the number of the copy, as a document may come twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.decontaminate import without_items
from quire.llm.mixture import with_copies
from quire.llm.ngram_join import ngram_jaccard_components
from quire.llm.pii import redacted
from quire.llm.quality import FOLDS, accepted, fit
from quire.llm.shared import documents, held_out, sent_if_few, stored, with_checkpoints


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Without any labels all stay."""
    model = fit(docs, documents(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), FOLDS))
    return accepted(docs, model)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays; rows without an id, which can't be named, stay.

    Of rows that repeat an id one stays, the first by the hash of all their columns.
    """
    found = ngram_jaccard_components(docs).filter("doc_id IS NOT NULL")
    per = found.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("times"))
    per = stored(per.filter("NOT stays OR times > 1"))
    out = docs.join(sent_if_few(per.filter("NOT stays").select("doc_id")), "doc_id", "left_anti")
    again = per.filter("stays").select("doc_id")
    if not again.isEmpty():
        first = Window.partitionBy("doc_id").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
        one = out.join(again, "doc_id", "left_semi").withColumn("of its id", F.row_number().over(first)).filter("`of its id` = 1").drop("of its id")
        out = out.join(again, "doc_id", "left_anti").unionByName(one)
    return out.select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, also those without an id."""
    return without_items(docs, documents(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; n_chars is counted anew."""
    out = redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with the copy's number from 1."""
    out = with_copies(docs).filter("mix.copies > 0")
    return out.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix.copies"))).alias("copy"))


STAGES = [
    ("quality", keep_quality),
    ("near copies", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("personal data", redact_personal_data),
    ("mixture", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared checkpoint folder and read again."""
    with_checkpoints(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{i - 1}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return docs
