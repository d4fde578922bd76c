"""JSON documents with explicit schemas. A wrong root type or a malformed file fails the read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.schemas import BOOK, MANIFEST, TIMING


def read(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows.withColumn("book_id", F.input_file_name())


def books(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, BOOK)


def manifests(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, MANIFEST)


def timings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read(spark, path, TIMING)


def manifest_units(found: DataFrame) -> DataFrame:
    """Units of manifests as rows (book_id, section_id, section_ord, ord, id, type, display_text, tts_text)."""
    s = found.select("book_id", F.posexplode("sections").alias("section_ord", "s"))
    return s.select("book_id", F.col("s.id").alias("section_id"), "section_ord", F.posexplode("s.units").alias("ord", "u")).select("book_id", "section_id", "section_ord", "ord", "u.*")


def timing_units(found: DataFrame) -> DataFrame:
    return found.select("section_id", F.posexplode("units").alias("ord", "u")).select("section_id", "ord", "u.*")
