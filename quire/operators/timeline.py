"""Clips of a section's audio, and the lookup of cached audio. Durations are an input; no codec is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.ids import request_signature, text_sha256


def timeline(unit_rows: DataFrame, section: str = "section_id", order: str = "ord", duration: str = "duration_ms", pause_ms: int = 350) -> DataFrame:
    """`unit_rows` with clip_begin_ms and clip_end_ms: units follow each other with a pause between, none after the last."""
    if pause_ms < 0:
        raise ValueError("pause_ms must not be negative")
    w = Window.partitionBy(section).orderBy(order)
    before = F.coalesce(F.sum(duration).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + (F.row_number().over(w) - 1) * pause_ms
    return unit_rows.withColumn("clip_begin_ms", before.cast("long")).withColumn("clip_end_ms", F.col("clip_begin_ms") + F.col(duration))


def section_durations(clips: DataFrame, section: str = "section_id") -> DataFrame:
    return clips.groupBy(section).agg(F.max("clip_end_ms").alias("duration_ms"), F.count("*").alias("units"))


def timing_documents(clips: DataFrame) -> DataFrame:
    """(section_id, section_ord, audio, duration_ms, units): one row for each section, its units in order."""
    u = F.struct("id", "type", "clip_begin_ms", "clip_end_ms", "duration_ms")
    units = F.transform(F.array_sort(F.collect_list(F.struct("ord", u.alias("u")))), lambda x: x["u"])
    rows = clips.groupBy("section_id", "section_ord").agg(F.max("clip_end_ms").alias("duration_ms"), units.alias("units"))
    return rows.select("section_id", "section_ord", F.concat("section_id", F.lit(".mp3")).alias("audio"), "duration_ms", "units")


def signed(requests: DataFrame, text: str, voice: str, rate: str, max_chars: int) -> DataFrame:
    """`requests` with signature and tts_text_sha256, what a cache entry of this request is known by."""
    return requests.withColumn("signature", request_signature(F.col(text), F.lit(voice), F.lit(rate), F.lit(max_chars))).withColumn("tts_text_sha256", text_sha256(F.col(text)))


def to_synthesize(requests: DataFrame, cache: DataFrame, force: bool = False) -> DataFrame:
    """Requests without a cache entry of their signature whose audio is valid (duration_ms above 0)."""
    valid = cache.filter("duration_ms > 0").select("signature")
    return requests if force else requests.join(valid, "signature", "left_anti")


def cached(requests: DataFrame, cache: DataFrame) -> DataFrame:
    valid = cache.filter("duration_ms > 0").select("signature")
    return requests.join(valid, "signature", "left_semi")


def fake_durations(unit_rows: DataFrame, text: str = "tts_text", ms_per_char: int = 60) -> DataFrame:
    """`unit_rows` with a duration by length, where no speech service is at hand."""
    return unit_rows.withColumn("duration_ms", F.greatest(F.lit(1), F.length(text)).cast("long") * ms_per_char)
