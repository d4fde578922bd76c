"""Audio of speech requests: a call for each chunk, a cache by signature, and what counts as valid audio.

No codec is part of this package. What makes sound and what measures it are functions
that the caller gives: `call(text, voice, rate) -> bytes` and `probe(bytes) -> milliseconds`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.ids import canonical_json, json_string, request_signature, text_sha256
from quire.functions.text import ssml
from quire.operators.checks import violation
from quire.operators.chunks import exploded, with_chunks

Call = Callable[[str, str, str], bytes]
Probe = Callable[[bytes], int]
CACHE = "signature string, tts_text_sha256 string, voice string, rate string, max_chars_per_request int, duration_ms long, made_ms long, audio binary"

#: Bytes of audio that a task holds before it hands them on; one request's audio at least.
HELD = 1 << 22


def valid_duration(duration: Column, size: Column) -> Column:
    """Milliseconds of valid audio; null for a file that is missing, empty, can't be measured, or has no length."""
    return F.when((size > 0) & (duration > 0), duration)


def probed(df: DataFrame, probe: Probe, content: str = "audio", target: str = "duration_ms") -> DataFrame:
    """`df` with the valid duration of a binary column; what `probe` fails on has none."""

    @F.pandas_udf("long")
    def measure(data: pd.Series) -> pd.Series:
        def one(b):
            try:
                return None if b is None or not len(b) else int(probe(bytes(b)))
            except Exception:  # whatever a decoder raises, the audio isn't valid
                return None

        return pd.Series([one(b) for b in data], dtype="Int64")

    return df.withColumn(target, valid_duration(measure(F.col(content)), F.length(content)))


def audio_files(spark: SparkSession, folder: str, probe: Probe, pattern: str = "*.mp3") -> DataFrame:
    """(section_id, path, duration_ms) of the audio files below a folder; section_id is the file's name. Empty files give no row, see with_audio."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    found = probed(files.select("path", F.col("content").alias("audio")), probe)
    return found.select(F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1).alias("section_id"), "path", "duration_ms")


def with_audio(sections: DataFrame, files: DataFrame) -> DataFrame:
    """`sections` with path and duration_ms of their audio: null where the file is missing or empty, duration_ms also where it isn't valid."""
    return sections.join(files, "section_id", "left")


def called(requests: DataFrame, call: Call, probe: Probe) -> DataFrame:
    """`requests` (text, voice, rate and others) with audio, duration_ms and error: one call for each row, its failure in its row.

    The call gets the text; whoever needs markup takes it from quire.functions.text.ssml.
    Audio that isn't valid is a failure too, and is not handed on.
    """

    names = requests.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start, size, done = 0, 0, []
            for i in range(b.num_rows):
                text, voice, rate = (b[c][i].as_py() for c in ("text", "voice", "rate"))
                try:
                    data = bytes(call(text, voice, rate))
                    ms = int(probe(data)) if data else 0
                    if ms <= 0:
                        raise ValueError("no valid audio")
                    done.append((data, ms, None))
                    size += len(data)
                except Exception as e:  # the detail of any failure belongs to its request
                    done.append((None, None, f"{type(e).__name__}: {e}"))
                # audio is far larger than its text: it is handed on as it comes, not by the batch of its requests
                if size >= HELD or i + 1 == b.num_rows:
                    made = [pa.array(x, kind) for x, kind in zip(zip(*done, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)]
                    yield pa.RecordBatch.from_arrays([*b.slice(start, len(done)).columns, *made], [*names, "audio", "duration_ms", "error"])
                    start, size, done = i + 1, 0, []

    return requests.mapInArrow(run, f"{requests.schema.simpleString()[7:-1].replace(':', ' ')}, audio binary, duration_ms long, error string")


def call_failures(done: DataFrame) -> DataFrame:
    return violation(done.filter("error IS NOT NULL"), "speech request", F.concat_ws("/", "id", "chunk_id"), "error")


def requests_of(unit_rows: DataFrame, voice: str, rate: str, max_chars: int = 2500) -> DataFrame:
    """The speech requests of units, one for each chunk: all columns of the unit, chunk_id, text, voice, rate, signature and tts_text_sha256."""
    rows = exploded(with_chunks(unit_rows, "tts_text", "chunks", max_chars))
    rows = rows.withColumnRenamed("chunk", "text").withColumn("voice", F.lit(voice)).withColumn("rate", F.lit(rate)).withColumn("max_chars_per_request", F.lit(max_chars))
    return rows.withColumn("signature", request_signature(F.col("text"), F.col("voice"), F.col("rate"), F.col("max_chars_per_request"))).withColumn("tts_text_sha256", text_sha256(F.col("text")))


def markup(requests: DataFrame, language: str = "vi-VN") -> DataFrame:
    return requests.withColumn("ssml", ssml(F.col("text"), F.col("voice"), F.col("rate"), language))


def sidecar(text: Column, voice: Column, rate: Column, max_chars: Column) -> Column:
    """The JSON that stands beside cached audio and tells what it was made from."""
    fields = {"signature": json_string(request_signature(text, voice, rate, max_chars)), "tts_text_sha256": json_string(text_sha256(text)), "voice": json_string(voice), "rate": json_string(rate), "max_chars_per_request": max_chars.cast("string")}
    return canonical_json(fields)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache table at a path, or an empty one if there is none yet. Of a signature's entries the last counts."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def append_cache(done: DataFrame, path: str) -> None:
    """Add the requests that succeeded to the cache table, each signature once."""
    names = [c.split()[0] for c in CACHE.split(", ")]
    done.filter("error IS NULL").dropDuplicates(["signature"]).withColumn("made_ms", F.unix_millis(F.current_timestamp())).select(*names).write.mode("append").parquet(path)


def synthesized(unit_rows: DataFrame, cache_path: str, call: Call, probe: Probe, voice: str, rate: str, max_chars: int = 2500, force: bool = False) -> DataFrame:
    """Units (all columns) with duration_ms, the sum over their chunks. Chunks without valid audio in the cache are called for and added to it.

    Failed calls raise with their details once those that succeeded are in the cache.
    """
    from quire.operators.checks import assert_none
    from quire.operators.timeline import to_synthesize

    spark = unit_rows.sparkSession
    wanted = requests_of(unit_rows, voice, rate, max_chars)
    todo = to_synthesize(wanted, read_cache(spark, cache_path), force).dropDuplicates(["signature"])
    done = called(todo.select("id", "chunk_id", "text", "voice", "rate", "max_chars_per_request", "signature", "tts_text_sha256"), call, probe).persist()
    try:
        append_cache(done, cache_path)
        assert_none(call_failures(done))
    finally:
        done.unpersist()
    made = read_cache(spark, cache_path).filter("duration_ms > 0").groupBy("signature").agg(F.max_by("duration_ms", "made_ms").alias("duration_ms"))
    lengths = wanted.select("section_id", "id", "signature").join(made, "signature").groupBy("section_id", "id").agg(F.sum("duration_ms").alias("duration_ms"))
    return unit_rows.join(lengths, ["section_id", "id"], "left")


def silent(text: str, voice: str, rate: str) -> bytes:
    """A stand-in for a speech service: as many zero bytes as milliseconds, 60 for each character."""
    return bytes(60 * max(1, len(text)))


def silent_length(data: bytes) -> int:
    return len(data)
