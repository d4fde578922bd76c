"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.words import mix


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_checkpoints(spark: SparkSession) -> None:
    """Name the folder for checkpoint(): the cluster's, or where none is set a new one, if all tasks run on this machine (tests)."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc._jsc.sc().isLocal():
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quire-"))


def kept(df: DataFrame) -> DataFrame:
    """Rows written to the shared checkpoint folder; later reads survive the loss of any executor."""
    with_checkpoints(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Rows written as a table in the shared checkpoint folder and read again, so that their size is known to the planner."""
    spark = df.sparkSession
    with_checkpoints(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers each, up to which a table is sent to all executors: some 30 MB.
FEW_ROWS = 1_000_000


def sent_if_few(df: DataFrame, most: int = FEW_ROWS) -> DataFrame:
    """`df`, a stored table, to be broadcast if it is counted to be small; else the planner joins it."""
    return F.broadcast(df) if df.count() <= most else df


def lean(run):
    """`run` for a task, with the memory that it has freed handed back afterwards: a worker process goes on to other tasks."""

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return trimmed


def shuffle_parts(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, in this order; other columns, whatever their names, don't matter."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def held_out(doc_id, folds: int):
    """crc32 of the id as text modulo `folds` is 1; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 1


def membership(values: DataFrame, column: str, pieces: int = 32):
    """A Bloom filter over a column of 64-bit numbers, of 16 bits for each but 2 ** 20 to 2 ** 27 in all. What it lets through too much, a join must drop."""
    bits = min(27, max(20, 4 + values.count().bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, bool)
        for b in batches:
            for at in _places(b[column].to_numpy(), bits):
                table[at] = True
        rows = [(p, x.tobytes()) for p, x in enumerate(np.split(np.packbits(table), pieces)) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["piece", "bits"])

    def either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for b in batches:
            for p, x in zip(b["piece"].to_pylist(), b["bits"], strict=True):
                got[p] = got.get(p, 0) | np.frombuffer(x.as_py(), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int32()), pa.array([x.tobytes() for x in got.values()], pa.binary())], ["piece", "bits"])

    packed = np.zeros((1 << bits) // 8, np.uint8)
    size = len(packed) // pieces
    for r in values.select(column).mapInArrow(run, "piece int, bits binary").repartition(pieces, "piece").mapInArrow(either, "piece int, bits binary").collect():
        packed[r.piece * size : (r.piece + 1) * size] = np.frombuffer(r["bits"], np.uint8)

    def wanted(x: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), bool)
        for at in _places(x, bits):
            ok &= (packed[at >> 3] >> (7 - (at & 7))) & 1 == 1
        return ok

    return wanted


def _places(x: np.ndarray, bits: int):
    h = mix(x.view(np.uint64))
    for shift in (0, 18, 36):
        yield ((h >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)
