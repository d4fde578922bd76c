"""Threshold-scaled document fingerprints.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range,
so its size follows the document's and documents of very unequal length can be
compared. The LEAST smallest hashes are kept in any case, which makes short texts
exact. Both rules hold for a union as well: merging two fingerprints and applying
them again gives the fingerprint of both texts together.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import columns, documents, shuffle_parts
from quire.llm.words import shingle_sets

SHINGLE = 5
#: One hash of so many is kept; hashes are the upper 32 bits of 64.
SCALE = 8
LEAST = 32
BELOW = (1 << 32) // SCALE


def scaled(hashes: np.ndarray) -> np.ndarray:
    """The sorted hashes that a fingerprint keeps, as 32-bit values."""
    h = np.unique((hashes >> np.uint64(32)).astype(np.uint32))
    return h[: max(LEAST, int(np.searchsorted(h, BELOW)))]


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = np.union1d(a, b)
    return h[: max(LEAST, int(np.searchsorted(h, BELOW)))]


def packed(h: np.ndarray) -> str:
    return base64.b64encode(h.astype(">u4").tobytes()).decode()


def unpacked(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u4").astype(np.uint32)


def _whole_below(h: np.ndarray) -> int:
    """Below this value the fingerprint holds every hash of the text."""
    return 1 << 32 if len(h) < LEAST else max(BELOW, int(h[LEAST - 1]) + 1)


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Estimates of the Jaccard similarity, and of the share of a's shingles that b contains.

    Both look only where both fingerprints are whole. Two empty texts are alike (1.0, 1.0); an empty one contains nothing.
    """
    top = min(_whole_below(a), _whole_below(b))
    a, b = a[: np.searchsorted(a, top)], b[: np.searchsorted(b, top)]
    if not len(a) and not len(b):
        return 1.0, 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both), both / len(a) if len(a) else 0.0


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """`doc_id` and `fingerprint` (base64 of big-endian 32-bit hashes) for each row; null and empty texts have an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([packed(scaled(s)) for s in shingle_sets(b["text"], k)], pa.string())], ["doc_id", "fingerprint"])

    return columns(docs, "doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def in_descending_order(docs: DataFrame) -> DataFrame:
    """Rows of doc_id and text dealt into ranges of doc_id, with `part`, `own` and the order within a part.

    Parts are cut at quantiles, and rows of one id, or of none, that fill several
    parts are cut at the hash of their text, which is also their order. A part also gets
    a copy (own is false) of the row that follows its last one: the first of the next
    part that has rows, and for the last part the first row of all. So neighbours meet
    without a global sort, and one row of numbers for each part passes through the driver.
    """
    ranked = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    parts = shuffle_parts(docs.sparkSession)
    at = [i / parts for i in range(1, parts)] or [0.5]
    n, known, cuts = ranked.agg(F.count("*"), F.count("doc_id"), F.percentile_approx("doc_id", at, 10 * parts)).first()
    cuts = np.array(cuts or [], np.int64)[: parts - 1]
    nameless = min(n - known, max(1, round(parts * (n - known) / max(1, n))))  # parts of null ids, which come last

    @F.arrow_udf("int")
    def part_of(x: pa.Array, h: pa.Array) -> pa.Array:
        ids, none = x.fill_null(0).to_numpy(zero_copy_only=False), x.is_null().to_numpy(zero_copy_only=False)
        first, last = np.searchsorted(cuts, ids, "left"), np.searchsorted(cuts, ids, "right")
        share = h.to_numpy(zero_copy_only=False) / 2.0**64 + 0.5
        among = np.where(none, nameless, last - first + 1)
        sub = np.minimum((share * among).astype(np.int64), among - 1)
        return pa.array(np.where(none, sub, nameless + first + sub).astype(np.int32))

    part = part_of("doc_id", "h")
    place = F.struct(F.col("doc_id").isNotNull().cast("int").alias("known"), "doc_id", "h")
    top = {r.part: (r.top.known, r.top.doc_id or 0, r.top.h) for r in ranked.groupBy(part.alias("part")).agg(F.max(place).alias("top")).collect()}
    order = sorted(top, reverse=True)
    after: dict = {}
    for i, p in enumerate(order):
        after.setdefault(top[order[(i + 1) % len(order)]], []).append(p)
    tops = np.array(sorted({h for _, _, h in after}), np.int64)

    @F.arrow_udf("array<int>")
    def lent_to(x: pa.Array, h: pa.Array) -> pa.Array:
        out: list = [[]] * len(x)
        for i in np.flatnonzero(np.isin(h.to_numpy(zero_copy_only=False), tops)).tolist():
            v = x[i].as_py()
            out[i] = after.get((int(v is not None), v or 0, h[i].as_py()), [])
        return pa.array(out, pa.list_(pa.int32()))

    # ids of parts as places in a list, each a task of its own
    task = {p: i for i, p in enumerate(order)}
    number = np.array([task.get(p, 0) for p in range(max(order, default=0) + 1)], np.int32)

    @F.arrow_udf("int")
    def task_of(p: pa.Array) -> pa.Array:
        return pa.array(number[p.to_numpy(zero_copy_only=False)])

    to = F.concat(F.array(F.struct(part.alias("part"), F.lit(True).alias("own"))), F.transform(lent_to("doc_id", "h"), lambda p: F.struct(p.alias("part"), F.lit(False).alias("own"))))
    out = ranked.withColumn("to", F.explode(to)).select("to.part", "to.own", "doc_id", "h", "text")
    return out.repartitionById(max(1, len(top)), task_of("part")).sortWithinPartitions("part", F.col("own").desc(), F.col("doc_id").desc_nulls_last(), F.col("h").desc())


def with_edits(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """Fingerprints of each text, of its edited text and their likeness, and that to the next document.

    The edited text is the text with its last floor(n_chars / 2) code points replaced
    by the first as many, or all, of the next document by descending doc_id; after
    the last comes the first. Rows with one doc_id follow each other by descending hash
    of their text. A null text is empty, null ids come last, a single row is its own
    successor, and no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row whose successor is still to come
        for b in batches:
            rows = []
            for part, own, doc_id, text in zip(*(b[c].to_pylist() for c in ("part", "own", "doc_id", "text")), strict=True):
                if last and last[0] == part:
                    rows.append((last[1], last[2], text))
                elif last:
                    raise RuntimeError(f"no successor of document {last[1]}")
                last = (part, doc_id, text) if own else None
            for lo in range(0, len(rows), 256):
                yield compared(rows[lo : lo + 256])
        if last:
            raise RuntimeError(f"no successor of document {last[1]}")

    def compared(rows) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for _, t, n in rows]
        own, new, after = ([scaled(s) for s in shingle_sets(pa.array(x, pa.large_string()), k)] for x in ([r[1] for r in rows], edited, [r[2] for r in rows]))
        like, beside = [likeness(a, b) for a, b in zip(own, new, strict=True)], [likeness(a, b) for a, b in zip(own, after, strict=True)]
        cols = [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in edited], pa.string()),
            pa.array([packed(x) for x in own], pa.string()),
            pa.array([packed(x) for x in new], pa.string()),
            *(pa.array([x[i] for x in got], pa.float64()) for got, i in ((like, 0), (beside, 0), (like, 1), (beside, 1))),
        ]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "in_edited", "in_next"])

    dealt = in_descending_order(columns(docs, "doc_id", "text"))
    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, in_edited double, in_next double")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edits(documents(spark, sf_dir))
