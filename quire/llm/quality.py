"""Quality scores: random Fourier features, ridge regression and isotonic calibration.

Statistics of a text's characters, words and lines are standardised and mapped to
random Fourier features, whose inner products approximate a Gaussian kernel.
Each partition sums its part of the normal equations, the sums give the ridge
weights, and isotonic regression over binned scores turns scores into probabilities.
The scores that it sees are those of weights fitted without their rows: the rows are
dealt into two halves, each scored by the other's weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import columns, documents, held_out, kept, lean
from quire.llm.words import SPACE, passes, shingle_hashes, utf8, word_hashes

FOLDS = 3
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
FEATURES = 256
WIDTH = 0.35
RIDGE = 1e-3
BINS = 1000
SEED = 5

#: Byte classes, counted per text: what isn't named is class 0.
CLASSES = ("lower", "upper", "digit", "blank", "newline", "stop", "bang", "symbol", "bar", "quote", "lead", "tail", "other")
_members = {
    "lower": range(0x61, 0x7B), "upper": range(0x41, 0x5B), "digit": range(0x30, 0x3A), "blank": b" \t\r\x0b\x0c", "newline": b"\n", "stop": b".,;:", "bang": b"!?",
    "symbol": b"#$%&*@^~=+<>/\\_", "bar": b"|[]{}()", "quote": b"\"'`-", "lead": range(0xC0, 0x100), "tail": range(0x80, 0xC0),
}
KIND = np.full(256, CLASSES.index("other"), np.int64)
for _i, _c in enumerate(CLASSES[:-1]):
    KIND[list(_members[_c])] = _i


def statistics(col) -> np.ndarray:
    """One row of statistics for each text. An empty text has zeros."""
    data, at = utf8(col)
    out = np.zeros((len(at) - 1, len(CLASSES) + 7))
    n_kinds = len(CLASSES)
    for lo, hi in passes(at):
        part = at[lo : hi + 1] - at[lo]
        text = data[at[lo] : at[hi]]
        size = np.diff(part)
        row = np.repeat(np.arange(hi - lo), size)
        counts = np.bincount(row * n_kinds + KIND[text], minlength=(hi - lo) * n_kinds).reshape(-1, n_kinds)
        some = np.maximum(size, 1)[:, None]
        h, word_at, starts, ends = word_hashes(text, part)
        runs, run_at = shingle_hashes(h, word_at)
        words = np.diff(word_at)
        letters = np.concatenate(([0], np.cumsum(ends - starts)))
        ends_odd = np.concatenate(([0], np.cumsum((KIND[text[ends - 1]] == CLASSES.index("symbol")) | (KIND[text[ends - 1]] == CLASSES.index("bang"))))) if len(ends) else np.zeros(1)
        own = out[lo:hi]
        own[:, :n_kinds] = np.sqrt(counts / some)
        own[:, n_kinds] = np.log1p(size) / 4
        own[:, n_kinds + 1] = np.log1p((letters[word_at[1:]] - letters[word_at[:-1]]) / np.maximum(words, 1))
        own[:, n_kinds + 2] = np.sqrt((ends_odd[word_at[1:]] - ends_odd[word_at[:-1]]) / np.maximum(words, 1))
        for i in range(hi - lo):
            w, r = h[word_at[i] : word_at[i + 1]], runs[run_at[i] : run_at[i + 1]]
            if len(w):
                own[i, n_kinds + 3] = len(np.unique(w)) / len(w)
                own[i, n_kinds + 4] = len(np.unique(r)) / len(r)
        lines = counts[:, CLASSES.index("newline")] + 1
        own[:, n_kinds + 5] = np.log1p(words / lines) / 3
        own[:, n_kinds + 6] = np.sqrt(_double_space(text, part, some[:, 0]))
    return out


def _double_space(text: np.ndarray, part: np.ndarray, some: np.ndarray) -> np.ndarray:
    """White space followed by white space, as a share of all bytes."""
    blank = SPACE[text]
    twice = np.concatenate(([0], np.cumsum(blank & np.concatenate((blank[1:], [False])))))
    return (twice[part[1:]] - twice[part[:-1]]) / some


class Features:
    """Standardised statistics mapped to cosines of random projections; cos and offsets come from the seed."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, n: int = FEATURES, width: float = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(size=(len(mean), n)) * width
        self.b = rng.uniform(0, 2 * np.pi, n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))], 1)


class Model:
    def __init__(self, features: Features, weights: np.ndarray, knots: np.ndarray, values: np.ndarray):
        self.features, self.weights, self.knots, self.values = features, weights, knots, values

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.features(x) @ self.weights, self.knots, self.values), 0, 1) if len(x) else np.zeros(0)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the nondecreasing fit to y at ascending x: pooled means at the blocks' mean places."""
    blocks: list[list[float]] = []  # weight, sum of y, sum of x
    for a, b, w in zip(x, y, weight, strict=True):
        blocks.append([w, w * b, w * a])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def _sums(rows: DataFrame, make) -> np.ndarray:
    """make(statistics, labels, halves) summed over the partitions of (x binary, y int, half int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x = np.stack([np.frombuffer(v.as_buffer(), np.float64) for v in b["x"]])
                got = make(x, b["y"].to_numpy().astype(np.float64), b["half"].to_numpy())
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    parts = [np.frombuffer(r.s, np.float64) for r in rows.mapInArrow(lean(run), "s binary").collect()]
    return np.sum(parts, axis=0) if parts else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, train, label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """A model from the rows of `labels` for which the condition `train` holds; None without any.

    At most about `sample` labelled rows are used, the same ones in each run: those
    whose hashed id is below a share. They are so few that they are sent to all
    tasks that read texts; the fit itself is summed up by partition.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col(f"`{label}`").cast("int").alias("y")).filter(train & F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    share = min(1.0, sample / max(1, known.count()))
    known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < int(share * (1 << 20)))

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(b["text"])
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), b["y"], b["half"]], ["x", "y", "half"])

    known = known.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(known), "doc_id").select("text", "y", "half")
    # the texts are read where they lie; of the few rows of numbers left, few parts each return sums of a fixed size
    rows = kept(texts.mapInArrow(lean(stats), "x binary, y int, half int").repartition(8))
    head = _sums(rows, lambda x, y, half: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]))
    if not len(head):
        return None
    d = (len(head) - 1) // 2
    mean = head[1 : d + 1] / head[0]
    scale = np.sqrt(np.maximum(head[d + 1 :] / head[0] - mean**2, 0)) + 1e-3
    features = Features(mean, scale)

    n = FEATURES + 1

    def normal(x, y, half):
        z = features(x)
        return np.concatenate([np.concatenate([(z[at].T @ z[at]).ravel(), z[at].T @ y[at], [at.sum()]]) for at in (half == 0, half == 1)])

    def solved(total):
        return np.linalg.solve(total[: n * n].reshape(n, n) + RIDGE * total[-1] / n * np.eye(n), total[n * n : -1])

    halves = _sums(rows, normal).reshape(2, -1)
    weights = solved(halves.sum(0))
    # without rows in one of the halves the weights of all have to do
    others = [solved(halves[1 - i]) if halves[1 - i][-1] else weights for i in (0, 1)]

    def histogram(x, y, half):
        z = features(x)
        s = np.clip((np.where(half == 0, z @ others[0], z @ others[1]) + 0.5) * BINS / 2, 0, BINS - 1).astype(np.int64)
        return np.concatenate([np.bincount(s, minlength=BINS), np.bincount(s, y, BINS)]).astype(np.float64)

    bins = _sums(rows, histogram).reshape(2, BINS)
    use = np.flatnonzero(bins[0])
    knots, values = isotonic((use + 0.5) * 2 / BINS - 0.5, bins[1][use] / bins[0][use], bins[0][use])
    return Model(features, weights, knots, values)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, predicted) for each row. A null text is empty. Without a model all scores are 1: nothing is known against a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model(statistics(b["text"])) if model else np.ones(b.num_rows)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(run), "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores 0.5 or more."""
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index("text")
            yield b.filter(pa.array(model(statistics(b.column(i))) >= 0.5, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of `docs`, learned from labels outside the held-out fold.

    Reads doc_id and text of `docs`, doc_id and quality of `labels`; a null, unknown
    or repeated label is ignored, or the greater one taken. Only the text enters a
    score. Rows that repeat get the same score.
    """
    model = fit(docs, labels, ~held_out(F.col("doc_id"), folds))
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score", "predicted")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(columns(documents(spark, sf_dir), "doc_id", "text"), columns(documents(spark, sf_dir, "labels"), "doc_id", "quality"))
