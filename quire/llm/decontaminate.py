"""Benchmark decontamination with SimHash over windows of the items' sizes.

For an item of w words the windows are all runs of w words of a document; a document
of fewer words is one window as a whole. A
window that shares no shingle with any item has similarity 0, so only windows
around shared shingles get fingerprints; that loses nothing. A window's 64-bit
SimHash is the sign of the summed bits of its shingles, each weighted by its
count. Fingerprints within RADIUS bits of an item's agree with it to within
RADIUS // BLOCKS bits in one of BLOCKS blocks at least, so looking up every block
value within that distance in the index finds all of them. Candidates are then
verified by the exact weighted Jaccard similarity of their shingles:
sum of lesser counts / sum of greater counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import columns, documents, lean, stored
from quire.llm.words import mix, passes, shingle_hashes, utf8, word_hashes

U64 = np.uint64
SHINGLE = 5
SIMILARITY = 0.75
#: At similarity 0.75 two fingerprints differ in 11 bits of 64 on average, with a deviation of 3.
RADIUS = 23
BLOCKS = 8
#: Bytes of an index that is sent to every executor, about; a larger benchmark is looked for in blocks.
INDEX_BYTES = 64 << 20


class ItemIndex:
    """Fingerprints and shingles of benchmark items; about 3 kB for each item of 40 words."""

    def __init__(self, items: list[tuple[int, str]], k: int = SHINGLE):
        h, at, _, _ = word_hashes(*utf8(pa.array([t or "" for _, t in items], pa.large_string())))
        sizes = np.diff(at)
        use = np.flatnonzero(sizes > 0)
        self.k, self.ids, self.size = k, [items[i][0] for i in use], sizes[use]
        self.shingles = []
        for i in use:
            run, _ = shingle_hashes(h[at[i] : at[i + 1]], np.array([0, sizes[i]]), min(k, sizes[i]))
            self.shingles.append(np.unique(run, return_counts=True))
        self.prints = np.array([fingerprint(*s) for s in self.shingles], U64)
        every = np.unique(np.concatenate([s[0] for s in self.shingles])) if len(use) else np.zeros(0, U64)
        self.known = every
        self.gate = np.zeros(1 << 20, bool)
        self.gate[(every >> U64(44)).astype(np.int64)] = True
        owner = [np.zeros(0, np.int64), *(np.full(len(s[0]), i) for i, s in enumerate(self.shingles))]
        place = np.searchsorted(every, np.concatenate([np.zeros(0, U64), *(s[0] for s in self.shingles)]))
        by = np.argsort(place, kind="stable")
        self.owner, self.owner_at = np.concatenate(owner)[by], np.searchsorted(place[by], np.arange(len(every) + 1))
        near = np.array([sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in combinations(range(8), r)])
        self.table = []
        for b in range(BLOCKS):
            value = ((self.prints >> U64(8 * b)) & U64(255)).astype(np.int64)
            keys = (value[:, None] ^ near[None, :]).ravel()
            rows = np.repeat(np.arange(len(value)), len(near))
            by = np.argsort(keys, kind="stable")
            self.table.append((rows[by], np.searchsorted(keys[by], np.arange(257))))

    def within(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All (place in prints, item) of this window size at most RADIUS bits apart."""
        found = []
        for b, (rows, at) in enumerate(self.table):
            value = ((prints >> U64(8 * b)) & U64(255)).astype(np.int64)
            n = at[value + 1] - at[value]
            i = np.repeat(np.arange(len(prints)), n)
            item = rows[np.repeat(at[value] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
            fit = self.size[item] == size
            i, item = i[fit], item[fit]
            near = np.bitwise_count(prints[i] ^ self.prints[item]) <= RADIUS
            found.append(i[near] * len(self.ids) + item[near])
        both = np.unique(np.concatenate(found))
        return both // len(self.ids), both % len(self.ids)


def _bits(shingles: np.ndarray) -> np.ndarray:
    """+1 and -1 for the 64 bits of each shingle's hash."""
    raw = np.unpackbits(mix(shingles ^ U64(0xA5A5A5A5A5A5A5A5)).view(np.uint8).reshape(-1, 8), axis=1)
    return raw.astype(np.int32) * 2 - 1


def fingerprint(shingles: np.ndarray, counts: np.ndarray) -> int:
    total = (_bits(shingles) * counts[:, None]).sum(0)
    return int(np.packbits(total > 0).view(U64)[0])


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def matches(words: np.ndarray, index: ItemIndex, hits: dict[int, np.ndarray], similarity: float) -> list[tuple[int, float, int, int]]:
    """(item, similarity, first word, words) of the best window for each item found in one document.

    hits: for each shingle length, the word positions of shingles that some item has.
    """
    best: dict[int, tuple[float, int]] = {}
    for k, at in hits.items():
        shingles, _ = shingle_hashes(words, np.array([0, len(words)]), k)
        place = np.searchsorted(index.known, shingles[at])
        items = np.unique(np.concatenate([index.owner[index.owner_at[p] : index.owner_at[p + 1]] for p in np.unique(place)]))
        items = items[np.minimum(index.size[items], index.k) == k]
        for size in np.unique(index.size[items]):
            if size > len(words):
                break
            per = int(size) - k + 1
            first, last = np.maximum(at - per + 1, 0), np.minimum(at, len(words) - size)
            step = np.zeros(len(words) + 2, np.int64)
            np.add.at(step, first, 1)
            np.add.at(step, np.maximum(last + 1, first), -1)
            starts = np.flatnonzero(np.cumsum(step)[: len(words) - size + 1] > 0)
            for lo in range(0, len(starts), 20_000):
                s = starts[lo : lo + 20_000]
                # runs of neighbouring windows share one running sum
                cut = np.flatnonzero(np.diff(s) > per) + 1
                prints = []
                for part in np.split(s, cut):
                    total = np.cumsum(_bits(shingles[part[0] : part[-1] + per]), axis=0, dtype=np.int32)
                    total = np.concatenate((np.zeros((1, 64), np.int32), total))
                    prints.append(np.packbits(total[part - part[0] + per] - total[part - part[0]] > 0, axis=1).view(U64).ravel())
                i, item = index.within(np.concatenate(prints), int(size))
                for j, x in zip(i.tolist(), item.tolist(), strict=True):
                    start = int(s[j])
                    # no more of its shingles than this can be the item's
                    own = shingles[start : start + per]
                    got = weighted_jaccard(np.unique(own, return_counts=True), index.shingles[x])
                    if got >= similarity and got > best.get(x, (0.0, 0))[0]:
                        best[x] = (got, start)
        short = items[index.size[items] > len(words)]
        if len(short):
            whole = np.unique(shingles, return_counts=True)
            near = np.bitwise_count(U64(fingerprint(*whole)) ^ index.prints[short]) <= RADIUS
            # the similarity is at most the ratio of the numbers of shingles
            near &= len(shingles) >= similarity * (index.size[short] - k + 1) - 1e-9
            for x in short[near].tolist():
                if (got := weighted_jaccard(whole, index.shingles[x])) >= similarity:
                    best[x] = (got, 0)
    return [(x, s, start, min(int(index.size[x]), len(words))) for x, (s, start) in sorted(best.items())]


def indexes(items: DataFrame, limit: int | None = None) -> Iterator[tuple[ItemIndex, bool]]:
    """Indexes of blocks of items, each of about `limit` bytes at most or one item, and whether it is the only one."""
    limit, rows, size, only = limit or INDEX_BYTES, [], 0, True
    for r in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        # eight tables of places, and three numbers for each shingle
        more = 8 * 8 * 37 + 12 * len(r[1] or "")
        if rows and size + more > limit:
            only = False
            yield ItemIndex(rows), False
            rows, size = [], 0
        rows.append((r[0], r[1]))
        size += more
    yield ItemIndex(rows), only


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words) for each document and item that it holds.

    `docs` has doc_id and text, `items` item_id and text; other columns are
    ignored. The row names the first of the most similar windows; of a document shorter
    than the item, the whole document. Null and empty
    texts match nothing, items of fewer than five words are one shingle, repeated
    items give a row each, repeated documents too, and a null id stays null. Items
    are a stated query set: those of a large benchmark are looked for in blocks, of which
    the driver has one at a time.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for index, only in indexes(items):
        part = _scan(docs, index, similarity)
        part = part if only else stored(part)
        out = part if out is None else out.union(part)
    return out


FOUND = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def _hits(col, index: ItemIndex, similarity: float) -> Iterator[tuple[int, list[tuple[int, float, int, int]]]]:
    """(row, matches) of the rows of a string column that hold an item."""
    data, at = utf8(col)
    lengths = np.unique(np.minimum(index.size, index.k)).tolist()
    for lo, hi in passes(at):
        part = at[lo : hi + 1]
        h, word_at, _, _ = word_hashes(data[part[0] : part[-1]], part - part[0])
        hits: dict[int, dict[int, np.ndarray]] = {}
        for k in lengths:
            runs, run_at = shingle_hashes(h, word_at, k)
            near = np.flatnonzero(index.gate[(runs >> U64(44)).astype(np.int64)])
            place = np.searchsorted(index.known, runs[near])
            near = near[index.known[np.minimum(place, len(index.known) - 1)] == runs[near]]
            row = np.searchsorted(run_at, near, "right") - 1
            for r in np.unique(row):
                if word_at[r + 1] - word_at[r] >= k:
                    hits.setdefault(int(r), {})[k] = near[row == r] - run_at[r]
        for r, found in sorted(hits.items()):
            if got := matches(h[word_at[r] : word_at[r + 1]], index, found, similarity):
                yield lo + r, got


def _scan(docs: DataFrame, index: ItemIndex, similarity: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b["doc_id"]
            out = [(ids[r].as_py(), index.ids[x], s, first, size) for r, got in _hits(b["text"], index, similarity) for x, s, first, size in got]
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [c.split()[0] for c in FOUND.split(", ")])

    return docs.mapInArrow(lean(run), FOUND)


def without_items(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs`, all columns, that hold no item, whatever their ids. Nothing is shuffled."""

    def clean(index: ItemIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                stay = np.ones(b.num_rows, bool)
                stay[[r for r, _ in _hits(b.column(b.schema.get_field_index("text")), index, similarity)]] = False
                yield b.filter(pa.array(stay))

        return run

    for index, _ in indexes(items):
        docs = docs.mapInArrow(lean(clean(index)), docs.schema)
    return docs


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it holds, and nothing for clean documents."""
    return contaminated(columns(documents(spark, sf_dir), "doc_id", "text"), columns(documents(spark, sf_dir, "benchmark"), "item_id", "text"))
