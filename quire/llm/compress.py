"""Language-model scores by prediction by partial matching over bytes.

A trie of byte contexts up to ORDER bytes long holds how often each byte followed
each context in the training texts. A byte that its context has not seen is coded
by an escape (method D: half of each distinct byte's first count goes to it) and then
by the next shorter context, from which all bytes of the longer one are excluded. The pretrained
trie gives the code length of each document; `adaptive` codes one text by what came
before in it.

The trie holds all contexts, so it grows with the corpus and stays where it is counted:
dealt out by its contexts of NEAR bytes, so that a context and all that escapes from it
reach down to NEAR bytes lie in one range. Only the contexts below that, of at most
256 ** (NEAR - 1) kinds, are summed up on the driver and sent to every range. The counts
of all words, for the unigram base, are dealt out likewise, by hash.

Batches of documents send their distinct contexts and words to the ranges and get a
probability or a count for each, with which the batch's texts are read once more. A range
has its counts in memory and one batch's questions at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import columns, documents, held_out, kept, lean, shuffle_parts, stored
from quire.llm.words import LOWER, SPACE, passes, utf8, word_hashes

U64 = np.uint64
FOLDS = 5
ORDER = 5
END = 0x0A
#: Contexts of so many bytes decide the range of all longer ones.
NEAR = 3
#: Documents of one batch at most.
BATCH = 8192
#: Bytes of one batch's texts at most, or one text.
BATCH_BYTES = 16 << 20
#: Ranges of hashes for each shuffle partition.
RANGES_PER_PART = 1


def stream(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all rows, each after ORDER end symbols, with a mask of those that are coded and their rows.

    A row's symbols are its words, lower-cased and joined by one space, and an end.
    """
    n, rows = len(data), len(at) - 1
    blank = SPACE[data]
    keep = ~blank
    # a blank stays if a word's byte comes just before it, and a word follows in the row
    if n:
        first = np.zeros(n, bool)
        first[at[:-1][at[:-1] < n]] = True
        words = np.concatenate(([0], np.cumsum(keep)))
        row = np.repeat(np.arange(rows), np.diff(at))
        after = words[at[row + 1]] - words[1:] > 0
        keep |= blank & ~first & np.concatenate(([False], keep[:-1])) & after
    size = np.concatenate(([0], np.cumsum(keep)))
    size = size[at[1:]] - size[at[:-1]]
    start = np.concatenate(([0], np.cumsum(size + 1))) + ORDER - 1  # ends of the rows before, and the first contexts
    total = int(start[-1]) + 1 - ORDER + 1
    out = np.full(ORDER + (size + 1).sum() + (ORDER - 1) * max(0, rows - 1), END, np.uint8)
    del total
    begin = ORDER + np.concatenate(([0], np.cumsum(size + ORDER)[:-1])) if rows else np.zeros(0, np.int64)
    place = np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    text = LOWER[data[keep]]
    text[SPACE[text]] = 0x20
    out[place] = text
    coded = np.zeros(len(out), bool)
    coded[place] = True
    coded[begin + size] = True
    where = np.flatnonzero(coded)
    return out, where, np.repeat(np.arange(rows), size + 1)


def codes(symbols: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Each coded symbol with its ORDER predecessors in one number, the symbol lowest."""
    code = symbols[where].astype(U64)
    for d in range(1, ORDER + 1):
        code |= symbols[where - d].astype(U64) << U64(8 * d)
    return code


def _range(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(33)).astype(np.int64) % ranges


def _near(keys: np.ndarray) -> np.ndarray:
    """The NEAR bytes before the symbol of each code."""
    return (keys >> U64(8)) & U64((1 << 8 * NEAR) - 1)


def _by_range(r: np.ndarray, ranges: int, *rows: np.ndarray) -> list[tuple]:
    """The rows of each range that has some, in their order."""
    r = r.astype(np.uint16 if ranges <= 1 << 16 else np.int64)
    by = np.argsort(r, kind="stable")
    cut = np.searchsorted(r[by], np.arange(1, ranges))
    return [(i, *x) for i, x in enumerate(zip(*(np.split(x[by], cut) for x in rows), strict=True)) if len(x[0])]


def _codes_by_range(keys: np.ndarray, counts: np.ndarray, ranges: int) -> list[tuple]:
    return [(CODES, *x) for x in _by_range(_range(_near(keys), ranges), ranges, keys, counts)]


def _summed(batches: Iterator[pa.RecordBatch]) -> list[tuple]:
    held: dict[tuple, list] = {}
    for b in batches:
        for kind, r, k, c in _unpacked(b):
            held.setdefault((kind, r), []).append((k, c))
    return [(*of, *_add(*map(np.concatenate, zip(*x, strict=True)))) for of, x in sorted(held.items())]


class _Sums:
    """Keys with counts, gathered and summed up from time to time."""

    def __init__(self) -> None:
        self.keys, self.counts, self.pending = [np.zeros(0, U64)], [np.zeros(0, np.int64)], 0

    def add(self, keys: np.ndarray) -> None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        self.keys.append(keys[first])
        self.counts.append(np.diff(np.append(first, len(keys))))
        self.pending += len(first)
        if self.pending > PENDING:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        k, c = _add(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts, self.pending = [k], [c], 0
        return k, c


def training_counts(docs: DataFrame, ranges: int) -> DataFrame:
    """(kind, range, keys, counts): how often each context and byte, and each word, came, packed by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, words = _Sums(), _Sums()
        for b in batches:
            data, at = utf8(b["text"])
            for lo, hi in passes(at):
                text, part = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                s, where, _ = stream(text, part)
                contexts.add(codes(s, where))
                words.add(word_hashes(text, part)[0])
        w, n = words.total()
        yield _packed(_codes_by_range(*contexts.total(), ranges))
        yield _packed([(WORDS, *x) for x in _by_range(_range(w, ranges), ranges, w, n)])

    return docs.mapInArrow(lean(run), PACKED).repartition(ranges, "range").mapInArrow(lambda it: [_packed(_summed(it))], PACKED)


#: Codes that a task gathers before it sums them up.
PENDING = 1 << 20
PACKED = "kind int, range int, keys binary, counts binary"
#: Kinds of keys.
CODES, WORDS = 0, 1


def _unpacked(b: pa.RecordBatch):
    for kind, r, k, c in zip(b["kind"].to_pylist(), b["range"].to_pylist(), b["keys"], b["counts"], strict=True):
        yield kind, r, _expanded(k.as_py()), np.frombuffer(_whole(c.as_py()), np.int64)


def _squeezed(raw: bytes, level: int = 1) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", level).compress(raw, asbytes=True)


def _whole(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)


def _sorted_bytes(keys: np.ndarray) -> bytes:
    """Sorted keys as the bytes of their differences, equal places together."""
    return _squeezed(np.diff(keys, prepend=U64(0)).view(np.uint8).reshape(-1, 8).T.tobytes())


def _expanded(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(_whole(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view(U64).ravel(), dtype=U64)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    """rows: kind, range, sorted keys, counts."""
    cols = list(zip(*((kind, r, _sorted_bytes(k), _squeezed(c.astype(np.int64).tobytes())) for kind, r, k, c in rows), strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["kind", "range", "keys", "counts"])


def _add(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Trie:
    """The counts of contexts and the log10 probabilities that they give."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        """levels: sorted codes and counts for contexts of 0 to ORDER bytes; from NEAR on maybe only those of one range."""
        self.levels = levels
        self.contexts = []  # for each order: contexts, bytes seen in them, distinct ones, and both for the next order's exclusion
        for k in range(ORDER + 1):
            keys, counts = self.levels[k]
            ctx = keys >> U64(8)
            first = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1]))) if len(ctx) else np.zeros(0, np.int64)
            total = np.add.reduceat(counts, first) if len(first) else counts
            distinct = np.diff(np.append(first, len(keys)))
            if k:  # what the next shorter context has of the bytes seen here
                less = self._count(k - 1, keys & U64((1 << 8 * k) - 1))
                less = np.add.reduceat(less, first) if len(first) else less
            else:
                less = np.zeros(len(first), np.int64)
            self.contexts.append((ctx[first], total, distinct, less))
        keys = self.levels[ORDER][0]
        self.bits = max(10, int(math.ceil(math.log2(max(1, len(keys)) * 2))))
        self.slots = np.zeros(1 << self.bits, U64)
        self.values = np.full(1 << self.bits, np.nan, np.float32)
        at, value = self._slot(keys), self.slow(keys).astype(np.float32)
        left = np.arange(len(keys))
        while len(left):
            free = np.isnan(self.values[at[left]])
            at[left[~free]] = (at[left[~free]] + 1) & ((1 << self.bits) - 1)
            cand = left[free]
            spot, one = np.unique(at[cand], return_index=True)
            self.slots[spot], self.values[spot] = keys[cand[one]], value[cand[one]]
            placed = np.zeros(len(keys), bool)
            placed[cand[one]] = True
            left = left[~placed[left]]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def _count(self, order: int, keys: np.ndarray) -> np.ndarray:
        have, counts = self.levels[order]
        if not len(have):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        return np.where(have[at] == keys, counts[at], 0)

    def slow(self, keys: np.ndarray) -> np.ndarray:
        """log10 probabilities by escapes and exclusion, order by order."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        gone_n, gone_d = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)  # excluded count and bytes at this order
        for k in range(ORDER, -1, -1):
            if not len(left):
                return out
            key = keys[left] & U64((1 << 8 * (k + 1)) - 1)
            ctx, total, distinct, less = self.contexts[k]
            if not len(ctx):
                continue
            at = np.minimum(np.searchsorted(ctx, key >> U64(8)), len(ctx) - 1)
            known = ctx[at] == key >> U64(8)
            n, d = total[at] - gone_n[left], distinct[at] - gone_d[left]
            c = self._count(k, key)
            use = known & (d > 0)
            seen = use & (c > 0)
            out[left[seen]] += np.log10((2 * c[seen] - 1) / (2 * n[seen]))
            escape = use & ~seen
            out[left[escape]] += np.log10(d[escape] / (2 * n[escape]))
            gone_d[left[known]], gone_n[left[known]] = distinct[at[known]], less[at[known]]
            left = left[~seen]
        # order -1: all bytes that were never seen are alike
        out[left] += -np.log10(np.maximum(1, 256 - gone_d[left]))
        return out

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.values[at].astype(np.float64)
        wrong = np.flatnonzero((self.slots[at] != keys) | np.isnan(out))
        missing = []
        while len(wrong):
            none = np.isnan(self.values[at[wrong]])
            missing.append(wrong[none])
            wrong = wrong[~none]
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            hit = self.slots[at[wrong]] == keys[wrong]
            hit &= ~np.isnan(self.values[at[wrong]])
            out[wrong[hit]] = self.values[at[wrong[hit]]]
            wrong = wrong[~hit]
        if missing and len(rows := np.concatenate(missing)):
            unique, back = np.unique(keys[rows], return_inverse=True)
            out[rows] = self.slow(unique)[back]
        return out


def _shorter(keys: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    return _add(keys & U64((1 << 8 * (order + 1)) - 1), counts)


def nearest(counts: DataFrame, ranges: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The levels below NEAR of all counts: their size is bounded by the kinds of bytes, not by the corpus."""
    low = counts.filter(F.col("kind") == CODES).mapInArrow(lambda it: (_packed(_codes_by_range(*_shorter(x, c, NEAR - 1), ranges)) for b in it for _, _, x, c in _unpacked(b)), PACKED)
    low = low.repartition(ranges, "range").mapInArrow(lambda it: [_packed(_summed(it))], PACKED)
    levels = [_gathered(low)]
    for k in range(NEAR - 2, -1, -1):
        levels.insert(0, _shorter(*levels[0], k))
    return levels


def of_range(low: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray, counts: np.ndarray) -> Trie:
    """The trie of one range's codes, whole for all contexts that have its nearest bytes."""
    levels = [_add(keys, counts)]
    for k in range(ORDER - 1, NEAR - 1, -1):
        levels.insert(0, _shorter(*levels[0], k))
    return Trie([*low, *levels])


def _gathered(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    got = rows.collect()
    keys = np.concatenate([np.zeros(0, U64), *(_expanded(bytes(r["keys"])) for r in got)])
    return _add(keys, np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(_whole(bytes(r["counts"])), np.int64) for r in got)]))


def adaptive(text: str) -> float:
    """log10 probability of one text, each byte predicted from what came before it in the text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    symbols, where, _ = stream(data, np.array([0, len(data)]))
    seen: list[dict[bytes, dict[int, int]]] = [{} for _ in range(ORDER + 1)]
    raw, total = symbols.tobytes(), 0.0
    for i in where.tolist():
        s, gone = raw[i], set()
        for k in range(ORDER, -1, -1):
            have = {b: c for b, c in seen[k].get(raw[i - k : i], {}).items() if b not in gone}
            if have:
                n = 2 * sum(have.values())
                if s in have:
                    total += math.log10((2 * have[s] - 1) / n)
                    break
                total += math.log10(len(have) / n)
                gone |= set(have)
        else:
            total -= math.log10(max(1, 256 - len(gone)))
        for k in range(ORDER + 1):
            own = seen[k].setdefault(raw[i - k : i], {})
            own[s] = own.get(s, 0) + 1
    return total


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


def _merged(found: list[np.ndarray]) -> np.ndarray:
    return _distinct(np.concatenate([np.zeros(0, U64), *found]))


def _dealt(keys: np.ndarray, near: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys in order of their ranges, and the place where each range begins."""
    r = _range(near, ranges).astype(np.uint16 if ranges <= 1 << 16 else np.int64)
    by = np.argsort(r, kind="stable")
    return keys[by], np.searchsorted(r[by], np.arange(ranges + 1))


def _in_order(keys: np.ndarray, near: np.ndarray, ranges: int, values: np.ndarray) -> np.ndarray:
    """Values that came in the order of _dealt, for the sorted keys."""
    if len(keys) != len(values):
        raise RuntimeError(f"{len(values)} answers for {len(keys)} keys")
    back = np.empty_like(values)
    back[np.argsort(_range(near, ranges), kind="stable")] = values
    return back


def _read(text: bytes, at: np.ndarray, ranges: int, log_p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text of a batch: the sum of its codes' log10 probabilities, of its words' log10(c + 0.5), and its known words."""
    data, rows = np.frombuffer(text, np.uint8), len(at) - 1
    score, sums, known, held, all_words = np.zeros(rows), np.zeros(rows), np.zeros(rows, np.int64), [], []
    for lo, hi in passes(at):
        part, here = at[lo : hi + 1] - at[lo], data[at[lo] : at[hi]]
        s, where, row = stream(here, part)
        # a code has 48 bits and a batch fewer than 2 ** 16 rows
        both = np.sort((codes(s, where) << U64(16)) | row.astype(U64))
        k = both >> U64(16)
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        h, word_at, _, _ = word_hashes(here, part)
        all_words.append(_distinct(h))
        held.append((lo, hi, k[first], np.diff(np.append(first, len(k))).astype(np.int32), (both & U64(0xFFFF)).astype(np.uint16)))
    keys, words = _merged([x[2] for x in held]), _merged(all_words)
    log_p = _in_order(keys, _near(keys), ranges, log_p).astype(np.float64)
    counts = _in_order(words, words, ranges, counts)
    for lo, hi, k, times, row in held:
        score[lo:hi] = np.bincount(row, np.repeat(log_p[np.searchsorted(keys, k)], times), hi - lo)
        h, word_at, _, _ = word_hashes(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        c, owner = counts[np.searchsorted(words, h)], np.repeat(np.arange(hi - lo), np.diff(word_at))
        sums[lo:hi] = np.bincount(owner, np.log10(c + 0.5), hi - lo)
        known[lo:hi] = np.bincount(owner, c > 0, hi - lo).astype(np.int64)
    return score, sums, known


SENT = "batch long, range int, codes binary, words binary, docs binary, text binary"


def _sent(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows of each batch: one with range -1 holds its documents, the others its distinct codes and words by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH):
                part = whole.slice(lo, BATCH)
                # a batch's texts stay together, so long ones make smaller batches
                for first, last in passes(utf8(part["text"])[1], BATCH_BYTES):
                    yield one(part.slice(first, last - first), (task << 32) + n)
                    n += 1

    def one(b: pa.RecordBatch, number: int) -> pa.RecordBatch:
        data, at = utf8(b["text"])
        n_tokens, asked, found = np.ones(b.num_rows, np.int64), [], []
        for lo, hi in passes(at):
            part, text = at[lo : hi + 1] - at[lo], data[at[lo] : at[hi]]
            h, word_at, _, _ = word_hashes(text, part)
            n_tokens[lo:hi] += np.diff(word_at)
            found.append(_distinct(h))
            s, where, _ = stream(text, part)
            asked.append(_distinct(codes(s, where)))
        keys, words = _merged(asked), _merged(found)
        keys, at_key = _dealt(keys, _near(keys), ranges)
        words, at_word = _dealt(words, words, ranges)
        out = [(number, -1, None, None, _doc_rows(b, n_tokens, at), _squeezed(data.tobytes(), 6))]
        for r in np.flatnonzero((np.diff(at_key) > 0) | (np.diff(at_word) > 0)).tolist():
            out.append((number, r, *(_sorted_bytes(x) for x in (keys[at_key[r] : at_key[r + 1]], words[at_word[r] : at_word[r + 1]])), None, None))
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 4)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in SENT.split(", ")])

    return docs.mapInArrow(lean(run), SENT)


DOC = np.dtype([("id", np.int64), ("none", np.bool_), ("n", np.int64), ("train", np.bool_), ("size", np.int64)])


def _doc_rows(b: pa.RecordBatch, n_tokens: np.ndarray, at: np.ndarray) -> bytes:
    ids = b["doc_id"]
    out = np.zeros(b.num_rows, DOC)
    out["id"], out["none"], out["n"], out["size"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), n_tokens, np.diff(at)
    out["train"] = ~b["held_out"].to_numpy(zero_copy_only=False)
    return out.tobytes()


ANSWER = "batch long, range int, log_p binary, counts binary"


def _answered(sent: DataFrame, counts: DataFrame, low: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """For each batch and range: the log10 probabilities of its codes and the training counts of its words, in their order.

    Within a range the counts come first; then one batch's questions are in memory at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, have, trie = None, {}, None
        none = (np.zeros(0, U64), np.zeros(0, np.int64))
        for b in batches:
            out = []
            for r, number, kind, k, c, x, w in zip(*(b[n].to_pylist() for n in ("range", "batch", "kind")), *(b[n] for n in ("keys", "counts", "codes", "words")), strict=True):
                if r != at:
                    at, have, trie = r, {}, None
                if number is None:
                    have[kind] = (_expanded(k.as_py()), np.frombuffer(_whole(c.as_py()), np.int64))
                    continue
                trie = trie or of_range(low, *have.get(CODES, none))
                words, total = have.get(WORDS, none)
                asked = _expanded(w.as_py())
                place = np.minimum(np.searchsorted(words, asked), max(0, len(words) - 1))
                n = np.where(words[place] == asked, total[place], 0) if len(words) else np.zeros(len(asked), np.int64)
                out.append((number, r, _squeezed(trie(_expanded(x.as_py())).astype(np.float32).tobytes()), _squeezed(n.tobytes())))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["batch", "range", "log_p", "counts"])

    rows = counts.unionByName(sent.filter("range >= 0").select("batch", "range", "codes", "words"), allowMissingColumns=True)
    return rows.repartition(shuffle_parts(sent.sparkSession), "range").sortWithinPartitions("range", F.col("batch").asc_nulls_first()).mapInArrow(lean(run), ANSWER)


def _joined(sent: DataFrame, answers: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, log_sum, score) for each document, put together by batch."""

    def run(key, mine: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        docs = np.frombuffer(mine.docs.iloc[0], DOC)
        got = got.sort_values("range")
        log_p, counts = (np.concatenate([np.zeros(0, t), *(np.frombuffer(_whole(x), t) for x in got[n])]) for n, t in (("log_p", np.float32), ("counts", np.int64)))
        score, sums, known = _read(_whole(mine.text.iloc[0]), np.concatenate(([0], np.cumsum(docs["size"]))), ranges, log_p, counts)
        ids = pd.array(docs["id"], dtype="Int64")
        ids[docs["none"]] = pd.NA
        return pd.DataFrame({"doc_id": ids, "train": docs["train"], "n_tokens": docs["n"], "n_known": known, "log_sum": sums, "score": score})

    mine = sent.filter("range = -1").select("batch", "docs", "text")
    return mine.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(run, "doc_id long, train boolean, n_tokens long, n_known long, log_sum double, score double")


def vocabulary(counts: DataFrame) -> DataFrame:
    """The number of distinct training words: each is in one range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(k) for _, _, k, _ in _unpacked(b)], pa.int64())], ["n"])

    return counts.filter(F.col("kind") == WORDS).mapInArrow(lean(run), "n long").agg(F.sum("n"))


def scores(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs`.

    Reads doc_id and text. Learns from the rows outside the held-out fold. Tokens
    are the words, lower-cased, and one end, which each text has, also a null or
    empty one. base_score is the unigram model's log10 probability and score the
    trie's, of words joined by single spaces and the end. Rows that repeat count
    as often as they come. No rows give no rows; without training rows all bytes and
    words are unknown.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = docs.withColumn("held_out", held_out(F.col("doc_id"), folds))
    ranges = shuffle_parts(docs.sparkSession) * RANGES_PER_PART
    counts = kept(training_counts(docs.filter("not held_out").select("text"), ranges))
    sent = stored(_sent(docs, ranges))
    found = kept(_joined(sent, _answered(sent, counts, nearest(counts, ranges)), ranges))
    n, train_docs = found.filter("train").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*")).first()
    v = (vocabulary(counts).first()[0] or 0) + (train_docs > 0)  # the end is a token too
    all_of_it = n + 0.5 * (v + 1)
    end = math.log10((train_docs + 0.5) / all_of_it)
    return found.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + int(train_docs > 0)).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("log_sum") - (F.col("n_tokens") - 1) * math.log10(all_of_it) + end).alias("base_score"),
        "score",
    )


def op9_language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(columns(documents(spark, sf_dir), "doc_id", "text"))
