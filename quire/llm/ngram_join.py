"""N-gram Jaccard self-join of documents by vertical partitioning.

A document is the set of its distinct five-word shingles. Documents link when
100 * intersection >= 75 * union. One global order of all n-grams, rare ones
first, drives the join:

1. Documents with equal sets are one class. A sketch of fixed size counts all
   n-grams; the order is (sketched count, hash). A poor count can only cost time:
   any order that is the same for all documents is correct.
2. A class's first n - ceil(0.75 n) + AGREE n-grams in that order are its keys. Two
   classes that link share AGREE keys at least, or as many n-grams as they must have in
   common if that is less. A key with few classes counts for all its pairs; a larger
   one only for the pairs of each class with one leader of similar size.
3. Pairs are verified by vertical partitioning: the global order is cut into
   fragments, the overlap of each pair is counted within each fragment
   separately, and the counts are summed per pair.
4. Of the larger keys, those whose classes are not yet connected are searched further.
   Each class meets the leaders of its keys, and is described by what it lacks of a
   leader's n-grams and what it has besides. Classes that met few others at a leader are
   compared there. Of the others, two of different components can only link if they
   share so many of these differences that the differences have short prefixes again;
   those that share a difference and whose counts and places allow a link are verified.
   So no link between two components is lost, while copies are not expanded into all
   pairs.

Keys whose sketched count is high are dealt out over many tasks; a class is sent
once per key and input partition however many copies it has there.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.components import connected_components
from quire.llm.shared import columns, lean, membership, shuffle_parts, stored
from quire.llm.words import mix, shingle_sets

U64 = np.uint64
SHINGLE = 5
SHARE = (75, 100)
SKETCH_BITS = 20
PIECES = 16
#: Keys of up to so many classes propose all pairs at once.
SMALL_KEY = 16
#: Keys that two classes must share to be compared.
AGREE = 3
#: Parts that a key with a high count is dealt to.
HOT_PARTS = 64
#: Classes that met one leader are compared at once if they are so few, and their sets so many bytes, at most.
FEW, HELD = 64, 64 << 20
#: Classes that met one leader and meet in one task for each difference.
MEET = 1 << 16
#: Classes of one difference that are compared with each other in one task, where they are too many for one.
TILE = 4096
FRAGMENTS = 4
#: Partners of one class that are verified in one task.
PARTNERS = 512
#: Rows that ask for sets, of 48 bytes each, up to which they are sent to the sets; more are joined.
ASKED = 200_000


def _node(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _prefix(n: int) -> int:
    """Keys of a set of n: those that link have at least ceil(0.75 n) n-grams in common with it."""
    return min(n, n - -(-n * SHARE[0] // SHARE[1]) + AGREE)


def _need(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Keys that two linked sets of these sizes share at least."""
    return np.minimum(AGREE, -(-(na + nb) * SHARE[0] // (SHARE[0] + SHARE[1])))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(64 - SKETCH_BITS)).astype(np.int64)


CLASS = ["doc_id", "text_hash", "n_shingles", "node", "piece", "counts"]


def classes(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node) per document, and the pieces of the sketch as rows with `counts`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros(1 << SKETCH_BITS, np.uint32), set()
        for b in batches:
            n, nodes = [], []
            for s in shingle_sets(b["text"], k):
                n.append(len(s))
                nodes.append(_node(s) if len(s) else None)
                if len(s) and nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    np.add.at(sketch, _slot(s), 1)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], CLASS)
        if seen:
            none = pa.nulls(PIECES, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range(PIECES), pa.int32()), pa.array([zlib.compress(np.minimum(x, 65535).astype(np.uint16).tobytes(), 1) for x in np.split(sketch, PIECES)], pa.binary())], CLASS)

    return docs.mapInArrow(lean(run), "doc_id long, text_hash long, n_shingles long, node long, piece int, counts binary")


def sketch(found: DataFrame) -> np.ndarray:
    """The sketch summed over all partitions: 2 ** SKETCH_BITS counts, whatever the input's size."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for p, x in zip(b["piece"].to_pylist(), b["counts"], strict=True):
                sums[p] = sums.get(p, 0) + np.frombuffer(zlib.decompress(x.as_py()), np.uint16).astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["piece", "counts"])

    parts = found.filter("piece is not null").select("piece", "counts").repartition(PIECES, "piece").mapInArrow(combine, "piece int, counts binary").collect()
    total = np.zeros(1 << SKETCH_BITS, np.uint64)
    size = len(total) // PIECES
    for r in parts:
        total[r.piece * size : (r.piece + 1) * size] = np.frombuffer(r["counts"], np.uint64)
    return total


def _order(counts: np.ndarray) -> np.ndarray:
    """Rank of each sketch slot: its count on a logarithmic scale, at most 255."""
    return np.minimum(255, np.floor(np.log2(counts.astype(np.float64) + 1) * 8)).astype(np.uint8)


#: A key's row is packed: n in the upper bits, then pos, then the part in PART_BITS.
PART_BITS, POS_BITS = 7, 28


def keys(docs: DataFrame, counts: np.ndarray, k: int = SHINGLE) -> DataFrame:
    """(key, node, meta): each class's first n-grams in the global order; meta packs its size, the place and the part."""
    rank, mean = _order(counts), float(counts.mean())
    hot = counts > 4 * mean + 256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        out: tuple[list, list, list] = ([], [], [])
        rows = 0
        for b in batches:
            for s in shingle_sets(b["text"], k):
                if not len(s) or (node := _node(s)) in seen:
                    continue
                seen.add(node)
                n, slot = len(s), _slot(s)
                first = np.argsort(rank[slot], kind="stable")[: _prefix(n)]
                own = 1 + int(mix(np.array([node], np.int64).view(U64))[0] % U64(HOT_PARTS))
                out[0].append(s[first].view(np.int64))
                out[1].append(np.full(len(first), node))
                out[2].append((np.int64(n) << (PART_BITS + POS_BITS)) | (np.arange(len(first)) << PART_BITS) | np.where(hot[slot[first]], own, 0))
                if (rows := rows + len(first)) > 200_000:
                    yield _three(out, ["key", "node", "meta"])
                    rows = 0
        yield _three(out, ["key", "node", "meta"])

    return docs.mapInArrow(lean(run), "key long, node long, meta long")


def _three(out, names) -> pa.RecordBatch:
    cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
    for c in out:
        c.clear()
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def _fits(na, nb, pa_, pb, room=None) -> np.ndarray:
    """Sizes and places of a shared key, and what both have in common with others at most, still allow 100 * intersection >= 75 * union."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    most = np.minimum(small, np.minimum(pa_, pb) + np.minimum(na - pa_, nb - pb))
    if room is not None:
        most = np.minimum(most, room)
    return (SHARE[1] * small >= SHARE[0] * large) & (SHARE[1] * most >= SHARE[0] * (na + nb - most))


def _leaders(group: np.ndarray, node: np.ndarray, n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """For rows sorted by (group, n): the row of the leader in each row's band of sizes.

    The one with the fewest rarer n-grams leads: of near copies that is the one closest to all.
    """
    new = np.concatenate(([True], group[1:] != group[:-1]))
    band = np.floor(np.log(n) / np.log(SHARE[1] / SHARE[0])).astype(np.int64)
    new |= np.concatenate(([True], band[1:] != band[:-1]))
    number = np.cumsum(new) - 1
    by = np.lexsort((mix(node.view(U64)), pos, number))
    first = by[np.concatenate(([True], number[by][1:] != number[by][:-1]))]
    return first[number]


def _read(batches, names):
    table = pa.Table.from_batches(batches)
    return [table[c].to_numpy() for c in names]


def _counted(a: np.ndarray, b: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs, lesser node first, how often each came, and what it needs."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    by = np.lexsort((b, a))
    a, b, need = a[by], b[by], need[by]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
    return a[first], b[first], np.diff(np.append(first, len(a))), need[first]


PROPOSED = "kind int, key long, node long, n int, pos int, other long"


def propose(found: DataFrame) -> DataFrame:
    """(kind, key, node, n, pos, other), by kind.

    0: the pair (node, other) shares n small keys and needs pos; 3: the same for the keys that one of both leads;
    1: rows of larger keys; 2: leaders of dealt-out keys; 4: the node may share pos keys with others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        key, node, meta = _read(batches, ["key", "node", "meta"])
        del batches
        part, pos, n = meta & ((1 << PART_BITS) - 1), (meta >> PART_BITS) & ((1 << POS_BITS) - 1), meta >> (PART_BITS + POS_BITS)
        by = np.lexsort((node, n, part, key))
        key, part, node, n, pos = (x[by] for x in (key, part, node, n, pos))
        same = (key[1:] == key[:-1]) & (part[1:] == part[:-1])
        keep = np.concatenate(([True], ~(same & (node[1:] == node[:-1]))))
        # a key that one class has alone is done with, unless it is dealt out
        keep &= np.concatenate(([False], same)) | np.concatenate((same, [False])) | (part > 0)
        key, part, node, n, pos = (x[keep] for x in (key, part, node, n, pos))
        if not len(key):
            return
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (part[1:] != part[:-1]))))
        size = np.diff(np.append(new, len(key)))
        m, at = np.repeat(size, size), np.arange(len(key)) - np.repeat(new, size)
        who, times = np.unique(node, return_counts=True)
        for lo in range(0, len(who), 100_000):
            yield _batch(4, None, who[lo : lo + 100_000], None, times[lo : lo + 100_000], None)
        rows = np.flatnonzero((m > 1) & (m <= SMALL_KEY) & (part == 0))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d in range(1, SMALL_KEY):
            i = rows[at[rows] + d < m[rows]]
            i = i[_fits(n[i], n[i + d], pos[i], pos[i + d])]
            a.append(i)
            b.append(i + d)
        a, b = np.concatenate(a), np.concatenate(b)
        yield from _pairs(0, *_counted(node[a], node[b], _need(n[a], n[b])))
        big = np.flatnonzero((m > SMALL_KEY) | (part > 0))
        if len(big):
            group = np.repeat(new, size)[big]
            lead = big[_leaders(group, node[big], n[big], pos[big])]
            # leaders of neighbouring bands are linked too, so that a group across a border is one
            step = np.flatnonzero((lead[1:] != lead[:-1]) & (group[1:] == group[:-1]))
            one, two = np.concatenate([lead, lead[step]]), np.concatenate([big, lead[step + 1]])
            apart = (node[one] != node[two]) & (part[one] == 0)
            one, two = one[apart], two[apart]
            yield from _pairs(3, *_counted(node[one], node[two], _need(n[one], n[two])))
            for kind, rows in ((1, big), (2, np.unique(lead[part[big] > 0]))):
                for lo in range(0, len(rows), 100_000):
                    r = rows[lo : lo + 100_000]
                    yield _batch(kind, key[r], node[r], n[r], pos[r], None)

    parts = shuffle_parts(found.sparkSession)
    return found.repartition(parts, "key", F.expr(f"meta & {(1 << PART_BITS) - 1}")).mapInArrow(lean(run), PROPOSED)


def _pairs(kind: int, a, b, count, need) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(a), 100_000):
        s = slice(lo, lo + 100_000)
        yield _batch(kind, None, a[s], count[s], need[s], b[s])


def _batch(kind, key, node, n, pos, other) -> pa.RecordBatch:
    size = len(node)
    col = lambda x, t: pa.nulls(size, t) if x is None else pa.array(x).cast(t)
    return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), col(key, pa.int64()), col(node, pa.int64()), col(n, pa.int32()), col(pos, pa.int32()), col(other, pa.int64())], ["kind", "key", "node", "n", "pos", "other"])


def _led(proposed: DataFrame) -> DataFrame:
    """(a, b, n, need): classes of dealt-out keys with the one leader of their key and band of sizes.

    The leaders of the parts elect it, so there is one row for each key and band to join with.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        key, node, n, pos = _read(batches, ["key", "node", "n", "pos"])
        by = np.lexsort((node, n, key))
        key, node, n, pos = key[by], node[by], n[by], pos[by]
        lead = np.unique(_leaders(key, node, n, pos))
        yield pa.RecordBatch.from_arrays([pa.array(key[lead]), pa.array(node[lead]), pa.array(n[lead]).cast(pa.int32())], ["key", "a", "n_a"])

    band = lambda n: F.floor(F.log(n) / np.log(SHARE[1] / SHARE[0]))
    leaders = proposed.filter("kind = 2").select("key", "node", "n", "pos").repartition(shuffle_parts(proposed.sparkSession), "key").mapInArrow(lean(run), "key long, a long, n_a int")
    leaders = stored(leaders.withColumn("band", band(F.col("n_a"))))
    rows = proposed.filter("kind = 1").select("key", F.col("node").alias("b"), F.col("n").alias("n_b")).withColumn("band", band(F.col("n_b")))
    # a leader is compared with the next larger band too, so that a group across a border is one
    wide = leaders.union(leaders.withColumn("band", F.col("band") + 1))
    need = F.least(F.lit(AGREE), F.ceil((F.col("n_a") + F.col("n_b")) * SHARE[0] / (SHARE[0] + SHARE[1])))
    pairs = rows.join(wide, ["key", "band"]).filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), need.cast("long").alias("need"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("need").alias("need"))


def sets_of(docs: DataFrame, own: DataFrame, nodes: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(node, n, fragment, hashes) of the wanted classes; a filter over their texts' hashes spares reading most others."""
    wanted = membership(stored(own.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text_hash").alias("text_hash"))), "text_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            rows = []
            some = b.filter(pa.array(wanted(b["text_hash"].to_numpy())))
            for s in shingle_sets(some["text"], k):
                if not len(s) or (node := _node(s)) in seen:
                    continue
                seen.add(node)
                cut = np.searchsorted(s, [U64(f << (64 - FRAGMENTS.bit_length() + 1)) for f in range(1, FRAGMENTS)])
                rows += [(node, len(s), f, x.tobytes()) for f, x in enumerate(np.split(s, cut))]
                if len(rows) >= 2000:
                    yield _set_rows(rows)
                    rows = []
            yield _set_rows(rows)

    found = docs.mapInArrow(lean(run), "node long, n int, fragment int, hashes binary")
    return found.join(nodes, "node", "left_semi").dropDuplicates(["node", "fragment"])


def _set_rows(rows) -> pa.RecordBatch:
    node, n, f, x = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(n, pa.int32()), pa.array(f, pa.int32()), pa.array(x, pa.binary())], ["node", "n", "fragment", "hashes"])


def _few(asked: DataFrame, pairs: DataFrame) -> DataFrame:
    """`asked`, two rows for each of the stored `pairs` at most, to be broadcast if they are known to be few."""
    return F.broadcast(asked) if 2 * pairs.count() <= ASKED else asked


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both, n_a, n_b) of the pairs (a, b), distinct and of different nodes, `both` summed over the fragments.

    A node with many partners is sent to as many tasks as they fill. Within a task
    the rows are sorted, so one set of the many is in memory at a time.
    """
    both = pairs.select("a", "b").union(pairs.select("b", "a")).toDF("a", "b")
    degree = stored(both.groupBy("a").agg(F.count("*").alias("degree")))
    # the end with more partners is the one that stays in memory
    pairs = pairs.join(degree, "a").join(degree.select(F.col("a").alias("b"), F.col("degree").alias("degree_b")), "b")
    swap = F.col("degree_b") > F.col("degree")
    pairs = pairs.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"), F.greatest("degree", "degree_b").alias("degree"))
    # stored, so that the planner knows how few they are
    pairs = stored(pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("degree") / PARTNERS)).cast("int").alias("part")))
    # both ends ask for their sets at once
    none = F.lit(None).cast("long").alias("b")
    asked = pairs.select(F.col("a").alias("node"), "a", "part", none).distinct().union(pairs.select(F.col("b").alias("node"), "a", "part", "b"))
    asked = _few(asked, pairs).join(sets, "node").select("a", "part", "fragment", "b", "n", "hashes")
    dealt = asked.repartition(shuffle_parts(pairs.sparkSession), "a", "part", "fragment").sortWithinPartitions("a", "part", "fragment", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mine, n_a = None, None, 0
        for batch in batches:
            out = []
            for a, part, f, b, n, x in zip(*(batch[c].to_pylist() for c in ("a", "part", "fragment", "b", "n")), batch["hashes"], strict=True):
                x = np.frombuffer(x.as_buffer(), U64)
                if b is None:
                    held, mine, n_a = (a, part, f), x, n
                    continue
                if held != (a, part, f):
                    raise RuntimeError(f"no set of {a} to compare with")
                both = 0
                if len(mine) and len(x):
                    at = np.searchsorted(mine, x)
                    at[at == len(mine)] = 0
                    both = int((mine[at] == x).sum())
                out.append((a, b, both, n_a, n))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)], ["a", "b", "both", "n_a", "n_b"])

    counted = dealt.mapInArrow(lean(run), "a long, b long, both long, n_a long, n_b long")
    return counted.groupBy("a", "b").agg(F.sum("both").alias("both"), F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"))


def _linked(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("both") * SHARE[1] >= (F.col("n_a") + F.col("n_b") - F.col("both")) * SHARE[0]).select("a", "b")


def _apart(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """The (key, node, n, pos) of keys with classes of several components, with component."""
    rows = rows.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = stored(rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("key"))
    return rows.join(mixed, "key", "left_semi").select("key", "node", "n", "pos", "component")


def _elected(rows: DataFrame) -> DataFrame:
    """Distinct (leader, leader_component, node, component): the classes of each key with its leader in their band of sizes, and with that of the band below.

    Two classes that link are in one band or in neighbouring ones, so they have a leader
    in common. The class with the fewest rarer n-grams leads: of near copies that is the
    one closest to all.
    """
    rows = rows.withColumn("band", F.floor(F.log("n") / np.log(SHARE[1] / SHARE[0])))
    first = F.min(F.struct("pos", F.xxhash64("node").alias("h"), "node", "component"))
    leaders = stored(rows.groupBy("key", "band").agg(first.alias("l")).select("key", "band", F.col("l.node").alias("leader"), F.col("l.component").alias("leader_component")))
    leaders = leaders.union(leaders.withColumn("band", F.col("band") + 1))
    return rows.join(leaders, ["key", "band"]).filter("leader != node").select("leader", "leader_component", "node", "component").distinct()


DIFFERENCES = "a long, b long, token long, part int, n long, component long, pos int, size int, weight long, base long"


class _Met:
    """The classes that met one leader, in one task: their links, or the keys of their differences.

    A class that lacks m of the leader's l n-grams and has x others differs from it by
    weight = 100 m + 75 x. It links with the leader if weight <= base = 25 l, and with
    another class if both share (weight + weight - base) / 175 differences at least. So a
    class within the base, which only needs those beyond it, has more than weight / 175 of
    its differences in common with them, and one beyond it at least (weight - base) / 100.
    """

    def __init__(self, leader: int, mine: np.ndarray, wide: int):
        self.leader, self.mine, self.wide = leader, mine, wide
        self.base = (SHARE[1] - SHARE[0]) * len(mine)
        self.held: list[tuple] | None = [] if wide == 0 else None
        self.size = 0
        self.out: list[list] = [[] for _ in DIFFERENCES.split(", ")]
        self.rows = 0

    def put(self, *cols) -> None:
        size = max(len(c) for c in cols if isinstance(c, np.ndarray))
        for o, c in zip(self.out, cols, strict=True):
            o.append(c if isinstance(c, np.ndarray) else np.full(size, c, np.int64))
        self.rows += size

    def link(self, a: int, b: int) -> None:
        self.put(np.array([a], np.int64), b, 0, 0, 0, 0, -1, 0, 0, 0)

    def add(self, leader_component: int, node: int, component: int, s: np.ndarray) -> None:
        where = np.searchsorted(self.mine, s)
        where[where == len(self.mine)] = 0
        known = self.mine[where] == s
        lacking = np.ones(len(self.mine), bool)
        lacking[where[known]] = False
        extra, missing = s[~known], self.mine[lacking]
        weight = SHARE[1] * len(missing) + SHARE[0] * len(extra)
        if weight <= self.base and component != leader_component:
            self.link(self.leader, node)
        c = (node, component, len(s), extra, missing, weight)
        if self.held is None:
            self.tell(*c)
            return
        self.held.append(c)
        self.size += 8 * (len(extra) + len(missing))
        if len(self.held) > FEW or self.size > HELD:
            for c in self.held:
                self.tell(*c)
            self.held = None

    def tell(self, node: int, component: int, n: int, extra: np.ndarray, missing: np.ndarray, weight: int) -> None:
        """A row for each key of the differences. Those that aren't the leader's come first: they are the rare ones."""
        size = len(extra) + len(missing)
        need = weight // sum(SHARE) + 1 if weight <= self.base else max(1, -(-(weight - self.base) // SHARE[1]))
        keys = size - need + 1
        if keys > 0:
            token = mix(np.concatenate([np.sort(mix(extra)), np.sort(mix(~missing))])[:keys] ^ mix(np.array([self.leader], np.int64).view(U64)))
            part = 0 if self.wide <= 1 else 1 + int(mix(np.array([node], np.int64).view(U64))[0] % U64(self.wide))
            self.put(node, 0, token.view(np.int64), part, n, component, np.arange(keys), size, weight, self.base)

    def compare(self) -> None:
        """The links between the few classes held."""
        held, self.held = self.held or [], []
        for x, (a, ca, na, ea, ma, wa) in enumerate(held):
            for b, cb, nb, eb, mb, wb in held[:x]:
                need = max(1, -(-(wa + wb - self.base) // sum(SHARE)))
                if ca == cb or SHARE[1] * min(na, nb) < SHARE[0] * max(na, nb) or need > min(len(ea), len(eb)) + min(len(ma), len(mb)):
                    continue
                if len(np.intersect1d(ea, eb, assume_unique=True)) + len(np.intersect1d(ma, mb, assume_unique=True)) >= need:
                    self.link(a, b)

    def taken(self) -> pa.RecordBatch:
        kinds = DIFFERENCES.split(", ")
        cols = [np.concatenate([np.zeros(0, np.int64), *c]) for c in self.out]
        self.out, self.rows = [[] for _ in kinds], 0
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()).cast(pa.int32() if " int" in f else pa.int64()) for c, f in zip(cols, kinds, strict=True)], [f.split()[0] for f in kinds])


def _differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """From (leader, leader_component, node, component): links (a, b) between components, with pos -1, and rows with the keys (token) of the differences of a class (a)."""
    degree = stored(pairs.groupBy("leader").agg(F.count("*").alias("degree")))
    wide = F.when(F.col("degree") <= F.least(F.lit(FEW), F.lit(PARTNERS)), 0).otherwise(F.ceil(F.col("degree") / MEET)).cast("int")
    at = pairs.join(degree, "leader").withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("degree") / PARTNERS)).cast("int")).withColumn("wide", wide)
    at = stored(at.drop("degree"))
    none = lambda t: F.lit(None).cast(t)
    a = at.select(F.col("leader").alias("of"), "leader", "part", "wide", none("long").alias("node"), none("long").alias("leader_component"), none("long").alias("component")).distinct()
    asked = a.union(at.select(F.col("node").alias("of"), "leader", "part", "wide", "node", "leader_component", "component"))
    asked = _few(asked, at).join(sets.withColumnRenamed("node", "of"), "of")
    dealt = asked.repartition(shuffle_parts(pairs.sparkSession), "leader", "part").sortWithinPartitions("leader", "part", F.col("node").asc_nulls_first(), "fragment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, met, pieces = None, None, []
        for batch in batches:
            for leader, part, wide, node, n, lc, comp, x in zip(*(batch[c].to_pylist() for c in ("leader", "part", "wide", "node", "n", "leader_component", "component")), batch["hashes"], strict=True):
                pieces.append(np.frombuffer(x.as_buffer(), U64))
                if len(pieces) < FRAGMENTS:
                    continue
                s, pieces = np.concatenate(pieces), []
                if len(s) != n:
                    raise RuntimeError(f"{len(s)} of {n} n-grams of {leader if node is None else node}")
                if node is None:
                    if met:
                        met.compare()
                        yield met.taken()
                    now, met = (leader, part), _Met(leader, s, wide)
                    continue
                if now != (leader, part):
                    raise RuntimeError(f"no set of {leader} to compare with")
                met.add(lc, node, comp, s)
                if met.rows > 100_000:
                    yield met.taken()
        if met:
            met.compare()
            yield met.taken()

    return dealt.mapInArrow(lean(run), DIFFERENCES)


def _possible(weight: np.ndarray, least: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Differences that classes must share at least with one of the weight `least` to link with it."""
    return np.maximum(1, -(-(weight + least - base) // sum(SHARE)))


SHARING = ["token", "part", "a", "n", "component", "pos", "size", "weight", "base"]


def _sharing(tokens: DataFrame, tiled: bool = False) -> DataFrame:
    """(kind, a, b, ...) from rows of differences: pairs (a, b) that may link, of kind 0, and the rows of differences dealt to several tasks, of kind 1.

    Only classes that can link with one of another component stay in a group. If `tiled`,
    part holds the tiles lo and hi of a group that are compared, as 2 ** 16 lo + hi, and tile a row's own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        cols = _read(batches, SHARING + (["tile"] if tiled else []))
        del batches
        if not tiled:
            for lo in range(0, len(dealt := np.flatnonzero(cols[1] > 0)), 100_000):
                r = dealt[lo : lo + 100_000]
                yield rows_of(1, cols[2][r], np.zeros(len(r), np.int64), [c[r] for c in cols])
            cols = [c[cols[1] == 0] for c in cols]
        by = np.lexsort((cols[2], cols[1], cols[0]))
        cols = [c[by] for c in cols]
        for _ in range(4):
            if not len(cols[0]):
                return
            new, m = grouped(cols)
            token, part, node, n, comp, pos, size, weight, base = cols[:9]
            of = lambda f, x: np.repeat(f.reduceat(x, new), m)  # noqa: B023, E731
            beyond = of(np.minimum, np.where(weight > base, weight, np.iinfo(np.int64).max // 4))
            least = np.where(weight > base, of(np.minimum, weight), beyond)
            stay = (of(np.minimum, comp) != of(np.maximum, comp)) & (pos <= size - _possible(weight, least, base))
            if stay.all():
                break
            cols = [c[stay] for c in cols]
        new, m = grouped(cols)
        for first, size in zip(new.tolist(), m.tolist(), strict=True):
            yield from pairs([c[first : first + size] for c in cols])

    def grouped(cols):
        token, part = cols[0], cols[1]
        new = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (part[1:] != part[:-1])))) if len(token) else np.zeros(0, np.int64)
        return new, np.diff(np.append(new, len(token)))

    def pairs(cols):
        # by weight: what a class can link with is then a stretch that ends where the weight is too much for it
        by = np.argsort(cols[7], kind="stable")
        _, part, node, n, comp, pos, size, weight, base = (c[by] for c in cols[:9])
        top = sum(SHARE) * (size - pos) + base - weight
        ends = np.searchsorted(weight, top, "right")
        for i in range(len(node)):
            j = np.arange(i + 1, min(ends[i], len(node)))
            j = j[(weight[i] <= top[j]) & (comp[j] != comp[i]) & (SHARE[1] * np.minimum(n[i], n[j]) >= SHARE[0] * np.maximum(n[i], n[j]))]
            need = _possible(weight[j], weight[i], base[j])
            j = j[np.minimum(pos[i], pos[j]) + np.minimum(size[i] - pos[i], size[j] - pos[j]) >= need]
            if tiled:
                tile = cols[9][by]
                lo, hi = part[0] >> 16, part[0] & 0xFFFF
                j = j[(np.minimum(tile[i], tile[j]) == lo) & (np.maximum(tile[i], tile[j]) == hi)]
            if len(j):
                yield rows_of(0, np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), None)

    def rows_of(kind, a, b, cols) -> pa.RecordBatch:
        rest = [pa.nulls(len(a), pa.int64()) if cols is None else pa.array(cols[SHARING.index(c)].astype(np.int64)) for c in SHARING if c != "a"]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), *rest], ["kind", "a", "b", *(c for c in SHARING if c != "a")])

    kinds = "kind int, a long, b long, " + ", ".join(f"{c} long" for c in SHARING if c != "a")
    return tokens.repartition(shuffle_parts(tokens.sparkSession), "token", "part").mapInArrow(lean(run), kinds)


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows of differences that many classes have, without those that can link with none of another component, for the pairs of tiles in which they are compared."""
    fringe = F.col("weight") > F.col("base")
    of = stored(rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("weight").alias("least"), F.min(F.when(fringe, F.col("weight"))).alias("beyond")).filter("lo != hi AND beyond IS NOT NULL"))
    need = F.greatest(F.lit(1), F.ceil((F.col("weight") + F.when(fringe, F.col("least")).otherwise(F.col("beyond")) - F.col("base")) / sum(SHARE)))
    rows = stored(rows.join(of, "token").filter(F.col("pos") <= F.col("size") - need).select(*SHARING))
    many = stored(rows.groupBy("token").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")))
    rows = rows.join(many, "token").withColumn("tile", F.pmod(F.xxhash64("a"), F.col("tiles")).cast("long")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    part = F.least("tile", "with") * (1 << 16) + F.greatest("tile", "with")
    return rows.withColumn("part", part).select(*SHARING, "tile")


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """`parts` (node, component) with the components that links run between as one."""
    of = lambda c: parts.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    now = stored(connected_components(between))
    moved = parts.join(now.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return moved.union(now.join(parts, "node", "left_anti").select("node", "component"))


def _beyond(docs: DataFrame, own: DataFrame, proposed: DataFrame, sets: DataFrame, nodes: DataFrame, parts: DataFrame, k: int) -> DataFrame:
    """`parts` with the links between classes of different components that share larger keys. `sets` are those of `nodes`."""
    shared = proposed.filter("kind = 4").groupBy("node").agg(F.sum("pos").alias("shared"))
    rows = proposed.filter("kind = 1").select("key", "node", F.col("n").cast("long").alias("n"), "pos")
    # a class that links shares as many keys as this
    rows = rows.join(shared, "node").filter(F.col("shared") >= F.least(F.lit(AGREE), F.ceil(F.col("n") * SHARE[0] / SHARE[1]))).drop("shared")
    rows = stored(_apart(rows, parts))
    if rows.isEmpty():
        return parts
    pairs = stored(_elected(rows))
    late = stored(pairs.select(F.col("leader").alias("node")).union(pairs.select("node")).distinct().join(nodes, "node", "left_anti"))
    if not late.isEmpty():
        sets = sets.union(stored(sets_of(docs, own, late, k)))
    found = stored(_differences(pairs, sets))
    sharing = stored(_sharing(found.filter("pos >= 0")))
    near = sharing.filter("kind = 0").select("a", "b")
    dealt = sharing.filter("kind = 1")
    if not dealt.isEmpty():
        near = near.union(_sharing(_tiles(dealt.select(*SHARING)), tiled=True).select("a", "b"))
    near = stored(near.distinct())
    links = found.filter("pos < 0").select("a", "b")
    if not near.isEmpty():
        links = links.union(_linked(verify(near, sets)))
    links = stored(links)
    return parts if links.isEmpty() else stored(_merged(parts, links))


def ngram_jaccard_components(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs`.

    Reads doc_id (integer) and text; other columns are ignored. A null or empty
    text, or one without words, has no shingles and is linked with nothing:
    component_id is its doc_id. One to four words are one shingle. Rows that repeat
    are in one component, also where ids repeat; a null doc_id counts as larger than
    every other. No rows give no rows. Sets are compared by 64-bit shingle hashes,
    and equal sets found by a 64-bit digest.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("text_hash", F.xxhash64("text"))
    found = stored(classes(docs, k))
    own = found.filter("piece is null").select("doc_id", "text_hash", "n_shingles", "node")
    proposed = stored(propose(keys(docs, sketch(found), k)))
    pairs = proposed.filter("kind IN (0, 3)").select(F.col("node").alias("a"), F.col("other").alias("b"), F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("need"))
    if not proposed.filter("kind = 2").isEmpty():
        pairs = pairs.unionByName(_led(proposed))
    pairs = stored(pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("need").alias("need")).filter("n >= need").select("a", "b"))
    nodes = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    sets = stored(sets_of(docs, own, nodes, k))
    parts = stored(connected_components(_linked(verify(pairs, sets))))
    parts = _beyond(docs, own, proposed, sets, nodes, parts, k)
    own = own.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # a class alone in its component has documents too, those that are equal
    ids = own.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return own.join(ids, "component", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op10_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from quire.llm.shared import documents

    return ngram_jaccard_components(columns(documents(spark, sf_dir), "doc_id", "text"))
