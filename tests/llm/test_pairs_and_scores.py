"""Operators on documents against brute force, on small tables with the odd cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.llm import compress, decontaminate, mixture, ngram_join, pii, quality, sketch
from quire.llm.components import connected_components
from quire.llm.words import shingle_sets

DOCS = "doc_id long, text string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def corpus(seed=1, n=60):
    """Texts with exact and near copies, a passage that many share, and odd cases; columns that clash with inner names."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    base = [" ".join(word() for _ in range(rng.randint(1, 150))) for _ in range(n)]
    out = [None, "", " \n\t", "one", "one two three four", "one two three four five", "One  two THREE four", "É é"]
    for t in base:
        out.append(t)
        w = t.split()
        for _ in range(rng.choice((0, 0, 1, 3))):
            v = list(w)
            for _ in range(rng.randint(0, 1 + len(v) // 40)):
                v[rng.randrange(len(v))] = word()
            out.append(" ".join(v))
        if rng.random() < 0.3:
            out.append(t[:20] + " " + passage + " " + word())
    group = " ".join(word() for _ in range(100))
    for i in range(40):  # a group of near copies larger than a key that proposes all pairs
        v = group.split()
        for _ in range(i % 6):
            v[rng.randrange(len(v))] = f"edit{i}"
        out.append(" ".join(v))
    out += [out[10]] * 30
    rng.shuffle(out)
    return [(i * 3, t) for i, t in enumerate(out)]


def with_clashes(spark, rows):
    df = spark.createDataFrame(rows, DOCS)
    for c in ("node", "key", "n", "a", "part", "size", "first", "held_out", "copies"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def components_of(rows):
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i, _ in rows}


def test_shingle_hashes_tell_sets_apart():
    import pyarrow as pa

    rows = corpus(3)
    got = [s.tobytes() for s in shingle_sets(pa.array([t for _, t in rows]))]
    want = [frozenset(shingles(t)) for _, t in rows]
    assert len(set(got)) == len(set(want)) and [got.index(g) for g in got] == [want.index(w) for w in want]
    tiny = [s.tobytes() for s in shingle_sets(pa.array([t for _, t in rows]).slice(3))]
    assert tiny == got[3:]


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_finds_the_components_of_all_pairs(spark, seed):
    rows = corpus(seed)
    got = ngram_join.ngram_jaccard_components(with_clashes(spark, rows).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(rows)


def test_ngram_join_with_large_and_dealt_out_keys(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_KEY", 2)
    monkeypatch.setattr(ngram_join, "FEW", 3)
    monkeypatch.setattr(ngram_join, "MEET", 8)
    monkeypatch.setattr(ngram_join, "PARTNERS", 4)
    rows = corpus(5)
    real = ngram_join.keys

    def all_hot(docs, counts, k=5):
        return real(docs, np.where(counts > 1, counts.max() + 10**6, counts), k)

    monkeypatch.setattr(ngram_join, "keys", all_hot)
    got = ngram_join.ngram_jaccard_components(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(rows)


def test_ngram_join_of_nothing_and_of_repeated_rows(spark):
    assert ngram_join.ngram_jaccard_components(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(2, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (None, "x"), (3, None)]
    got = sorted(((r.doc_id or 0), r.component_id) for r in ngram_join.ngram_jaccard_components(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(0, None), (1, 1), (2, 1), (2, 1), (3, 3)]


def test_ngram_join_of_a_text_and_its_copies_with_leads(spark):
    # the keys of each copy are its own lead and a part of the text: what lies behind them is in other sets' keys
    base = " ".join(f"w{i}" for i in range(90))
    rows = [(0, base)] + [(i, " ".join(f"lead{i}x{j}" for j in range(15)) + " " + base) for i in range(1, 21)]
    got = ngram_join.ngram_jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    want = components_of(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len({c for _, c in want.values()}) == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ngram_join_of_families_around_the_threshold(spark, monkeypatch, seed):
    # copies edited so much that few link with the first text, in families that link among themselves, some cut short or prolonged
    monkeypatch.setattr(ngram_join, "SMALL_KEY", 2)
    monkeypatch.setattr(ngram_join, "FEW", 2 + seed)
    monkeypatch.setattr(ngram_join, "PARTNERS", 16)
    if seed == 3:
        monkeypatch.setattr(ngram_join, "MEET", 20)
        monkeypatch.setattr(ngram_join, "TILE", 5)
    rng = random.Random(seed)
    base, rows = [f"w{i}" for i in range(120)], []

    def edited(w, times):
        w = list(w)
        for _ in range(times):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        return w

    for _ in range(6):
        family = edited(base, rng.randint(0, 7))
        if rng.random() < 0.5:
            family = family[: rng.randint(70, 115)]
        if rng.random() < 0.5:
            family = family + [f"y{rng.randrange(10**6)}" for _ in range(rng.randint(5, 40))]
        rows += [" ".join(edited(family, rng.randint(0, 6))) for _ in range(15)]
    rows = list(enumerate(rows))
    got = ngram_join.ngram_jaccard_components(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    want = components_of(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and 3 < len({c for _, c in want.values()}) < len(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 100), (7, 7), (None, 3), (200, 100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {50: 50, 100: 50, 200: 50}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_decontamination_equals_all_windows(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 5)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((3, 5, 12, 30, 45, 45))] + [(90, None), (91, " "), (92, "la la la la la la la la")]
    items.append((93, items[3][1]))
    docs = [(0, None), (1, ""), (2, "la " * 12)]
    for i in range(60):
        w = [word() for _ in range(rng.randint(0, 80))]
        part = (items[rng.randrange(6)][1]).split()
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = word()
        at = rng.randint(0, len(w))
        docs.append((10 + i, " ".join(w[:at] + (part if i % 3 else []) + w[at:]).upper()))
    docs.append((10, docs[5][1]))
    count = lambda w, k: collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    want = collections.Counter()
    for d, t in docs:
        w = words(t)
        for i, item in items:
            v = words(item)
            if not v:
                continue
            k, best = min(5, len(v)), 0.0
            c = count(v, k)
            for s in range(len(w) - len(v) + 1):
                x = count(w[s : s + len(v)], k)
                m = sum((x & c).values())
                best = max(best, m / (sum(x.values()) + sum(c.values()) - m))
            if best >= 0.75:
                want[d, i, round(best, 9)] += 1
    df = with_clashes(spark, docs)
    got = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert collections.Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in got) == want and want
    assert decontaminate.contaminated(df, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_decontamination_of_documents_shorter_than_the_item(spark):
    w = [f"w{i}" for i in range(40)]
    items = spark.createDataFrame([(7, " ".join(w)), (8, "other words than those of the item above")], "item_id long, text string")
    docs = [(n, " ".join(w[:n])) for n in (39, 31, 30, 4)] + [(100, " ".join(w[2:38] + ["x"]))]
    # n of the item's words hold n - 4 of its 36 shingles; 36 and another one hold 32, and one of their own
    got = decontaminate.contaminated(spark.createDataFrame(docs, DOCS), items).collect()
    want = [(39, 7, 35 / 36, 0, 39), (31, 7, 27 / 36, 0, 31), (100, 7, 32 / 37, 0, 37)]
    assert sorted((r.doc_id, r.item_id, round(r.similarity, 9), r.first_word, r.n_words) for r in got) == sorted((d, i, round(x, 9), a, n) for d, i, x, a, n in want)


def test_decontamination_by_row_and_by_blocks_of_items(spark, monkeypatch):
    rng = random.Random(12)
    text = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(4)) for _ in range(n))
    items = [(i if i else None, text(30)) for i in range(6)] + [(9, None), (9, "")]
    docs = [(1, f"{text(20)} {items[3][1]} {text(20)}"), (None, f"{items[0][1]} {text(5)}"), (None, text(60)), (2, text(40)), (2, f"{text(9)} {items[5][1]}"), (4, None), (5, "")]
    docs_df, items_df = with_clashes(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    got = [sorted(map(str, ((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs_df, items_df).collect()))) for _ in [0] if not monkeypatch.setattr(decontaminate, "INDEX_BYTES", 64 << 20)]
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 6000)
    assert len(list(decontaminate.indexes(items_df))) > 2
    got.append(sorted(map(str, ((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs_df, items_df).collect()))))
    assert got == [["(1, 3)", "(2, 5)", "(None, None)"]] * 2
    left = decontaminate.without_items(docs_df, items_df)
    assert left.columns == docs_df.columns and sorted(str((r.doc_id, r.text)) for r in left.collect()) == sorted(str(docs[i]) for i in (2, 3, 5, 6))


def test_hamming_blocks_miss_nothing_within_the_radius():
    rng = np.random.default_rng(0)
    index = decontaminate.ItemIndex([(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(50)])
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, decontaminate.RADIUS + 1), replace=False)) for _ in range(50)], np.uint64)
    i, item = index.within(index.prints ^ flips, 20)
    assert {(x, x) for x in range(50)} <= set(zip(i.tolist(), item.tolist(), strict=True))


@pytest.mark.parametrize("sizes", [[("a", 100), ("b", 10), (None, 5)], [("a", 1), ("b", 1000), ("c", 1), ("d", 50)], [("a", 0)], []])
def test_targets_share_the_excess_until_none_is_above(spark, sizes):
    df = spark.createDataFrame(sizes, "source string, source_size long")
    got = {r.source: r.target for r in mixture.targets(df).collect()}
    order = sorted((s for s, _ in sizes), key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    size, total, full = dict(sizes), 1.5 * sum(n for _, n in sizes), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(2 * size[s] for s in full)
        want = {s: 2 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in rest) for s in order}
        above = {s for s in rest if want[s] > 2 * size[s]}
        if not above:
            break
        full |= above
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in got)


def test_mixture_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x y", "a"), (3, "x y", "a"), (None, "q", ""), (5, "long " * 500, "b")]
    got = mixture.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))).collect()
    assert sorted((r.doc_id or 0, r.size) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 2), (3, 2), (5, 500)]
    assert all(0 <= r.copies <= 2 for r in got)
    again = mixture.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(map(str, ((r.doc_id, r.copies) for r in got))) == sorted(map(str, ((r.doc_id, r.copies) for r in again)))


def test_mixture_comes_near_its_targets(spark):
    rng = random.Random(0)
    rows = [(i, "w " * rng.randint(1, 40), f"s{i % 4}") for i in range(4000)]
    got = mixture.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    per = got.assign(taken=got["size"] * got.copies).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((per.taken - per.target).abs() / per.target).max() < 0.06


def with_edits_by_hand(spark, rows):
    """(doc_id, text, edited text, next text), by descending doc_id and hash of the text, null ids last."""
    hashed = spark.createDataFrame([(i, t or "") for i, t in rows], DOCS).select("*", F.xxhash64("text").alias("h")).collect()
    docs = sorted(hashed, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), -r.h))
    out = []
    for r, n in zip(docs, docs[1:] + docs[:1], strict=True):
        out.append((r.doc_id, r.text, r.text[: len(r.text) - len(r.text) // 2] + n.text[: len(r.text) // 2], n.text))
    return out


def digested(rows):
    return sorted((str(i), len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in rows)


def test_fingerprints(spark):
    rows = [(i, t) for i, t in corpus(7)][:80] + [(None, "last é"), (9, "again"), (9, "again b")]
    got = sketch.with_edits(spark.createDataFrame(rows, DOCS).withColumn("part", F.lit("clash")).withColumn("h", F.lit("clash"))).collect()
    want = with_edits_by_hand(spark, rows)
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == digested(want)
    true = {(i, len(t)): (shingles(t), shingles(e), shingles(n)) for i, t, e, n in want}
    for r in got:
        a, *others = true[r.doc_id, r.n_chars]
        for b, near in zip(others, (r.near_edited, r.near_next), strict=True):
            real = len(a & b) / len(a | b) if a | b else 1.0
            if len(a) < sketch.LEAST and len(b) < sketch.LEAST:
                assert math.isclose(near, real)
            else:  # four deviations of a sample of as many hashes as are looked at, at least
                assert abs(near - real) < 4 * 0.5 / min(len(a | b), sketch.LEAST) ** 0.5
    assert sketch.with_edits(spark.createDataFrame([], DOCS)).count() == 0
    assert sketch.with_edits(spark.createDataFrame([(1, None)], DOCS)).count() == 1


def test_no_row_is_lost_with_large_null_and_repeated_ids(spark):
    big = [(2**53 + 1 + i, f"text {i} of many words that are not the same {i * i}") for i in range(40)]
    for rows in (big, big + [(None, "a"), (None, "b")], [(None, f"t{i}") for i in range(60)], [(7, f"t{i}") for i in range(60)] + big[:5] + [(None, "x")], [(7, "same")] * 20 + [(3, None)], [(-(2**63), "low"), (2**63 - 1, "high")]):
        got = sketch.with_edits(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == digested(with_edits_by_hand(spark, rows))


def test_likeness_on_both_sides_of_the_least_size():
    rng = np.random.default_rng(9)
    for n in (20, 31, 32, 33, 60, 255, 256, 257, 400, 4000, 40_000):
        errors = []
        for _ in range(60):
            both, a, b = (rng.integers(0, 2**64, int(n * x), dtype=np.uint64) for x in (0.6, 0.4, 0.4))
            real = len(both) / (len(both) + len(a) + len(b))
            errors.append(sketch.likeness(sketch.scaled(np.concatenate([both, a])), sketch.scaled(np.concatenate([both, b])))[0] - real)
        looked = max(sketch.LEAST, 1.4 * n / sketch.SCALE)
        assert abs(np.mean(errors)) < 0.04 and np.std(errors) < (0.01 if n < sketch.LEAST * 0.7 else 1.5 * 0.5 / looked**0.5), n


def test_fingerprints_merge():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 900).astype(np.uint64), rng.integers(0, 2**63, 40).astype(np.uint64)
    assert np.array_equal(sketch.merged(sketch.scaled(a), sketch.scaled(b)), sketch.scaled(np.concatenate([a, b])))
    assert np.array_equal(sketch.unpacked(sketch.packed(sketch.scaled(a))), sketch.scaled(a))
    assert sketch.likeness(sketch.scaled(b), sketch.scaled(np.concatenate([a, b])))[1] == 1.0


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    valid = lambda m: all(int(p) <= 255 for p in m[0].split("."))
    for n in range(20000):
        s = "".join(rng.choice("ab1@.-+% " if n % 2 else "124.. -+(") for _ in range(rng.randint(0, 34)))
        got = pii.base_spans(s)
        assert [(0, *m.span()) for m in pii.EMAIL.finditer(s)] == [x for x in got if x[0] == 0]
        assert [(1, *m.span()) for m in pii.IP.finditer(s) if valid(m)] == [x for x in got if x[0] == 1]
    assert pii.base_spans("a" * 200_000 + "@" + "1" * 5000) == []
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_tagger_on_held_out_examples():
    from quire.llm.tagger import examples, labelled, train

    x, y = labelled(examples(500, 4242))
    t = train()
    got = t.decode(t.emissions(x))
    assert (got == y).mean() > 0.95 and (got == y)[y > 0].mean() > 0.93


def test_tagger_gradient():
    from quire.llm.tagger import WINDOW, Tagger, examples, labelled

    x, y = labelled(examples(4, 1))
    t = Tagger(3)
    for k in t.p:
        t.p[k] = t.p[k].astype(np.float64)
    loss, d = t.gradient(x, y)
    rng = np.random.default_rng(0)
    for k in ("move", "out", "u", "w", "embed", "b", "bias"):
        i = tuple(int(rng.integers(s)) for s in t.p[k].shape)
        if k == "embed":
            i = (int(x[0, WINDOW // 2]), 1)
        t.p[k][i] += 1e-2
        up = t.gradient(x, y)[0]
        t.p[k][i] -= 2e-2
        down = t.gradient(x, y)[0]
        t.p[k][i] += 1e-2
        assert abs((up - down) / 2e-2 - d[k][i]) < 2e-2 * max(1, abs(d[k][i])), k


def test_personal_data(spark):
    text = "mail an.na@mail7.example.com, ring +1 (377)\n555-0271 or 10.0.0.1, 4111111111111111 é"
    rows = [(1, text), (2, None), (3, ""), (4, "nothing here"), (1, text)]
    got = {r.doc_id: r for r in pii.personal_data(with_clashes(spark, rows)).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 1, 0)
    base = [f"email:5:{5 + len('an.na@mail7.example.com')}", "ip:56:64", "card:66:82"]
    assert got[1].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and all(b in got[1].spans for b in base)
    assert "phone:35:52" in got[1].spans
    assert got[2].base_sha256 == hashlib.sha256(b"").hexdigest() and got[4].spans == ""
    clean = [r.text for r in pii.redacted(spark.createDataFrame(rows, DOCS)).orderBy("doc_id").collect()]
    assert clean[0] == "mail <email>, ring <phone> or <ip>, <card> é" and clean[2] is None
    assert pii.personal_data(spark.createDataFrame([], DOCS)).count() == 0


def test_reading_around_digits_equals_reading_the_whole_text(monkeypatch):
    from quire.llm.tagger import examples, train

    rng, tagger = random.Random(4), train()
    word = lambda lo, hi: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(lo, hi)))
    texts = ["", "no digit at all " * 50, "9", "a" * 3000 + "@" + "b" * 500]
    for _ in range(150):
        at = rng.choice(["@", " @ ", "(@)"])
        texts.append(" ".join([*(word(1, 9) for _ in range(rng.randint(0, 60))), f"{word(10, 70)}{at}{word(10, 70)}.{word(2, 9)}", *(word(1, 9) for _ in range(rng.randint(0, 60)))]))
    texts += [" ".join(t for t, _ in examples(8, 100 + i)) for i in range(40)]
    near = pii.added_spans(texts, tagger, 64)
    monkeypatch.setattr(pii, "_runs", lambda t: [(0, len(t))] if t else [])
    assert near == pii.added_spans(texts, tagger) and sum(map(len, near)) > 200


def test_cards_and_phones_equal_the_patterns():
    rng = random.Random(8)
    for n in range(6000):
        s = "".join(rng.choice("0123456789" + (" -" if n % 2 else "+() .-a")) for _ in range(rng.randint(0, 60)))
        got = pii.base_spans(s)
        digits = lambda t: [int(c) for c in t if c.isdigit()]
        luhn = lambda d: sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0
        assert [x for x in got if x[0] == 2] == [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", s) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
        assert [x for x in got if x[0] == 3] == [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", s) if 8 <= len(digits(m[0])) <= 15]


def good_and_bad(n=400, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(20, 120))]
        bad = i % 4 == 0
        docs.append((i, " ".join(x.upper() + "!!" if i % 8 else x + "$$$" for x in w) if bad else " ".join(w).capitalize() + "."))
        labels.append((i, int(not bad)))
    return docs, labels


def test_quality_on_the_held_out_fold(spark):
    docs, labels = good_and_bad()
    rows = docs + [(9001, None), (9002, ""), (None, "x"), (3, docs[3][1])]
    lab = spark.createDataFrame(labels + [(9001, None), (None, 1), (77777, 1)], "doc_id long, quality int")
    got = quality.quality_scores(with_clashes(spark, rows), lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a")], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.quality_scores(docs, none).collect()] == [1.0]
    assert quality.quality_scores(docs.limit(0), none).count() == 0


def test_quality_weights_equal_a_dense_solve(spark):
    docs, labels = good_and_bad(90)
    docs += [(500, "long " * 40_000), (501, ""), (3, docs[3][1])]
    labels += [(500, 0), (501, 0), (3, 1 - labels[3][1])]  # of a repeated label the greater counts
    model = quality.fit(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(True))
    truth: dict = {}
    for i, y in labels:
        truth[i] = max(y, truth.get(i, 0))
    import pyarrow as pa

    x = quality.statistics(pa.array([t for _, t in docs]))
    y = np.array([truth[i] for i, _ in docs], float)
    assert np.allclose(model.features.mean, x.mean(0)) and np.allclose(model.features.scale, x.std(0) + 1e-3, atol=1e-6)
    z = model.features(x)
    want = np.linalg.solve(z.T @ z + quality.RIDGE * len(x) / z.shape[1] * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(z @ model.weights, z @ want, atol=1e-6)
    # random features approximate the Gaussian kernel of the clipped, standardised statistics
    s = np.clip((x - model.features.mean) / model.features.scale, -6, 6)
    kernel = np.exp(-((s[:, None] - s[None]) ** 2).sum(2) * quality.WIDTH**2 / 2)
    assert np.abs(z[:, :-1] @ z[:, :-1].T - kernel).mean() < 0.08
    got = {r.doc_id: r.score for r in quality.scored(spark.createDataFrame(docs, DOCS), model).collect()}
    assert all(math.isclose(got[i], v, abs_tol=1e-9) for (i, _), v in zip(docs, model(x), strict=True))


def test_isotonic():
    x, y = quality.isotonic(np.arange(5.0), np.array([0.0, 1.0, 0.0, 1.0, 1.0]), np.ones(5))
    assert np.all(np.diff(y) >= 0) and np.allclose(y, [0, 0.5, 1.0]) and np.allclose(x, [0, 1.5, 3.5])


def ppm(rows, train):
    """The log10 probability of each text by its definition, with dictionaries."""
    k = compress.ORDER
    raw = [b"\n" * k + " ".join(words(t)).encode() + b"\n" for _, t in rows]
    seen = [collections.defaultdict(collections.Counter) for _ in range(k + 1)]
    for r, use in zip(raw, train, strict=True):
        for i in range(k, len(r)) if use else ():
            for o in range(k + 1):
                seen[o][r[i - o : i]][r[i]] += 1
    out = []
    for r in raw:
        total = 0.0
        for i in range(k, len(r)):
            gone = set()
            for o in range(k, -1, -1):
                have = {b: c for b, c in seen[o].get(r[i - o : i], {}).items() if b not in gone}
                if have:
                    n = 2 * sum(have.values())
                    if r[i] in have:
                        total += math.log10((2 * have[r[i]] - 1) / n)
                        break
                    total += math.log10(len(have) / n)
                    gone |= set(have)
            else:
                total -= math.log10(max(1, 256 - len(gone)))
        out.append(total)
    return out


def test_language_model_scores(spark, monkeypatch):
    monkeypatch.setattr(compress, "BATCH", 16)
    rows = corpus(11, 30) + [(None, "null id"), (4, "a b"), (4, "a b")]
    train = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for i, _ in rows]
    tokens = [[*words(t), "\n"] for _, t in rows]
    c = collections.Counter(w for t, use in zip(tokens, train, strict=True) if use for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted(
        (str(i), not use, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6), round(s, 3))
        for (i, _), use, t, s in zip(rows, train, tokens, ppm(rows, train), strict=True)
    )
    got = compress.scores(with_clashes(spark, rows).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3)) for r in got) == want
    assert compress.scores(spark.createDataFrame([], DOCS)).count() == 0


def test_adaptive_code_length():
    rng = random.Random(1)
    assert compress.adaptive("abcd " * 50) > compress.adaptive("".join(rng.choice("abcdefghijklmnop") for _ in range(250)))
    assert compress.adaptive("") == pytest.approx(-math.log10(256))


def test_language_model_keeps_rare_contexts(spark):
    # 18 MB of training text: a share of 2 ** -23 of it is more than one occurrence, and the last word's contexts come once
    long = "abcdefgh " * 10000
    rows = [(i, long) for i in range(250) if zlib.crc32(str(i).encode()) % 5 != 1] + [(1000, "zyxwvu"), (1003, "zyxwvu")]
    train = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    assert sum(len(t) for (_, t), use in zip(rows, train, strict=True) if use) > 2 * 2**23 and sum(train[-2:]) == 1
    # each byte of the rare word but its first is the one that came after its context, once: half of the count is left to it
    got = {r.doc_id: r.score for r in compress.scores(spark.createDataFrame(rows, DOCS)).filter("doc_id >= 1000").collect()}
    n = sum(train) - 1
    # the first byte: a of all the long texts at order 5, escaped to z
    first = math.log10((2 * 1 - 1) / (2 * (n + 1)))
    assert all(s == pytest.approx(first + 6 * math.log10(0.5), abs=1e-4) for s in got.values())
