"""Personal data: pattern matches, and spans that a trained tagger adds.

The base spans are those of four patterns. A character-level bidirectional LSTM
with CRF transitions (tagger.py) reads overlapping windows, which begin at every
STRIDE-th character of a text. Their tags are reconciled for the whole text: each
character takes its tag from the window in whose middle it is most, tags are joined to
spans, spans that a check of their kind refuses are dropped, and base spans win over
those that overlap them.

Every check asks for a digit or @. So only windows over words with such a character, and
REACH around them, are decoded, and more of them while a span goes on at the end of what
was read. The result is that of decoding all windows, at a small part of the time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import columns, documents, lean
from quire.llm.tagger import KINDS, PAD, STRIDE, WINDOW, Tagger, codes, train

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
NUMBER = re.compile(r"[0-9]+")
TRIGGER = re.compile(r"[0-9@]")
#: Characters around a word with a digit or @ that are read with it at first.
REACH = 16


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    """The matches of EMAIL in time linear in the text: all starts before one @ share what follows it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, (end := m.end())
        at = text.find("@", max(at + 1, end))


def _ips(text: str):
    """The matches of IP in linear time: fours of numbers in a chain with single dots between."""
    chain: list[re.Match] = []
    for m in NUMBER.finditer(text):
        if chain and not (m.start() == chain[-1].end() + 1 and text[m.start() - 1] == "."):
            chain = []
        chain.append(m)
        if len(chain) == 4:
            yield chain
            chain = []


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the four patterns, leftmost and non-overlapping for each kind."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, c[0].start(), c[3].end()) for c in _ips(text) if all(len(d := x[0].lstrip("0")) < 4 and int(d or 0) <= 255 for x in c)]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def _plausible(kind: int, s: str) -> bool:
    """The check that an added span must pass."""
    d = _digits(s)
    if kind == 0:
        return "@" in s and re.fullmatch(r"[\w.%+-]+\s?[(\[]?@[)\]]?\s?[\w-]+(\.[\w-]+)+", s) is not None
    if kind == 1:
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(len(p) < 4 and int(p) <= 255 for p in parts) and s.count(".") == 3
    if kind == 2:
        return 16 <= len(d) <= 19 and luhn(d) and re.fullmatch(r"[0-9 .\n-]+", s) is not None
    return 10 <= len(d) <= 15 and re.fullmatch(r"[+0-9 ().\n-]+", s) is not None and not s.isdigit()


def _runs(text: str) -> list[tuple[int, int]]:
    """Where words with a digit or @ lie, with REACH around them."""
    runs: list[tuple[int, int]] = []
    end, n = 0, len(text)
    for m in TRIGGER.finditer(text):
        if m.start() < end:
            continue
        lo, hi = m.span()
        while lo > end and not text[lo - 1].isspace():
            lo -= 1
        while hi < n and not text[hi].isspace():
            hi += 1
        end = hi
        runs.append((max(0, lo - REACH), min(n, hi + REACH)))
    return _joined(runs)


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in runs:
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _windows(lo: int, hi: int) -> range:
    """Numbers of the windows over the characters lo to hi; window k begins at k STRIDE."""
    return range(max(0, -(-(lo - WINDOW + 1) // STRIDE)), (hi - 1) // STRIDE + 1)


def _spans(tags: np.ndarray) -> list[tuple[int, int, int]]:
    out, i = [], 0
    kinds = np.where(tags > 0, (tags - 1) // 2, -1)
    edges = np.flatnonzero((kinds[1:] != kinds[:-1]) | ((tags[1:] > 0) & (tags[1:] % 2 == 1))) + 1
    for j in [*edges.tolist(), len(tags)]:
        if i < j and kinds[i] >= 0:
            out.append((int(kinds[i]), i, j))
        i = j
    return out


def _decoded(texts: list[str], wanted: list[tuple[int, int]], tagger: Tagger, batch: int, tags: dict[tuple[int, int], np.ndarray]) -> None:
    """Put the tags of the windows (text, number) into `tags`."""
    for b in range(0, len(wanted), batch):
        part = wanted[b : b + batch]
        x = np.full((len(part), WINDOW), PAD, np.uint8)
        for r, (i, k) in enumerate(part):
            c = codes(texts[i][k * STRIDE : k * STRIDE + WINDOW])
            x[r, : len(c)] = c
        for of, y in zip(part, tagger.decode(tagger.emissions(x)), strict=True):
            tags[of] = y


def _reconciled(i: int, lo: int, hi: int, size: int, tags: dict[tuple[int, int], np.ndarray]) -> np.ndarray:
    """The tags of the characters lo to hi of text i, which has `size`."""
    out, depth = np.zeros(hi - lo, np.int8), np.full(hi - lo, -1, np.int16)
    for k in _windows(lo, hi):
        begin = k * STRIDE
        n = min(WINDOW, size - begin)
        middle = np.minimum(np.arange(n), n - 1 - np.arange(n)).astype(np.int16)
        first, last = max(lo, begin), min(hi, begin + n)
        own, at = slice(first - lo, last - lo), slice(first - begin, last - begin)
        better = middle[at] > depth[own]
        out[own][better], depth[own][better] = tags[i, k][at][better], middle[at][better]
    return out


def added_spans(texts: list[str], tagger: Tagger, batch: int = 512) -> list[list[tuple[int, int, int]]]:
    """Spans that the tagger finds in each text, before base spans are considered."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    tags: dict[tuple[int, int], np.ndarray] = {}
    todo = {i: runs for i, t in enumerate(texts) if (runs := _runs(t))}
    while todo:
        new = sorted({(i, k) for i, runs in todo.items() for lo, hi in runs for k in _windows(lo, hi)} - tags.keys())
        _decoded(texts, new, tagger, batch, tags)
        again = {}
        for i, runs in todo.items():
            size, wider = len(texts[i]), []
            found = [_reconciled(i, lo, hi, size, tags) for lo, hi in runs]
            for (lo, hi), y in zip(runs, found, strict=True):
                # a span that goes on at an end isn't read to its own end
                wider.append((max(0, lo - WINDOW) if y[0] else lo, min(size, hi + WINDOW) if y[-1] else hi))
            if wider != runs:
                again[i] = _joined(wider)
                continue
            for (lo, _), y in zip(runs, found, strict=True):
                for kind, a, b in _spans(y):
                    s = texts[i][lo : lo + len(y)]
                    while a < b and s[a].isspace():
                        a += 1
                    while a < b and s[b - 1] in " \n\t.,;:!|-(#":
                        b -= 1
                    if a < b and _plausible(kind, s[a:b]):
                        out[i].append((kind, lo + a, lo + b))
        todo = again
    return out


def find_spans(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; added ones don't overlap others."""
    found = []
    for base, more in zip([base_spans(t) for t in texts], added_spans(texts, tagger), strict=True):
        taken = sorted((s, e) for _, s, e in base)
        new = []
        for kind, s, e in more:
            if not any(a < e and s < b for a, b in taken):
                new.append((kind, s, e))
        found.append((sorted(base), sorted(base + new)))
    return found


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of `docs`.

    Counts and the digest are of the base spans, spans lists all, by kind and start,
    in code points. A null or empty text has none: zeros, the digest of the empty
    string, and an empty list. Repeated rows give repeated results.
    """
    tagger = tagger or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                found = find_spans([t or "" for t in b["text"].to_pylist()], tagger)
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
                digest = pa.array([hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays([b["doc_id"], *counts, digest, pa.array([_listed(s) for _, s in found], pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(run), f"doc_id long, {kinds}, base_sha256 string, spans string")


def redacted(docs: DataFrame, text_col: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """`docs` with each span of personal data in its text replaced by its kind in angle brackets. A null text stays null."""
    tagger = tagger or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index(text_col)
            texts, out = b.column(i).to_pylist(), []
            for t, (_, spans) in zip(texts, find_spans([t or "" for t in texts], tagger), strict=True):
                at, parts, end = 0, [], -1
                for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
                    if s >= end:
                        parts += [t[at:s], f"<{KINDS[kind]}>"]
                        at = e
                    at, end = max(at, e), max(end, e)
                out.append("".join([*parts, t[at:]]) if spans else t)
            yield pa.RecordBatch.from_arrays([pa.array(out, c.type) if j == i else c for j, c in enumerate(b.columns)], names=b.schema.names)

    return docs.mapInArrow(lean(run), docs.schema)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(columns(documents(spark, sf_dir), "doc_id", "text"))
