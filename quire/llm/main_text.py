"""Main text of web pages, with boilerplate found by a suffix array over each host's pages.

Pages are parsed into blocks of visible text; menus, headers, footers, sidebars,
notices, adverts, forms and comments that the markup names are left out. The token
streams of one host's pages are concatenated and their suffixes sorted by prefix
doubling. Neighbours in that order with RUN tokens or more in common are a substring
that recurs; those on enough distinct pages are boilerplate, and what they cover is
removed. Whatever a longer substring covers is covered by its parts of RUN tokens, which
are on as many pages, so suffixes are sorted by RUN tokens and no further. Text inside an
article or main element only goes by whole blocks, and only if half of the host's pages
share it; elsewhere the unique runs are kept. Copies of one page count as one page.

A large host is dealt into groups of pages, each with its suffix array, and is still
judged as a whole: a substring on a share of the host's pages is on such a share of the
pages of one group at least, so the groups name the candidates, all groups count them,
and the sums decide. The three passes read one exchange.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import columns, documents, lean, shuffle_parts, stored
from quire.llm.words import shingle_hashes, utf8, word_hashes

RUN = 8
#: A host is dealt into groups of so many pages and characters of html at least.
GROUP_PAGES, GROUP_CHARS = 200, 2_000_000
#: Distinct pages, and share of a group's pages, that make a run outside an article boilerplate, and a block inside.
OUTSIDE, INSIDE = (3, 0.05), (4, 0.5)

#: Fixed values of HTML: elements without visible text, containers that are never main text, void and inline elements.
HIDDEN = frozenset("head script style noscript template iframe svg math canvas object audio video select option textarea button title".split())
APART = frozenset("nav footer aside form dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Names in class and id, as whole words of theirs, of what is never main text.
SURE = "ads? adverts? advertisement adbox adsense sponsored cookies? gdpr menu nav navbar navigation breadcrumbs? sidebar aside footer masthead topbar comments? disqus replies respond newsletter subscribe signup pagination pager".split()
#: Names that such parts share with wrappers of a page's text: these don't count for what holds most of it.
LOOSE = "banner sponsor promo consent notices? share sharing social related recommended login popup modal overlay widget toolbar skip".split()
_HEAD, _TAIL = r"(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary|post|article|social|user|reader|cookie)[-_])?", r"(?:[-_]?(?:bar|box|area|list|links?|block|section|container|wrap|wrapper|inner|menu|nav|content|thread|form|buttons?|banner|notice|consent|[0-9]+))?"
NAMED = {kind: re.compile(rf"{_HEAD}(?:{'|'.join(names)}){_TAIL}|(?:site|page)-?header", re.I) for kind, names in (("sure", SURE), ("loose", LOOSE))}
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW_END = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}


def _apart(tag: str, attributes: str, inside: bool) -> str | None:
    """Whether an element is set apart: "sure", "loose" if its name may be a wrapper's, or None."""
    if tag in APART or tag == "header" and not inside:
        return "sure"
    if not attributes or tag in ("html", "body"):
        return None
    found = None
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value.lower() in ROLES:
            return "sure"
        if name in ("class", "id") and tag not in MAIN:
            for word in value.split():
                if NAMED["sure"].fullmatch(word):
                    return "sure"
                if NAMED["loose"].fullmatch(word):
                    found = "loose"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "sure"
    return found


def blocks(page: str) -> list[tuple[bool, str]]:
    """(inside an article or main element, text) of the page's blocks in order, without the parts set apart.

    An element that is only set apart by a loose name stays if it holds more than half
    of the text that isn't surely apart.
    """
    out: list[tuple[bool, str, tuple[int, ...]]] = []  # with the loosely named elements around each block
    stack: list[tuple[str, bool, bool, tuple[int, ...]]] = []  # tag, hidden or apart, main, loose; each includes those around it
    parts: list[str] = []
    at, size, loose = 0, len(page), 0

    def flush(of) -> None:
        if parts:
            if text := " ".join(html.unescape("".join(parts)).split()):
                out.append((of[2], text, of[3]))
            parts.clear()

    top = ("", False, False, ())
    while at < size:
        m = TOKEN.search(page, at)
        of = stack[-1] if stack else top
        if not of[1]:
            parts.append(page[at : m.start() if m else size])
        if not m:
            break
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA[") and not of[1]:
                parts.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = m[2].lower()
        if tag == "br":
            if not of[1]:
                parts.append(" ")
            continue
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag not in INLINE and tag not in HIDDEN:
                flush(of)
            if depth is not None and not (tag in INLINE and any(s[0] not in INLINE for s in stack[depth:])):
                del stack[depth:]
            continue
        if tag not in INLINE and tag not in HIDDEN:
            flush(of)
            # an open paragraph, and what is open in it, ends where a block begins
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), None)
            if depth is not None and (stack[depth][0] == "p" or tag == stack[depth][0] and tag in ("li", "tr", "td", "th", "dt", "dd", "option")):
                del stack[depth:]
            of = stack[-1] if stack else top
        if tag in VOID or m[3].endswith("/") and tag in ("svg", "path", "use"):
            continue
        if tag in RAW_END:
            end = RAW_END[tag].search(page, at)
            at = end.start() if end else size
        inside = of[2] or tag in MAIN
        kind = _apart(tag, m[3], inside)
        if kind == "loose":
            if tag in INLINE:
                kind = None
            else:
                loose += 1
        stack.append((tag, of[1] or tag in HIDDEN or kind == "sure", inside, (*of[3], loose) if kind else of[3]))
    flush(stack[-1] if stack else top)
    if loose:
        holds: dict[int, int] = {}
        for _, text, names in out:
            for i in names:
                holds[i] = holds.get(i, 0) + len(text)
        half = sum(len(text) for _, text, _ in out) / 2
        out = [b for b in out if all(holds[i] > half for i in b[2])]
    return [(main, text) for main, text, _ in out]


def page_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, main, text, digest, first): text holds the blocks by line; digest is the same for pages of the same words.

    If a page has text inside an article or main element, its other text is left out.
    first is true for one page of each host and digest of a partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                found = [blocks(h or "") for h in b["html"].to_pylist()]
                found = [[x for x in f if x[0]] or f for f in found]
                main = pa.array([bool(f and f[0][0]) for f in found], pa.bool_())
                texts = pa.array(["\n".join(t for _, t in f) for f in found], pa.string())
                h, at, _, _ = word_hashes(*utf8(texts))
                digest, first = [int.from_bytes(hashlib.blake2b(h[i:j].tobytes(), digest_size=8).digest(), "little", signed=True) for i, j in zip(at[:-1], at[1:], strict=True)], []
                for of in zip(b["host"].to_pylist(), digest, strict=True):
                    first.append(of not in seen)
                    seen.add(of)
                yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], b["host"], main, texts, pa.array(digest, pa.int64()), pa.array(first, pa.bool_())], ["page_id", "url", "host", "main", "text", "digest", "first"])

    return pages.mapInArrow(lean(run), "page_id long, url string, host string, main boolean, text string, digest long, first boolean")


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).withColumn("host", host)


def repeated(tokens: np.ndarray, page: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """For the suffixes of `tokens` sorted by `run` tokens: classes of those that agree in them, per position (-1: none), and distinct pages of each class.

    Prefix doubling: ranks of runs of 1, 2, 4 ... tokens, each from pairs of the
    one before, until `run` tokens are ranked. A run doesn't cross into another page.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < run:
        step = min(length, run - length)
        # a run that would cross into the next page has no rank
        ok = np.zeros(n, bool)
        if n > step:
            ok[: n - step] = (page[: n - step] == page[step:]) & (rank[: n - step] >= 0) & (rank[step:] >= 0)
        pair = np.where(ok[: n - step], rank[: n - step] * n + rank[step:], -1) if n > step else np.zeros(0, np.int64)
        pair = np.concatenate([pair, np.full(n - len(pair), -1)])
        values, rank = np.unique(pair, return_inverse=True)
        rank = rank.astype(np.int64) - (1 if len(values) and values[0] == -1 else 0)
        length += step
    return rank, pages_of(rank, page)


def pages_of(rank: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Distinct pages of each class of positions."""
    has = np.flatnonzero(rank >= 0)
    both = np.unique(rank[has] * (int(page.max(initial=0)) + 1) + page[has])
    return np.bincount(both // (int(page.max(initial=0)) + 1), minlength=int(rank.max(initial=-1)) + 1)


def _cover(rank: np.ndarray, often: np.ndarray, run: int) -> np.ndarray:
    start = np.zeros(len(rank) + run, np.int64)
    hit = np.flatnonzero(rank >= 0)
    hit = hit[often[rank[hit]]]
    np.add.at(start, hit, 1)
    np.add.at(start, hit + run, -1)
    return np.cumsum(start)[: len(rank)] > 0


def runs_of(texts: list[str], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `run` tokens that begin at each token of the pages' texts, and where there is one."""
    h, at, _, _ = word_hashes(*utf8(pa.array(texts, pa.large_string())))
    hashes, run_at = shingle_hashes(h, at, run)
    out, has = np.zeros(len(h), np.uint64), np.zeros(len(h), bool)
    for i in np.flatnonzero(np.diff(at) >= run):
        n = run_at[i + 1] - run_at[i]
        out[at[i] : at[i] + n], has[at[i] : at[i] + n] = hashes[run_at[i] : run_at[i + 1]], True
    return out, has


def _counted(group: pd.DataFrame) -> list[str]:
    """The texts of the distinct pages that count in this group."""
    return group[group["first"]].drop_duplicates("digest")["text"].to_list()


def candidates(group: pd.DataFrame) -> pd.DataFrame:
    """(host, run): the runs that are on a share of OUTSIDE of a group's distinct pages."""
    texts = _counted(group)
    h, at, _, _ = word_hashes(*utf8(pa.array(texts, pa.large_string())))
    page = np.repeat(np.arange(len(texts)), np.diff(at))
    hashes, has = runs_of(texts)
    found = np.zeros(0, np.int64)
    if has.any():
        rank, count = repeated(h, page)
        # a class by the hash of its first run
        _, first = np.unique(rank[has], return_index=True)
        found = hashes[np.flatnonzero(has)[first[count >= OUTSIDE[1] * len(texts)]]].view(np.int64)
    return pd.DataFrame({"host": group["host"].iloc[0], "run": found})


def counts(group: pd.DataFrame, named: pd.DataFrame) -> pd.DataFrame:
    """(host, run, n, pages) for each of the host's candidate runs: the distinct pages of a group that have it, and all of them."""
    if not len(group) or not len(named):
        return pd.DataFrame({"host": [], "run": [], "n": [], "pages": []})
    wanted = np.sort(named["run"].to_numpy(np.int64).view(np.uint64))
    found, texts = [np.zeros(0, np.int64)], _counted(group)
    for text in texts:
        hashes, has = runs_of([text])
        hashes = np.unique(hashes[has])
        at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
        found.append(at[wanted[at] == hashes])
    n = np.bincount(np.concatenate(found), minlength=len(wanted))
    return pd.DataFrame({"host": group["host"].iloc[0], "run": wanted.view(np.int64), "n": n, "pages": len(texts)})


def frequent(rows: DataFrame, spread: DataFrame) -> DataFrame:
    """(host, part, run, inside): for each group of a host, the runs that enough of the host's distinct pages share."""
    parts = spread.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select("host", "part")
    # a condition that isn't deterministic stays above the exchange, which all passes share
    many = rows.filter(F.col("groups") + F.floor(F.rand()) > 1).groupBy("host", "part")
    named = many.applyInPandas(candidates, "host string, run long").distinct()
    found = many.cogroup(named.join(parts, "host").groupBy("host", "part")).applyInPandas(counts, "host string, run long, n long, pages long")
    found = found.groupBy("host", "run").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages")).filter((F.col("n") >= OUTSIDE[0]) & (F.col("n") >= OUTSIDE[1] * F.col("pages")))
    inside = (F.col("n") >= INSIDE[0]) & (F.col("n") >= INSIDE[1] * F.col("pages"))
    return found.select("host", "run", inside.alias("inside")).join(parts, "host").select("host", "part", "run", "inside")


def without_boilerplate(pages: list[tuple[bool, list[str]]], run: int = RUN, known: tuple[np.ndarray, np.ndarray] | None = None) -> list[str]:
    """The texts of one host's pages, (has a main element, blocks), with repeated runs removed.

    known: the hashes of the runs that are boilerplate outside and inside, if these are not all of the host's pages.
    """
    flat = [b for _, bs in pages for b in bs]
    h, word_at, _, _ = word_hashes(*utf8(pa.array(flat, pa.large_string())))
    sizes = np.diff(word_at)
    owner = np.repeat(np.arange(len(pages)), [len(bs) for _, bs in pages])
    first = np.concatenate(([0], np.cumsum([len(bs) for _, bs in pages]))).astype(np.int64)
    if known:
        hashes, has = runs_of([" ".join(bs) for _, bs in pages], run)
        rank = np.where(has, np.arange(len(h)), -1)
        outside, inside = (_cover(rank, np.isin(hashes, k), run) if len(h) else np.zeros(0, bool) for k in known)
    else:
        # copies of one page are one page
        copies: dict[bytes, int] = {}
        page_of = np.array([copies.setdefault(h[word_at[first[i]] : word_at[first[i + 1]]].tobytes(), i) for i in range(len(pages))], np.int64)
        token_page = np.repeat(owner, sizes)
        distinct = len(copies)
        rank, count = repeated(h, token_page, run) if len(h) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if distinct < len(pages) and len(h):
            count = pages_of(rank, page_of[token_page])
        outside = _cover(rank, count >= max(OUTSIDE[0], OUTSIDE[1] * distinct), run) if len(h) else np.zeros(0, bool)
        inside = _cover(rank, count >= max(INSIDE[0], INSIDE[1] * distinct), run) if len(h) else np.zeros(0, bool)
    out = []
    for i, (main, bs) in enumerate(pages):
        keep = []
        for j, text in zip(range(first[i], first[i + 1]), bs, strict=True):
            a, b = word_at[j], word_at[j + 1]
            if main:
                if not (b > a and inside[a:b].all()):
                    keep.append(text)
            elif not outside[a:b].any():
                keep.append(text)
            else:
                words = text.split(" ")
                if len(words) == b - a and (rest := " ".join(w for w, c in zip(words, outside[a:b], strict=True) if not c)):
                    keep.append(rest)
        out.append(" ".join(keep))
    return out


def cut(group: pd.DataFrame, often: pd.DataFrame) -> pd.DataFrame:
    """(page_id, url, text, n_chars) of a group's pages; `often` holds the host's frequent runs if it has other groups."""
    if not len(group):
        return pd.DataFrame({"page_id": [], "url": [], "text": [], "n_chars": []})
    known = None
    if group["groups"].iloc[0] > 1:
        run = often["run"].to_numpy(np.int64).view(np.uint64)
        known = (run, run[often["inside"].to_numpy(bool)])
    done = without_boilerplate([(m, t.split("\n") if t else []) for m, t in zip(group["main"], group["text"], strict=True)], known=known)
    return pd.DataFrame({"page_id": group["page_id"], "url": group["url"], "text": done, "n_chars": [len(t) for t in done]})


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of `pages`.

    Reads page_id, url and html. Null and empty html give an empty text, a null or
    odd url counts as one host of its own name. Repeated rows give repeated results.
    White space inside a block becomes one space; blocks are joined by one space.
    """
    pages = with_host(pages)
    size = pages.groupBy("host").agg(F.count("*").alias("pages"), F.sum(F.length("html")).alias("chars"))
    groups = F.floor(F.least(F.col("pages") / GROUP_PAGES, F.col("chars") / GROUP_CHARS)).cast("int")
    # written, so that the planner knows its size: one row for each host of several groups
    spread = stored(size.select("host", groups.alias("groups")).filter("groups > 1"))
    rows = page_blocks(pages).join(spread, "host", "left").withColumn("groups", F.coalesce("groups", F.lit(1)))
    # of the copies of a page one from each partition goes where all are counted once; the others are dealt out
    home = F.when(F.col("first"), F.xxhash64("digest")).otherwise(F.xxhash64("page_id", "url", "digest"))
    rows = rows.withColumn("part", F.pmod(home, F.col("groups")).cast("int"))
    rows = rows.repartition(shuffle_parts(pages.sparkSession), "host", "part")
    return rows.groupBy("host", "part").cogroup(frequent(rows, spread).groupBy("host", "part")).applyInPandas(cut, "page_id long, url string, text string, n_chars long")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(columns(documents(spark, sf_dir, "pages"), "page_id", "url", "html"))
