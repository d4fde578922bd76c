"""Paragraphs of HTML and XHTML documents, read with the tolerant parser of the standard library."""

from __future__ import annotations

import html
import posixpath
import unicodedata
from html.parser import HTMLParser
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.schemas import PARAGRAPHS_TYPE

#: Elements that end an open paragraph, fixed by HTML.
CLOSES_P = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table td th tr ul body html".split())


def one_line(text: str) -> str:
    return " ".join(unicodedata.normalize("NFC", text).replace(" ", " ").split())


class _Paragraphs(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.done: list[dict] = []
        self.open: dict | None = None

    def close_paragraph(self) -> None:
        if self.open is not None:
            p, self.open = self.open, None
            p["text"] = one_line("".join(p["text"]))
            if p["text"] or p["any_image"]:
                del p["any_image"]
                self.done.append(p)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self.close_paragraph()
        a = {k: v or "" for k, v in reversed(attrs)}
        if tag == "p":
            self.open = {"classes": a.get("class", "").split(), "text": [], "images": [], "any_image": False}
        elif tag == "img" and self.open is not None:
            self.open["any_image"] = True
            if "src" in a:
                self.open["images"].append({"src": a["src"], "alt": one_line(a.get("alt", ""))})

    def handle_endtag(self, tag: str) -> None:
        if tag in CLOSES_P:
            self.close_paragraph()

    def handle_data(self, data: str) -> None:
        # script and style are text nodes like others once they stand in a paragraph
        if self.open is not None:
            self.open["text"].append(data)


def parse(page: str | None) -> list[dict]:
    """Paragraphs in document order: classes, one line of text, and images. Those with neither text nor image are left out."""
    p = _Paragraphs()
    p.feed(page or "")
    p.close()
    p.close_paragraph()
    return p.done


#: Elements without an end tag, and attributes that a span which only formats may have; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FORMATTING = frozenset(("class", "dir", "lang", "style", "xml:lang"))


class _Normalized(HTMLParser):
    """Tokens of a document: formatting spans are left out, paragraphs are tidied once they end."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[list] = []  # kind, text or tag, and a place for attributes
        self.spans: list[bool] = []  # whether each open span is kept
        self.opened: int | None = None

    def handle_decl(self, decl: str) -> None:
        self.out.append(["raw", f"<!{decl}>"])

    def handle_comment(self, data: str) -> None:
        self.out.append(["raw", f"<!--{data}-->"])

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self.end_paragraph(implied=True)
        if tag == "span":
            self.spans.append(not {k for k, _ in attrs} <= FORMATTING)
            if not self.spans[-1]:
                return
        if tag == "p":
            self.opened = len(self.out)
        if tag == "img" and self.opened is not None:
            attrs = [(k, one_line(v or "") if k == "alt" else v) for k, v in attrs]
        self.out.append(["start", tag, attrs])

    def handle_endtag(self, tag: str) -> None:
        if tag == "span":
            if self.spans and not self.spans.pop():
                return
        if tag == "p" and self.opened is None:
            return
        if tag == "p" or tag in CLOSES_P:
            self.end_paragraph(implied=tag != "p")
            if tag == "p":
                return
        if tag not in VOID:
            self.out.append(["raw", f"</{tag}>"])

    def handle_data(self, data: str) -> None:
        self.out.append(["text", data])

    def end_paragraph(self, implied: bool = False) -> None:
        if self.opened is None:
            return
        mine, self.opened = self.out[self.opened :], None
        del self.out[len(self.out) - len(mine) :]
        text = [t for t in mine if t[0] == "text"]
        blank = True  # whether what came before ends with a space, or nothing came
        for t in text:
            t[1] = " ".join(f"x{unicodedata.normalize('NFC', t[1])}x".replace("\u00a0", " ").split())[1:-1]
            if blank:
                t[1] = t[1].lstrip(" ")
            blank = t[1].endswith(" ") if t[1] else blank
        for t in reversed(text):
            t[1] = t[1].rstrip(" ")
            if t[1]:
                break
        if any(t[1] for t in text) or any(t[0] == "start" and t[1] == "img" for t in mine):
            self.out += [*mine, ["raw", "</p>"]]

    def written(self) -> str:
        self.end_paragraph(implied=True)
        parts, verbatim = [], False
        for kind, value, *rest in self.out:
            if kind == "raw":
                parts.append(value)
                verbatim = False
            elif kind == "text":
                parts.append(value if verbatim else html.escape(value, quote=False))
            else:
                attrs = "".join(f' {k}="{html.escape(v)}"' if v is not None else f" {k}" for k, v in rest[0])
                parts.append(f"<{value}{attrs}>")
                verbatim = value in ("script", "style")
        return "".join(parts)


def normalized(page: str | None) -> str | None:
    """The document with spans that only format taken off, text of paragraphs in NFC with single spaces, and paragraphs without text or image left out.

    Other inline elements, such as b, strong, em, sup and sub, stay; so does what is outside of paragraphs.
    """
    if page is None:
        return None
    p = _Normalized()
    p.feed(page)
    p.close()
    return p.written()


@F.pandas_udf(T.StringType())
def normalized_html(page: pd.Series) -> pd.Series:
    return page.map(normalized)


def archive_path(base: str, href: str, query: bool = False) -> str:
    """A reference inside an archive as a path from its root; ValueError if it leads outside."""
    clean = href.split("#", 1)[0]
    clean = unquote(clean.split("?", 1)[0] if query else clean)
    path = posixpath.normpath(posixpath.join(posixpath.dirname(base), clean))
    if path.startswith(("../", "/")) or path == "..":
        raise ValueError(f"leads outside the archive: {href}")
    return path


@F.pandas_udf(PARAGRAPHS_TYPE)
def paragraphs_of(page: pd.Series) -> pd.Series:
    return page.map(parse)


def paragraphs(pages: DataFrame, html: str, *keep: str) -> DataFrame:
    """One row for each paragraph: the columns `keep`, then pos, classes, text and images. pos counts from 0 in the page."""
    found = pages.select(*[F.col(f"`{k}`") for k in keep], F.posexplode(paragraphs_of(F.col(f"`{html}`"))).alias("pos", "p"))
    return found.select(*keep, F.col("pos").cast("long").alias("pos"), "p.classes", "p.text", "p.images")
