"""Text rules as Column functions. Only Unicode normalization leaves the JVM (there is no builtin for it)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python and Unicode define it; Java's class lacks the four separators.
WS = r"[\s\x1c-\x1f]"
NUM = r"[0-9]+(?:[.,][0-9]+)*"


#: Characters that are in NFC whatever stands beside them: composed letters (of Vietnamese as well), signs, ideographs, syllables.
SETTLED = r"\x00-\x{2FF}\x{400}-\x{482}\x{1E00}-\x{1EFF}\x{2010}-\x{205F}\x{20A0}-\x{20BF}\x{3000}-\x{3029}\x{3041}-\x{3098}\x{309B}-\x{30FF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}\x{FF01}-\x{FFEF}\x{1F300}-\x{1FAFF}"


@F.pandas_udf(T.StringType())
def _normalized(text: pd.Series) -> pd.Series:
    return text.map(lambda s: s if s is None else unicodedata.normalize("NFC", s))


def nfc(c: Column) -> Column:
    """Only texts with characters that may be composed or put in order are sent to Python."""
    loose = c.rlike(f"[^{SETTLED}]")
    return F.coalesce(_normalized(F.when(loose, c)), c)


def trimmed(c: Column) -> Column:
    """Without white space of any kind at either end; F.trim knows the space only."""
    return F.regexp_replace(c, rf"(?U)^{WS}+|{WS}+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def strict(c: Column) -> Column:
    """NFC, every run of white space one space, none at the ends."""
    return F.trim(F.regexp_replace(nfc(c), rf"(?U){WS}+", " "))


def spoken_form(c: Column) -> Column:
    """NFC, runs of blanks one space, line breaks kept, none before punctuation or at the ends."""
    return respaced(nfc(c))


def respaced(c: Column) -> Column:
    """spoken_form of text that is in NFC already; stays in the JVM."""
    c = F.regexp_replace(F.replace(c, F.lit(" "), F.lit(" ")), r"[ \t]+", " ")
    return trimmed(F.regexp_replace(c, rf"(?U){WS}+([,.;:!?])", "$1"))


def regex_sub(c: Column, pattern: str, fn: Callable[[Column], Column]) -> Column:
    """Each match m of `pattern` replaced by fn(m). fn sees the match alone, without what is around it."""
    gaps, found = F.split(c, pattern, -1), F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    return F.array_join(F.zip_with(gaps, found, lambda gap, m: F.concat(gap, F.coalesce(fn(m), F.lit("")))), "")


def mostly_upper(c: Column) -> Column:
    """At least 0.8 of the letters are upper case, and there is one."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    upper = F.length(F.regexp_replace(c, r"[^\p{Lu}]", ""))
    return (letters > 0) & (upper * 10 >= letters * 8)


def sentence_case(c: Column) -> Column:
    """All lower case but for the first letter."""
    part = lambda i: F.regexp_extract(F.lower(c), r"(?s)^([^\p{L}]*)(\p{L}?)(.*)$", i)
    return F.concat(part(1), F.upper(part(2)), part(3))


#: A heading's "Chương X. " prefix and title.
PREFIX = r"(?iU)^(Chương\s+[^.]+\.\s*)(.*)$"


def heading_case(c: Column) -> Column:
    """Sentence case for a heading, or for its title after a chapter prefix, that is mostly upper case."""
    prefix, title = F.regexp_extract(c, PREFIX, 1), F.regexp_extract(c, PREFIX, 2)
    with_prefix = F.when(mostly_upper(title), F.concat(prefix, sentence_case(title))).otherwise(c)
    return F.when(c.rlike(PREFIX), with_prefix).when(mostly_upper(c), sentence_case(c)).otherwise(c)


def is_chapter_heading(c: Column, style: Column | None = None) -> Column:
    by_text = F.coalesce(spoken_form(c).rlike(r"(?iU)^(?:chương|chapter)\s+[0-9ivxlcdm]+\b"), F.lit(False))
    if style is None:
        return by_text
    return F.coalesce(F.replace(F.lower(style), F.lit("_"), F.lit(" ")).isin("heading 1", "title 1"), F.lit(False)) | by_text


def replace_all(c: Column, table: Mapping[str, str]) -> Column:
    """Literal replacements, longest first; later ones see what earlier ones wrote."""
    for key in sorted(table, key=len, reverse=True):
        c = F.replace(c, F.lit(key), F.lit(table[key]))
    return c


def literal_map(table: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv]) if table else F.create_map().cast("map<string,string>")


def heading_override(c: Column, table: Mapping[str, str]) -> Column:
    """The table's text for the whole heading, or for its title without the end mark after a chapter prefix."""
    known = literal_map(table)
    title = F.regexp_extract(c, PREFIX, 2)
    bare = F.regexp_replace(title, r"[.!?…]+$", "")
    inner = F.concat(F.regexp_extract(c, PREFIX, 1), F.try_element_at(known, bare), F.substring(title, F.length(bare) + 1, F.length(title)))
    return F.coalesce(F.try_element_at(known, c), F.when(c.rlike(PREFIX), inner), c)


def excerpt(text: Column, token: Column, limit: int = 160) -> Column:
    """At most `limit` characters around the token, with dots where text was cut."""
    n, at = F.length(text), F.instr(text, token) - 1
    ahead = F.floor((F.lit(limit) - F.length(token)) / 2)
    first = F.greatest(F.lit(0), at - ahead)
    last = F.least(n, first + limit)
    first = F.greatest(F.lit(0), last - limit)
    part = F.substring(text, (first + 1).cast("int"), (last - first).cast("int"))
    part = F.when(first > 0, F.concat(F.lit("..."), F.substring(part, 4, limit))).otherwise(part)
    part = F.when(last < n, F.concat(F.substring(part, F.lit(1), F.length(part) - 3), F.lit("..."))).otherwise(part)
    absent = F.concat(F.regexp_replace(F.substring(text, 1, limit - 3), rf"(?U){WS}+$", ""), F.lit("..."))
    return F.when(n <= limit, text).when(at < 0, absent).otherwise(part)


def has_text(c: Column) -> Column:
    """Anything but white space; null has none. The normal form of a text is blank where the text is."""
    return F.coalesce(c.rlike(rf"(?U)[^{WS[1:]}"), F.lit(False))


def needs_alt_review(alt: Column) -> Column:
    """NFC makes and takes away no character that is asked for here, so that the text need not leave the JVM for it."""
    value = F.trim(F.regexp_replace(alt, rf"(?U){WS}+", " "))
    return F.lower(value).isin("", "image", "undefined") | value.rlike(r"(?i)^[^\s/]+\.(?:gif|jpe?g|png|webp)$")


def is_safe_id(c: Column) -> Column:
    return c.rlike(r"^[^/\\]+$") & ~c.isin(".", "..")


def is_iso_date_shape(c: Column) -> Column:
    return c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")


def is_decimal_token(c: Column) -> Column:
    """One comma, or a dot and not all groups after it of three digits."""
    commas = F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))
    return F.when(commas > 0, commas == 1).otherwise(c.contains(".") & ~c.rlike(r"^[^.]*(?:\.[^.]{3})+$"))


def resolved_path(base: Column, href: Column, query: bool = False) -> Column:
    """A reference made relative to the folder of `base`, percent-decoded, with . and .. folded; null if it leads outside."""
    clean = F.substring_index(href, "#", 1)
    if query:
        clean = F.substring_index(clean, "?", 1)
    clean = F.url_decode(F.replace(clean, F.lit("+"), F.lit("%2B")))  # a plus is a plus in paths
    folder = F.regexp_extract(base, r"^(.*/)?[^/]*$", 1)
    whole = F.when(clean.startswith("/"), clean).otherwise(F.concat(folder, clean))
    parts = F.filter(F.split(whole, "/"), lambda p: ~p.isin("", "."))
    empty = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("out"))
    fold = F.aggregate(
        parts,
        empty,
        lambda acc, p: F.when(
            p == "..", F.struct(F.slice(acc["kept"], 1, F.greatest(F.size(acc["kept"]) - 1, F.lit(0))).alias("kept"), (acc["out"] | (F.size(acc["kept"]) == 0)).alias("out"))
        ).otherwise(F.struct(F.concat(acc["kept"], F.array(p)).alias("kept"), acc["out"].alias("out"))),
    )
    return F.when(~fold["out"] & ~whole.startswith("/"), F.array_join(fold["kept"], "/"))


def xml_escape(c: Column, quotes: bool = False) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")) + ((('"', "&quot;"),) if quotes else ()):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def ssml(text: Column, voice: Column, rate: Column, language: str = "vi-VN") -> Column:
    return F.concat(
        F.lit(f'<speak version="1.0" xml:lang="{language}"><voice name="'), xml_escape(voice), F.lit('"><prosody rate="'), xml_escape(rate), F.lit('">'), xml_escape(spoken_form(text)), F.lit("</prosody></voice></speak>")
    )
