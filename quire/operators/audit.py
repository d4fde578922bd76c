"""Audit of speech units for tokens that a voice may read wrongly."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import NUM, excerpt, is_decimal_token, mostly_upper

# Categories, and the tokens and phrases of the dictionary, in order.
CATEGORIES = ("all_caps", "acronym", "decimal", "percent", "currency", "slash_expression", "attached_unit", "unusual_symbol", "suspicious_source_text", "unmapped_foreign_token")
KNOWN_TOKENS = (
    "S&P 500", "Roth IRA", "401(k)", "401 (k)", "ARPANET", "GEICO", "NAFTA", "CNBC", "NASA", "MBA", "JFK", "NYU", "LHQ", "SEC", "CEO", "IRA", "GDP", "IBM",
    "MPG", "AWS", "SUV", "NIH", "ICU", "ROI", "IRS", "USC", "P&G", "TV", "VC", "GE", "PC", "UC", "JP", "DC", "GS", "GB",
)
EXPANDED = {"401(k)": "bốn không một k", "401 (k)": "bốn không một k"}
SUSPICIOUS = ("Warrant Buffet", "Bill Gate", "nữa số lần", "quan trong", "Marc Andreesen")

ACRONYM = r"(?U)\b[A-Z]{2,}\b"
#: Categories that are matches of one pattern in the display text.
PATTERNS = {"percent": rf"{NUM}%", "currency": rf"\${NUM}", "slash_expression": r"(?U)\b[0-9]+/[0-9]+\b", "attached_unit": rf"(?U){NUM}(?:GB|kg)\b"}
DECIMAL = rf"(?U)\b{NUM}\b"
FOREIGN = r"(?U)\b[A-Z][a-z]+(?:[\s\x1c-\x1f]+(?:[A-Z][a-z]+|[A-Z]{2,}))+\b"
SYMBOL = r"><|[<>]"


def _all(pattern: str) -> Column:
    return F.regexp_extract_all("display_text", F.lit(pattern), F.lit(0))


def _spoken(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: F.contains(F.col("tts_text"), t))


def _quoted(token: str) -> str:
    return "\\Q" + token + "\\E"


#: Known tokens that are upper-case words, and the upper-case words within the others.
WORDS = tuple(t for t in KNOWN_TOKENS if re.fullmatch("[A-Z]{2,}", t))
if not set(re.findall(r"\b[A-Z]{2,}\b", " ".join(KNOWN_TOKENS))) <= set(WORDS):
    raise ValueError("an upper-case word within a known token must be one itself")


def acronyms(display: str = "display_text", tts: str = "tts_text") -> Column:
    """Known tokens, and upper-case words that lie in no known token, which the speech text still has.

    A known token that is a word covers the word that is equal to it and none that is
    longer; what lies within one of several words is a known token too. So looking the
    words up does what comparing their places with those of the tokens would.
    """
    text, spoken = F.col(display), F.col(tts)
    present = [F.contains(text, F.lit(t)) & (F.contains(spoken, F.lit(t)) | (F.contains(spoken, F.lit(EXPANDED[t])) if t in EXPANDED else F.lit(False))) for t in KNOWN_TOKENS]
    kept = F.array_compact(F.array(*[F.when(p, F.lit(t)) for p, t in zip(present, KNOWN_TOKENS, strict=True)]))
    free = F.filter(F.regexp_extract_all(text, F.lit(ACRONYM), F.lit(0)), lambda a: ~a.isin(*WORDS) & F.contains(spoken, a))
    # most texts have no capitals in a row: only those that do are looked through
    return F.when(text.rlike(r"[A-Z0-9&]{2}"), F.concat(kept, free)).otherwise(F.array().cast("array<string>"))


def tokens() -> list[tuple[str, Column]]:
    """(category, array of tokens) in the order of the report."""
    whole = F.when(F.col("type").isin("heading", "subtitle") & mostly_upper(F.col("tts_text")), F.array("tts_text")).otherwise(F.array().cast("array<string>"))
    found = [("all_caps", whole), ("acronym", acronyms()), ("decimal", F.filter(_all(DECIMAL), is_decimal_token))]
    found += [(c, _all(p)) for c, p in PATTERNS.items()]
    found.append(("unusual_symbol", _spoken(_all(SYMBOL))))
    phrase = [F.when(F.col("display_text").rlike(rf"(?iU)(?<!\w){_quoted(t)}(?!\w)"), F.lit(t)) for t in SUSPICIOUS]
    found.append(("suspicious_source_text", F.array_compact(F.array(*phrase))))
    found.append(("unmapped_foreign_token", _spoken(_all(FOREIGN))))
    return found


def issues(unit_rows: DataFrame) -> DataFrame:
    """(section_id, unit_id, category, token, display_text, tts_text), each (unit, category, token) once, at its first place.

    Reads section_id, section_ord, ord, id, type, display_text and tts_text. Texts are
    cut to excerpts around the token. Only tokens travel: texts are cut before the shuffle.
    """
    def listed(rank: int, category: str, found: Column) -> Column:
        return F.transform(found, lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("pos"), F.lit(category).alias("category"), x.alias("token")))

    lists = [listed(n, c, t) for n, (c, t) in enumerate(tokens())]
    # within a unit the first of equal tokens is kept at once
    rows = unit_rows.select("section_id", "section_ord", "ord", F.col("id").alias("unit_id"), "display_text", "tts_text", F.explode(F.concat(*lists)).alias("t"))
    rows = rows.select("section_id", "section_ord", "ord", "unit_id", "t.*", excerpt(F.col("display_text"), F.col("t.token")).alias("display_text"), excerpt(F.col("tts_text"), F.col("t.token")).alias("tts_text"))
    first = Window.partitionBy("unit_id", "category", "token").orderBy("section_ord", "ord", "rank", "pos")
    return rows.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")


def in_report_order(found: DataFrame) -> DataFrame:
    return found.orderBy("section_ord", "ord", "rank", "pos").select("section_id", "unit_id", "category", "token", "display_text", "tts_text")


def category_counts(found: DataFrame, categories=CATEGORIES) -> DataFrame:
    """(category_ord, category, issues) with a row for each category, also those without issues."""
    spark = found.sparkSession
    every = spark.createDataFrame(list(enumerate(categories)), "category_ord int, category string")
    return every.join(found.groupBy("category").agg(F.count("*").alias("issues")), "category", "left").na.fill(0, ["issues"]).select("category_ord", "category", "issues")


def distinct_tokens(found: DataFrame, categories=("acronym", "unmapped_foreign_token")) -> DataFrame:
    return found.filter(F.col("category").isin(*categories)).select("token").distinct()


def totals(unit_rows: DataFrame, chunks: str | None = None) -> DataFrame:
    """(section_id, units, characters, requests) for each section, and for all with a null section_id, in one pass."""
    requests = F.sum(F.size(chunks)) if chunks else F.lit(None)
    return unit_rows.rollup("section_id").agg(F.count("*").alias("units"), F.sum(F.length("tts_text").cast("long")).alias("characters"), requests.cast("long").alias("requests"))
