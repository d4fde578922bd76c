"""Clocks, ISBNs and name-based identifiers as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import blank_to_null, trimmed

CLOCK = r"^([0-9]+):([0-9]{2}):([0-9]{2})(?:\.([0-9]{1,3}))?$"


def _parts(ms: Column) -> tuple[Column, ...]:
    ms = ms.cast("long")
    return F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000


def clock(ms: Column) -> Column:
    """H:MM:SS.mmm of milliseconds; null for null and for less than 0."""
    return F.when(ms >= 0, F.format_string("%d:%02d:%02d.%03d", *[p.cast("long") for p in _parts(ms)]))


def duration(ms: Column) -> Column:
    """HH:MM:SS.mmm of milliseconds; null for null and for less than 0."""
    return F.when(ms >= 0, F.format_string("%02d:%02d:%02d.%03d", *[p.cast("long") for p in _parts(ms)]))


def clock_ms(c: Column) -> Column:
    """Milliseconds of a clock, or null if it isn't one, its minutes or seconds exceed 59, or it has another prefix such as npt=."""
    c = trimmed(c)
    h, m, s = (F.try_to_number(F.nullif(F.regexp_extract(c, CLOCK, i), F.lit("")), F.lit("9" * 15)).cast("long") for i in (1, 2, 3))
    frac = F.rpad(F.regexp_extract(c, CLOCK, 4), 3, "0")
    return F.when(c.rlike(CLOCK) & (m < 60) & (s < 60), ((h * 60 + m) * 60 + s) * 1000 + frac.try_cast("long"))


def isbn13(c: Column) -> Column:
    """The 13 digits of a valid ISBN-13, else null, also for ISBN-10: the accepted form is the long one."""
    bare = F.regexp_replace(F.trim(F.regexp_replace(trimmed(c), r"^urn:isbn:\s*", "")), r"(?i)^isbn\s*", "")
    digits = F.regexp_replace(bare, "[^0-9Xx]", "")
    total = F.aggregate(F.sequence(F.lit(1), F.lit(13)), F.lit(0), lambda acc, i: acc + F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 1).otherwise(3))
    return F.when(digits.rlike("^[0-9]{13}$"), F.when(total % 10 == 0, digits))


def isbn_urn(c: Column) -> Column:
    return F.concat(F.lit("urn:isbn:"), isbn13(c))


def preferred(*candidates: Column) -> Column:
    """The first candidate that isn't null or blank, trimmed."""
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def json_string(c: Column) -> Column:
    """A JSON string of the text, non-ASCII characters as they are."""
    one = F.to_json(F.struct(c.alias("v")))
    return F.substring(one, F.lit(6), F.length(one) - 6)


def canonical_json(fields: dict[str, Column], comma: str = ",", colon: str = ":") -> Column:
    """An object of the non-null fields (already JSON), keys sorted."""
    parts = [F.when(v.isNotNull(), F.concat(F.lit(f'"{k}"{colon}'), v)) for k, v in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(comma, *parts), F.lit("}"))


#: The namespace of names that are URLs (RFC 4122), a fixed value.
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = NAMESPACE_URL) -> Column:
    """The version 5 UUID of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def book_uid(title: Column, author: Column, language: Column, subject=None, translator=None, publisher=None, date=None, isbn=None) -> Column:
    """urn:uuid of a book's stable metadata; null if title, author or language is blank."""
    fields = {"title": title, "author": author, "language": language, "subject": subject, "translator": translator, "source_publisher": publisher, "source_date": date, "source_isbn": isbn}
    # to_json leaves null fields out, and writes no spaces; an array of one row keeps its fields computed once
    row = F.struct(*[blank_to_null(v).alias(k) for k, v in sorted(fields.items()) if v is not None])
    names = F.transform(F.array(row), lambda r: F.when(r["title"].isNotNull() & r["author"].isNotNull() & r["language"].isNotNull(), F.to_json(r)))
    return F.get(F.transform(names, lambda n: F.concat(F.lit("urn:uuid:"), uuid5(n))), 0)


def request_signature(text: Column, voice: Column, rate: Column, max_chars: Column) -> Column:
    """SHA-256 of what a speech request depends on, as JSON with sorted keys and a space after , and :."""
    fields = {"tts_text": json_string(text), "voice": json_string(voice), "rate": json_string(rate), "max_chars_per_request": max_chars.cast("string")}
    return F.sha2(canonical_json(fields, ", ", ": ").cast("binary"), 256)


def text_sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)
