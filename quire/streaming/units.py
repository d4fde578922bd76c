"""The row-wise steps on streams: units arrive, speech text and audit tokens go on. No state is kept.

Deduplication over units needs state; `first_tokens` bounds it by a watermark.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.speech import with_speech_text
from quire.operators.audit import tokens


def spoken(units: DataFrame, pronunciation: Mapping[str, str] | None = None) -> DataFrame:
    """Units with tts_text, from a stream or a batch of (id, type, display_text)."""
    return with_speech_text(units, "display_text", "tts_text", "type", pronunciation)


def token_stream(units: DataFrame) -> DataFrame:
    """`units` by token: all columns but the texts, with category and token."""
    def listed(category: str, found):
        return F.transform(found, lambda x: F.struct(F.lit(category).alias("category"), x.alias("token")))

    lists = [listed(c, t) for c, t in tokens()]
    keep = [c for c in units.columns if c not in ("display_text", "tts_text")]
    return units.select(*keep, F.inline(F.array_distinct(F.concat(*lists))))


def first_tokens(units: DataFrame, time: str, late: str = "1 hour") -> DataFrame:
    """Each (id, category, token) once within the watermark."""
    return token_stream(units).withWatermark(time, late).dropDuplicatesWithinWatermark(["id", "category", "token"])
