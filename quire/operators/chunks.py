"""Cutting text into requests of bounded length, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import WS, spoken_form, trimmed

SENTENCE_END = rf"(?U)(?<=[.!?…]){WS}+"


def _pieces(sentence: Column, limit: int) -> Column:
    """A sentence as runs of at most `limit` characters that end before the last space that fits, or hard without one."""
    solid = r"[^\s\x1c-\x1f]"
    fits = rf"(?sU){solid}(?:.{{0,{limit - 1}}}\z|.{{0,{limit - 1}}}(?= )|.{{{limit - 1}}})"
    return F.transform(F.regexp_extract_all(sentence, F.lit(fits), F.lit(0)), trimmed)


def chunks(text: Column, limit: int = 2500) -> Column:
    """The sentences of a text gathered into chunks of at most `limit` characters, joined by a space.

    A longer sentence begins a chunk; its last piece is filled up by the sentences after
    it. A text that fits is one chunk as it is, an empty one has none, null has null.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    sentences = F.filter(F.transform(F.split(text, SENTENCE_END, -1), trimmed), lambda s: s != "")
    part = lambda s, alone: F.struct(s.alias("text"), alone.alias("alone"))
    parts = F.flatten(F.transform(sentences, lambda s: F.when(F.length(s) <= limit, F.array(part(s, F.lit(False)))).otherwise(F.transform(_pieces(s, limit), lambda p: part(p, F.lit(True))))))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(acc: Column, p: Column) -> Column:
        more = F.concat(acc["open"], F.lit(" "), p["text"])
        joins = acc["open"].isNotNull() & ~p["alone"] & (F.length(more) <= limit)
        done = F.when(acc["open"].isNull() | joins, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        return F.struct(done.alias("done"), F.when(joins, more).otherwise(p["text"]).alias("open"))

    packed = F.aggregate(parts, start, step, lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))
    return F.when(text == "", F.array().cast("array<string>")).when(F.length(text) <= limit, F.array(text)).otherwise(packed)


def with_chunks(df: DataFrame, text: str, target: str = "chunks", max_chars: int = 2500) -> DataFrame:
    """`df` with an array of chunks of a text's speech form. A null text has null."""
    return df.withColumn(target, spoken_form(F.col(f"`{text}`"))).withColumn(target, chunks(F.col(f"`{target}`"), max_chars))


def exploded(df: DataFrame, chunks: str = "chunks") -> DataFrame:
    """A row for each chunk, with chunk_id chunk_0001 and on."""
    return df.select("*", F.posexplode(chunks).alias("pos", "chunk")).withColumn("chunk_id", F.format_string("chunk_%04d", F.col("pos") + 1)).drop(chunks, "pos")
