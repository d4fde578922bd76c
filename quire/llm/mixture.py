"""Mixing sources to target weights, in DataFrame operations throughout.

Tokens are summed for each source, targets are filled up by weight, and each
document is taken floor(rate) times plus once more if a number in [0, 1) hashed
from the seed and its id is below the fraction of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.shared import columns, documents, sent_if_few, stored

WEIGHTS = (5, 2, 1)
#: Tokens of the whole mix, and at most of one source, as multiples of what there is.
TOTAL, MOST = 1.5, 2.0
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _unit(seed: str, doc_id: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the seed and the id; a null id counts as empty."""
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size), one row for each source.

    Sources weigh `weights` in turn, by code point, a null source last. They share
    `total` of all tokens; no target exceeds `most` times its source, and the excess
    is shared by weight until none does. That is one level for all that stay below:
    sources are sorted by the level at which they are full, and running sums give
    the level at each. The windows run over one row for each source, not over documents.
    """
    ranked = sizes.withColumn("turn", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(kinds, (F.col("turn") % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("full", F.col("cap") / F.col("weight"))
    ranked = ranked.withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(total))).withColumn("weights", F.sum("weight").over(everything))
    before = Window.orderBy("full", "turn").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("level", (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the first source that is not full at its level sets the level of all after it; beyond it levels fall
    level = F.max(F.when(F.col("full") > F.col("level"), F.col("level"))).over(everything)
    ranked = ranked.withColumn("level", level).withColumn("target", F.when(F.col("level").isNull() | (F.col("full") <= F.col("level")), F.col("cap")).otherwise(F.col("level") * F.col("weight")))
    return ranked.select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))


def with_copies(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST, seed: str = SEED) -> DataFrame:
    """`docs`, all columns, with a struct `mix` of size, source_size, target, rate and copies.

    Reads doc_id, text and source. Null and empty texts have size 0. Null is a
    source of its own. Rows that repeat an id get the same draw. No rows give no rows.
    One row for each source is sent around, so documents stay where they are. Copies are
    drawn by chance, so what a source of few documents takes may miss its target by as
    much as some of its documents.
    """
    size = word_count(F.col("text"))
    goal = targets(docs.select("source", size.alias("size")).groupBy("source").agg(F.sum("size").alias("source_size")), weights, total, most)
    # joined null-safe
    key = lambda c: F.struct(F.coalesce(c, F.lit("")), c.isNull())
    goal = sent_if_few(stored(goal.select(key(F.col("source")).alias("mix_key"), F.struct("source_size", "target", "rate").alias("mix_goal"))), 100_000)
    out = docs.withColumn("mix_key", key(F.col("source"))).join(goal, "mix_key").drop("mix_key")
    rate = F.col("mix_goal.rate")
    more = (_unit(seed, F.col("doc_id")) < rate - F.floor(rate)).cast("long")
    mix = F.struct(size.alias("size"), "mix_goal.source_size", "mix_goal.target", "mix_goal.rate", (F.floor(rate) + more).alias("copies"))
    return out.withColumn("mix", mix).drop("mix_goal")


def mixed(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies), one row for each row of `docs`; see with_copies."""
    return with_copies(docs.select("doc_id", "text", "source"), weights, total, most, seed).select("doc_id", "source", "mix.*")


def op4_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(columns(documents(spark, sf_dir), "doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS turn FROM sums),
weighed AS (
  SELECT *, CASE turn % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap FROM ranked),
levels AS (
  SELECT *, cap / weight AS filled,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS at_here
  FROM weighed WINDOW b AS (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT source, source_size, CASE WHEN l IS NULL OR filled <= l THEN cap ELSE l * weight END AS target
  FROM (SELECT *, max(CASE WHEN filled > at_here THEN at_here END) OVER () AS l FROM levels)),
rated AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE
    WHEN CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < rate - floor(rate)
    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
