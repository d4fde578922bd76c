"""Chat formatting in DataFrame operations throughout.

A finite-state machine over the roles validates the order of turns. Each turn
becomes three text segments, header, text and end, and a declarative template
says what they are and which carry loss. Control strings inside texts are escaped,
so the formatted text can be read back; `parsed` does that.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.shared import columns, documents


@dataclass(frozen=True)
class Template:
    """Marks of turns. A text has no mark or end after escaping, whatever it holds."""

    mark: str = "###"
    after: str = ": "
    end: str = "</turn>"
    names: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    #: Roles whose texts carry loss.
    loss: tuple = ("assistant",)
    #: state -> role -> next state; what isn't here is an error, and so is an end in a state not in `final`.
    moves: dict = field(default_factory=lambda: {"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"}, "assistant": {"user": "user"}})
    final: tuple = ("assistant",)

    def escaped(self, text: Column) -> Column:
        r"""\ becomes \\, the mark \m and the end \e; so neither mark nor end is left."""
        for a, b in (("\\", "\\\\"), (self.mark, "\\m"), (self.end, "\\e")):
            text = F.replace(text, F.lit(a), F.lit(b))
        return text

    def unescaped(self, text: Column) -> Column:
        parts = F.split(text, r"\\\\", -1)  # the pattern of two backslashes
        return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\e"), F.lit(self.end)), F.lit("\\m"), F.lit(self.mark))), "\\")

    def header(self, role: Column) -> Column:
        """The mark, the role's name, and `after`; a role without a name is written as = and the escaped role, : as \\c."""
        known = F.create_map(*[F.lit(x) for pair in self.names.items() for x in pair])
        other = F.concat(F.lit("="), F.replace(self.escaped(role), F.lit(":"), F.lit("\\c")))
        return F.concat(F.lit(f"{self.mark} "), F.coalesce(F.try_element_at(known, role), other), F.lit(self.after))

    def role(self, name: Column) -> Column:
        known = F.create_map(*[F.lit(x) for k, v in self.names.items() for x in (v, k)])
        parts = F.split(F.substring(name, 2, 2_000_000_000), r"\\\\", -1)
        plain = F.array_join(F.transform(parts, lambda p: F.replace(F.replace(F.replace(p, F.lit("\\c"), F.lit(":")), F.lit("\\e"), F.lit(self.end)), F.lit("\\m"), F.lit(self.mark))), "\\")
        return F.coalesce(F.try_element_at(known, name), plain)


TEMPLATE = Template()
#: The conversation that the query adds, with every control string inside its texts.
PROBE = (-7, "\\### Assistant: </turn> ok")


def validity(roles: Column, template: Template = TEMPLATE) -> Column:
    """Null if the machine accepts the roles, else the number of the first turn that it rejects, or of turns if they end early."""
    moves = F.create_map(*[F.lit(x) for s, m in template.moves.items() for r, to in m.items() for x in (f"{s}\n{r}", to)])
    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("bad"))

    def move(acc: Column, role: Column) -> Column:
        to = F.try_element_at(moves, F.concat(acc["state"], F.lit("\n"), role))
        return F.struct(F.coalesce(to, F.lit("error")).alias("state"), (acc["n"] + 1).alias("n"), F.when(acc["bad"].isNull() & to.isNull(), acc["n"]).otherwise(acc["bad"]).alias("bad"))

    return F.aggregate(roles, start, move, lambda acc: F.coalesce(acc["bad"], F.when(~acc["state"].isin(*template.final), acc["n"])))


def formatted(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, n_turns, error_turn, segments, formatted), one row for each conversation.

    Reads conv_id, turn, role and text of `turns`. segments is an array of
    (text, loss) in order; formatted is their concatenation. Turns are ordered by
    turn, null first, then role and text, so ties and repeated rows stay and are in
    a defined order. A null role or text is empty; a null conv_id is a conversation
    of its own. error_turn is null if the turn order is valid; invalid
    conversations are formatted all the same. One conversation is one row, as its
    training example is; the sort is within conversations.
    """
    clean = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text")
    rows = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list(key)).alias("t"))
    segments = F.flatten(
        F.transform(
            F.col("t"),
            lambda t: F.array(
                F.struct(template.header(t["role"]).alias("text"), F.lit(False).alias("loss")),
                F.struct(template.escaped(t["text"]).alias("text"), t["role"].isin(*template.loss).alias("loss")),
                F.struct(F.lit(template.end + "\n").alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    rows = rows.select("conv_id", F.size("t").cast("long").alias("n_turns"), validity(F.col("t.role"), template).alias("error_turn"), segments.alias("segments"))
    return rows.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def parsed(text: Column, template: Template = TEMPLATE) -> Column:
    """The turns, array of (role, text), read back from formatted text alone."""
    pieces = F.split(text, template.end + "\n", -1)  # no special characters in the end mark
    turns = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        head = F.instr(p, F.lit(template.after))
        name = F.substring(p, F.lit(len(template.mark) + 2), head - len(template.mark) - 2)
        body = F.substring(p, head + len(template.after), F.length(p))
        return F.struct(template.role(name).alias("role"), template.unescaped(body).alias("text"))

    return F.transform(turns, turn)


def with_probe(turns: DataFrame) -> DataFrame:
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    two = turns.sparkSession.range(2).select(F.lit(PROBE[0]).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(PROBE[1]).alias("text"))
    return turns.unionByName(two)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests that the formatted text and its loss flags give when read back."""
    turns = with_probe(columns(documents(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"))
    out = formatted(turns).withColumn("turns", parsed(F.col("formatted")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: TEMPLATE.unescaped(s["text"])), "")
    out = out.withColumn("learned", learned)
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("error_turn").cast("long").alias("error_turn"),
    )


OP8_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
numbered AS (
  SELECT *, row_number() OVER w - 1 AS i, lag(role) OVER w AS last, lead(role) OVER w IS NULL AS final
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text))),
judged AS (
  SELECT *, CASE
      WHEN role = 'system' AND last IS NULL THEN NULL
      WHEN role = 'user' AND (last IS NULL OR last IN ('system', 'assistant')) THEN NULL
      WHEN role = 'assistant' AND last = 'user' THEN NULL
      ELSE i END AS bad,
    replace(replace(replace(text, '\', '\\'), '###', '\m'), '</turn>', '\e') AS escaped
  FROM numbered)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
      ELSE 1 + length(replace(replace(replace(replace(role, '\', '\\'), '###', '\m'), '</turn>', '\e'), ':', '\c')) END
    + 2 + length(escaped) + 8) AS BIGINT) AS formatted_chars,
  coalesce(min(bad), CASE WHEN max(role) FILTER (final) <> 'assistant' THEN count(*) END) AS error_turn
FROM judged GROUP BY conv_id
"""
