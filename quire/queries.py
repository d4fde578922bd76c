"""The registered queries over the tables of a directory, each with the SQL that a second engine runs on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import ids, text
from quire.functions.speech import with_speech_text
from quire.operators import audit, checks, chunks, render, structure, timeline
from quire.sources.html import CLOSES_P, paragraphs

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as the one unit of a section of its own, spoken as it is written."""
    docs = table(spark, sf_dir, "documents")
    key = F.col("doc_id").cast("string")
    return docs.select(key.alias("section_id"), F.col("doc_id").alias("section_ord"), F.lit(0).alias("ord"), key.alias("id"), F.lit("paragraph").alias("type"), F.col("text").alias("display_text"), F.col("text").alias("tts_text"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, ord, classes, text, images): the lines of each document as paragraph records."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").alias("book_id"), F.posexplode(F.split("text", "\n", -1)).alias("ord", "text"))
    image = F.array().cast("array<struct<src:string,alt:string>>")
    return rows.select("book_id", F.col("ord").cast("long").alias("ord"), F.array(F.lit("block_3")).alias("classes"), "text", image.alias("images"))


LINES = "lines AS (SELECT doc_id AS book_id, CAST(unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS BIGINT) AS ord, unnest(string_split(text, chr(10))) AS text FROM documents)"


@query("SELECT doc_id, trim(regexp_replace(replace(nfc_normalize(text), chr(160), ' '), '\\s+', ' ', 'g')) AS value FROM documents")
def text_strict_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.strict(F.col("text")).alias("value"))


@query(
    r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(nfc_normalize(text), chr(160), ' '), '[ \t]+', ' ', 'g'), '\s+([,.;:!?])', '\1', 'g'), '^\s+|\s+$', '', 'g') AS value FROM documents"
)
def text_speech_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.spoken_form(F.col("text")).alias("value"))


@query(
    f"WITH {LINES} SELECT book_id, ord, printf('%d_p%04d', book_id, row_number() OVER (PARTITION BY book_id ORDER BY ord)) AS id, text AS display_text FROM lines WHERE text <> ''"
)
def paragraph_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir).filter("text != ''")
    n = F.row_number().over(Window.partitionBy("book_id").orderBy("ord"))
    return lines.select("book_id", "ord", F.format_string("%d_p%04d", "book_id", n).alias("id"), F.col("text").alias("display_text"))


_ENDS = "|".join(sorted(CLOSES_P, key=lambda t: (-len(t), t)))


@query(
    rf"""WITH seg AS (SELECT page_id, unnest(x) AS s, unnest(range(len(x))) AS i FROM (SELECT page_id, regexp_split_to_array(html, '<p(?:\s[^>]*)?>') AS x FROM pages)),
    raw AS (SELECT page_id, i, regexp_extract(s, '(?s)^(.*?)(?:</?(?:{_ENDS})(?:[\s/>]|$)|$)', 1) AS s FROM seg WHERE i > 0),
    said AS (SELECT page_id, i, s, trim(regexp_replace(replace(nfc_normalize(replace(replace(replace(replace(regexp_replace(s, '<[^>]*>', '', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&')), chr(160), ' '), '\s+', ' ', 'g')) AS text FROM raw)
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS BIGINT) AS pos, '' AS classes, text, CAST(len(regexp_extract_all(s, '<img[\s/>]')) AS BIGINT) AS images FROM said WHERE text <> '' OR regexp_matches(s, '<img[\s/>]')"""
)
def html_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = paragraphs(table(spark, sf_dir, "pages"), "html", "page_id")
    return out.select("page_id", "pos", F.array_join("classes", " ").alias("classes"), "text", F.size("images").cast("long").alias("images"))


@query(
    r"SELECT doc_id, CAST(length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS BIGINT) AS upper_letters, length(regexp_replace(text, '[^\p{L}]', '', 'g')) > 0 AND "
    r"length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) * 10 >= length(regexp_replace(text, '[^\p{L}]', '', 'g')) * 8 AS mostly_upper FROM documents"
)
def upper_ratio_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = F.length(F.regexp_replace("text", r"[^\p{Lu}]", "")).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", upper.alias("upper_letters"), text.mostly_upper(F.col("text")).alias("mostly_upper"))


EXCERPT = """SELECT doc_id, token, CASE WHEN length(text) <= 160 THEN text ELSE
  CASE WHEN s > 0 THEN '...' || substr(CASE WHEN e < n THEN substr(p, 1, length(p) - 3) || '...' ELSE p END, 4) WHEN e < n THEN substr(p, 1, length(p) - 3) || '...' ELSE p END END AS excerpt
  FROM (SELECT *, substr(text, s + 1, e - s) AS p FROM (SELECT *, greatest(0, e - 160) AS s FROM (SELECT *, least(n, f + 160) AS e FROM (
    SELECT *, length(text) AS n, greatest(0, instr(text, token) - 1 - CAST(floor((160 - length(token)) / 2.0) AS BIGINT)) AS f FROM found))))"""


def _audit(category: str, sql: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        column = dict(audit.tokens())[category]
        rows = document_units(spark, sf_dir).select(F.col("section_ord").alias("doc_id"), "display_text", F.explode(F.array_distinct(column.alias("t"))).alias("token"))
        return rows.select("doc_id", "token", text.excerpt(F.col("display_text"), F.col("token")).alias("excerpt"))

    run.__name__ = f"audit_{category}"
    return query(f"WITH found AS (SELECT DISTINCT d.doc_id, d.text, t.token FROM documents d, LATERAL (SELECT unnest({sql}) AS token) t) {EXCERPT}")(run)


_audit("percent", r"regexp_extract_all(d.text, '[0-9]+(?:[.,][0-9]+)*%')")


#: White space of any kind, and texts with all letters but those of ASCII as underscores, so that a word begins and ends where it does.
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_NUM = "[0-9]+(?:[.,][0-9]+)*"
_known = ", ".join("'" + t + "'" for t in audit.KNOWN_TOKENS)
FOUND = rf"""texts AS (SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(text, '[^\P{{L}}\x00-\x7F]', '_', 'g'), '\p{{M}}', '_', 'g'), '[^\P{{Nd}}\x00-\x7F]', '_', 'g') AS t FROM documents),
pieces AS (SELECT doc_id, p, sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (SELECT doc_id, unnest(x) AS p, unnest(range(len(x))) AS i FROM (SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+') AS x FROM texts WHERE regexp_matches(t, '[A-Z]{{2}}')))),
capitals AS (SELECT doc_id, p AS token, e - length(p) AS s, e FROM pieces WHERE regexp_full_match(p, '[A-Z]{{2,}}')),
known AS (SELECT doc_id, k, sum(length(g) + length(k)) OVER (PARTITION BY doc_id, k ORDER BY i) AS e, i, n FROM (SELECT doc_id, k, unnest(string_split(text, k)) AS g, unnest(range(len(string_split(text, k)))) AS i, len(string_split(text, k)) AS n FROM documents, (SELECT unnest([{_known}]) AS k) WHERE contains(text, k))),
numbers AS (SELECT doc_id, unnest(regexp_extract_all(t, '\b{_NUM}\b')) AS token FROM texts),
found AS (
  SELECT DISTINCT doc_id, 'acronym' AS category, k AS token FROM known
  UNION SELECT doc_id, 'acronym', token FROM capitals c WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.doc_id = c.doc_id AND k.i < k.n - 1 AND k.e - length(k.k) <= c.s AND c.e <= k.e)
  UNION SELECT doc_id, 'decimal', token FROM numbers WHERE CASE WHEN contains(token, ',') THEN length(token) - length(replace(token, ',', '')) = 1 ELSE contains(token, '.') AND NOT regexp_full_match(token, '[^.]*(\.[^.]{{3}})+') END
  UNION SELECT doc_id, 'percent', unnest(regexp_extract_all(text, '{_NUM}%')) FROM documents
  UNION SELECT doc_id, 'currency', unnest(regexp_extract_all(text, '\${_NUM}')) FROM documents
  UNION SELECT doc_id, 'slash_expression', unnest(regexp_extract_all(t, '\b[0-9]+/[0-9]+\b')) FROM texts
  UNION SELECT doc_id, 'attached_unit', unnest(regexp_extract_all(t, '{_NUM}(?:GB|kg)\b')) FROM texts
  UNION SELECT doc_id, 'unusual_symbol', unnest(regexp_extract_all(text, '><|[<>]')) FROM documents
  UNION SELECT doc_id, 'suspicious_source_text', p FROM documents, (SELECT unnest([{", ".join("'" + t + "'" for t in audit.SUSPICIOUS)}]) AS p) WHERE regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}])' || p || '($|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}])')
  UNION SELECT doc_id, 'unmapped_foreign_token', unnest(regexp_extract_all(t, '\b[A-Z][a-z]+(?:{_BLANK}+(?:[A-Z][a-z]+|[A-Z]{{2,}}))+\b')) FROM texts)"""


@query(f"WITH {FOUND}, cut AS ({EXCERPT.replace('FROM found)', 'FROM found JOIN documents USING (doc_id))').replace('SELECT doc_id, token,', 'SELECT doc_id, category, token,', 1)}) SELECT CAST(doc_id AS VARCHAR) AS section_id, CAST(doc_id AS VARCHAR) AS unit_id, category, token, excerpt AS display_text, excerpt AS tts_text FROM cut")
def audit_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of every category, each document as a unit that is spoken as it is written."""
    found = audit.issues(document_units(spark, sf_dir))
    return found.select("section_id", "unit_id", "category", "token", "display_text", "tts_text")


@query(
    f"WITH {FOUND} SELECT c.category_ord, c.category, count(f.token) AS issues FROM (VALUES "
    + ", ".join(f"({i}, '{c}')" for i, c in enumerate(audit.CATEGORIES))
    + ") c(category_ord, category) LEFT JOIN found f ON f.category = c.category GROUP BY ALL"
)
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues by category over documents, with a row for every category."""
    return audit.category_counts(audit.issues(document_units(spark, sf_dir)))


@query(f"WITH {FOUND} SELECT DISTINCT token FROM found WHERE category IN ('acronym', 'unmapped_foreign_token')")
def audit_distinct_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_tokens(audit.issues(document_units(spark, sf_dir)))


SPOKEN_SQL = r"regexp_replace(regexp_replace(regexp_replace(replace(nfc_normalize(text), chr(160), ' '), '[ \t]+', ' ', 'g'), '\s+([,.;:!?])', '\1', 'g'), '^\s+|\s+$', '', 'g')"


@query(
    rf"""WITH RECURSIVE t AS (SELECT doc_id, {SPOKEN_SQL} AS x FROM documents),
    s AS (SELECT doc_id, i, trim(w, chr(32) || chr(9) || chr(10) || chr(13)) AS w FROM (SELECT doc_id, unnest(l) AS w, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(regexp_replace(x, '([.!?…])\s+', '\1' || chr(1), 'g'), chr(1)) AS l FROM t WHERE length(x) > 2500)) WHERE trim(w, chr(32) || chr(9) || chr(10) || chr(13)) <> ''),
    cut(doc_id, i, n, piece, rest) AS (
      SELECT doc_id, i, 0, CAST(NULL AS VARCHAR), w FROM s WHERE length(w) > 2500
      UNION ALL SELECT doc_id, i, n + 1, trim(substr(rest, 1, e), chr(32) || chr(10)), ltrim(substr(rest, e + 1), chr(32) || chr(10)) FROM (
        SELECT *, CASE WHEN length(rest) <= 2500 THEN length(rest) WHEN 2502 - instr(reverse(substr(rest, 1, 2501)), ' ') BETWEEN 2 AND 2501 THEN 2501 - instr(reverse(substr(rest, 1, 2501)), ' ') ELSE 2500 END AS e FROM cut WHERE rest <> '')),
    items AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, n) AS k, size, alone FROM (
      SELECT doc_id, i, 0 AS n, length(w) AS size, FALSE AS alone FROM s WHERE length(w) <= 2500 UNION ALL SELECT doc_id, i, n, length(piece), TRUE FROM cut WHERE piece IS NOT NULL)),
    fold(doc_id, k, open, done, longest) AS (
      SELECT doc_id, k, size, 0, 0 FROM items WHERE k = 1
      UNION ALL SELECT f.doc_id, i.k, CASE WHEN NOT alone AND open + 1 + size <= 2500 THEN open + 1 + size ELSE size END, CASE WHEN NOT alone AND open + 1 + size <= 2500 THEN done ELSE done + 1 END,
        CASE WHEN NOT alone AND open + 1 + size <= 2500 THEN longest ELSE greatest(longest, open) END FROM fold f JOIN items i ON i.doc_id = f.doc_id AND i.k = f.k + 1)
    SELECT doc_id, CAST(CASE WHEN x = '' THEN 0 ELSE 1 END AS BIGINT) AS requests, CAST(length(x) AS BIGINT) AS longest FROM t WHERE length(x) <= 2500
    UNION ALL SELECT doc_id, CAST(max(done) + 1 AS BIGINT), CAST(greatest(max(longest), arg_max(open, k)) AS BIGINT) FROM fold GROUP BY doc_id"""
)
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = chunks.with_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    longest = F.coalesce(F.array_max(F.transform("chunks", F.length)), F.lit(0))
    return docs.select("doc_id", F.size("chunks").cast("long").alias("requests"), longest.cast("long").alias("longest"))


CLIPS = """clips AS (SELECT conv_id, turn, CAST(coalesce(sum(length(text) * 10) OVER w, 0) + (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) * 350 AS BIGINT) AS clip_begin_ms, length(text) * 10 AS duration_ms
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def conversation_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", (F.length("text").cast("long") * 10).alias("duration_ms"))
    return timeline.timeline(turns, "conv_id", "turn")


@query(f"WITH {CLIPS} SELECT conv_id, turn, clip_begin_ms, CAST(clip_begin_ms + duration_ms AS BIGINT) AS clip_end_ms FROM clips")
def timeline_prefix_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_clips(spark, sf_dir).select("conv_id", "turn", "clip_begin_ms", "clip_end_ms")


@query(
    f"""WITH {CLIPS}, moved AS (SELECT conv_id, turn, clip_begin_ms - CASE WHEN turn % 3 = 2 THEN 400 ELSE 0 END AS b, clip_begin_ms + CASE WHEN turn % 5 = 4 THEN -1 ELSE duration_ms END AS e FROM clips),
    seen AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS p FROM moved)
    SELECT rule, conv_id || '/' || turn AS key, b || '-' || e AS detail FROM (
      SELECT 'negative begin' AS rule, * FROM seen WHERE b < 0 UNION ALL SELECT 'end not after begin', * FROM seen WHERE e <= b UNION ALL SELECT 'not monotonic', * FROM seen WHERE b < p)"""
)
def timeline_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of conversations, some moved so that they break a rule."""
    clips = conversation_clips(spark, sf_dir)
    clips = clips.withColumn("clip_end_ms", F.col("clip_begin_ms") + F.when(F.col("turn") % 5 == 4, -1).otherwise(F.col("duration_ms")))
    clips = clips.withColumn("clip_begin_ms", F.col("clip_begin_ms") - F.when(F.col("turn") % 3 == 2, 400).otherwise(0))
    return checks.clip_violations(clips, section="conv_id", order="turn")


@query(
    "SELECT conv_id, turn, printf('%d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS clock, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS duration, "
    "ms AS parsed FROM (SELECT conv_id, turn, CAST(length(text) * 7919 AS BIGINT) AS ms FROM conversations)"
)
def clock_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.length("text").cast("long") * 7919
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", ids.clock(ms).alias("clock"), ids.duration(ms).alias("duration"))
    return turns.withColumn("parsed", ids.clock_ms(F.col("clock")))


@query(f"WITH {LINES} SELECT book_id, ord, min(CASE WHEN text <> '' THEN ord END) OVER (PARTITION BY book_id ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ord FROM lines")
def next_text_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.next_text(document_lines(spark, sf_dir)).select("book_id", "ord", "next_ord")


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS section FROM conversations QUALIFY section IS NOT NULL")
def section_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns assigned to the user turn that began their exchange."""
    turns = table(spark, sf_dir, "conversations")
    starts = turns.filter("role = 'user'").select(F.col("conv_id").alias("book_id"), F.col("turn").alias("first_ord"), F.col("turn").cast("string").alias("section_id"), F.col("turn").alias("section_ord"), F.col("turn").alias("content_ord"))
    out = structure.assign_sections(turns.select(F.col("conv_id").alias("book_id"), F.col("turn").alias("ord")), starts)
    return out.select(F.col("book_id").alias("conv_id"), F.col("ord").alias("turn"), F.col("section_ord").alias("section"))


@query(
    """WITH a AS (SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ord FROM documents), b AS (SELECT * FROM a WHERE doc_id % 7 <> 3)
    , m AS (SELECT source, doc_id, CASE WHEN doc_id % 11 = 5 THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ord FROM b)
    SELECT CASE WHEN a.doc_id IS NULL OR m.doc_id IS NULL THEN 'manifest unit count' WHEN a.doc_id <> m.doc_id THEN 'manifest id' ELSE 'manifest display text' END AS rule,
      coalesce(a.source, m.source) || '/' || coalesce(a.ord, m.ord) AS key, CAST(coalesce(a.doc_id, m.doc_id) AS VARCHAR) AS detail
    FROM a FULL JOIN m ON a.source = m.source AND a.ord = m.ord WHERE a.doc_id IS NULL OR m.doc_id IS NULL OR a.doc_id <> m.doc_id OR a.text <> m.text"""
)
def positional_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source against a copy with some left out and some changed, position by position."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("section_id"), F.col("doc_id").alias("n"), F.col("doc_id").cast("string").alias("id"), F.lit("paragraph").alias("type"), F.col("text").alias("display_text"))
    order = F.row_number().over(Window.partitionBy("section_id").orderBy("n")) - 1
    other = docs.filter("n % 7 != 3").withColumn("display_text", F.when(F.col("n") % 11 == 5, "").otherwise(F.col("display_text"))).withColumn("ord", order)
    return checks.reconciled(docs.withColumn("ord", order), other, other)


@query("SELECT 'duplicate key' AS rule, l_orderkey || '/' || l_linenumber AS key, CAST(count(*) AS VARCHAR) AS detail FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicates(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], "duplicate key")


@query(
    "SELECT 'order without lines' AS rule, CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) "
    "UNION ALL SELECT 'document without label', CAST(doc_id AS VARCHAR) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"
)
def broken_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    out = checks.missing(table(spark, sf_dir, "orders").select("o_orderkey"), lines, "o_orderkey", "order without lines", "o_orderkey")
    docs, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    return out.union(checks.missing(docs, labels, "doc_id", "document without label", "doc_id")).select("rule", "key")


def _requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    requests = timeline.signed(docs, "text", "vi-VN-HoaiMyNeural", "-5%", 2500)
    return requests, requests.filter("doc_id % 3 = 0").select("signature", F.lit(1000).alias("duration_ms"))


CACHED = "EXISTS (SELECT 1 FROM documents c WHERE c.doc_id % 3 = 0 AND c.text = d.text)"


@query(f"SELECT doc_id, sha256(text) AS tts_text_sha256 FROM documents d WHERE NOT {CACHED}")
def cache_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, cache = _requests(spark, sf_dir)
    return timeline.to_synthesize(requests, cache).select("doc_id", "tts_text_sha256")


@query(f"SELECT doc_id FROM documents d WHERE {CACHED}")
def cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, cache = _requests(spark, sf_dir)
    return timeline.cached(requests, cache).select("doc_id")


@query(
    "SELECT d.doc_id, coalesce(nullif(trim(CASE WHEN l.quality = 1 THEN 'good' ELSE ' ' END), ''), nullif(trim(lang), '')) AS value FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"
)
def metadata_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    override = F.when(F.col("quality") == 1, "good").otherwise(" ")
    return docs.join(labels, "doc_id", "left").select("doc_id", ids.preferred(override, F.col("lang")).alias("value"))


@query(
    f"""WITH {CLIPS}, c AS (SELECT conv_id, turn, clip_begin_ms AS b, clip_begin_ms + duration_ms AS e FROM clips)
    SELECT conv_id, string_agg('<par id="par_' || conv_id || '_' || turn || '"><text src="book.xml#' || conv_id || '_' || turn || '"/><audio src="' || conv_id || '.mp3" clipBegin="' ||
      printf('%d:%02d:%02d.%03d', b // 3600000, b // 60000 % 60, b // 1000 % 60, b % 1000) || '" clipEnd="' || printf('%d:%02d:%02d.%03d', e // 3600000, e // 60000 % 60, e // 1000 % 60, e % 1000) || '"/></par>', chr(10) ORDER BY turn) AS pars
    FROM c GROUP BY conv_id"""
)
def render_par(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = conversation_clips(spark, sf_dir).withColumn("section_id", F.col("conv_id").cast("string")).withColumn("id", F.concat_ws("_", "section_id", F.col("turn").cast("string")))
    return render.smil_pars(clips).groupBy("conv_id").agg(render.joined("turn", "xml").alias("pars"))


@query()
def tts_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_speech_text(docs, "text", "tts_text").select("doc_id", "tts_text")


@query(
    """SELECT doc_id, sha256('{"max_chars_per_request": 2500, "rate": "-5%", "tts_text": "' || replace(replace(replace(text, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n') || '", "voice": "v"}') AS signature FROM documents""".replace("\\\\", "\\")
)
def request_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", ids.request_signature(F.col("text"), F.lit("v"), F.lit("-5%"), F.lit(2500)).alias("signature"))


@query(
    """WITH s AS (SELECT doc_id, lang, source, source || '-' || doc_id AS title FROM documents)
    SELECT doc_id, 'urn:uuid:' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr(h, 17, 1)) AS INTEGER) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uid
    FROM (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('{"author":"' || source || '","language":"' || lang || '","title":"' || title || '"}')) AS h FROM s)"""
)
def book_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    title = F.concat_ws("-", "source", F.col("doc_id").cast("string"))
    return docs.select("doc_id", ids.book_uid(title, F.col("source"), F.col("lang")).alias("uid"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, to units, to tokens, to counts by category: the flagship."""
    return audit_summary(spark, sf_dir)
