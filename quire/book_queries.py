"""Registered queries that call the operators on books, packages and texts, each with the SQL that a second engine runs.

Books are made from `documents`: each word is a paragraph record, and its place in the
text decides its class, so that there are introductions, chapters, and books that lack some.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import ids, text
from quire.functions.speech import number_words, with_speech_text
from quire.operators import audio, audit, checks, render, structure, timeline
from quire.plans.book import manifest
from quire.queries import query, table
from quire.sources import epub

CHAPTERS = 3

RECS = """words AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS i FROM documents),
recs AS (SELECT doc_id AS book_id, i AS ord,
  CASE WHEN i = 0 AND doc_id % 4 <> 3 THEN 'Giới thiệu' WHEN i >= 3 AND (i - 3) % 7 = 0 THEN CAST((i - 3) // 7 + 1 AS VARCHAR) ELSE w END AS text,
  CASE WHEN i = 0 THEN CASE WHEN doc_id % 4 <> 3 THEN 'block_' ELSE 'block_3' END WHEN i = 1 THEN 'block_2' WHEN i = 2 THEN 'block_3'
    WHEN (i - 3) % 7 IN (0, 1) AND NOT (doc_id % 5 = 0 AND i = 10) THEN 'block_' WHEN (i - 3) % 7 = 2 THEN 'block_10' ELSE 'block_3' END AS cls,
  CASE WHEN i % 11 = 5 THEN 'img/' || w || '.png' END AS src, CASE WHEN i % 11 = 5 THEN CASE WHEN i % 2 = 0 THEN ' Image ' ELSE 'x' || w END END AS alt FROM words),
followed AS (SELECT *, lead(cls) OVER b AS c1, lead(ord) OVER b AS o1, lead(text) OVER b AS t1, lead(cls, 2) OVER b AS c2, lead(ord, 2) OVER b AS o2, lead(text, 2) OVER b AS t2
  FROM recs WHERE text <> '' WINDOW b AS (PARTITION BY book_id ORDER BY ord)),
markers AS (SELECT book_id, CAST(text AS INTEGER) AS number, ord AS marker_ord, o1 AS title_ord, o2 AS subtitle_ord, t1 AS title, t2 AS subtitle
  FROM followed WHERE cls = 'block_' AND regexp_full_match(text, '[0-9]+') AND try_cast(text AS INTEGER) BETWEEN 1 AND 3 AND c1 = 'block_' AND c2 IN ('block_2', 'block_10')),
intros AS (SELECT f.book_id, min(struct_pack(ord := f.ord, text := f.text, o1 := o1, t1 := t1)) AS r FROM followed f JOIN (SELECT book_id, min(marker_ord) AS first FROM markers GROUP BY book_id) m ON f.book_id = m.book_id AND f.ord < m.first
  WHERE cls = 'block_' AND lower(text) = 'giới thiệu' AND c1 = 'block_2' GROUP BY f.book_id),
secs AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY first_ord, section_id) - 1 AS section_ord FROM (
  SELECT book_id, 'introduction' AS section_id, 'introduction' AS type, CAST(NULL AS INTEGER) AS number, r.text AS title, r.t1 AS subtitle, 0 AS first_ord, r.o1 AS content_ord FROM intros
  UNION ALL SELECT book_id, printf('chapter_%02d', number), 'chapter', number, title, subtitle, marker_ord, subtitle_ord FROM markers)),
assigned AS (SELECT * FROM recs ASOF JOIN (SELECT book_id AS b, first_ord, section_id, section_ord, content_ord FROM secs) s ON recs.book_id = s.b AND recs.ord >= s.first_ord),
numbered AS (SELECT *, ord > content_ord AND text <> '' AS para, count(*) FILTER (ord > content_ord AND text <> '') OVER (PARTITION BY book_id, section_id ORDER BY ord) AS n FROM assigned),
blocks AS (SELECT *, row_number() OVER (PARTITION BY book_id, section_id ORDER BY ord, pos) AS block_ord FROM (
  SELECT book_id, section_id, section_ord, ord, 0 AS pos, 'image' AS type, CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS display_text, src, alt, trim(alt) IN ('', 'Image') OR regexp_matches(trim(alt), '(?i)^[^\\s/]+\\.(gif|jpe?g|png|webp)$') AS needs_alt_review FROM numbered WHERE src IS NOT NULL
  UNION ALL SELECT book_id, section_id, section_ord, ord, 1, 'paragraph', section_id || printf('_p%04d', n), text, NULL, NULL, NULL FROM numbered WHERE para)),
units AS (SELECT *, row_number() OVER (PARTITION BY book_id, section_id ORDER BY rank, block_ord) - 1 AS ord FROM (
  SELECT book_id, section_id, section_ord, 0 AS rank, 0 AS block_ord, section_id || '_title' AS id, 'heading' AS type, title AS display_text FROM secs WHERE trim(title) <> ''
  UNION ALL SELECT book_id, section_id, section_ord, 1, 0, section_id || '_subtitle', 'subtitle', subtitle FROM secs WHERE trim(subtitle) <> ''
  UNION ALL SELECT book_id, section_id, section_ord, 2, block_ord, id, type, display_text FROM blocks WHERE type = 'paragraph'))
"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, records): each book's records in its row, as a document has its words."""
    book = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    return rows.select(book.alias("book_id"), F.transform(F.split("text", " ", -1), lambda w, i: _record(book, w, i)).alias("records"))


def _record(book: Column, w: Column, i: Column) -> Column:
    j = i - 3
    intro = (i == 0) & (book % 4 != 3)
    said = F.when(intro, "Giới thiệu").when((i >= 3) & (j % 7 == 0), F.floor(j / 7 + 1).cast("string")).otherwise(w)
    kind = F.when(i == 0, F.when(intro, "block_").otherwise("block_3")).when(i == 1, "block_2").when(i == 2, "block_3")
    kind = kind.when((j % 7).isin(0, 1) & ~((book % 5 == 0) & (i == 10)), "block_").when(j % 7 == 2, "block_10").otherwise("block_3")
    image = F.struct(F.concat(F.lit("img/"), w, F.lit(".png")).alias("src"), F.when(i % 2 == 0, " Image ").otherwise(F.concat(F.lit("x"), w)).alias("alt"))
    images = F.when(i % 11 == 5, F.array(image)).otherwise(F.array().cast("array<struct<src:string,alt:string>>"))
    return F.struct(i.cast("long").alias("ord"), F.array(kind).alias("classes"), said.alias("text"), images.alias("images"))


def _outlined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.outlined(records(spark, sf_dir), CHAPTERS)


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.structured(_outlined(spark, sf_dir))


@query(f"WITH {RECS} SELECT * FROM markers")
def chapter_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.chapter_markers(_outlined(spark, sf_dir))


@query(
    f"""WITH {RECS}, lists AS (SELECT book_id, list(number ORDER BY marker_ord) AS numbers FROM markers GROUP BY book_id),
    every AS (SELECT d.doc_id AS book_id, coalesce(numbers, []) AS numbers FROM documents d LEFT JOIN lists ON lists.book_id = d.doc_id WHERE d.text IS NOT NULL)
    SELECT CASE WHEN len(numbers) <> 3 THEN 'chapter count' ELSE 'chapter order' END AS rule, CAST(book_id AS VARCHAR) AS key, array_to_string(numbers, ',') AS detail FROM every WHERE numbers <> [1, 2, 3]
    UNION ALL SELECT 'introduction', CAST(doc_id AS VARCHAR), NULL FROM documents WHERE text IS NOT NULL AND doc_id NOT IN (SELECT book_id FROM intros)"""
)
def book_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.outline_violations(_outlined(spark, sf_dir), CHAPTERS)


@query(f"WITH {RECS} SELECT book_id, r.ord AS title_ord, r.o1 AS subtitle_ord, r.text AS title, r.t1 AS subtitle FROM intros")
def introductions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.introductions(_outlined(spark, sf_dir))


@query(f"WITH {RECS} SELECT book_id, section_id, type, number, title, subtitle, first_ord, content_ord, section_ord FROM secs")
def book_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.sections(_outlined(spark, sf_dir))


BLOCKS = "SELECT book_id, section_id, section_ord, block_ord, type, id, display_text, src, alt, needs_alt_review FROM blocks"


@query(f"WITH {RECS} {BLOCKS}")
def book_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.flattened(_books(spark, sf_dir))[1].select("book_id", "section_id", "section_ord", "block_ord", "type", "id", "display_text", "src", "alt", "needs_alt_review")


@query(f"WITH {RECS} {BLOCKS}")
def nested_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks put into nested books and taken out again."""
    out = structure.flattened(_books(spark, sf_dir))[1]
    return out.select("book_id", "section_id", "section_ord", "block_ord", "type", "id", "display_text", "src", "alt", "needs_alt_review")


@query(f"WITH {RECS} SELECT book_id, section_id, section_ord, ord, id, type, display_text FROM units")
def book_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.units(_books(spark, sf_dir)).select("book_id", "section_id", "section_ord", "ord", "id", "type", "display_text")


@query(
    f"""WITH {RECS}, moved AS (SELECT *, CASE WHEN book_id % 3 = 0 AND ord = 4 THEN section_id || '_title' WHEN book_id % 7 = 2 AND ord = 5 THEN ' ' ELSE id END AS uid FROM units)
    SELECT 'duplicate unit id' AS rule, book_id || '/' || uid AS key, CAST(count(*) AS VARCHAR) AS detail FROM moved GROUP BY book_id, uid HAVING count(*) > 1
    UNION ALL SELECT 'paragraph without id', section_id, NULL FROM moved WHERE type = 'paragraph' AND trim(uid) = ''
    UNION ALL SELECT 'paragraph without text', uid, NULL FROM moved WHERE type = 'paragraph' AND trim(regexp_replace(replace(display_text, chr(160), ' '), '\\s+', ' ', 'g')) = ''"""
)
def unit_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of books, some with another's id or none."""
    book = F.col("book_id")
    moved = lambda s, u, i: F.when((book % 3 == 0) & (i == 4), F.concat(s["id"], F.lit("_title"))).when((book % 7 == 2) & (i == 5), " ").otherwise(u["id"])
    books = structure.with_units(_books(spark, sf_dir))
    books = books.withColumn("sections", F.transform("sections", lambda s: s.withField("units", F.transform(s["units"], lambda u, i: u.withField("id", moved(s, u, i))))))
    books = books.withColumn("sections", F.transform("sections", lambda s: s.withField("blocks", s["units"])))
    return structure.unit_violations(books, structure.units(_books(spark, sf_dir)).withColumn("tts_text", F.lit("x")))


@query(
    f"""WITH {RECS}, s AS (SELECT secs.book_id, secs.section_id, '{{"id":"' || secs.section_id || '","type":"' || type || '"' || coalesce(',"number":' || number, '') || ',"units":' || (SELECT count(*) FROM units u WHERE u.book_id = secs.book_id AND u.section_id = secs.section_id) || '}}' AS j, section_ord FROM secs)
    SELECT book_id, '[' || string_agg(j, ',' ORDER BY section_ord) || ']' AS sections FROM s GROUP BY book_id"""
)
def sparse_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests as JSON: a key that has no value is left out. Units are counted only."""
    out = manifest(structure.with_units(_books(spark, sf_dir)).withColumn("metadata", F.struct(F.lit("t").alias("title"))))
    short = F.transform("sections", lambda s: F.struct(s["id"].alias("id"), s["type"].alias("type"), s["number"].alias("number"), F.size(s["units"]).alias("units")))
    return out.select("book_id", F.to_json(short).alias("sections"))


@query(
    f"""WITH {RECS} SELECT s.book_id, s.chapters, s.introduction, coalesce(b.paragraphs, 0) AS paragraphs, coalesce(b.images, 0) AS images, coalesce(b.alt_reviews, 0) AS alt_reviews
    FROM (SELECT book_id, count(*) FILTER (type = 'chapter') AS chapters, bool_or(type = 'introduction') AS introduction FROM secs GROUP BY book_id) s
    LEFT JOIN (SELECT book_id, count(*) FILTER (type = 'paragraph') AS paragraphs, count(*) FILTER (type = 'image') AS images, count(*) FILTER (needs_alt_review) AS alt_reviews FROM blocks GROUP BY book_id) b ON b.book_id = s.book_id"""
)
def book_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.summary(_books(spark, sf_dir))


TURNS = "t AS (SELECT conv_id, turn, role, text, CAST(conv_id AS VARCHAR) AS section_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ord FROM conversations)"


def turn_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as sections, turns as units."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        F.col("conv_id").cast("string").alias("section_id"), F.col("conv_id").alias("section_ord"), F.col("turn").alias("ord"), F.concat_ws("_", "conv_id", "turn").alias("id"),
        F.when(F.col("role") == "system", "heading").when(F.col("role") == "user", "subtitle").otherwise("paragraph").alias("type"), F.col("text").alias("display_text"), F.col("text").alias("tts_text"), "role",
    )


@query(
    """SELECT section_id, CAST(row_number() OVER (PARTITION BY section_id ORDER BY rank, o) - 1 AS BIGINT) AS ord, id, type, display_text FROM (
      SELECT CAST(conv_id AS VARCHAR) AS section_id, 0 AS rank, 0 AS o, conv_id || '_title' AS id, 'heading' AS type, role AS display_text FROM conversations WHERE turn = 0
      UNION ALL SELECT CAST(conv_id AS VARCHAR), 1, 0, conv_id || '_subtitle', 'subtitle', text FROM conversations WHERE turn = 0 AND conv_id % 2 = 0
      UNION ALL SELECT CAST(conv_id AS VARCHAR), 2, turn, conv_id || '_' || turn, 'paragraph', text FROM conversations WHERE role <> 'system')"""
)
def expected_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_units(spark, sf_dir)
    found = turns.filter("ord = 0").select("section_id", F.col("role").alias("title"), F.when(F.col("section_ord") % 2 == 0, F.col("display_text")).alias("subtitle"))
    block_rows = turns.select("section_id", F.col("ord").alias("block_ord"), "id", F.when(F.col("role") == "system", "image").otherwise("paragraph").alias("type"), "display_text")
    return checks.expected_units(found, block_rows).withColumn("ord", F.col("ord").cast("long"))


@query(
    """SELECT 'blank title' AS rule, CAST(conv_id AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS detail FROM conversations WHERE turn = 0 AND conv_id % 5 = 1
    UNION ALL SELECT 'blank subtitle', CAST(conv_id AS VARCHAR), NULL FROM conversations WHERE turn = 0 AND conv_id % 6 = 1
    UNION ALL SELECT 'unknown block type', CAST(conv_id AS VARCHAR), role FROM conversations WHERE role <> 'user' AND conv_id % 4 = 3
    UNION ALL SELECT 'paragraph without id', CAST(conv_id AS VARCHAR), NULL FROM conversations WHERE (role = 'user' OR conv_id % 4 <> 3) AND turn % 9 = 3
    UNION ALL SELECT 'paragraph without text', CASE WHEN turn % 9 = 3 THEN NULL ELSE conv_id || '_' || turn END, NULL FROM conversations WHERE (role = 'user' OR conv_id % 4 <> 3) AND turn % 7 = 2"""
)
def source_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections and blocks of conversations, some broken."""
    turns, c = turn_units(spark, sf_dir), F.col("section_ord")
    found = turns.filter("ord = 0").select("section_id", F.when(c % 5 == 1, " ").otherwise(F.col("role")).alias("title"), F.when(c % 6 == 1, "").alias("subtitle"))
    kind = F.when((c % 4 == 3) & (F.col("role") != "user"), F.col("role")).otherwise("paragraph")
    block_rows = turns.select("section_id", kind.alias("type"), F.when(F.col("ord") % 9 != 3, F.col("id")).alias("id"), F.when(F.col("ord") % 7 == 2, " ").otherwise(F.col("display_text")).alias("display_text"))
    return checks.source_violations(found, block_rows)


@query(
    """WITH u AS (SELECT *, CASE WHEN conv_id % 6 = 4 THEN '../' || conv_id ELSE CAST(conv_id AS VARCHAR) END AS s, CASE WHEN turn % 8 = 5 THEN conv_id || '/x' WHEN turn = 3 AND conv_id % 2 = 0 THEN conv_id || '_1' ELSE conv_id || '_' || turn END AS id FROM conversations)
    SELECT 'unsafe section id' AS rule, s AS key, CAST(NULL AS VARCHAR) AS detail FROM (SELECT DISTINCT s FROM u) WHERE s LIKE '%/%'
    UNION ALL SELECT 'section without units', 'none', NULL
    UNION ALL SELECT 'unsafe unit id', id, NULL FROM u WHERE id LIKE '%/%'
    UNION ALL SELECT 'unknown unit type', id, 'tool' FROM u WHERE turn % 5 = 4
    UNION ALL SELECT 'unit without speech text', id, NULL FROM u WHERE turn % 6 = 5
    UNION ALL SELECT 'duplicate unit id', s || '/' || id, CAST(count(*) AS VARCHAR) FROM u GROUP BY s, id HAVING count(*) > 1"""
)
def section_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of conversations, some broken, and a section without any."""
    turns, c, o = turn_units(spark, sf_dir), F.col("section_ord"), F.col("ord")
    rows = turns.select(
        F.when(c % 6 == 4, F.concat(F.lit("../"), "section_id")).otherwise(F.col("section_id")).alias("section_id"),
        F.when(o % 8 == 5, F.concat("section_id", F.lit("/x"))).when((o == 3) & (c % 2 == 0), F.concat("section_id", F.lit("_1"))).otherwise(F.col("id")).alias("id"),
        F.when(o % 5 == 4, "tool").otherwise(F.col("type")).alias("type"), F.when(o % 6 == 5, " \t ").otherwise("x").alias("tts_text"),
    )
    found = rows.select("section_id").distinct().union(spark.sql("SELECT 'none' AS section_id"))
    return checks.section_violations(rows, found)


@query("SELECT conv_id AS section_ord, turn AS ord, text AS display_text FROM conversations WHERE conv_id = (SELECT max(conv_id) FROM conversations)")
def selected_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units of the last conversation, selected as a section."""
    turns = turn_units(spark, sf_dir)
    last = str(turns.agg(F.max("section_ord")).first()[0])
    one = checks.selected(turns.select("section_id").distinct(), last)
    return turns.join(one, "section_id", "left_semi").select("section_ord", "ord", "display_text")


@query(
    """WITH a AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ord FROM documents),
    m AS (SELECT source, doc_id, ord, CASE WHEN doc_id % 13 = 6 THEN 'heading' ELSE 'paragraph' END AS type FROM a), t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS o FROM m WHERE doc_id % 5 <> 2),
    e AS (SELECT a.source, a.ord, a.doc_id AS ad, m.type AS mt FROM a JOIN m ON a.source = m.source AND a.ord = m.ord)
    SELECT 'manifest type' AS rule, source || '/' || ord AS key, CAST(ad AS VARCHAR) AS detail FROM e WHERE mt <> 'paragraph'
    UNION ALL SELECT 'timing unit count', e.source || '/' || e.ord, CAST(ad AS VARCHAR) FROM e LEFT JOIN t ON t.source = e.source AND t.o = e.ord WHERE t.source IS NULL
    UNION ALL SELECT 'timing id', e.source || '/' || e.ord, CAST(ad AS VARCHAR) FROM e JOIN t ON t.source = e.source AND t.o = e.ord WHERE t.doc_id <> ad
    UNION ALL SELECT 'timing type', e.source || '/' || e.ord, CAST(ad AS VARCHAR) FROM e JOIN t ON t.source = e.source AND t.o = e.ord WHERE t.doc_id = ad AND mt <> 'paragraph'"""
)
def timing_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source against a manifest with other types and a timing that lacks some."""
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("section_id").orderBy("n")) - 1
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("section_id"), F.col("doc_id").alias("n"), F.col("doc_id").cast("string").alias("id"), F.lit("paragraph").alias("type"), F.lit("x").alias("display_text")).withColumn("ord", order)
    units = docs.withColumn("type", F.when(F.col("n") % 13 == 6, "heading").otherwise("paragraph"))
    timing = docs.drop("display_text").filter("n % 5 != 2").withColumn("ord", order)
    return checks.reconciled(docs, units, timing)


# --- text rules -------------------------------------------------------------------------

NAMED = "n AS (SELECT p_partkey, p_name, upper(p_name) AS up, 'Chương ' || (p_partkey % 20 + 1) || '. ' || upper(p_name) || CASE WHEN p_partkey % 2 = 0 THEN '.' ELSE '' END AS head FROM part)"


def _headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.concat(F.lit("Chương "), (F.col("p_partkey") % 20 + 1).cast("string"), F.lit(". "), F.upper("p_name"), F.when(F.col("p_partkey") % 2 == 0, ".").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", F.upper("p_name").alias("up"), head.alias("head"))


def _sentence(c: str) -> str:
    return f"regexp_extract(lower({c}), '^[^a-z]*') || upper(substr(lower({c}), length(regexp_extract(lower({c}), '^[^a-z]*')) + 1, 1)) || substr(lower({c}), length(regexp_extract(lower({c}), '^[^a-z]*')) + 2)"


@query(
    f"""WITH {NAMED} SELECT p_partkey, {_sentence("up")} AS sentence, CASE WHEN regexp_matches(up, '[A-Z]') THEN 'Chương ' || (p_partkey % 20 + 1) || '. ' || {_sentence("up")} || CASE WHEN p_partkey % 2 = 0 THEN '.' ELSE '' END ELSE head END AS heading,
    CASE WHEN NOT regexp_matches(p_name, '[A-Za-z]') OR length(regexp_replace(p_name, '[^A-Z]', '', 'g')) * 10 < length(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) * 8 THEN p_name ELSE {_sentence("p_name")} END AS plain FROM n"""
)
def heading_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _headings(spark, sf_dir)
    return rows.select("p_partkey", text.sentence_case(F.col("up")).alias("sentence"), text.heading_case(F.col("head")).alias("heading"), text.heading_case(F.col("p_name")).alias("plain"))


@query(
    f"""WITH {NAMED} SELECT p_partkey, TRUE AS by_text, p_partkey % 3 = 0 AS by_style, replace(replace(replace(p_name, 'part', 'Teil'), 'a', 'o'), '0', 'a') AS replaced,
    CASE WHEN up = (SELECT min(up) FROM n) THEN 'eins' ELSE up END AS whole,
    'Chương ' || (p_partkey % 20 + 1) || '. ' || CASE WHEN up = (SELECT min(up) FROM n) THEN 'eins' ELSE up END || CASE WHEN p_partkey % 2 = 0 THEN '.' ELSE '' END AS inner_title FROM n"""
)
def heading_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter headings, literal replacements in order of length, and overrides of whole headings and of titles."""
    rows = _headings(spark, sf_dir)
    one = rows.agg(F.min("up")).first()[0]
    style = F.when(F.col("p_partkey") % 3 == 0, "Heading_1").otherwise("Normal")
    return rows.select(
        "p_partkey", text.is_chapter_heading(F.col("head")).alias("by_text"), text.is_chapter_heading(F.col("p_name"), style).alias("by_style"),
        text.replace_all(F.col("p_name"), {"part": "Teil", "a": "o", "0": "a"}).alias("replaced"),
        text.heading_override(F.col("up"), {one: "eins"}).alias("whole"), text.heading_override(F.col("head"), {one: "eins"}).alias("inner_title"),
    )


SPOKEN = r"regexp_replace(regexp_replace(regexp_replace(replace(nfc_normalize(text), chr(160), ' '), '[ \t]+', ' ', 'g'), '\s+([,.;:!?])', '\1', 'g'), '^\s+|\s+$', '', 'g')"


@query(
    f"""SELECT doc_id, '<speak version="1.0" xml:lang="vi-VN"><voice name="a &amp; b"><prosody rate="-5%">' || replace(replace(replace({SPOKEN}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</prosody></voice></speak>' AS ssml FROM documents"""
)
def ssml_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.lit("a & b").alias("voice"), F.lit("-5%").alias("rate"))
    return audio.markup(docs).select("doc_id", "ssml")


@query(
    r"""SELECT page_id, regexp_matches(u, '^[^/\\]+$') AND u NOT IN ('.', '..') AS safe, lower(alt) IN ('', 'image', 'undefined') OR regexp_matches(alt, '(?i)^[^\s/]+\.(gif|jpe?g|png|webp)$') AS review,
      CASE WHEN page_id % 4 = 3 THEN NULL WHEN page_id % 4 = 2 THEN 'img/' || page_id || ' a.png' ELSE 'OPS/' || CASE WHEN page_id % 4 = 0 THEN 'text/' ELSE '' END || 'img/' || page_id || ' a.png' END AS path
    FROM (SELECT page_id, regexp_extract(url, '[^/]*$') AS u, CASE page_id % 5 WHEN 0 THEN 'image' WHEN 1 THEN page_id || '.PNG' WHEN 2 THEN 'a cat' WHEN 3 THEN '' ELSE 'a b.png' END AS alt FROM pages)"""
)
def path_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safe ids, texts of images to review, and references inside an archive, some of which lead outside."""
    i = F.col("page_id")
    alt = F.when(i % 5 == 0, "image").when(i % 5 == 1, F.concat(i.cast("string"), F.lit(".PNG"))).when(i % 5 == 2, " a  cat ").when(i % 5 == 3, " ").otherwise("a b.png")
    href = F.concat(F.element_at(F.array(F.lit("./"), F.lit("../"), F.lit("../../"), F.lit("../../../")), (i % 4 + 1).cast("int")), F.lit("img/"), i.cast("string"), F.lit("%20a.png?q#f"))
    rows = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"[^/]*$", 0).alias("u"), alt.alias("alt"), href.alias("href"))
    return rows.select("page_id", text.is_safe_id(F.col("u")).alias("safe"), text.needs_alt_review(F.col("alt")).alias("review"), text.resolved_path(F.lit("OPS/text/a.html"), F.col("href"), query=True).alias("path"))


_DIGITS = " + ".join(f"CAST(substr(d, {k}, 1) AS INTEGER) * {3 if k % 2 else 1}" for k in range(1, 10))
ISBN = f"""i AS (SELECT doc_id, d, (10 - (9 + 7 * 3 + 8 + {_DIGITS}) % 10) % 10 AS c FROM (SELECT doc_id, printf('%09d', doc_id * 7919 % 1000000000) AS d FROM documents)),
  isbns AS (SELECT doc_id, '978' || d || (c + CASE WHEN doc_id % 4 = 1 THEN 1 ELSE 0 END) % 10 AS isbn FROM i)"""


def _isbns(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.lpad((F.col("doc_id") * 7919 % 1_000_000_000).cast("string"), 9, "0")
    total = F.lit(9 + 7 * 3 + 8)
    for k in range(1, 10):
        total = total + F.substring("d", k, 1).cast("int") * (3 if k % 2 else 1)
    rows = table(spark, sf_dir, "documents").select("doc_id", d.alias("d")).withColumn("c", (10 - total % 10) % 10 + F.when(F.col("doc_id") % 4 == 1, 1).otherwise(0))
    return rows.select("doc_id", F.concat(F.lit("978"), "d", (F.col("c") % 10).cast("string")).alias("isbn"))


@query(f"WITH {ISBN} SELECT doc_id, CASE WHEN doc_id % 4 <> 1 THEN isbn END AS isbn, CASE WHEN doc_id % 4 <> 1 THEN 'urn:isbn:' || isbn END AS urn, doc_id % 3 <> 2 AS dated FROM isbns")
def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISBNs in several spellings, every fourth with a wrong digit, and dates."""
    written = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("urn:isbn:"), "isbn")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("ISBN "), F.regexp_replace("isbn", "^(.{3})(.)(.{4})", "$1-$2-$3 "))).otherwise(F.col("isbn"))
    date = F.when(F.col("doc_id") % 3 == 2, "2021-1-05").otherwise("2021-01-05")
    rows = _isbns(spark, sf_dir).select("doc_id", written.alias("w"), date.alias("d"))
    return rows.select("doc_id", ids.isbn13(F.col("w")).alias("isbn"), ids.isbn_urn(F.col("w")).alias("urn"), text.is_iso_date_shape(F.col("d")).alias("dated"))


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(_isbns(spark, sf_dir), "doc_id")
    null = F.lit(None).cast("string")
    source = F.struct(null.alias("publisher"), F.when(i % 3 == 2, "2021").when(i % 3 == 0, "2021-01-05").alias("date"), "isbn")
    meta = F.struct(F.when(i % 7 == 3, " ").otherwise(F.col("source")).alias("title"), F.when(i % 5 != 4, F.col("lang")).alias("author"), F.lit("s").alias("subject"), F.col("lang").alias("language"), null.alias("translator"), F.lit("").alias("description"), source.alias("source"))
    return docs.select(i.cast("string").alias("book_id"), meta.alias("metadata"))


@query(
    f"""WITH {ISBN} SELECT 'required metadata' AS rule, CAST(doc_id AS VARCHAR) AS key, 'title' AS detail FROM documents WHERE doc_id % 7 = 3
    UNION ALL SELECT 'required metadata', CAST(doc_id AS VARCHAR), 'creator' FROM documents WHERE doc_id % 5 = 4
    UNION ALL SELECT 'source date', CAST(doc_id AS VARCHAR), '2021' FROM documents WHERE doc_id % 3 = 2
    UNION ALL SELECT 'source ISBN', CAST(doc_id AS VARCHAR), isbn FROM isbns WHERE doc_id % 4 = 1"""
)
def metadata_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.metadata_violations(_metadata(spark, sf_dir))


@query(
    "SELECT key, count(*) FILTER (present) AS present, count(*) AS books FROM (SELECT doc_id, unnest([struct_pack(key := 'title', present := doc_id % 7 <> 3), struct_pack(key := 'creator', present := doc_id % 5 <> 4), struct_pack(key := 'subject', present := TRUE), "
    "struct_pack(key := 'language', present := TRUE), struct_pack(key := 'translator', present := FALSE), struct_pack(key := 'publisher', present := FALSE), struct_pack(key := 'date', present := doc_id % 3 <> 1), struct_pack(key := 'isbn', present := TRUE), "
    "struct_pack(key := 'description', present := FALSE)], recursive := TRUE) FROM documents) GROUP BY key"
)
def metadata_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = checks.metadata_report(_metadata(spark, sf_dir))
    return report.groupBy("key").agg(F.count_if("present").alias("present"), F.count("*").alias("books"))


# --- numbers in words -------------------------------------------------------------------

_D = "['không', 'một', 'hai', 'ba', 'bốn', 'năm', 'sáu', 'bảy', 'tám', 'chín']"
WORDS = f"""low AS (SELECT n, CASE WHEN n < 10 THEN {_D}[n + 1] ELSE CASE WHEN n < 20 THEN 'mười' ELSE {_D}[n // 10 + 1] || ' mươi' END ||
    CASE WHEN n % 10 = 0 THEN '' WHEN n % 10 = 5 THEN ' lăm' WHEN n % 10 = 1 AND n >= 20 THEN ' mốt' ELSE ' ' || {_D}[n % 10 + 1] END END AS w FROM (SELECT unnest(range(100)) AS n)),
  w AS (SELECT h * 100 + low.n AS n, CASE WHEN h = 0 THEN low.w ELSE {_D}[h + 1] || ' trăm' || CASE WHEN low.n = 0 THEN '' WHEN low.n < 10 THEN ' lẻ ' || low.w ELSE ' ' || low.w END END AS w FROM low, (SELECT unnest(range(10)) AS h)),
  said AS (SELECT v, CASE WHEN v = 0 THEN 'không' ELSE concat_ws(' ', CASE WHEN v // 1000000 > 0 THEN a.w || ' triệu' END, CASE WHEN v // 1000 % 1000 > 0 THEN b.w || ' nghìn' END, CASE WHEN v % 1000 > 0 THEN c.w END) END AS s
    FROM (SELECT DISTINCT v FROM vals) JOIN w a ON a.n = v // 1000000 JOIN w b ON b.n = v // 1000 % 1000 JOIN w c ON c.n = v % 1000)"""


@query(
    f"""WITH vals AS (SELECT o_orderkey * 7919 % 1000000000 AS v FROM orders UNION ALL SELECT o_orderkey % 1000 FROM orders), {WORDS}
    SELECT o_orderkey, a.s AS whole, a.s AS grouped, b.s || ' phẩy ' || {_D}[o_orderkey % 10 + 1] || ' ' || {_D}[o_orderkey // 10 % 10 + 1] AS fraction, CASE WHEN o_orderkey % 2 = 0 THEN '1,000,' || o_orderkey ELSE '1.2.' || o_orderkey || ',5' END AS other
    FROM orders JOIN said a ON a.v = o_orderkey * 7919 % 1000000000 JOIN said b ON b.v = o_orderkey % 1000"""
)
def numbers_in_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers, integers in groups of three, decimals, and what is none of them."""
    key = F.col("o_orderkey")
    v = (key * 7919 % 1_000_000_000).cast("string")
    grouped = F.regexp_replace(v, r"(?<=[0-9])(?=(?:[0-9]{3})+$)", ".")
    fraction = F.concat((key % 1000).cast("string"), F.when(key % 2 == 0, ",").otherwise("."), (key % 10).cast("string"), (F.floor(key / 10) % 10).cast("string"))
    other = F.when(key % 2 == 0, F.concat(F.lit("1,000,"), key.cast("string"))).otherwise(F.concat(F.lit("1.2."), key.cast("string"), F.lit(",5")))
    return table(spark, sf_dir, "orders").select("o_orderkey", number_words(v).alias("whole"), number_words(grouped).alias("grouped"), number_words(fraction).alias("fraction"), number_words(other).alias("other"))


@query(
    f"""WITH vals AS (SELECT l_orderkey % 997 + 1 AS v FROM lineitem UNION ALL SELECT l_partkey % 100 + 1 FROM lineitem), {WORDS},
    x AS (SELECT l_orderkey, l_linenumber, a.s AS a, b.s AS b, (l_orderkey + l_linenumber) % 18 AS k, l_orderkey % 997 + 1 AS n, l_partkey % 100 + 1 AS m FROM lineitem JOIN said a ON a.v = l_orderkey % 997 + 1 JOIN said b ON b.v = l_partkey % 100 + 1)
    SELECT l_orderkey, l_linenumber, CASE k WHEN 0 THEN 'nặng ' || a || ' ki-lô-gam và ' || b || ' xen-ti-mét' WHEN 1 THEN 'một mét vuông đất' WHEN 2 THEN 'lấy một phần hai và ' || a || ' cái' WHEN 3 THEN 'gọi năm năm năm, không một hai ba ngay' WHEN 4 THEN 'quỹ bốn không một k'
      WHEN 5 THEN 'mở hai mươi bốn giờ một ngày, bảy ngày một tuần' WHEN 6 THEN 'ăn ba phần tư của ' || a WHEN 7 THEN 'trả ' || a || ' đô la mỗi tháng' WHEN 8 THEN 'tăng gấp ' || a || ' đến ' || b || ' lần' WHEN 9 THEN 'tăng gấp ' || a || ' lần' WHEN 10 THEN a || ' cộng ' || b
      WHEN 11 THEN a || ' nhân ' || b WHEN 12 THEN 'từ ' || a || ' đến ' || b || ' người' WHEN 13 THEN 'nóng từ ' || a || ' đến ' || b || ' độ C' WHEN 14 THEN 'nóng ' || a || ' độ C' WHEN 15 THEN 'giá ' || a || ' đô la' WHEN 16 THEN 'lãi ' || a || ' phần trăm và ' || b ELSE 'năm ' || n || '. R và D' END AS said FROM x"""
)
def speech_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sentence for each rule of speech, with numbers from the table."""
    a, b = (F.col("l_orderkey") % 997 + 1).cast("string"), (F.col("l_partkey") % 100 + 1).cast("string")
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 18
    say = ["nặng Akg và B cm", "1 m2 đất", "lấy ½ và A cái", "gọi 555-0123 ngay", "quỹ 401 (k)", "mở 24/7", "ăn 3/4 của A", "trả $A/tháng", "tăng Ax – Bx", "tăng Ax", "A + B", "A × B", "A–B người", "nóng A-B°C", "nóng A°C", "giá $A", "lãi A% và B", "năm A. R & D"]
    sentence = F.element_at(F.array(*[F.lit(s) for s in say]), (k + 1).cast("int"))
    sentence = F.replace(F.replace(F.replace(F.replace(sentence, F.lit("A"), F.lit("\x01")), F.lit("B"), F.lit("\x02")), F.lit("\x01"), a), F.lit("\x02"), b)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", sentence.alias("x"))
    return with_speech_text(rows, "x", "said").select("l_orderkey", "l_linenumber", "said")


# --- audio ------------------------------------------------------------------------------


@query("SELECT conv_id, turn, CASE WHEN turn % 5 = 3 THEN NULL ELSE greatest(1, length(text)) * 60 END AS duration_ms, CASE WHEN turn % 5 = 3 THEN 'ValueError: no voice' END AS error FROM conversations")
def speech_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A call for each turn, some of which fail, with a stand-in for the service."""
    voice = F.when(F.col("turn") % 5 == 3, "none").otherwise("v")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", voice.alias("voice"), F.lit("0%").alias("rate"))

    def call(said: str, voice: str, rate: str) -> bytes:
        if voice == "none":
            raise ValueError("no voice")
        return bytes(60 * max(1, len(said)))

    return audio.called(rows, call, len).select("conv_id", "turn", F.col("duration_ms").cast("long").alias("duration_ms"), "error")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 AND o_orderkey % 7 - 2 > 0 THEN o_orderkey % 7 - 2 END AS duration_ms FROM orders")
def valid_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", audio.valid_duration(key % 7 - 2, key % 3).alias("duration_ms"))


@query(
    """WITH c AS (SELECT conv_id, turn, length(text) * 10 AS d, CAST(coalesce(sum(length(text) * 10) OVER w, 0) + (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) * 350 AS BIGINT) AS b
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT CAST(conv_id AS VARCHAR) AS section_id, conv_id || '.mp3' AS audio, CAST(max(b + d) AS BIGINT) AS duration_ms, count(*) AS units, string_agg(conv_id || '_' || turn || ':' || b, ',' ORDER BY turn) AS clips FROM c GROUP BY conv_id"""
)
def timing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timeline.timeline(turn_units(spark, sf_dir).withColumn("duration_ms", F.length("tts_text").cast("long") * 10))
    out = timeline.timing_documents(rows)
    clips = F.array_join(F.transform("units", lambda u: F.concat(u["id"], F.lit(":"), u["clip_begin_ms"].cast("string"))), ",")
    return out.select("section_id", "audio", "duration_ms", F.size("units").cast("long").alias("units"), clips.alias("clips"))


# --- archives and packages ---------------------------------------------------------------


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of 25 archives: customers are manifest items and, but for some, text entries; orders are the spine."""
    c, o = F.col("c_custkey"), F.col("o_custkey")
    book = lambda k: F.concat(F.lit("book"), (k % 25).cast("string")).alias("book_id")
    kind = F.when(c % 4 == 0, "image/png").when(c % 4 == 1, "text/html").otherwise("application/xhtml+xml")
    items = table(spark, sf_dir, "customer").select(book(c), F.lit("item").alias("kind"), c.alias("ord"), F.concat(F.lit("c"), c.cast("string")).alias("id"), F.when(c % 11 != 5, F.concat(F.lit("h"), c.cast("string"))).alias("href"), kind.alias("media_type"), F.when((c % 11 == 5) & (c % 2 == 0), "leads outside").alias("error"))
    texts = table(spark, sf_dir, "customer").filter("c_custkey % 7 != 0").select(book(c), F.lit("entry").alias("kind"), F.concat(F.lit("h"), c.cast("string")).alias("href"), F.col("c_name").cast("binary").alias("content"))
    # orders of customers who aren't there have no item
    refs = table(spark, sf_dir, "orders").select(book(o), F.lit("itemref").alias("kind"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderkey") % 101 == 50, "none").otherwise(F.concat(F.lit("c"), o.cast("string"))).alias("id"))
    return items.unionByName(texts, allowMissingColumns=True).unionByName(refs, allowMissingColumns=True)


SPINE = "r AS (SELECT 'book' || (o_custkey % 25) AS book_id, o_orderkey, o_custkey, CASE WHEN o_orderkey % 101 = 50 THEN 'none' ELSE 'c' || o_custkey END AS id FROM orders), j AS (SELECT r.*, c.c_custkey AS c, c.c_name FROM r LEFT JOIN customer c ON r.id = 'c' || c.c_custkey)"


@query(
    f"""WITH {SPINE} SELECT book_id, o_orderkey AS spine_ord, id, 'h' || c AS href, CASE WHEN c % 4 = 1 THEN 'text/html' ELSE 'application/xhtml+xml' END AS media_type, c_name AS content FROM j WHERE c IS NOT NULL AND c % 4 <> 0 AND c % 11 <> 5 AND c % 7 <> 0"""
)
def spine_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epub.spine_documents(_entries(spark, sf_dir)).withColumn("content", F.col("content").cast("string"))


@query(
    f"""WITH {SPINE} SELECT 'spine item not in manifest' AS rule, book_id AS key, id AS detail FROM j WHERE c IS NULL
    UNION ALL SELECT 'manifest item without href', book_id, id FROM j WHERE c % 11 = 5 AND c % 2 = 1
    UNION ALL SELECT 'item leads outside the archive', book_id, 'leads outside' FROM j WHERE c % 11 = 5 AND c % 2 = 0 AND c % 4 <> 0
    UNION ALL SELECT 'spine document is missing', book_id, 'h' || c FROM j WHERE c % 11 <> 5 AND c % 4 <> 0 AND c % 7 = 0"""
)
def archive_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epub.epub_violations(_entries(spark, sf_dir))


def _metas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of a book for each supplier."""
    s, name = F.col("s_suppkey"), F.col("s_name")
    one = lambda i, tag, value, role="": F.struct(F.lit(i).alias("ord"), F.lit(tag).alias("id"), value.alias("name"), F.lit(role).alias("role"))
    rows = F.array(
        one(0, "title", F.concat(F.lit("  "), name, F.lit("\n"))), one(1, "creator", F.when(s % 3 == 0, F.concat(name, F.lit(" (dịch) "))).otherwise(name)), one(2, "creator", F.concat(F.lit("T"), s.cast("string")), "trl"), one(3, "creator", F.lit(" ")),
        one(4, "subject", F.lit("A")), one(5, "subject", F.when(s % 2 == 0, "B")), one(6, "language", F.lit("vi")), one(7, "identifier", F.lit("x-1")), one(8, "identifier", F.lit("978-1-2345-6789-7")), one(9, "date", F.lit("2020")),
    )
    rows = table(spark, sf_dir, "supplier").select(s.cast("string").alias("book_id"), F.explode(rows).alias("m"))
    return rows.select("book_id", F.lit("meta").alias("kind"), F.col("m.ord").cast("long").alias("ord"), "m.id", "m.role", "m.name")


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS book_id, s_name AS title, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS author, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE 'T' || s_suppkey END AS translator,
      'fr' AS language, CASE WHEN s_suppkey % 2 = 0 THEN 'A; B' ELSE 'A' END AS subject, 'House' AS publisher, '2020' AS date, '978-1-2345-6789-7' AS isbn, 'quire' AS generator FROM supplier"""
)
def book_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Package metadata under overrides: blank ones don't count, roles and marks tell translators."""
    overrides = {"title": " ", "language": "fr", "source": {"publisher": " House "}, "production": {"generator": "quire"}}
    m = epub.book_metadata(epub.package_metadata(_metas(spark, sf_dir)), overrides)
    return m.select("book_id", *[F.col(f"metadata.{c}").alias(c) for c in ("title", "author", "translator", "language", "subject")], *[F.col(f"metadata.source.{c}").alias(c) for c in ("publisher", "date", "isbn")], F.col("metadata.production.generator").alias("generator"))


_BOOKS = ", ".join(
    (
        "struct(title AS title, author AS author, CAST(NULL AS string) AS translator, 'vi' AS language, 's' AS subject, CAST(NULL AS string) AS description, "
        "struct('P' AS publisher, CAST(NULL AS string) AS date, '9781234567897' AS isbn, CAST(NULL AS string) AS edition) AS source, struct(CAST(NULL AS string) AS producer, 'quire' AS generator) AS production) AS metadata",
        "concat('urn:x:', book_id) AS uid",
    )
)


def _known(turns: DataFrame) -> DataFrame:
    """(book_id, uid, metadata): a book for each conversation."""
    return turns.select("book_id").distinct().selectExpr("book_id", "concat('T & ', book_id) AS title", "'A' AS author").selectExpr("book_id", *_split(_BOOKS))


def _split(columns: str) -> list[str]:
    head, _, tail = columns.rpartition(", concat(")
    return [head, f"concat({tail}"]


META = "'<meta name=\"dtb:uid\" content=\"urn:x:' || conv_id || '\"/>'"


@query(
    f"""WITH u AS (SELECT conv_id, turn, conv_id || '_' || turn AS id, role, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS t FROM conversations),
    x AS (SELECT conv_id, string_agg(CASE role WHEN 'system' THEN '<h1 id="' || id || '" smilref="s' || conv_id || '.smil#par_' || id || '">' || t || '</h1>' WHEN 'user' THEN '<p id="' || id || '" smilref="s' || conv_id || '.smil#par_' || id || '" class="subtitle">' || t || '</p>'
      ELSE '<p id="' || id || '" smilref="s' || conv_id || '.smil#par_' || id || '">' || t || '</p>' END, chr(10) ORDER BY turn) AS units FROM u GROUP BY conv_id)
    SELECT conv_id AS book_id, 'book.xml' AS path, sha256('{render.DECLARATION}{render.DOCTYPES["dtbook"]}' || '<dtbook xmlns="{render.NAMESPACES["dtbook"]}" version="2005-3" xml:lang="vi"><head>' || {META} || '<meta name="dc:Title" content="T &amp; ' || conv_id || '"/><meta name="dc:Creator" content="A"/><meta name="dc:Language" content="vi"/><meta name="dc:Subject" content="s"/><meta name="dc:Source" content="urn:isbn:9781234567897"/><meta name="dtb:generator" content="quire"/></head><book><bodymatter>' || chr(10)
      || '<level1 id="s' || conv_id || '">' || chr(10) || units || chr(10) || '</level1>' || chr(10) || '</bodymatter></book></dtbook>' || chr(10)) AS sha256 FROM x"""
)
def render_dtbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_units(spark, sf_dir).withColumn("book_id", F.col("section_ord")).withColumn("section_id", F.concat(F.lit("s"), "section_id"))
    return render.dtbook(turns, _known(turns)).select("book_id", "path", F.sha2(F.col("content").cast("binary"), 256).alias("sha256"))


@query(
    f"""WITH p AS (SELECT conv_id, string_agg('<navPoint id="nav_s' || turn || '" playOrder="' || n || '"><navLabel><text>' || CASE WHEN turn % 2 = 0 THEN 'Chương ' || turn || '. ' || role ELSE role END || '</text></navLabel><content src="s' || turn || '.smil#par_s' || turn || '_title"/></navPoint>', chr(10) ORDER BY n) AS points
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) GROUP BY conv_id)
    SELECT conv_id AS book_id, '{render.DECLARATION}{render.DOCTYPES["ncx"]}' || '<ncx xmlns="{render.NAMESPACES["ncx"]}" version="2005-1" xml:lang="vi"><head>' || {META} || '<meta name="dtb:depth" content="1"/><meta name="dtb:totalPageCount" content="0"/><meta name="dtb:maxPageNumber" content="0"/><meta name="dtb:generator" content="quire"/></head><docTitle><text>T &amp; ' || conv_id
      || '</text></docTitle><docAuthor><text>A</text></docAuthor><navMap>' || chr(10) || points || chr(10) || '</navMap></ncx>' || chr(10) AS content FROM p"""
)
def render_ncx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as sections of a book for each conversation."""
    turns = table(spark, sf_dir, "conversations").withColumn("book_id", F.col("conv_id"))
    found = turns.select("book_id", F.col("turn").alias("section_ord"), F.concat(F.lit("s"), F.col("turn").cast("string")).alias("section_id"), F.when(F.col("turn") % 2 == 0, "chapter").otherwise("introduction").alias("type"), F.col("turn").alias("number"), F.col("role").alias("title"))
    return render.ncx(found, _known(turns)).select("book_id", "content")


@query(
    f"""WITH p AS (SELECT conv_id, sum(length(text) * 10) AS ms, string_agg('<item id="smil_s' || turn || '" href="s' || turn || '.smil" media-type="application/smil"/><item id="audio_s' || turn || '" href="s' || turn || '.mp3" media-type="audio/mpeg"/>', chr(10) ORDER BY turn) AS items,
      string_agg('<itemref idref="smil_s' || turn || '"/>', chr(10) ORDER BY turn) AS refs FROM conversations GROUP BY conv_id)
    SELECT conv_id AS book_id, '{render.DECLARATION}{render.DOCTYPES["opf"]}' || '<package xmlns="{render.NAMESPACES["opf"]}" unique-identifier="uid"><metadata><dc-metadata xmlns:dc="{render.NAMESPACES["dc"]}" xmlns:oebpackage="{render.NAMESPACES["opf"]}"><dc:Title>T &amp; ' || conv_id
      || '</dc:Title><dc:Creator>A</dc:Creator><dc:Language>vi</dc:Language><dc:Subject>s</dc:Subject><dc:Source>urn:isbn:9781234567897</dc:Source><dc:Identifier id="uid">urn:x:' || conv_id || '</dc:Identifier><dc:Format>ANSI/NISO Z39.86-2005</dc:Format></dc-metadata><x-metadata>' || {META}
      || '<meta name="dtb:multimediaType" content="audioFullText"/><meta name="dtb:multimediaContent" content="audio,text"/><meta name="dtb:audioFormat" content="MP3"/><meta name="dtb:totalTime" content="' || printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000)
      || '"/><meta name="dtb:sourcePublisher" content="P"/><meta name="dtb:generator" content="quire"/></x-metadata></metadata><manifest><item id="opf" href="book.opf" media-type="text/xml"/><item id="dtbook" href="book.xml" media-type="application/x-dtbook+xml"/><item id="ncx" href="book.ncx" media-type="application/x-dtbncx+xml"/>' || chr(10)
      || items || '</manifest><spine>' || refs || '</spine></package>' || chr(10) AS content FROM p"""
)
def render_opf(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("book_id", F.col("conv_id"))
    rows = turns.select("book_id", F.col("turn").alias("section_ord"), F.concat(F.lit("s"), F.col("turn").cast("string")).alias("section_id"), (F.length("text").cast("long") * 10).alias("duration_ms"))
    return render.opf(rows, _known(turns)).select("book_id", "content")


def _package(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Files and elements of a package with orders as its units, many of them broken."""
    files = spark.sql(
        "SELECT * FROM VALUES ('book.opf', '.opf', NULL), ('book.xml', '.xml', NULL), ('other.xml', '.xml', 'not well-formed'), ('s1.smil', '.smil', NULL), ('s1.mp3', '.mp3', NULL) AS t(path, ext, error)"
    )
    e = lambda ord, parent, tag, attrs="map()", text="NULL", path="book.opf": f"('{path}', {ord}L, {parent}, '{tag}', CAST({attrs} AS map<string,string>), {text})"
    item = lambda i, href, kind: e(i, "4L", "item", f"map('id', 'i{i}', 'href', '{href}', 'media-type', '{kind}')")
    fixed = [
        e(0, "NULL", "package", "map('unique-identifier', 'uid')"), e(1, "0L", "metadata"), e(2, "1L", "dc-metadata"), e(3, "1L", "x-metadata"), e(4, "0L", "manifest"), e(5, "0L", "spine", "map('toc', 'nothing')"),
        e(6, "2L", "Format", text="'another format'"), e(7, "2L", "Identifier", "map('id', 'uid')", "' u1 '"), e(8, "3L", "meta", "map('name', 'dtb:uid', 'content', 'u1')"), e(9, "3L", "meta", "map('name', 'dtb:multimediaType', 'content', 'audioFullText')"),
        e(10, "3L", "meta", "map('name', 'dtb:multimediaContent', 'content', 'text, image')"), e(11, "3L", "meta", "map('name', 'dtb:audioFormat', 'content', 'wav')"), e(12, "3L", "meta", "map('name', 'dtb:totalTime', 'content', '0:00:01.000')"),
        item(13, "book.opf", "text/xml"), item(14, "book.xml", "text/xml"), item(15, "s1.smil", "application/smil"), item(16, "s1.mp3", "audio/mpeg"), item(17, "s2.mp3", "audio/mpeg"), e(18, "4L", "item", "map('id', '', 'href', 'x.css')"), e(19, "4L", "item", "map('id', 'i19')"),
        e(20, "5L", "itemref", "map('idref', 'i15')"), e(21, "5L", "itemref", "map('idref', 'gone')"), e(22, "5L", "itemref", "map('idref', 'i14')"), e(0, "NULL", "dtbook", path="book.xml"), e(1, "0L", "meta", "map('name', 'dtb:uid', 'content', 'u2')", path="book.xml"), e(0, "NULL", "smil", path="s1.smil"),
    ]
    kinds = "path, ord, parent, tag, attrs, text"
    known = spark.sql(f"SELECT * FROM VALUES {', '.join(fixed)} AS t({kinds})")
    key = F.col("o_orderkey")
    name = lambda c: F.concat(F.lit("o"), c.cast("string"))
    orders = table(spark, sf_dir, "orders").select(key)
    null = F.lit(None).cast("string")
    clock = lambda ms: ids.clock(ms)
    row = lambda path, ord, parent, tag, attrs: orders.select(F.lit(path).alias("path"), ord.alias("ord"), parent.alias("parent"), F.lit(tag).alias("tag"), attrs.alias("attrs"), null.alias("text"))
    zero = F.lit(0).cast("long")
    out = known.union(row("book.xml", key + 10, zero, "p", F.create_map(F.lit("id"), F.when(key % 10 != 3, name(key)).otherwise(F.lit("again")))))
    out = out.union(row("s1.smil", key * 10, zero, "par", F.create_map(F.lit("id"), F.concat(F.lit("par"), key.cast("string")))))
    out = out.union(row("s1.smil", key * 10 + 1, key * 10, "text", F.create_map(F.lit("src"), F.concat(F.when(key % 9 == 4, "../").otherwise(""), F.when(key % 8 == 7, "none.xml#").otherwise("book.xml#"), name(key)))))
    begin = F.when(key % 17 == 5, "npt=0s").when(key % 13 == 6, clock(key * 10 + 9)).otherwise(clock(key * 10))
    audio_ = F.create_map(F.lit("src"), F.when(key % 14 == 9, "s3.mp3").otherwise("s1.mp3"), F.lit("clipBegin"), begin, F.lit("clipEnd"), clock(key * 10 + 9))
    some = row("s1.smil", key * 10 + 2, key * 10, "audio", audio_)
    return files, out.union(some.filter("parent % 190 != 30"))


@query(
    """WITH o AS (SELECT o_orderkey AS k FROM orders), a AS (SELECT * FROM o WHERE k % 19 <> 3)
    SELECT 'required file' AS rule, 1 AS n UNION ALL SELECT 'invalid XML', 1 UNION ALL SELECT 'duplicate id', count(*) - 1 FROM o WHERE k % 10 = 3 UNION ALL SELECT 'reference leads outside', count(*) FROM o WHERE k % 9 = 4
    UNION ALL SELECT 'broken reference', (SELECT count(*) FROM o WHERE k % 9 <> 4 AND k % 8 = 7) + (SELECT count(*) FROM a WHERE k % 14 = 9) + 2 UNION ALL SELECT 'broken fragment', count(*) FROM o WHERE k % 9 <> 4 AND k % 8 <> 7 AND k % 10 = 3
    UNION ALL SELECT 'manifest item without id', 1 UNION ALL SELECT 'manifest item without href', 1 UNION ALL SELECT 'manifest lacks file', 1 UNION ALL SELECT 'manifest media type', 1 UNION ALL SELECT 'dc:Format', 1 UNION ALL SELECT 'multimedia content', 1 UNION ALL SELECT 'audio format', 1
    UNION ALL SELECT 'spine idref', 1 UNION ALL SELECT 'spine item is not SMIL', 1 UNION ALL SELECT 'spine toc', 1 UNION ALL SELECT 'manifest MP3 does not exist', 1 UNION ALL SELECT 'one uid in each file', 1 UNION ALL SELECT 'one uid in all files', 1
    UNION ALL SELECT 'invalid clip clock', count(*) FROM a WHERE k % 17 = 5 UNION ALL SELECT 'clip begin not before end', count(*) FROM a WHERE k % 17 <> 5 AND k % 13 = 6
    UNION ALL SELECT 'unit without audio', count(*) FROM o WHERE k % 19 = 3 UNION ALL SELECT 'audio is not a manifest MP3', count(*) FROM a WHERE k % 14 = 9 UNION ALL SELECT 'clip after total time', 1"""
)
def package_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each rule of a package is broken."""
    files, elements = _package(spark, sf_dir)
    return checks.package_violations(files, elements, ["s1"]).groupBy("rule").agg(F.count("*").alias("n"))


@query("SELECT 'more than one package file' AS rule, '.opf' AS key, '2' AS detail")
def package_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, _ = _package(spark, sf_dir)
    return checks.package_warnings(files.union(files.filter("ext = '.opf'").withColumn("path", F.lit("two.opf"))))


# --- audit --------------------------------------------------------------------------------


@query("SELECT lang AS section_id, count(*) AS units, CAST(sum(length(text)) AS BIGINT) AS characters, CAST(NULL AS BIGINT) AS requests FROM documents GROUP BY ROLLUP (lang)")
def dry_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.totals(table(spark, sf_dir, "documents").select(F.col("lang").alias("section_id"), F.col("text").alias("tts_text")))
