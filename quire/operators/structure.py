"""Books from ordered paragraph records: chapter markers, sections, blocks, and speech units.

Records are rows (book_id, ord, classes, text, images), or rows (book_id, records) that hold
those of a book in order. All that is found out about a book is worked out in its one row, as
arrays: only records that come as rows are shuffled, once. Books are spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import has_text, needs_alt_review, respaced
from quire.functions.speech import with_speech_text
from quire.schemas import BLOCK

HEADING_CLASS = "block_"
SUBTITLE_CLASSES = ("block_2", "block_10")
INTRODUCTION, INTRODUCTION_CLASS = "giới thiệu", "block_2"
CHAPTERS = 20


def next_text(records: DataFrame) -> DataFrame:
    """`records` with next_ord, the ord of the next row of the book that has text, or null."""
    after = Window.partitionBy("book_id").orderBy("ord").rowsBetween(1, Window.unboundedFollowing)
    return records.withColumn("next_ord", F.first(F.when(F.col("text") != "", F.col("ord")), ignorenulls=True).over(after))


def _each(rows: DataFrame, array: str, ord: str, name: str, *others: str | Column) -> DataFrame:
    """A row for each element of an array. Of an outer generator the planner makes no filter, which would work out the array twice."""
    return rows.select(*others, F.posexplode_outer(array).alias(ord, name)).filter(F.col(ord).isNotNull())


def by_book(records: DataFrame) -> DataFrame:
    """(book_id, records): a row for each book with its records in order. What has this form already stays as it is."""
    if "records" in records.columns:
        return records
    return records.groupBy("book_id").agg(F.sort_array(F.collect_list(F.struct("ord", "classes", "text", "images"))).alias("records"))


def outlined(records: DataFrame, chapters: int = CHAPTERS) -> DataFrame:
    """(book_id, records, markers, introduction, outline) of each book.

    A marker is a heading record that is a number from 1 to `chapters`, followed by a
    heading record and a record of a subtitle class; records without text don't count.
    The introduction is the first heading of this name before the first marker. The
    outline has the sections in order, with first_ord, where each begins, content_ord,
    the last record of its heading, and at, the place of its first record.
    """
    books = by_book(records).withColumn("said", F.filter("records", lambda r: r["text"] != ""))
    begins = lambda r: F.array_contains(r["classes"], HEADING_CLASS) & (r["text"].rlike(r"^[0-9]+\z") | (F.lower(r["text"]) == INTRODUCTION))
    places = F.filter(F.transform("said", lambda r, i: F.when(begins(r), i)), lambda i: i.isNotNull())
    books = books.withColumn("heads", F.transform(places, lambda i: F.struct(F.get("said", i).alias("head"), F.get("said", i + 1).alias("one"), F.get("said", i + 2).alias("two"))))
    # what comes before this generator stays there: the planner would else put it into filters again, once for each use
    books = books.select("book_id", "records", F.explode_outer(F.array("heads")).alias("heads"))
    row = lambda h, *first: F.struct(*first, h["one"]["ord"].alias("title_ord"), h["two"]["ord"].alias("subtitle_ord"), h["one"]["text"].alias("title"), h["two"]["text"].alias("subtitle"))
    follows = lambda h: F.array_contains(h["one"]["classes"], HEADING_CLASS) & F.arrays_overlap(h["two"]["classes"], F.array(*map(F.lit, SUBTITLE_CLASSES)))
    number = lambda h: h["head"]["text"].try_cast("int")
    numbered = F.filter("heads", lambda h: number(h).between(1, chapters) & follows(h))
    books = books.withColumn("markers", F.transform(numbered, lambda h: row(h, number(h).alias("number"), h["head"]["ord"].alias("marker_ord"))))
    intros = F.filter("heads", lambda h: (F.lower(h["head"]["text"]) == INTRODUCTION) & F.array_contains(h["one"]["classes"], INTRODUCTION_CLASS) & (h["head"]["ord"] < F.get("markers", F.lit(0))["marker_ord"]))
    intro = F.transform(intros, lambda h: F.struct(h["head"]["ord"].alias("title_ord"), h["one"]["ord"].alias("subtitle_ord"), h["head"]["text"].alias("title"), h["one"]["text"].alias("subtitle")))
    books = books.withColumn("introduction", F.get(intro, F.lit(0)))
    section = lambda first, id, kind, number, s: F.struct(
        first.cast("long").alias("first_ord"), id.alias("section_id"), F.lit(kind).alias("type"), number.alias("number"), s["title"].alias("title"), s["subtitle"].alias("subtitle"), s["subtitle_ord"].alias("content_ord")
    )
    opening = F.when(F.col("introduction").isNotNull(), F.array(section(F.lit(0), F.lit("introduction"), "introduction", F.lit(None).cast("int"), F.col("introduction"))))
    listed = F.transform("markers", lambda m: section(m["marker_ord"], F.format_string("chapter_%02d", m["number"]), "chapter", m["number"], m))
    books = books.withColumn("listed", F.sort_array(F.when(opening.isNotNull(), F.concat(opening, listed)).otherwise(listed)))
    ords = F.col("records.ord")
    at = lambda s: F.coalesce(F.nullif(F.array_position(ords, s["first_ord"]).cast("int"), F.lit(0)) - 1, F.size(F.filter(ords, lambda o: o < s["first_ord"])))
    return books.select("book_id", "records", "markers", "introduction", F.transform("listed", lambda s: s.withField("at", at(s))).alias("outline"))


def chapter_markers(books: DataFrame) -> DataFrame:
    """(book_id, number, marker_ord, title_ord, subtitle_ord, title, subtitle) of the numbered chapters of outlined books."""
    return _each(books, "markers", "n", "m", "book_id").select("book_id", "m.*")


def introductions(books: DataFrame) -> DataFrame:
    """(book_id, title_ord, subtitle_ord, title, subtitle) of the introductions of outlined books."""
    return books.filter("introduction IS NOT NULL").select("book_id", "introduction.*")


def sections(books: DataFrame) -> DataFrame:
    """One row for each section of outlined books."""
    s = _each(books, "outline", "section_ord", "s", "book_id")
    return s.select("book_id", "s.section_id", "s.type", "s.number", "s.title", "s.subtitle", "s.first_ord", "s.content_ord", "section_ord")


def outline_violations(books: DataFrame, chapters: int = CHAPTERS) -> DataFrame:
    """Outlined books, of all that have records, whose markers aren't the numbers from 1 to `chapters` in order, and those without an introduction."""
    numbers, none = F.col("markers.number"), F.lit(None).cast("string")
    row = lambda rule, detail: F.struct(rule.alias("rule"), detail.alias("detail"))
    wrong = F.when((F.size("records") > 0) & (numbers != F.sequence(F.lit(1), F.lit(chapters))), row(F.when(F.size(numbers) != chapters, "chapter count").otherwise("chapter order"), F.array_join(numbers.cast("array<string>"), ",")))
    without = F.when((F.size("records") > 0) & F.col("introduction").isNull(), row(F.lit("introduction"), none))
    found = _each(books.withColumn("found", F.array_compact(F.array(wrong, without))), "found", "n", "v", "book_id")
    return found.select("v.rule", F.col("book_id").cast("string").alias("key"), "v.detail")


def assign_sections(records: DataFrame, found: DataFrame) -> DataFrame:
    """`records` with the section that began last at or before each row; rows before the first are left out."""
    starts = found.select("book_id", F.col("first_ord").alias("ord"), F.struct("section_id", "section_ord", "content_ord").alias("s"), F.lit(0).alias("late"))
    rows = records.withColumn("s", F.lit(None).cast(starts.schema["s"].dataType)).withColumn("late", F.lit(1))
    both = rows.unionByName(starts, allowMissingColumns=True)
    w = Window.partitionBy("book_id").orderBy("ord", "late").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("s", F.last("s", ignorenulls=True).over(w)).filter("late = 1 AND s IS NOT NULL")
    return both.select(*records.columns, "s.section_id", "s.section_ord", "s.content_ord")


def structured(books: DataFrame) -> DataFrame:
    """(book_id, sections) of outlined books that have sections: blocks nested in sections, both in order.

    Records of a heading give image blocks only; a record's images come before its text.
    """
    null = F.lit(None).cast("string")
    block = lambda kind, id, text, src, alt, review: F.struct(F.lit(kind).alias("type"), id.alias("id"), text.alias("display_text"), src.alias("src"), alt.alias("alt"), review.alias("needs_alt_review"))
    placed = lambda ord, rank, pos, b: F.struct(ord.alias("ord"), F.lit(rank).alias("rank"), pos.alias("pos"), b.alias("b"))
    image = lambda i: block("image", null, null, i["src"], i["alt"], needs_alt_review(i["alt"]))
    paragraph = lambda s, r, i: block("paragraph", F.concat(s["section_id"], F.lit("_p"), _padded(i + 1)), r["text"], null, null, F.lit(None).cast("boolean"))

    def blocks(s: Column, k: Column) -> Column:
        end = F.coalesce(F.get("outline", k + 1)["at"], F.size("records"))
        own = F.slice("records", s["at"] + 1, end - s["at"])
        images = F.flatten(F.transform(F.filter(own, lambda r: F.size(r["images"]) > 0), lambda r: F.transform(r["images"], lambda i, j: placed(r["ord"], 0, j, image(i)))))
        texts = F.transform(F.filter(own, lambda r: (r["ord"] > s["content_ord"]) & (r["text"] != "")), lambda r, i: placed(r["ord"], 1, i, paragraph(s, r, i)))
        return F.sort_array(F.concat(images, texts))["b"].cast(f"array<{BLOCK}>")

    nested = F.transform("outline", lambda s, k: F.struct(s["section_id"].alias("id"), s["type"].alias("type"), s["number"].alias("number"), s["title"].alias("title"), s["subtitle"].alias("subtitle"), blocks(s, k).alias("blocks")))
    return books.filter(F.size("outline") > 0).select("book_id", nested.alias("sections"))


def _padded(n: Column) -> Column:
    """Four digits at least."""
    digits = n.cast("string")
    return F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), "0")


def flattened(books: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sections and blocks of nested books as rows."""
    s = _each(books, "sections", "section_ord", "s", "book_id")
    found = s.select("book_id", "section_ord", F.col("s.id").alias("section_id"), "s.type", "s.number", "s.title", "s.subtitle")
    b = _each(s, "s.blocks", "block_ord", "b", "book_id", "section_ord", F.col("s.id").alias("section_id"))
    return found, b.select("book_id", "section_id", "section_ord", (F.col("block_ord") + 1).alias("block_ord"), "b.*")


def with_units(books: DataFrame) -> DataFrame:
    """Nested books whose sections have units (id, type, display_text, spoken) as well: heading, subtitle and paragraphs in order.

    A blank title or subtitle gives no unit; blocks of other types than paragraph neither.
    A chapter's heading is spoken as "Chương number. title" with a full stop if it has no end mark.
    """
    unit = lambda id, kind, text, spoken=None: F.struct(id.alias("id"), F.lit(kind).alias("type"), text.alias("display_text"), (text if spoken is None else spoken).alias("spoken"))

    def of(s: Column) -> Column:
        numbered = F.concat(F.lit("Chương "), F.coalesce(s["number"].cast("string"), F.lit("None")), F.lit(". "), respaced(s["title"]))
        head = F.when(s["type"] == "chapter", F.when(numbered.rlike("[.!?…]$"), numbered).otherwise(F.concat(numbered, F.lit(".")))).otherwise(s["title"])
        title = F.when(has_text(s["title"]), unit(F.concat(s["id"], F.lit("_title")), "heading", s["title"], head))
        subtitle = F.when(has_text(s["subtitle"]), unit(F.concat(s["id"], F.lit("_subtitle")), "subtitle", s["subtitle"]))
        paragraphs = F.transform(F.filter(s["blocks"], lambda b: b["type"] == "paragraph"), lambda b: unit(b["id"], "paragraph", b["display_text"]))
        return F.concat(F.array_compact(F.array(title, subtitle)), paragraphs)

    return books.withColumn("sections", F.transform("sections", lambda s: s.withField("units", of(s))))


def nested_units(books: DataFrame, unit_rows: DataFrame) -> DataFrame:
    """Nested books whose sections have those of `unit_rows` as units (id, type, display_text, tts_text): the rows of a book meet once."""
    u = F.struct("section_id", "ord", F.struct("id", "type", "display_text", "tts_text").alias("u"))
    rows = books.join(unit_rows.groupBy("book_id").agg(F.sort_array(F.collect_list(u)).alias("said")), "book_id", "left")
    own = lambda s: F.filter("said", lambda x: x["section_id"] == s["id"])["u"]
    return rows.withColumn("sections", F.transform("sections", lambda s: s.withField("units", own(s)))).drop("said")


def units(books: DataFrame, pronunciation: Mapping[str, str] | None = None) -> DataFrame:
    """The units of nested books as rows, with display_text as it is and tts_text, in order `ord` within a section."""
    s = _each(with_units(books), "sections", "section_ord", "s", "book_id")
    rows = _each(s, "s.units", "ord", "u", "book_id", F.col("s.id").alias("section_id"), "section_ord").select("book_id", "section_id", "section_ord", "ord", "u.*")
    return with_speech_text(rows, "spoken", "tts_text", "type", pronunciation).drop("spoken")


def unit_violations(books: DataFrame, unit_rows: DataFrame) -> DataFrame:
    """Constraints on nested books with units, each book in its row, and on the speech texts of `unit_rows`, as rows (rule, key, detail)."""
    from quire.operators.checks import violation

    null, book = F.lit(None).cast("string"), F.col("book_id").cast("string")
    row = lambda rule, key, detail=null: F.struct(F.lit(rule).alias("rule"), key.alias("key"), detail.alias("detail"))

    def repeated(rule: str, ids: Column) -> Column:
        """A violation for each id that comes more than once in sorted `ids`; detail is how often."""
        again = F.filter(ids, lambda x, i: (i > 0) & x.eqNullSafe(F.get(ids, i - 1)))
        times = lambda x: F.size(F.filter(again, lambda y: y.eqNullSafe(x))) + 1
        return F.transform(F.array_distinct(again), lambda x: row(rule, F.concat_ws("/", book, x), times(x).cast("string")))

    def texts(s: Column) -> Column:
        paragraphs = F.filter(s["blocks"], lambda b: b["type"] == "paragraph")
        without_id = F.filter(paragraphs, lambda b: b["id"].isNull() | (F.trim(b["id"]) == ""))
        without_text = F.filter(paragraphs, lambda b: ~has_text(b["display_text"]))
        return F.concat(F.transform(without_id, lambda b: row("paragraph without id", s["id"])), F.transform(without_text, lambda b: row("paragraph without text", b["id"])))

    books = books.withColumn("section_ids", F.sort_array(F.transform("sections", lambda s: F.coalesce(s["id"], F.lit(""))))).withColumn("unit_ids", F.sort_array(F.flatten(F.transform("sections", lambda s: s["units"]["id"]))))
    without = F.transform(F.filter("section_ids", lambda x: F.trim(x) == ""), lambda x: row("section without id", book))
    # arrays that are looked up by place are columns, so that they aren't made again for each element
    found = F.concat(without, repeated("duplicate section id", F.col("section_ids")), repeated("duplicate unit id", F.col("unit_ids")), F.flatten(F.transform("sections", texts)))
    out = _each(books.withColumn("found", found), "found", "n", "v").select("v.*")
    return out.union(violation(unit_rows.filter("tts_text = ''"), "unit empty after pronunciation rules", "id"))


def summary(books: DataFrame, block_rows: DataFrame | None = None) -> DataFrame:
    """Counts for each book: chapters, whether there is an introduction, paragraphs, images, and images to review. Of nested books, or of sections and blocks as rows."""
    if block_rows is None:
        of = lambda test: F.size(F.filter("sections", lambda s: test(s["type"]))).cast("long")
        blocks = lambda test: F.aggregate("sections", F.lit(0).cast("long"), lambda n, s: n + F.size(F.filter(s["blocks"], test)))
        return books.select(
            "book_id", of(lambda t: t == "chapter").alias("chapters"), (of(lambda t: t == "introduction") > 0).alias("introduction"),
            blocks(lambda b: b["type"] == "paragraph").alias("paragraphs"), blocks(lambda b: b["type"] == "image").alias("images"), blocks(lambda b: b["needs_alt_review"]).alias("alt_reviews"),
        )
    s = books.groupBy("book_id").agg(F.count_if(F.col("type") == "chapter").alias("chapters"), F.bool_or(F.col("type") == "introduction").alias("introduction"))
    b = block_rows.groupBy("book_id").agg(F.count_if(F.col("type") == "paragraph").alias("paragraphs"), F.count_if(F.col("type") == "image").alias("images"), F.count_if(F.col("needs_alt_review")).alias("alt_reviews"))
    return s.join(b, "book_id", "left").na.fill(0, ["paragraphs", "images", "alt_reviews"])
