"""The XML documents of a talking book, put together as text in the engine and ordered by explicit keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.ids import clock, duration, isbn_urn, preferred
from quire.functions.text import xml_escape

# Fixed values of the standards: declarations, document types, namespaces and names of the formats.
DECLARATION = '<?xml version="1.0" encoding="utf-8"?>\n'
DOCTYPES = {
    "dtbook": '<!DOCTYPE dtbook PUBLIC "-//NISO//DTD dtbook 2005-3//EN" "http://www.daisy.org/z3986/2005/dtbook-2005-3.dtd">\n',
    "ncx": '<!DOCTYPE ncx PUBLIC "-//NISO//DTD ncx 2005-1//EN" "http://www.daisy.org/z3986/2005/ncx-2005-1.dtd">\n',
    "smil": '<!DOCTYPE smil PUBLIC "-//NISO//DTD dtbsmil 2005-2//EN" "http://www.daisy.org/z3986/2005/dtbsmil-2005-2.dtd">\n',
    "opf": '<!DOCTYPE package PUBLIC "+//ISBN 0-9673008-1-9//DTD OEB 1.2 Package//EN" "http://openebook.org/dtds/oeb-1.2/oebpkg12.dtd">\n',
}
NAMESPACES = {"dtbook": "http://www.daisy.org/z3986/2005/dtbook/", "ncx": "http://www.daisy.org/z3986/2005/ncx/", "smil": "http://www.w3.org/2001/SMIL20/", "opf": "http://openebook.org/namespaces/oeb-package/1.0/", "dc": "http://purl.org/dc/elements/1.1/"}
CORE = (("title", "Title"), ("author", "Creator"), ("translator", "Contributor"), ("language", "Language"), ("subject", "Subject"), ("description", "Description"))


def _a(c: Column | str) -> Column:
    """An attribute's value."""
    return F.lit(c) if isinstance(c, str) else xml_escape(F.coalesce(c, F.lit("")), quotes=True)


def tag(name: str, attrs: dict[str, Column | str], body: Column | None = None) -> Column:
    parts: list = [F.lit(f"<{name}")]
    for k, v in attrs.items():
        parts += [F.lit(f' {k}="'), _a(v), F.lit('"')]
    return F.concat(*parts, *([F.lit("/>")] if body is None else [F.lit(">"), body, F.lit(f"</{name}>")]))


def joined(order: str | list[str], xml: str, between: str = "\n") -> Column:
    """An aggregate that puts the rows of a group together in order."""
    keys = [order] if isinstance(order, str) else order
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*keys, xml))), lambda r: r[xml]), between)


def _meta(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), tag("meta", {"name": name, "content": value}))


def _field(m: str, *paths: str) -> Column:
    return preferred(*[F.col(f"{m}.{p}") for p in paths])


def _document(kind: str, root: Column) -> Column:
    return F.concat(F.lit(DECLARATION + DOCTYPES[kind]), root, F.lit("\n"))


def smil_pars(clips: DataFrame) -> DataFrame:
    """`clips` with xml, the par element of each timed unit (section_id, ord, id, clip_begin_ms, clip_end_ms)."""
    text = tag("text", {"src": F.concat(F.lit("book.xml#"), "id")})
    audio = tag("audio", {"src": F.concat("section_id", F.lit(".mp3")), "clipBegin": clock(F.col("clip_begin_ms")), "clipEnd": clock(F.col("clip_end_ms"))})
    return clips.withColumn("xml", tag("par", {"id": F.concat(F.lit("par_"), "id")}, F.concat(text, audio)))


def smil(clips: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, section_id, path, content): one file for each section. books: (book_id, uid, metadata)."""
    rows = smil_pars(clips).groupBy("book_id", "section_id").agg(joined("ord", "xml").alias("pars")).join(books, "book_id")
    head = F.concat_ws("", _meta("dtb:uid", F.col("uid")), _meta("dtb:totalElapsedTime", F.lit("00:00:00.000")))
    body = tag("body", {}, tag("seq", {"id": F.concat(F.lit("seq_"), "section_id")}, F.concat(F.lit("\n"), "pars", F.lit("\n"))))
    root = tag("smil", {"xmlns": NAMESPACES["smil"]}, F.concat(tag("head", {}, head), body))
    return rows.select("book_id", "section_id", F.concat("section_id", F.lit(".smil")).alias("path"), _document("smil", root).alias("content"))


def dtbook(unit_rows: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, path, content): the text of each book, a level for each section, an element for each unit."""
    attrs = {"id": F.col("id"), "smilref": F.concat("section_id", F.lit(".smil#par_"), "id")}
    text = xml_escape(F.col("display_text"))
    xml = F.when(F.col("type") == "heading", tag("h1", attrs, text)).when(F.col("type") == "subtitle", tag("p", attrs | {"class": "subtitle"}, text)).otherwise(tag("p", attrs, text))
    levels = unit_rows.withColumn("xml", xml).groupBy("book_id", "section_ord", "section_id").agg(joined("ord", "xml").alias("units"))
    levels = levels.withColumn("xml", tag("level1", {"id": F.col("section_id")}, F.concat(F.lit("\n"), "units", F.lit("\n"))))
    rows = levels.groupBy("book_id").agg(joined("section_ord", "xml").alias("levels")).join(books, "book_id")
    metas = [_meta("dtb:uid", F.col("uid")), *[_meta(f"dc:{n}", _field("metadata", k)) for k, n in CORE], _meta("dc:Source", isbn_urn(_field("metadata", "source.isbn"))), _meta("dtb:generator", _field("metadata", "production.generator"))]
    language = F.coalesce(_field("metadata", "language"), F.lit("vi"))
    book = tag("book", {}, tag("bodymatter", {}, F.concat(F.lit("\n"), "levels", F.lit("\n"))))
    root = tag("dtbook", {"xmlns": NAMESPACES["dtbook"], "version": "2005-3", "xml:lang": language}, F.concat(tag("head", {}, F.concat_ws("", *metas)), book))
    return rows.select("book_id", F.lit("book.xml").alias("path"), _document("dtbook", root).alias("content"))


def ncx(found: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, path, content): navigation with a point for each section, numbered from 1."""
    label = F.when((F.col("type") == "introduction") | F.col("number").isNull(), F.col("title")).otherwise(F.concat(F.lit("Chương "), F.col("number").cast("string"), F.lit(". "), "title"))
    order = F.row_number().over(Window.partitionBy("book_id").orderBy("section_ord"))
    rows = found.withColumn("play", order)
    to = tag("content", {"src": F.concat("section_id", F.lit(".smil#par_"), "section_id", F.lit("_title"))})
    point = tag("navPoint", {"id": F.concat(F.lit("nav_"), "section_id"), "playOrder": F.col("play").cast("string")}, F.concat(tag("navLabel", {}, tag("text", {}, xml_escape(label))), to))
    rows = rows.withColumn("xml", point).groupBy("book_id").agg(joined("play", "xml").alias("points")).join(books, "book_id")
    metas = [_meta("dtb:uid", F.col("uid")), *[_meta(n, F.lit(v)) for n, v in (("dtb:depth", "1"), ("dtb:totalPageCount", "0"), ("dtb:maxPageNumber", "0"))], _meta("dtb:generator", _field("metadata", "production.generator"))]
    head = tag("head", {}, F.concat_ws("", *metas))
    titles = F.concat(*[tag(n, {}, tag("text", {}, xml_escape(F.coalesce(F.col(f"metadata.{k}"), F.lit(""))))) for n, k in (("docTitle", "title"), ("docAuthor", "author"))])
    root = tag("ncx", {"xmlns": NAMESPACES["ncx"], "version": "2005-1", "xml:lang": F.coalesce(_field("metadata", "language"), F.lit("vi"))}, F.concat(head, titles, tag("navMap", {}, F.concat(F.lit("\n"), "points", F.lit("\n")))))
    return rows.select("book_id", F.lit("book.ncx").alias("path"), _document("ncx", root).alias("content"))


def opf(section_rows: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, path, content): the package file. section_rows: (book_id, section_ord, section_id, duration_ms)."""
    item = lambda i, h, t: tag("item", {"id": i, "href": h, "media-type": t})
    s = F.col("section_id")
    rows = section_rows.withColumn("items", F.concat(item(F.concat(F.lit("smil_"), s), F.concat(s, F.lit(".smil")), "application/smil"), item(F.concat(F.lit("audio_"), s), F.concat(s, F.lit(".mp3")), "audio/mpeg")))
    rows = rows.withColumn("refs", tag("itemref", {"idref": F.concat(F.lit("smil_"), s)}))
    rows = rows.groupBy("book_id").agg(joined("section_ord", "items").alias("items"), joined("section_ord", "refs").alias("refs"), F.sum("duration_ms").alias("total_ms")).join(books, "book_id")
    dc = lambda n, v, a=None: F.when(v.isNotNull(), tag(f"dc:{n}", a or {}, xml_escape(v)))
    core = [dc(n, _field("metadata", k)) for k, n in CORE]
    core += [dc("Source", isbn_urn(_field("metadata", "source.isbn"))), dc("Identifier", F.col("uid"), {"id": "uid"}), dc("Format", F.lit("ANSI/NISO Z39.86-2005"))]
    extra = [_meta(n, v) for n, v in (("dtb:uid", F.col("uid")), ("dtb:multimediaType", F.lit("audioFullText")), ("dtb:multimediaContent", F.lit("audio,text")), ("dtb:audioFormat", F.lit("MP3")), ("dtb:totalTime", duration(F.col("total_ms"))))]
    extra += [_meta(n, _field("metadata", p)) for n, p in (("dtb:sourcePublisher", "source.publisher"), ("dtb:sourceDate", "source.date"), ("dtb:sourceEdition", "source.edition"), ("dtb:producer", "production.producer"), ("dtb:generator", "production.generator"))]
    meta = tag("metadata", {}, F.concat(tag("dc-metadata", {"xmlns:dc": NAMESPACES["dc"], "xmlns:oebpackage": NAMESPACES["opf"]}, F.concat_ws("", *core)), tag("x-metadata", {}, F.concat_ws("", *extra))))
    fixed = F.concat(*[item(i, h, t) for i, h, t in (("opf", "book.opf", "text/xml"), ("dtbook", "book.xml", "application/x-dtbook+xml"), ("ncx", "book.ncx", "application/x-dtbncx+xml"))])
    root = tag("package", {"xmlns": NAMESPACES["opf"], "unique-identifier": "uid"}, F.concat(meta, tag("manifest", {}, F.concat(fixed, F.lit("\n"), "items")), tag("spine", {}, F.col("refs"))))
    return rows.select("book_id", F.lit("book.opf").alias("path"), _document("opf", root).alias("content"))
