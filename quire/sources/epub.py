"""EPUB archives: entries, package metadata, spine and paragraphs.

Archives are read as binary files; each is unpacked in the task that read it. The
lookups of spine, manifest and entries are joins over all archives at once.
"""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.ids import isbn13
from quire.functions.text import blank_to_null, strict
from quire.operators.checks import violation
from quire.sources.html import archive_path, paragraphs_of

CONTAINER = "META-INF/container.xml"
#: Media types of text documents, and XML namespaces; fixed by the format.
TEXT_TYPES = ("application/xhtml+xml", "text/html")
NS = {"c": "urn:oasis:names:tc:opendocument:xmlns:container", "opf": "http://www.idpf.org/2007/opf", "dc": "http://purl.org/dc/elements/1.1/"}
TRANSLATOR = r"(?iU)\s*\(\s*dịch\s*\)\s*$"

ENTRY = "book_id string, kind string, ord long, id string, href string, media_type string, role string, name string, content binary, error string"


def _rows(book_id: str, data: bytes) -> Iterator[dict]:
    """What an archive holds, as rows of kind: error, item, itemref, meta, or entry (text documents only)."""
    fail = lambda text: {"book_id": book_id, "kind": "error", "error": text}
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
        names = set(archive.namelist())
        if CONTAINER not in names:
            yield fail(f"missing {CONTAINER}")
            return
        roots = [r.get("full-path") for r in ET.fromstring(archive.read(CONTAINER)).iterfind("./c:rootfiles/c:rootfile", NS) if r.get("full-path")]
        if not roots:
            yield fail("no package in container")
            return
        if roots[0] not in names:
            yield fail(f"missing package {roots[0]}")
            return
        package = ET.fromstring(archive.read(roots[0]))
    except (zipfile.BadZipFile, ET.ParseError) as e:
        yield fail(f"unreadable archive: {e}")
        return
    wanted = set()
    for n, item in enumerate(package.iterfind("./opf:manifest/opf:item", NS)):
        href, kind, path, error = item.get("href"), item.get("media-type", ""), None, None
        if href:
            try:
                path = archive_path(roots[0], href)
            except ValueError as e:
                error = str(e)
        if kind in TEXT_TYPES and path:
            wanted.add(path)
        yield {"book_id": book_id, "kind": "item", "ord": n, "id": item.get("id"), "href": path, "media_type": kind, "error": error}
    for n, ref in enumerate(package.iterfind("./opf:spine/opf:itemref", NS)):
        yield {"book_id": book_id, "kind": "itemref", "ord": n, "id": ref.get("idref")}
    for n, e in enumerate(x for m in package.iterfind("./opf:metadata", NS) for x in m):
        if e.tag.startswith("{%s}" % NS["dc"]):
            yield {"book_id": book_id, "kind": "meta", "ord": n, "id": e.tag.rpartition("}")[2], "role": (e.get("{%s}role" % NS["opf"]) or "").lower(), "name": e.text}
    for path in sorted(wanted & names):
        yield {"book_id": book_id, "kind": "entry", "href": path, "content": archive.read(path)}


def entries(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all archives below a path that Spark can read; book_id is the file's path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in ENTRY.split(", ")]
        for b in batches:
            for book_id, data in zip(b["path"], b["content"], strict=True):
                out = pd.DataFrame(list(_rows(book_id, bytes(data))), columns=columns)
                out["ord"] = out["ord"].astype("Int64")
                yield out.astype(object).where(out.notna(), None)

    return files.mapInPandas(run, ENTRY)


def spine_documents(found: DataFrame) -> DataFrame:
    """(book_id, spine_ord, id, href, media_type, content): text documents in reading order.

    Of manifest items with one id the last counts. Items of other types are left out.
    """
    refs = found.filter("kind = 'itemref'").select("book_id", F.col("ord").alias("spine_ord"), "id")
    items = found.filter("kind = 'item' AND id IS NOT NULL AND id != ''").groupBy("book_id", "id").agg(F.max_by(F.struct("href", "media_type"), "ord").alias("i"))
    files = found.filter("kind = 'entry'").select("book_id", "href", "content")
    rows = refs.join(items, ["book_id", "id"]).select("book_id", "spine_ord", "id", "i.href", "i.media_type").filter(F.col("media_type").isin(*TEXT_TYPES))
    return rows.join(files, ["book_id", "href"]).select("book_id", "spine_ord", "id", "href", "media_type", "content")


def epub_violations(found: DataFrame) -> DataFrame:
    refs = found.filter("kind = 'itemref'").select("book_id", F.col("ord").alias("spine_ord"), "id")
    items = found.filter("kind = 'item' AND id IS NOT NULL AND id != ''").groupBy("book_id", "id").agg(F.max_by(F.struct("href", "media_type", "error"), "ord").alias("i"))
    used = refs.join(items, ["book_id", "id"], "left")
    text = used.filter(F.col("i").isNotNull() & F.col("i.media_type").isin(*TEXT_TYPES))
    files = found.filter("kind = 'entry'").select("book_id", F.col("href").alias("path"))
    lost = text.filter("i.href IS NOT NULL").withColumn("path", F.col("i.href")).join(files, ["book_id", "path"], "left_anti")
    out = violation(found.filter("kind = 'error'"), "archive", "book_id", "error")
    out = out.union(violation(used.filter("i IS NULL"), "spine item not in manifest", "book_id", "id"))
    out = out.union(violation(used.filter("i IS NOT NULL AND i.href IS NULL AND i.error IS NULL"), "manifest item without href", "book_id", "id"))
    out = out.union(violation(text.filter("i.error IS NOT NULL"), "item leads outside the archive", "book_id", "i.error"))
    return out.union(violation(lost, "spine document is missing", "book_id", "path"))


def records(documents: DataFrame) -> DataFrame:
    """(book_id, ord, classes, text, images): paragraphs of all documents in reading order; image paths from the archive's root."""

    @F.pandas_udf("string")
    def image_path(document: pd.Series, src: pd.Series) -> pd.Series:
        return pd.Series([archive_path(d, s, query=True) for d, s in zip(document, src, strict=True)], dtype=object)

    rows = documents.select("book_id", "spine_ord", "href", F.posexplode(paragraphs_of(F.decode("content", "UTF-8"))).alias("pos", "p"))
    order = F.row_number().over(Window.partitionBy("book_id").orderBy("spine_ord", "pos")) - 1
    rows = rows.select("book_id", order.cast("long").alias("ord"), "href", "p.classes", "p.text", "p.images")
    images = rows.select("book_id", "ord", "href", F.posexplode("images").alias("i", "image"))
    images = images.select("book_id", "ord", "i", F.struct(image_path("href", "image.src").alias("src"), F.col("image.alt").alias("alt")).alias("image"))
    images = images.groupBy("book_id", "ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "image"))), lambda x: x["image"]).alias("resolved"))
    rows = rows.join(images, ["book_id", "ord"], "left")
    return rows.select("book_id", "ord", "classes", "text", F.coalesce("resolved", "images").alias("images"))


def package_metadata(found: DataFrame) -> DataFrame:
    """(book_id, title, creators, authors, translators, language, identifiers, publisher, date, subject, description, rights).

    A creator is a translator by its role, or by the mark at the end of its name, which is taken off.
    """
    m = found.filter("kind = 'meta'").withColumn("name", blank_to_null(F.col("name"))).filter("name IS NOT NULL")
    # mark and role are looked at for creators only
    translator = (F.col("role") == "trl") | F.col("name").rlike(r"(?iU)\(\s*dịch\s*\)$")
    m = m.withColumn("translator", translator).withColumn("bare", F.when(F.col("translator"), F.regexp_replace("name", TRANSLATOR, "")).otherwise(F.col("name")))
    rows = m.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("ord", "id", "name", "translator", "bare"))).alias("m"))
    of = lambda tag, field="name", also=None: F.transform(F.filter("m", lambda x: (x["id"] == tag) & (also(x) if also else F.lit(True))), lambda x: x[field])
    one = lambda tag: F.get(of(tag), 0)
    return rows.select(
        "book_id", one("title").alias("title"), of("creator").alias("creators"), of("creator", "name", lambda x: ~x["translator"]).alias("authors"), of("creator", "bare", lambda x: x["translator"]).alias("translators"),
        one("language").alias("language"), of("identifier").alias("identifiers"), one("publisher").alias("publisher"), one("date").alias("date"),
        F.nullif(F.array_join(of("subject"), "; "), F.lit("")).alias("subject"), one("description").alias("description"), one("rights").alias("rights"),
    )


def book_metadata(package: DataFrame, overrides: dict | None = None) -> DataFrame:
    """(book_id, metadata): package metadata under the overrides of a configuration; blank ones don't count.

    publisher, date, isbn, url, edition and rights are read from overrides["source"], or
    where that is missing from the top level. Of the identifiers the first valid ISBN is kept as written.
    """
    o = overrides or {}
    source = o.get("source") if isinstance(o.get("source"), dict) and o.get("source") else o
    production = o.get("production") if isinstance(o.get("production"), dict) else {}
    null = F.lit(None).cast("string")

    def value(table: dict, key: str, fallback=null):
        v = table.get(key)
        return strict(F.lit(v)) if isinstance(v, str) and v.strip() else fallback

    isbn = F.get(F.filter("identifiers", lambda i: isbn13(i).isNotNull()), 0)
    top = F.lit(o["isbn"].strip()) if isinstance(o.get("isbn"), str) else null
    return package.select(
        "book_id",
        F.struct(
            value(o, "title", F.col("title")).alias("title"), value(o, "creator", F.get("authors", 0)).alias("author"), value(o, "translator", F.get("translators", 0)).alias("translator"),
            value(o, "language", F.col("language")).alias("language"), value(o, "subject", F.col("subject")).alias("subject"), value(o, "description", F.col("description")).alias("description"),
            F.struct(
                value(source, "publisher", F.col("publisher")).alias("publisher"), value(source, "date", F.col("date")).alias("date"), F.coalesce(value(source, "isbn"), F.trim(isbn), top).alias("isbn"),
                value(source, "url").alias("url"), value(source, "edition").alias("edition"), value(source, "rights", F.col("rights")).alias("rights"),
            ).alias("source"),
            F.struct(value(production, "producer").alias("producer"), value(production, "generator").alias("generator")).alias("production"),
        ).alias("metadata"),
    )
