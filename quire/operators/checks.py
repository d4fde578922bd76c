"""Constraints as DataFrames of violations (rule, key, detail), and one gate that raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.ids import clock_ms
from quire.functions.text import is_safe_id, respaced

#: Files of a package that must be there, and what its package file must say. Fixed values.
REQUIRED = (".opf", ".xml", ".smil", ".ncx", ".mp3")
MEDIA_TYPES = {"book.opf": "text/xml", "book.xml": "application/x-dtbook+xml", "book.ncx": "application/x-dtbncx+xml"}
SMIL, MP3 = "application/smil", "audio/mpeg"
FORMAT = "ANSI/NISO Z39.86-2005"
UNIT_TYPES = ("heading", "subtitle", "paragraph")


class ConstraintError(ValueError):
    """Rows that break a constraint; the first few are in the message."""


def violation(rows: DataFrame, rule: str | Column, key: str | Column, detail: str | Column | None = None) -> DataFrame:
    text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    return rows.select((F.lit(rule) if isinstance(rule, str) else rule).alias("rule"), text(key).alias("key"), (F.lit(None).cast("string") if detail is None else text(detail)).alias("detail"))


def duplicates(rows: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """One violation for each key that comes more than once; detail is how often. Counts are combined before the shuffle."""
    found = rows.groupBy(*keys).agg(F.count("*").alias("times")).filter("times > 1")
    return violation(found, rule, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.col("times"))


def missing(rows: DataFrame, known: DataFrame, on: str | Sequence[str], rule: str, key: str | Column) -> DataFrame:
    """Rows whose reference finds nothing: an anti join."""
    return violation(rows.join(known, on, "left_anti"), rule, key)


def assert_none(violations: DataFrame, shown: int = 5) -> None:
    if found := violations.limit(shown).collect():
        raise ConstraintError("; ".join(f"{r.rule}: {r.key}" + (f" ({r.detail})" if r.detail else "") for r in found))


def selected(found: DataFrame, section_id: str) -> DataFrame:
    """The one section of this id; ConstraintError without any or with several."""
    rows = found.filter(F.col("section_id") == section_id)
    if (n := rows.count()) != 1:
        raise ConstraintError(f"section {section_id}: {'not found' if n == 0 else 'duplicate id'}")
    return rows


def section_violations(unit_rows: DataFrame, found: DataFrame) -> DataFrame:
    """What must hold before audio is made: safe ids, known types, text to speak, no duplicates, a unit at least."""
    out = violation(found.filter(~F.coalesce(is_safe_id(F.col("section_id")), F.lit(False))), "unsafe section id", "section_id")
    out = out.union(violation(found.join(unit_rows, "section_id", "left_anti"), "section without units", "section_id"))
    out = out.union(violation(unit_rows.filter(~F.coalesce(is_safe_id(F.col("id")), F.lit(False))), "unsafe unit id", "id"))
    out = out.union(violation(unit_rows.filter(~F.coalesce(F.col("type").isin(*UNIT_TYPES), F.lit(False))), "unknown unit type", "id", "type"))
    out = out.union(violation(unit_rows.filter(F.coalesce(respaced(F.col("tts_text")), F.lit("")) == ""), "unit without speech text", "id"))
    return out.union(duplicates(unit_rows, ["section_id", "id"], "duplicate unit id"))


def source_violations(found: DataFrame, block_rows: DataFrame) -> DataFrame:
    """The stricter rules on a book before a package is built: no blank titles, no unknown blocks, ids and texts everywhere."""
    out = violation(found.filter("title IS NOT NULL AND trim(title) = ''"), "blank title", "section_id")
    out = out.union(violation(found.filter("subtitle IS NOT NULL AND trim(subtitle) = ''"), "blank subtitle", "section_id"))
    out = out.union(violation(block_rows.filter("type IS NULL OR type NOT IN ('image', 'paragraph')"), "unknown block type", "section_id", "type"))
    paragraphs = block_rows.filter("type = 'paragraph'")
    out = out.union(violation(paragraphs.filter("id IS NULL OR trim(id) = ''"), "paragraph without id", "section_id"))
    return out.union(violation(paragraphs.filter("display_text IS NULL OR trim(display_text) = ''"), "paragraph without text", "id"))


def expected_units(found: DataFrame, block_rows: DataFrame) -> DataFrame:
    """(section_id, ord, id, type, display_text) that a book calls for; see source_violations for what must hold."""
    title = found.filter("title IS NOT NULL").select("section_id", F.lit(0).alias("rank"), F.lit(0).alias("block_ord"), F.concat("section_id", F.lit("_title")).alias("id"), F.lit("heading").alias("type"), F.col("title").alias("display_text"))
    subtitle = found.filter("subtitle IS NOT NULL").select("section_id", F.lit(1).alias("rank"), F.lit(0).alias("block_ord"), F.concat("section_id", F.lit("_subtitle")).alias("id"), F.lit("subtitle").alias("type"), F.col("subtitle").alias("display_text"))
    rows = title.union(subtitle).union(block_rows.filter("type = 'paragraph'").select("section_id", F.lit(2), "block_ord", "id", "type", "display_text"))
    w = Window.partitionBy("section_id").orderBy("rank", "block_ord")
    return rows.withColumn("ord", F.row_number().over(w) - 1).drop("rank", "block_ord")


def reconciled(expected: DataFrame, manifest: DataFrame, timing: DataFrame) -> DataFrame:
    """Violations of the positional agreement of book, manifest and timing, by (section_id, ord).

    Each side has section_id, ord, id and type, the first two display_text as well.
    A side without a row at a position differs in its number of units.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        text = F.col("display_text") if "display_text" in df.columns else F.lit(None).cast("string")
        return df.select("section_id", "ord", F.struct("id", "type", text.alias("display_text")).alias(name))

    at = side(expected, "e").join(side(manifest, "m"), ["section_id", "ord"], "full_outer").join(side(timing, "t"), ["section_id", "ord"], "full_outer")
    here = F.concat_ws("/", "section_id", F.col("ord").cast("string"))
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    cases = [
        ("manifest unit count", F.col("e").isNull() != F.col("m").isNull()),
        ("manifest id", F.col("e").isNotNull() & F.col("m").isNotNull() & differs("e.id", "m.id")),
        ("manifest type", F.col("e").isNotNull() & F.col("m").isNotNull() & ~differs("e.id", "m.id") & differs("e.type", "m.type")),
        ("manifest display text", F.col("e").isNotNull() & F.col("m").isNotNull() & ~differs("e.id", "m.id") & differs("e.display_text", "m.display_text")),
        ("timing unit count", F.col("m").isNull() != F.col("t").isNull()),
        ("timing id", F.col("m").isNotNull() & F.col("t").isNotNull() & differs("m.id", "t.id")),
        ("timing type", F.col("m").isNotNull() & F.col("t").isNotNull() & ~differs("m.id", "t.id") & differs("m.type", "t.type")),
    ]
    hit = F.array_compact(F.array(*[F.when(test, F.struct(F.lit(name).alias("rule"), F.lit(i).alias("rank"))) for i, (name, test) in enumerate(cases)]))
    out = at.select(F.explode(hit).alias("v"), here.alias("key"), F.coalesce("e.id", "m.id", "t.id").alias("detail"))
    return out.select("v.rule", "key", "detail")


def clip_violations(clips: DataFrame, durations: DataFrame | None = None, section: str = "section_id", order: str = "ord") -> DataFrame:
    """Intervals that begin before 0, don't end after they begin, begin before the one before has ended, or end after their section."""
    w = Window.partitionBy(section).orderBy(order)
    rows = clips.withColumn("before", F.coalesce(F.lag("clip_end_ms").over(w), F.lit(0)))
    if durations is not None:
        rows = rows.join(durations.select(section, F.col("duration_ms").alias("section_ms")), section, "left")
    else:
        rows = rows.withColumn("section_ms", F.lit(None).cast("long"))
    cases = [
        ("negative begin", F.col("clip_begin_ms") < 0),
        ("end not after begin", F.col("clip_end_ms") <= F.col("clip_begin_ms")),
        ("not monotonic", F.col("clip_begin_ms") < F.col("before")),
        ("end after section", F.col("clip_end_ms") > F.col("section_ms")),
    ]
    hit = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in cases]))
    key = F.concat_ws("/", F.col(section).cast("string"), F.col(order).cast("string"))
    out = rows.select(F.explode(hit).alias("rule"), key.alias("key"), F.concat_ws("-", F.col("clip_begin_ms").cast("string"), F.col("clip_end_ms").cast("string")).alias("detail"))
    if durations is None:
        return out
    return out.union(violation(durations.filter("duration_ms <= 0"), "duration not positive", section))


def package_violations(files: DataFrame, elements: DataFrame, section_ids: Sequence[str]) -> DataFrame:
    """All rules of a package directory.

    files: (path, ext, error), error for XML that doesn't parse; elements: (path, ord,
    parent, tag, attrs, text) of its XML files. section_ids name the SMIL and MP3 files
    that the package file must list. Paths are relative to the package, folded.
    """
    spark = files.sparkSession
    have = files.groupBy("ext").count()
    required = spark.createDataFrame([(e,) for e in REQUIRED], "ext string")
    out = violation(required.join(have, "ext", "left_anti"), "required file", "ext")
    out = out.union(violation(files.filter("error IS NOT NULL"), "invalid XML", "path", "error"))
    attr = lambda name: F.try_element_at("attrs", F.lit(name))

    ids = elements.select("path", F.explode(F.array_compact(F.array(F.nullif(attr("id"), F.lit("")), F.nullif(attr("xml:id"), F.lit(""))))).alias("id"))
    repeated = ids.groupBy("path", "id").agg(F.count("*").alias("times")).filter("times > 1")
    # one for each occurrence after the first
    repeated = repeated.withColumn("again", F.explode(F.sequence(F.lit(2), F.col("times").cast("int"))))
    out = out.union(violation(repeated, "duplicate id", "path", "id"))

    out = out.union(_reference_violations(files, elements, ids))
    out = out.union(_opf_violations(files, elements, section_ids))
    audio = elements.filter("tag = 'audio'").select("path", "ord", attr("clipBegin").alias("b"), attr("clipEnd").alias("e"))
    audio = audio.withColumn("begin", clock_ms(F.coalesce("b", F.lit("")))).withColumn("end", clock_ms(F.coalesce("e", F.lit(""))))
    wrong = F.when(F.col("begin").isNull() | F.col("end").isNull(), "invalid clip clock").when(F.col("begin") >= F.col("end"), "clip begin not before end")
    out = out.union(violation(audio.withColumn("rule", wrong).filter("rule IS NOT NULL"), F.col("rule"), "path", F.concat_ws(" -> ", "b", "e")))

    uid = elements.filter((F.col("tag") == "meta") & (attr("name") == "dtb:uid")).select("path", F.trim(attr("content")).alias("uid"))
    uid = uid.union(_identifiers(elements).select("path", "uid")).filter("uid != ''")
    per = files.filter("error IS NULL AND ext IN ('.xml', '.smil', '.ncx', '.opf')").select("path").join(uid.distinct().groupBy("path").agg(F.count("*").alias("n"), F.min("uid").alias("uid")), "path", "left")
    out = out.union(violation(per.filter("coalesce(n, 0) != 1"), "one uid in each file", "path", F.coalesce("n", F.lit(0))))
    whole = per.filter("n = 1").agg(F.countDistinct("uid").alias("n"), F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", "path", "uid"))), ", ").alias("d"))
    return out.union(violation(whole.filter("n > 1"), "one uid in all files", F.lit("package"), "d"))


def package_warnings(files: DataFrame) -> DataFrame:
    return violation(files.groupBy("ext").count().filter("ext = '.opf' AND count > 1"), "more than one package file", "ext", "count")


def _folded(c: Column) -> Column:
    from quire.functions.text import resolved_path

    return resolved_path(F.col("path"), c)


def _reference_violations(files: DataFrame, elements: DataFrame, ids: DataFrame) -> DataFrame:
    """src, href and smilref of local targets: inside the package, an existing file, and an existing id."""
    refs = elements.select("path", F.explode(F.array_compact(F.array(*[F.trim(F.try_element_at("attrs", F.lit(a))) for a in ("src", "href", "smilref")]))).alias("ref"))
    refs = refs.filter(~F.col("ref").isin("") & ~F.col("ref").contains("://") & ~F.col("ref").startswith("data:"))
    refs = refs.withColumn("fragment", F.when(F.instr("ref", "#") > 0, F.url_decode(F.replace(F.substring("ref", F.instr("ref", "#") + 1, F.length("ref")), F.lit("+"), F.lit("%2B")))))
    refs = refs.withColumn("target", F.when(F.substring_index("ref", "#", 1) == "", F.col("path")).otherwise(_folded(F.col("ref"))))
    out = violation(refs.filter("target IS NULL"), "reference leads outside", "path", "ref")
    inside = refs.filter("target IS NOT NULL")
    there = files.select(F.col("path").alias("target"), F.lit(True).alias("there"), (F.col("ext").isin(".xml", ".smil", ".ncx", ".opf") & F.col("error").isNull()).alias("parsed"))
    inside = inside.join(there, "target", "left")
    out = out.union(violation(inside.filter("there IS NULL"), "broken reference", "path", "ref"))
    pointed = inside.filter("parsed AND fragment IS NOT NULL AND fragment != ''")
    targets = ids.select(F.col("path").alias("target"), F.col("id").alias("fragment")).distinct()
    return out.union(violation(pointed.join(targets, ["target", "fragment"], "left_anti"), "broken fragment", "path", "ref"))


def _identifiers(elements: DataFrame) -> DataFrame:
    """(path, uid) of Identifier elements that a package file's unique-identifier names."""
    named = elements.filter("tag = 'package'").select("path", F.try_element_at("attrs", F.lit("unique-identifier")).alias("name"))
    found = elements.filter("tag = 'Identifier'").select("path", F.try_element_at("attrs", F.lit("id")).alias("name"), F.trim(F.coalesce("text", F.lit(""))).alias("uid"))
    return named.join(found, ["path", "name"]).select("path", "uid")


def _opf_violations(files: DataFrame, elements: DataFrame, section_ids: Sequence[str]) -> DataFrame:
    spark = files.sparkSession
    opf = files.filter("ext = '.opf' AND error IS NULL").select("path")
    mine = elements.join(opf, "path", "left_semi")
    parents = mine.select("path", F.col("ord").alias("parent"), F.col("tag").alias("in"))
    attr = lambda name: F.try_element_at("attrs", F.lit(name))
    inner = mine.join(parents, ["path", "parent"], "left")
    items = inner.filter("tag = 'item' AND `in` = 'manifest'").select("path", F.nullif(attr("id"), F.lit("")).alias("id"), F.nullif(attr("href"), F.lit("")).alias("href"), attr("media-type").alias("kind"))
    out = violation(items.filter("id IS NULL"), "manifest item without id", "path").union(violation(items.filter("href IS NULL"), "manifest item without href", "path"))

    kinds = MEDIA_TYPES | {f"{s}.smil": SMIL for s in section_ids} | {f"{s}.mp3": MP3 for s in section_ids}
    listed = opf.crossJoin(F.broadcast(spark.createDataFrame(list(kinds.items()), "href string, expected string")))  # a fixed list for each package file
    listed = listed.join(items.groupBy("path", "href").agg(F.count("*").alias("n"), F.collect_set(F.coalesce("kind", F.lit(""))).alias("kinds")), ["path", "href"], "left")
    out = out.union(violation(listed.filter("href = 'book.opf' AND coalesce(n, 0) != 1"), "one entry for book.opf", "path", F.coalesce("n", F.lit(0))))
    out = out.union(violation(listed.filter("n IS NULL"), "manifest lacks file", "path", "href"))
    out = out.union(violation(listed.filter("n IS NOT NULL AND kinds != array(expected)"), "manifest media type", "path", "href"))

    values = inner.filter("tag = 'meta' AND `in` = 'x-metadata'").select("path", attr("name").alias("name"), F.trim(F.coalesce(attr("content"), F.lit(""))).alias("v"))
    values = values.union(inner.filter("tag = 'Format' AND `in` = 'dc-metadata'").select("path", F.lit("dc:Format"), F.trim(F.coalesce("text", F.lit("")))))
    lists = opf.join(values.groupBy("path").pivot("name", ["dc:Format", "dtb:multimediaType", "dtb:multimediaContent", "dtb:audioFormat", "dtb:totalTime"]).agg(F.collect_list("v")), "path", "left")
    only = lambda c: F.when(F.size(F.coalesce(F.col(f"`{c}`"), F.array().cast("array<string>"))) == 1, F.element_at(F.col(f"`{c}`"), 1))
    parts = lambda c, up=False: F.transform(F.split(F.upper(only(c)) if up else only(c), ","), F.trim)
    rules = {
        "dc:Format": only("dc:Format") == FORMAT,
        "multimedia type": only("dtb:multimediaType") == "audioFullText",
        "multimedia content": F.size(F.array_except(F.array(F.lit("audio"), F.lit("text")), parts("dtb:multimediaContent"))) == 0,
        "audio format": F.array_contains(parts("dtb:audioFormat", True), "MP3"),
        "total time": clock_ms(only("dtb:totalTime")) > 0,
    }
    for rule, holds in rules.items():
        out = out.union(violation(lists.filter(~F.coalesce(holds, F.lit(False))), rule, "path"))

    spine = inner.filter("tag = 'itemref' AND `in` = 'spine'").select("path", attr("idref").alias("id"))
    by_id = items.filter("id IS NOT NULL").groupBy("path", "id").agg(F.count("*").alias("n"), F.max("kind").alias("kind"), F.max("href").alias("href"))
    spine = spine.join(by_id, ["path", "id"], "left")
    out = out.union(violation(spine.filter("n IS NULL"), "spine idref", "path", "id"))
    out = out.union(violation(spine.filter(f"n IS NOT NULL AND (n != 1 OR kind IS NULL OR kind != '{SMIL}')"), "spine item is not SMIL", "path", "id"))
    toc = mine.filter("tag = 'spine'").select("path", F.nullif(attr("toc"), F.lit("")).alias("id")).filter("id IS NOT NULL")
    out = out.union(violation(toc.join(by_id, ["path", "id"], "left_anti"), "spine toc", "path", "id"))

    audio_files = items.filter(f"href IS NOT NULL AND kind = '{MP3}'").withColumn("target", _folded(F.col("href"))).select(F.col("path").alias("opf"), "target").distinct()
    out = out.union(violation(audio_files.join(files.select(F.col("path").alias("target")), "target", "left_anti"), "manifest MP3 does not exist", "opf", "target"))

    smil = spine.filter(f"n = 1 AND kind = '{SMIL}' AND href IS NOT NULL").withColumn("smil", _folded(F.col("href"))).select(F.col("path").alias("opf"), "smil").distinct()
    smil = smil.join(files.filter("error IS NULL").select(F.col("path").alias("smil")), "smil", "left_semi")
    audio = elements.filter("tag = 'audio'").select(F.col("path").alias("smil"), "ord", "parent", F.coalesce(attr("src"), F.lit("")).alias("src"), clock_ms(F.coalesce(attr("clipBegin"), F.lit(""))).alias("begin"), clock_ms(F.coalesce(attr("clipEnd"), F.lit(""))).alias("end"))
    audio = audio.join(F.broadcast(smil), "smil")  # one row for each file: sent, so that a file's elements need not meet
    out = out.union(violation(smil.join(audio.select("smil").distinct(), "smil", "left_anti"), "SMIL without audio", "smil"))
    par = elements.filter("tag = 'par'").select(F.col("path").alias("smil"), F.col("ord").alias("parent"), attr("id").alias("id")).join(F.broadcast(smil), "smil")
    out = out.union(violation(par.join(audio.select("smil", "parent"), ["smil", "parent"], "left_anti"), "unit without audio", "smil", "id"))
    to = audio.withColumn("path", F.col("smil")).withColumn("target", F.when(F.col("src") != "", _folded(F.col("src"))))
    out = out.union(violation(to.join(F.broadcast(audio_files), ["opf", "target"], "left_anti"), "audio is not a manifest MP3", "smil", "src"))
    valid = audio.filter("begin IS NOT NULL AND end IS NOT NULL AND begin < end")
    out = out.union(violation(_late(valid), "clips not monotonic", "smil", "ord"))
    total = lists.select(F.col("path").alias("opf"), clock_ms(only("dtb:totalTime")).alias("total"))
    last = valid.groupBy("opf", "smil").agg(F.max("end").alias("end")).join(total, "opf")
    out = out.union(violation(last.filter("end > total"), "clip after total time", "smil"))
    unique = opf.join(_identifiers(elements).groupBy("path").agg(F.count("*").alias("n"), F.max("uid").alias("uid")), "path", "left")
    return out.union(violation(unique.filter("coalesce(n, 0) != 1 OR uid = ''"), "unique-identifier", "path"))


#: Of the elements of a file, numbers that differ above these bits are in different tasks.
RUN_BITS = 17


def _late(clips: DataFrame) -> DataFrame:
    """Clips (opf, smil, ord, begin, end) that begin before the one before them has ended. A file is dealt out in runs; the first clip of a run is compared with the last of the run before."""
    rows = clips.withColumn("run", F.shiftright("ord", RUN_BITS))
    inside = rows.withColumn("before", F.lag("end").over(Window.partitionBy("opf", "smil", "run").orderBy("ord")))
    ends = rows.groupBy("opf", "smil", "run").agg(F.min(F.struct("ord", "begin")).alias("first"), F.max(F.struct("ord", "end")).alias("last"))
    firsts = ends.withColumn("before", F.lag("last.end").over(Window.partitionBy("opf", "smil").orderBy("run"))).select("smil", "first.ord", "first.begin", "before")
    return inside.select("smil", "ord", "begin", "before").union(firsts).filter("begin < before").select("smil", "ord")


def metadata_report(books: DataFrame) -> DataFrame:
    """(key, required, value, present) for the metadata fields of `books` (book_id, metadata), one row for each field.

    creator falls back to author; optional fields may stand under source as well.
    """
    m = lambda *names: F.coalesce(*[F.nullif(F.trim(F.col(f"metadata.{n}")), F.lit("")) for n in names])
    fields = {"title": ("title",), "creator": ("author",), "subject": ("subject",), "language": ("language",)}
    optional = {"translator": ("translator",), "publisher": ("source.publisher",), "date": ("source.date",), "isbn": ("source.isbn",), "description": ("description",)}
    rows = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(k in fields).alias("required"), m(*v).alias("value")) for k, v in (fields | optional).items()])
    return books.select("book_id", F.explode(rows).alias("f")).select("book_id", "f.*", F.col("f.value").isNotNull().alias("present"))


def metadata_violations(books: DataFrame) -> DataFrame:
    from quire.functions.ids import isbn13
    from quire.functions.text import is_iso_date_shape

    report = metadata_report(books)
    out = violation(report.filter("required AND NOT present"), "required metadata", "book_id", "key")
    out = out.union(violation(report.filter("key = 'date' AND present").filter(~is_iso_date_shape(F.col("value"))), "source date", "book_id", "value"))
    return out.union(violation(report.filter("key = 'isbn' AND present").filter(isbn13(F.col("value")).isNull()), "source ISBN", "book_id", "value"))
