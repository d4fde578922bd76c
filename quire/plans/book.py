"""Whole runs: archives to structured books, books to units and audits, units to packages. Each step has a command."""

from __future__ import annotations

import argparse
import contextlib
import importlib
import os
import sys
from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.ids import book_uid, duration
from quire.operators import audio, audit, checks, publish, render, structure, timeline
from quire.operators.chunks import with_chunks
from quire.sources import config, epub
from quire.sources import json as json_source
from quire.schemas import VIOLATION
from quire.sources.package import package


def extract(spark: SparkSession, path: str, overrides: dict | None = None, chapters: int = structure.CHAPTERS) -> dict[str, DataFrame]:
    """books (book_id, metadata, sections), with sections, blocks and violations as rows."""
    found = epub.entries(spark, path)
    records = epub.records(epub.spine_documents(found))
    outlines = structure.outlined(records, chapters)
    nested = structure.structured(outlines)
    books = epub.book_metadata(epub.package_metadata(found), overrides).join(nested, "book_id")
    violations = epub.epub_violations(found).union(structure.outline_violations(outlines, chapters))
    return {"books": books, "sections": structure.sections(outlines), "blocks": structure.flattened(nested)[1], "violations": violations}


def manifest(books: DataFrame) -> DataFrame:
    """(book_id, metadata, sections) of nested books with units: in each section its units instead of its blocks."""
    s = lambda s: F.struct(*[s[c].alias(c) for c in ("id", "type", "number", "title", "subtitle", "units")])
    return books.select("book_id", "metadata", F.transform("sections", s).alias("sections"))


def prepared(books: DataFrame, pronunciation: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Units of structured books, and the violations among them."""
    unit_rows = structure.units(books, pronunciation)
    return unit_rows, structure.unit_violations(structure.with_units(books), unit_rows)


def dry_run(unit_rows: DataFrame, max_chars: int = 2500) -> DataFrame:
    """Units, characters and speech requests for each section and in all."""
    return audit.totals(with_chunks(unit_rows, "tts_text", "chunks", max_chars), "chunks")


def with_uid(books: DataFrame) -> DataFrame:
    m = lambda p: F.col(f"metadata.{p}")
    uid = book_uid(m("title"), m("author"), m("language"), m("subject"), m("translator"), m("source.publisher"), m("source.date"), m("source.isbn"))
    return books.select("book_id", "metadata", uid.alias("uid"))


def rendered(books: DataFrame, unit_rows: DataFrame, clips: DataFrame) -> DataFrame:
    """(book_id, path, content) of all XML files of all books. Sections and order are those of the books."""
    sections, _ = structure.flattened(books)
    known = with_uid(books)
    lengths = clips.groupBy("book_id", "section_id").agg(F.max("clip_end_ms").alias("duration_ms"))
    timed = sections.select("book_id", "section_id", "section_ord").join(lengths, ["book_id", "section_id"])
    return render.dtbook(unit_rows, known).union(render.ncx(sections, known)).union(render.opf(timed, known)).union(render.smil(clips, known).drop("section_id"))


def source_checks(books: DataFrame, unit_rows: DataFrame, clips: DataFrame) -> DataFrame:
    """What must hold between one book, its manifest and its timing before its package is built."""
    sections, blocks = structure.flattened(books)
    out = checks.source_violations(sections, blocks)
    out = out.union(checks.reconciled(checks.expected_units(sections, blocks), unit_rows, clips))
    out = out.union(checks.clip_violations(clips, timeline.section_durations(clips)))
    return out.union(checks.violation(with_uid(books).filter("uid IS NULL"), "book metadata", "book_id"))


def validated(spark: SparkSession, folder: str | Path, section_ids: list[str]) -> DataFrame:
    """Violations of a package directory, as they are now: the files are parsed once, and nothing of them is kept."""
    if not Path(folder).is_dir():
        raise NotADirectoryError(f"not a directory: {folder}")
    files, elements = (x.persist() for x in package(spark, str(folder)))
    try:
        found = checks.package_violations(files, elements, section_ids).collect()  # of one package
    finally:
        elements.unpersist()
        files.unpersist()
    return spark.createDataFrame(found, VIOLATION)


def warnings(spark: SparkSession, folder: str | Path) -> DataFrame:
    return checks.package_warnings(package(spark, str(folder))[0])


def build(spark: SparkSession, books: DataFrame, unit_rows: DataFrame, clips: DataFrame, audio: Mapping[str, Path], target: str | Path) -> Path:
    """The package of one book, from its units, clips, and the audio file of each section."""
    checks.assert_none(source_checks(books, unit_rows, clips))
    ids = [r[0] for r in structure.flattened(books)[0].select("section_id").distinct().collect()]  # the sections of one book
    if lacking := sorted(set(ids) - set(audio)):
        raise FileNotFoundError(f"no audio for {', '.join(lacking)}")
    return publish.publish(rendered(books, unit_rows, clips), target, lambda folder: validated(spark, folder, ids), {f"{s}.mp3": Path(p) for s, p in audio.items()})


def of_section(book: DataFrame, section_id: str | None) -> DataFrame:
    """`book` (metadata, sections) with the one section of this id, or as it is for None."""
    if section_id is None:
        return book
    checks.selected(book.select(F.explode("sections.id").alias("section_id")), section_id)
    return book.withColumn("sections", F.filter("sections", lambda s: s["id"] == section_id))


def settings(path: str | None, env: Mapping[str, str]) -> dict:
    """Voice, rate, pause and request length: the environment's voice over the configuration's over the defaults."""
    tts = config.section(path, "tts") if path else {}
    voice = env.get("SPEECH_VOICE", "").strip() or str(tts.get("voice") or "vi-VN-HoaiMyNeural")
    return {"voice": voice, "rate": str(tts.get("rate") or "-5%"), "pause_ms": int(tts.get("pause_ms", 350)), "max_chars": int(tts.get("max_chars_per_request", 2500))}


def generate(unit_rows: DataFrame, folder: str | Path, call: audio.Call, probe: audio.Probe, voice: str, rate: str, pause_ms: int = 350, max_chars: int = 2500, force: bool = False) -> list[Path]:
    """Speech for the units of one book, and a timing document for each section; the paths of those documents in order.

    What is in the cache below the folder isn't asked for again, unless `force` is set. The timing
    holds where each unit would lie in the section's audio; joining audio is up to a codec.
    """
    checks.assert_none(checks.section_violations(unit_rows, unit_rows.select("section_id").distinct()))
    folder = Path(folder)
    spoken = audio.synthesized(unit_rows, str(folder / "cache"), call, probe, voice, rate, max_chars, force)
    clips = timeline.timeline(spoken, pause_ms=pause_ms)
    out = []
    for r in timeline.timing_documents(clips).orderBy("section_ord").toLocalIterator():  # the sections of one book
        path = folder / r.section_id / f"{r.section_id}_timing.json"
        publish.write_value({"section_id": r.section_id, "audio": r.audio, "duration_ms": r.duration_ms, "units": [u.asDict() for u in r.units]}, path)
        out.append(path)
    return out


def build_from(spark: SparkSession, book: str, manifest: str, audio_dir: str | Path, target: str | Path, section_id: str | None = None) -> dict:
    """The package of a book, or of its one section, from its documents and its audio; counts for the summary."""
    books = of_section(json_source.books(spark, book), section_id).withColumn("book_id", F.lit(book))
    unit_rows = json_source.manifest_units(of_section(json_source.manifests(spark, manifest), section_id)).withColumn("book_id", F.lit(book))
    ids = [r[0] for r in structure.flattened(books)[0].orderBy("section_ord").select("section_id").collect()]  # of one book
    folder = Path(audio_dir)
    timing = [folder / s / f"{s}_timing.json" for s in ids]
    if lacking := [str(p) for p in timing if not p.is_file()]:
        raise FileNotFoundError(f"no timing: {', '.join(lacking)}")
    order = structure.flattened(books)[0].select("section_id", "section_ord")
    clips = json_source.timing_units(json_source.timings(spark, [str(p) for p in timing])).join(order, "section_id").withColumn("book_id", F.lit(book))
    build(spark, books, unit_rows, clips, {s: folder / s / f"{s}.mp3" for s in ids}, target)
    total = clips.groupBy("section_id").agg(F.max("clip_end_ms").alias("ms"), F.count("*").alias("units")).agg(F.sum("ms").alias("ms"), F.sum("units").alias("units"))
    r = total.select("units", duration(F.col("ms")).alias("duration")).first()
    return {"units": r.units, "duration": r.duration, "uid": with_uid(books).first().uid, "output": str(target), "files": sorted(p.name for p in Path(target).iterdir())}


def newer(outputs: list[Path], inputs: list[Path]) -> bool:
    """Whether all outputs are there and none is older than an input."""
    return all(p.exists() for p in outputs) and min(p.stat().st_mtime for p in outputs) >= max(p.stat().st_mtime for p in inputs)


def chain(steps: list[tuple[str, list[Path], list[Path], Callable[[], object]]], always: bool = False) -> list[str]:
    """Run (name, inputs, outputs, action) in order, without those whose outputs are up to date; the names of those that ran.

    Once a step has run, all after it run too.
    """
    ran: list[str] = []
    for name, inputs, outputs, action in steps:
        if ran or always or not newer(outputs, inputs):
            action()
            ran.append(name)
    return ran


def _function(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


@contextlib.contextmanager
def _held(df: DataFrame):
    """`df` kept while it is used several times, and not longer."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def _write_books(books: DataFrame, folder: Path) -> None:
    """book.json and metadata.json of one book, or of each of several in a folder of its own name."""
    rows = list(books.select("book_id").toLocalIterator())
    for r in rows:
        one, to = books.filter(F.col("book_id") == r.book_id), folder if len(rows) == 1 else folder / Path(r.book_id).stem
        publish.write_json(one.select("metadata", "sections"), to / "book.json")
        publish.write_json(one.select("metadata.*"), to / "metadata.json")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quire")
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *places: str, **options):
        c = commands.add_parser(name, help=text)
        for place in places:
            c.add_argument(place)
        for k, v in options.items():
            c.add_argument(f"--{k.replace('_', '-')}", **v)
        return c

    path, flag = {"default": None}, {"action": "store_true"}
    add("extract", "archives to structured books, as JSON", "source", "output", config=path, chapters={"type": int, "default": structure.CHAPTERS})
    add("prepare", "a book to units, as JSON", "source", "output", pronunciation=path)
    add("audit", "issues of units, as JSON", "source", "output")
    add("dry-run", "speech requests of units", "source", max_chars={"type": int, "default": 2500})
    c = add("generate", "speech and timing of units", "source", "output", config=path, dry_run=flag, force=flag, speech={"default": "quire.operators.audio:silent", "help": "module:function that makes audio"}, length={"default": "quire.operators.audio:silent_length", "help": "module:function that measures it"})
    which = c.add_mutually_exclusive_group(required=True)
    which.add_argument("--section")
    which.add_argument("--all", action="store_true")
    c = add("build", "a package from a book, its units and their audio", "book", "manifest", "audio", "output")
    which = c.add_mutually_exclusive_group()
    which.add_argument("--section")
    which.add_argument("--all", action="store_true")
    add("validate", "rules of a package", "source", sections={"default": "chapter_01"})
    add("package", "zip of a package", "source", "output", sections={"default": "chapter_01"})
    add("verify", "a zipped package against its checksum, and its number of sections", "source", sections={"type": int, "default": None})
    add("check-metadata", "metadata of books", "source")
    add("all", "an archive to the units, audit and requests of its book, as far as they aren't up to date", "source", "output", config=path, pronunciation=path, chapters={"type": int, "default": structure.CHAPTERS})
    return parser


def _extract(spark: SparkSession, a) -> None:
    if not os.path.exists(a.source):
        raise FileNotFoundError(f"no such file: {a.source}")
    found = extract(spark, a.source, config.section(a.config, "book") if a.config else None, a.chapters)
    checks.assert_none(found["violations"])
    with _held(found["books"]) as books:
        _write_books(books, Path(a.output))
        structure.summary(books).show(truncate=False)


def _prepare(spark: SparkSession, source: str, output: str, pronunciation: str | None) -> None:
    books = json_source.books(spark, source)
    with _held(structure.units(books, config.pronunciation(pronunciation) if pronunciation else None)) as rows:
        checks.assert_none(structure.unit_violations(structure.with_units(books), rows))
        publish.write_json(manifest(structure.nested_units(books, rows)), output, "book_id")


def _audit(spark: SparkSession, source: str, output: str) -> None:
    with _held(audit.issues(json_source.manifest_units(json_source.manifests(spark, source)))) as found:
        publish.write_values(audit.in_report_order(found), output)
        audit.category_counts(found).orderBy("category_ord").show(truncate=False)


def _generate(spark: SparkSession, a) -> None:
    s = settings(a.config, os.environ)
    unit_rows = json_source.manifest_units(of_section(json_source.manifests(spark, a.source), a.section))
    if a.dry_run:
        checks.assert_none(checks.section_violations(unit_rows, unit_rows.select("section_id").distinct()))
        dry_run(unit_rows, s["max_chars"]).orderBy("section_id").show(truncate=False)
        return
    for p in generate(unit_rows, a.output, _function(a.speech), _function(a.length), s["voice"], s["rate"], s["pause_ms"], s["max_chars"], a.force):
        print(p)


def _verify(a) -> None:
    archive = Path(a.source)
    wrong = publish.verified(archive, archive.with_name(f"{archive.stem}_sha256sums.txt"))
    if a.sections is not None and not wrong:
        import zipfile

        with zipfile.ZipFile(archive) as z:
            n = sum(x.endswith(".smil") for x in z.namelist())
        if n != a.sections:
            wrong.append(f"{n} sections, not {a.sections}")
    if wrong:
        raise ValueError("; ".join(wrong))


def _all(spark: SparkSession, a) -> None:
    out = Path(a.output)
    book, units, report = out / "book.json", out / "manifest.json", out / "audit.json"
    settled = [Path(p) for p in (a.config, a.pronunciation) if p]
    steps = [
        ("extract", [Path(a.source), *settled[:1]], [book], lambda: _extract(spark, a)),
        ("prepare", [book, *settled], [units], lambda: _prepare(spark, str(book), str(units), a.pronunciation)),
        ("audit", [units], [report], lambda: _audit(spark, str(units), str(report))),
    ]
    print("ran: " + (", ".join(chain(steps)) or "nothing, all is up to date"))


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    try:
        if a.command == "extract":
            _extract(spark, a)
        elif a.command == "prepare":
            _prepare(spark, a.source, a.output, a.pronunciation)
        elif a.command == "audit":
            _audit(spark, a.source, a.output)
        elif a.command == "dry-run":
            dry_run(json_source.manifest_units(json_source.manifests(spark, a.source)), a.max_chars).orderBy("section_id").show(truncate=False)
        elif a.command == "generate":
            _generate(spark, a)
        elif a.command == "build":
            for k, v in build_from(spark, a.book, a.manifest, a.audio, a.output, None if a.all else a.section or "chapter_01").items():
                print(f"{k}: {v}")
        elif a.command == "check-metadata":
            books = json_source.books(spark, a.source)
            checks.assert_none(checks.metadata_violations(books))
            checks.metadata_report(books).filter("NOT present").show(truncate=False)
        elif a.command == "verify":
            _verify(a)
        elif a.command == "all":
            _all(spark, a)
        else:
            wrong = validated(spark, a.source, a.sections.split(","))
            for w in warnings(spark, a.source).collect():
                print(f"WARNING: {w.rule}", file=sys.stderr)
            checks.assert_none(wrong)
            if a.command == "package":
                publish.zipped(a.source, a.output, wrong)
    except (OSError, ValueError, PySparkException) as e:
        print(f"ERROR: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
