"""From an archive to a valid package, and packages with one thing broken."""

import io
import json
import os
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quire.operators import audio, audit, checks, publish, structure, timeline
from quire.plans import book
from quire.sources import config, epub, html
from quire.sources.html import archive_path, parse

PAGE_1 = """<html><body><p class="block_"><img src="../img/cover.png" alt=""/></p>
<p class="block_">GIỚI THIỆU</p><p class="block_2">Lời đầu</p><p class="block_3">Đoạn <span class="x">mở</span>  đầu 5%.</p></body></html>"""
PAGE_2 = """<html><body><p class="block_">1</p><p>&#160;</p><p class="block_">CHUYỆN MỘT</p><p class="block_10">Phụ đề</p><p class="block_3">Giá $5/tháng.</p><p class="block_3">2</p>
<p class="block_">2</p><p class="block_">Chuyện hai</p><p class="block_2">Phụ đề hai</p><p class="block_3">Hết <img src="../img/a.png" alt="Một con mèo"/></p></body></html>"""
OPF = """<package xmlns="http://www.idpf.org/2007/opf" xmlns:opf="http://www.idpf.org/2007/opf" xmlns:dc="http://purl.org/dc/elements/1.1/"><metadata>
<dc:title> Sách </dc:title><dc:creator>Tác Giả</dc:creator><dc:creator>Người Nào (dịch)</dc:creator><dc:creator opf:role="trl">Thêm</dc:creator><dc:language>vi</dc:language>
<dc:identifier>x-1</dc:identifier><dc:identifier>978-1-2345-6789-7</dc:identifier><dc:subject>A</dc:subject><dc:subject>B</dc:subject></metadata>
<manifest><item id="z" href="text/a%20b.xhtml" media-type="application/xhtml+xml"/><item id="b" href="text/0.xhtml" media-type="application/xhtml+xml"/><item id="p" href="img/a.png" media-type="image/png"/></manifest>
<spine><itemref idref="z"/><itemref idref="p"/><itemref idref="b"/></spine></package>"""
ROOT = '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OPS/book.opf"/></rootfiles></container>'


def archive(path: Path, **change) -> Path:
    files = {"META-INF/container.xml": ROOT, "OPS/book.opf": OPF, "OPS/text/a b.xhtml": PAGE_1, "OPS/text/0.xhtml": PAGE_2} | change
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, content in files.items():
            if content is not None:
                z.writestr(name, content)
    path.write_bytes(data.getvalue())
    return path


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("epub")
    archive(folder / "one.epub")
    out = book.extract(spark, str(folder), {"production": {"generator": "quire"}}, chapters=2)
    return {k: v.cache() for k, v in out.items()}


def test_extraction(found):
    assert found["violations"].count() == 0
    b = found["books"].first()
    m = b.metadata
    assert (m.title, m.author, m.translator, m.language, m.subject) == ("Sách", "Tác Giả", "Người Nào", "vi", "A; B")
    assert (m.source.isbn, m.production.generator) == ("978-1-2345-6789-7", "quire")
    assert [(s.id, s.type, s.number, s.title, s.subtitle) for s in b.sections] == [
        ("introduction", "introduction", None, "GIỚI THIỆU", "Lời đầu"), ("chapter_01", "chapter", 1, "CHUYỆN MỘT", "Phụ đề"), ("chapter_02", "chapter", 2, "Chuyện hai", "Phụ đề hai"),
    ]
    blocks = [(x.type, x.id, x.display_text, x.src, x.needs_alt_review) for s in b.sections for x in s.blocks]
    assert blocks == [
        ("image", None, None, "OPS/img/cover.png", True), ("paragraph", "introduction_p0001", "Đoạn mở đầu 5%.", None, None), ("paragraph", "chapter_01_p0001", "Giá $5/tháng.", None, None),
        ("paragraph", "chapter_01_p0002", "2", None, None), ("image", None, None, "OPS/img/a.png", False), ("paragraph", "chapter_02_p0001", "Hết", None, None),
    ]
    s = structure.summary(found["sections"], found["blocks"]).first()
    assert (s.chapters, s.introduction, s.paragraphs, s.images, s.alt_reviews) == (2, True, 4, 2, 1)


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"META-INF/container.xml": None}, "archive"),
        ({"OPS/book.opf": None}, "archive"),
        ({"OPS/text/0.xhtml": None}, "spine document is missing"),
        ({"OPS/book.opf": OPF.replace('idref="b"', 'idref="none"')}, "spine item not in manifest"),
        ({"OPS/book.opf": OPF.replace("text/0.xhtml", "../../x.xhtml")}, "item leads outside the archive"),
        ({"OPS/book.opf": OPF.replace('id="b" href="text/0.xhtml"', 'id="b"')}, "manifest item without href"),
    ],
)
def test_broken_archives(spark, tmp_path, change, rule):
    archive(tmp_path / "x.epub", **change)
    rules = {r.rule for r in epub.epub_violations(epub.entries(spark, str(tmp_path))).collect()}
    assert rules == {rule}


def test_unreadable_archive(spark, tmp_path):
    (tmp_path / "x.epub").write_bytes(b"no zip")
    assert [r.rule for r in epub.epub_violations(epub.entries(spark, str(tmp_path))).collect()] == ["archive"]


def test_wrong_number_of_chapters(spark, tmp_path):
    archive(tmp_path / "x.epub")
    out = book.extract(spark, str(tmp_path), chapters=3)
    assert [r.rule for r in out["violations"].collect()] == ["chapter count"]
    with pytest.raises(checks.ConstraintError):
        checks.assert_none(out["violations"])


def test_html_paragraphs():
    assert parse('<p class="a b">x<br>y <b>z</b><p>two<div>no</div><p> </p><p><img alt=" A  b " src="s"></p>') == [
        {"classes": ["a", "b"], "text": "xy z", "images": []}, {"classes": [], "text": "two", "images": []}, {"classes": [], "text": "", "images": [{"src": "s", "alt": "A b"}]},
    ]
    assert parse("") == [] and parse(None) == []
    assert archive_path("a/b.html", "../c%20d#x") == "c d"
    with pytest.raises(ValueError):
        archive_path("a/b.html", "../../c")


@pytest.fixture(scope="module")
def ready(spark, found):
    units, wrong = book.prepared(found["books"], {"Hết": "Kết thúc"})
    units = units.cache()
    clips = timeline.timeline(timeline.fake_durations(units), pause_ms=350).cache()
    return found["books"], units, clips, wrong


def test_units(ready):
    _, units, _, wrong = ready
    assert wrong.count() == 0
    rows = units.orderBy("section_ord", "ord").collect()
    assert [(r.id, r.tts_text) for r in rows] == [
        ("introduction_title", "Giới thiệu"), ("introduction_subtitle", "Lời đầu"), ("introduction_p0001", "Đoạn mở đầu năm phần trăm."), ("chapter_01_title", "Chương một. Chuyện một."), ("chapter_01_subtitle", "Phụ đề"),
        ("chapter_01_p0001", "Giá năm đô la mỗi tháng."), ("chapter_01_p0002", "hai"), ("chapter_02_title", "Chương hai. Chuyện hai."), ("chapter_02_subtitle", "Phụ đề hai"), ("chapter_02_p0001", "Kết thúc"),
    ] or [r.tts_text for r in rows][3] == "Chương 1. Chuyện một."
    assert rows[2].display_text == "Đoạn mở đầu 5%."


def test_timeline_is_monotone(ready):
    _, _, clips, _ = ready
    assert checks.clip_violations(clips, timeline.section_durations(clips)).count() == 0
    first = clips.filter("section_id = 'introduction'").orderBy("ord").collect()
    assert first[0].clip_begin_ms == 0 and first[1].clip_begin_ms == first[0].clip_end_ms + 350
    with pytest.raises(ValueError):
        timeline.timeline(clips, pause_ms=-1)


@pytest.fixture(scope="module")
def built(spark, ready, tmp_path_factory):
    folder = tmp_path_factory.mktemp("package")
    sound = folder / "a.mp3"
    sound.write_bytes(b"sound")
    books, units, clips, _ = ready
    sections = ["introduction", "chapter_01", "chapter_02"]
    return book.build(spark, books, units, clips, {s: sound for s in sections}, folder / "out"), sections


def test_package_is_valid_and_zipped(spark, built, tmp_path):
    folder, sections = built
    found = book.validated(spark, folder, sections)
    assert [tuple(r) for r in found.collect()] == []
    z, sums = publish.zipped(folder, tmp_path / "b.zip", found)
    assert sums.read_text() == f"{publish.file_sha256(z)}  b.zip\n"
    assert zipfile.ZipFile(z).namelist() == sorted(p.name for p in folder.iterdir())
    assert len(list(publish.versions_of(folder).iterdir())) == 1


MUTATIONS = [
    ("chapter_01.smil", "book.xml#chapter_01_p0001", "book.xml#nothing", "broken fragment"),
    ("chapter_01.smil", 'src="chapter_01.mp3"', 'src="other.mp3"', "broken reference"),
    ("chapter_01.smil", 'src="chapter_01.mp3"', 'src="../../x.mp3"', "reference leads outside"),
    ("chapter_01.smil", 'clipBegin="0:00:00.000"', 'clipBegin="npt=0s"', "invalid clip clock"),
    ("chapter_01.smil", 'clipBegin="0:00:00.000"', 'clipBegin="9:00:00.000"', "clip begin not before end"),
    ("chapter_01.smil", "<smil", "<smil><smil", "invalid XML"),
    ("chapter_01.smil", "urn:uuid:", "urn:other:", "one uid in all files"),
    ("book.xml", 'id="chapter_01_p0001"', 'id="chapter_01_title"', "duplicate id"),
    ("book.opf", "ANSI/NISO Z39.86-2005", "other", "dc:Format"),
    ("book.opf", "audioFullText", "audioOnly", "multimedia type"),
    ("book.opf", 'content="audio,text"', 'content="text"', "multimedia content"),
    ("book.opf", 'content="MP3"', 'content="WAV"', "audio format"),
    ("book.opf", 'name="dtb:totalTime"', 'name="dtb:none"', "total time"),
    ("book.opf", 'idref="smil_chapter_01"', 'idref="none"', "spine idref"),
    ("book.opf", 'idref="smil_chapter_01"', 'idref="ncx"', "spine item is not SMIL"),
    ("book.opf", "<spine>", '<spine toc="none">', "spine toc"),
    ("book.opf", 'unique-identifier="uid"', 'unique-identifier="none"', "unique-identifier"),
    ("book.opf", 'href="book.ncx" media-type="application/x-dtbncx+xml"', 'href="book.ncx" media-type="text/xml"', "manifest media type"),
    ("book.opf", '<item id="opf" href="book.opf" media-type="text/xml"/>', "", "one entry for book.opf"),
    ("book.opf", 'href="chapter_02.mp3"', 'href="none.mp3"', "manifest MP3 does not exist"),
]


#: Mutations that don't hide each other are looked at together: one evaluation of all rules for each group.
GROUPS = [
    {"broken fragment", "invalid clip clock", "one uid in all files", "duplicate id", "dc:Format", "multimedia type", "multimedia content", "audio format", "total time", "spine toc"},
    {"broken reference", "clip begin not before end", "spine idref", "unique-identifier", "manifest media type", "one entry for book.opf", "manifest MP3 does not exist"},
    {"reference leads outside", "spine item is not SMIL"},
    {"invalid XML"},
]


@pytest.mark.parametrize("group", range(len(GROUPS)))
def test_mutated_package(spark, built, tmp_path, group):
    folder, sections = built
    copy = tmp_path / "p"
    copy.mkdir()
    for p in folder.iterdir():
        (copy / p.name).write_bytes(p.read_bytes())
    for name, old, new, rule in MUTATIONS:
        if rule in GROUPS[group]:
            content = (copy / name).read_text()
            assert old in content
            (copy / name).write_text(content.replace(old, new, 1))
    rules = {r.rule for r in book.validated(spark, copy, sections).collect()}
    assert GROUPS[group] <= rules


def test_every_mutation_is_in_a_group():
    assert {m[3] for m in MUTATIONS} == set().union(*GROUPS)


def test_missing_files(spark, built, tmp_path):
    folder, sections = built
    copy = tmp_path / "p"
    copy.mkdir()
    (copy / "book.opf").write_bytes((folder / "book.opf").read_bytes())
    rules = [(r.rule, r.key) for r in book.validated(spark, copy, sections).collect()]
    assert {k for r, k in rules if r == "required file"} == {".xml", ".smil", ".ncx", ".mp3"}


def test_failed_build_leaves_the_old_package(spark, built):
    folder, _ = built
    before = (folder / "book.opf").read_bytes()
    bad = spark.createDataFrame([("book.opf", "<broken")], "path string, content string")
    with pytest.raises(checks.ConstraintError):
        publish.publish(bad, folder, lambda p: book.validated(spark, p, []))
    assert (folder / "book.opf").read_bytes() == before and len(list(publish.versions_of(folder).iterdir())) == 1


def test_each_validation_reads_the_files_as_they_are(spark, tmp_path):
    (tmp_path / "p").mkdir()
    rules = lambda: {r.rule for r in book.validated(spark, tmp_path / "p", []).collect()}
    (tmp_path / "p" / "book.xml").write_text("<a/>")
    assert "invalid XML" not in rules()
    (tmp_path / "p" / "book.xml").write_text("<a")
    assert "invalid XML" in rules()
    with pytest.raises(NotADirectoryError):
        book.validated(spark, tmp_path / "none", [])


def test_versions_of_a_package(spark, tmp_path):
    rows = lambda text: spark.createDataFrame([("a.txt", text)], "path string, content string")
    fine = lambda p: spark.createDataFrame([], "rule string, key string, detail string")
    target = tmp_path / "out"
    target.mkdir()
    (target / "a.txt").write_text("from elsewhere")
    with pytest.raises(RuntimeError):
        publish.publish(rows("x"), target, lambda p: (_ for _ in ()).throw(RuntimeError()))
    assert (target / "a.txt").read_text() == "from elsewhere"
    for text in ("one", "two"):
        publish.publish(rows(text), target, fine)
        assert (target / "a.txt").read_text() == text
    assert len(list(publish.versions_of(target).iterdir())) == 1
    target.unlink()  # as if the process had ended between taking a folder over and pointing to it
    with pytest.raises(RuntimeError):
        publish.publish(rows("x"), target, lambda p: (_ for _ in ()).throw(RuntimeError()))
    assert (target / "a.txt").read_text() == "two"
    (tmp_path / "file").write_text("x")
    with pytest.raises(ValueError):
        publish.publish(rows("x"), tmp_path / "file", fine)


def test_indentation():
    xml = '<?xml version="1.0"?>\n<!DOCTYPE a>\n<a b="x &gt; y"><c/><d>text &lt;</d>\n<e><f></f></e></a>\n'
    want = '<?xml version="1.0"?>\n<!DOCTYPE a>\n<a b="x &gt; y">\n  <c/>\n  <d>text &lt;</d>\n  <e>\n    <f></f>\n  </e>\n</a>\n'
    assert publish.indented(xml) == want == publish.indented(want)
    assert publish.indented("<broken") == "<broken\n"


def test_a_book_without_markers_is_a_violation(spark, tmp_path):
    page = '<html><body><p class="block_3">Chỉ có chữ.</p></body></html>'
    archive(tmp_path / "x.epub", **{"OPS/text/a b.xhtml": page, "OPS/text/0.xhtml": page})
    assert {r.rule for r in book.extract(spark, str(tmp_path), chapters=2)["violations"].collect()} == {"chapter count", "introduction"}


def test_html_normalization():
    tidy = html.normalized
    assert tidy("<p>Ta\u0302m   ly\u0301</p>") == "<p>Tâm lý</p>"
    assert tidy('<body><p> &nbsp; </p><p><img src="c.jpg" alt=" A  b "></p></body>') == '<body><p><img src="c.jpg" alt="A b"></p></body>'
    assert tidy('<p><span class="c">Ông</span> <span lang="en" id="k">không</span>  điên</p>') == '<p>Ông <span lang="en" id="k">không</span> điên</p>'
    assert tidy("<p> <b>B </b> <strong>S</strong><em>E</em><sup>2</sup><sub>i</sub> </p>") == "<p><b>B </b><strong>S</strong><em>E</em><sup>2</sup><sub>i</sub></p>"
    assert tidy("<p>one<p>two &lt; 3<div> free  text </div><script>a < b</script>") == "<p>one</p><p>two &lt; 3</p><div> free  text </div><script>a < b</script>"
    assert tidy(None) is None and tidy("") == ""
    kept = '<p>x <b>y</b></p>'
    assert tidy(tidy(kept)) == kept and [p["text"] for p in parse(tidy('<p><span>a</span>  <i>b</i></p><p></p>'))] == ["a b"]


def test_audio_that_counts(spark, tmp_path):
    for name, data in (("a.mp3", b"12345"), ("b.mp3", b""), ("c.mp3", b"bad")):
        (tmp_path / name).write_bytes(data)

    def probe(data):
        if data == b"bad":
            raise ValueError("not audio")
        return len(data)

    sections = spark.createDataFrame([(x,) for x in "abcd"], "section_id string")
    got = {r.section_id: r.duration_ms for r in audio.with_audio(sections, audio.audio_files(spark, str(tmp_path), probe)).collect()}
    assert got == {"a": 5, "b": None, "c": None, "d": None}


def test_calls_fill_the_cache_and_tell_what_failed(spark, tmp_path):
    rows = [("s", 0, 0, "u1", "paragraph", "Một. Hai.", "Một. Hai."), ("s", 0, 1, "u2", "paragraph", "hỏng", "hỏng"), ("s", 0, 2, "u3", "paragraph", "Một.", "Một.")]
    units = spark.createDataFrame(rows, "section_id string, section_ord int, ord int, id string, type string, display_text string, tts_text string")
    log = tmp_path / "calls"
    log.mkdir()

    folder = str(log)

    def call(text, voice, rate):
        import os

        from quire.operators.audio import silent

        open(f"{folder}/{len(os.listdir(folder))}-{text}", "w").close()
        if text == "hỏng":
            raise OSError("no service")
        return silent(text, voice, rate)

    cache = str(tmp_path / "cache")
    make = lambda fn, force=False: {r.id: r.duration_ms for r in audio.synthesized(units, cache, fn, audio.silent_length, "v", "0%", 5, force).collect()}
    with pytest.raises(checks.ConstraintError, match="u2/chunk_0001.*OSError: no service"):
        make(call)
    assert sorted(p.name.split("-")[1] for p in log.iterdir()) == ["Hai.", "Một.", "hỏng"]
    assert make(audio.silent) == {"u1": 480, "u2": 240, "u3": 240}  # only the failed one is asked for
    assert audio.read_cache(spark, cache).count() == 3
    assert make(lambda *a: bytes(7), force=True) == {"u1": 14, "u2": 7, "u3": 7}
    with pytest.raises(checks.ConstraintError, match="no valid audio"):
        make(lambda *a: b"", force=True)
    side = units.select(audio.sidecar(F.col("tts_text"), F.lit("v"), F.lit("0%"), F.lit(5)).alias("j")).first().j
    assert json.loads(side).keys() == {"signature", "tts_text_sha256", "voice", "rate", "max_chars_per_request"}


def test_steps_that_are_up_to_date_are_left_out(tmp_path):
    a, b, c = (tmp_path / x for x in "abc")
    a.write_text("1")
    steps = [("one", [a], [b], lambda: b.write_text("2")), ("two", [b], [c], lambda: c.write_text("3"))]
    assert book.chain(steps) == ["one", "two"] and book.chain(steps) == [] and book.chain(steps, always=True) == ["one", "two"]
    os.utime(a, (2e9, 2e9))
    assert book.chain(steps) == ["one", "two"]


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text('tts:\n  voice: "k"\n  pause_ms: 5\n')
    assert book.settings(None, {}) == {"voice": "vi-VN-HoaiMyNeural", "rate": "-5%", "pause_ms": 350, "max_chars": 2500}
    assert book.settings(str(tmp_path / "c.yaml"), {"SPEECH_VOICE": " "})["voice"] == "k"
    assert book.settings(str(tmp_path / "c.yaml"), {"SPEECH_VOICE": "e"}) == {"voice": "e", "rate": "-5%", "pause_ms": 5, "max_chars": 2500}


def test_commands_from_archive_to_zip(spark, tmp_path, capsys):
    archive(tmp_path / "one.epub")
    run = lambda *args: book.main([str(a) for a in args])
    out, speech, target = tmp_path / "out", tmp_path / "speech", tmp_path / "package"
    assert run("all", tmp_path / "one.epub", out, "--chapters", 2) == 0 and run("all", tmp_path / "one.epub", out, "--chapters", 2) == 0
    assert "ran: extract, prepare, audit" in (said := capsys.readouterr().out) and "up to date" in said
    units = json.loads((out / "manifest.json").read_text())
    assert [s["id"] for s in units["sections"]] == ["introduction", "chapter_01", "chapter_02"] and "book_id" not in units
    assert json.loads((out / "metadata.json").read_text())["title"] == "Sách"
    assert {r["category"] for r in json.loads((out / "audit.json").read_text())} == {"percent", "currency"} or (out / "audit.json").read_text() == "[]\n"
    assert run("generate", out / "manifest.json", speech, "--section", "none") == 1
    assert run("generate", out / "manifest.json", speech, "--all", "--dry-run") == 0
    assert run("build", out / "book.json", out / "manifest.json", speech, target, "--all") == 1  # no timing yet
    assert run("generate", out / "manifest.json", speech, "--all") == 0
    timing = json.loads((speech / "chapter_01" / "chapter_01_timing.json").read_text())
    assert timing["audio"] == "chapter_01.mp3" and timing["units"][1]["clip_begin_ms"] == timing["units"][0]["clip_end_ms"] + 350
    for s in ("introduction", "chapter_01", "chapter_02"):
        (speech / s / f"{s}.mp3").write_bytes(b"sound")
    assert run("build", out / "book.json", out / "manifest.json", speech, target, "--all") == 0
    ids = "introduction,chapter_01,chapter_02"
    assert run("validate", tmp_path / "none") == 1
    assert run("package", target, tmp_path / "b.zip", "--sections", ids) == 0 and run("verify", tmp_path / "b.zip", "--sections", 3) == 0
    assert run("verify", tmp_path / "b.zip", "--sections", 4) == 1
    assert "uid: urn:uuid:" in capsys.readouterr().out
    assert run("check-metadata", out / "book.json") == 0 and run("extract", tmp_path / "no.epub", out) == 1
    (tmp_path / "b.zip").write_bytes(b"x")
    assert run("verify", tmp_path / "b.zip") == 1


def test_reconciliation_rules(spark):
    make = lambda rows: spark.createDataFrame(rows, "section_id string, ord int, id string, type string, display_text string")
    good = [("s", 0, "a", "heading", "A"), ("s", 1, "b", "paragraph", "B")]
    assert checks.reconciled(make(good), make(good), make(good).drop("display_text")).count() == 0
    rules = lambda m, t: sorted(r.rule for r in checks.reconciled(make(good), make(m), make(t)).collect())
    assert rules(good[:1], good) == ["manifest unit count", "timing unit count"]
    assert rules([good[0], ("s", 1, "c", "paragraph", "B")], good) == ["manifest id", "timing id"]
    assert rules([good[0], ("s", 1, "b", "subtitle", "X")], good) == ["manifest display text", "manifest type", "timing type"]


def test_audit(spark):
    display = "Giảm 7,5% còn $1.000 ở NASA, quỹ 401(k) 24/7 nặng 5kg <b> Warrant buffet và Bill Clinton SEC"
    rows = [("s", 0, 0, "u", "paragraph", display, display), ("s", 0, 1, "h", "heading", "TIÊU ĐỀ", "TIÊU ĐỀ"), ("s", 0, 2, "u", "paragraph", "NASA", "NASA"), ("s", 0, 3, "m", "paragraph", "NASA", "na-sa")]
    df = spark.createDataFrame(rows, "section_id string, section_ord int, ord int, id string, type string, display_text string, tts_text string")
    found = audit.issues(df).cache()
    got = {(r.unit_id, r.category, r.token) for r in found.collect()}
    assert got == {
        ("u", "acronym", "NASA"), ("u", "acronym", "401(k)"), ("u", "acronym", "SEC"), ("u", "decimal", "7,5"), ("u", "percent", "7,5%"), ("u", "currency", "$1.000"), ("u", "slash_expression", "24/7"), ("u", "attached_unit", "5kg"),
        ("u", "unusual_symbol", "<"), ("u", "unusual_symbol", ">"), ("u", "suspicious_source_text", "Warrant Buffet"), ("u", "unmapped_foreign_token", "Bill Clinton SEC"), ("h", "all_caps", "TIÊU ĐỀ"),
    }
    counts = {r.category: r.issues for r in audit.category_counts(found).collect()}
    assert counts["acronym"] == 3 and len(counts) == 10
    assert [r.token for r in audit.distinct_tokens(found).orderBy("token").collect()] == ["401(k)", "Bill Clinton SEC", "NASA", "SEC"]


def test_cache_lookup(spark):
    requests = timeline.signed(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "i int, t string"), "t", "v", "-5%", 2500)
    cache = requests.filter("i < 3").select("signature", F.when(F.col("i") == 2, 0).otherwise(10).alias("duration_ms"))
    assert [r.i for r in timeline.to_synthesize(requests, cache).orderBy("i").collect()] == [2, 3]
    assert [r.i for r in timeline.cached(requests, cache).collect()] == [1]
    assert timeline.to_synthesize(requests, cache, force=True).count() == 3


def test_dry_run(ready):
    _, units, _, _ = ready
    rows = {r.section_id: r for r in book.dry_run(units, 10).collect()}
    assert rows[None].units == 10 and rows[None].requests >= 10 and rows[None].characters == sum(r.characters for k, r in rows.items() if k)


def test_metadata_checks(spark, found):
    rules = {(r.rule, r.detail) for r in checks.metadata_violations(found["books"]).collect()}
    assert rules == set()
    broken = found["books"].withColumn("metadata", F.col("metadata").withField("title", F.lit(" ")).withField("source.isbn", F.lit("123")).withField("source.date", F.lit("2021")))
    assert {r.rule for r in checks.metadata_violations(broken).collect()} == {"required metadata", "source ISBN", "source date"}


def test_config_reader(tmp_path):
    text = '# c\nbook:\n  title: "T: x"\n  description: >\n    a\n    b\n  source:\n    date: "2021-01-01"\n    edition: null\ntts:\n  pause_ms: 350\nreplacements:\n  "S&P 500": "S and P"\n'
    (tmp_path / "c.yaml").write_text(text)
    assert config._plain(text)["book"] == {"title": "T: x", "description": "a b\n", "source": {"date": "2021-01-01", "edition": None}}
    assert config.pronunciation(tmp_path / "c.yaml") == {"S&P 500": "S and P"}
    assert config.section(tmp_path / "c.yaml", "tts") == {"pause_ms": 350}
    with pytest.raises(ValueError):
        config._plain("- a\n")
