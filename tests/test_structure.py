"""Books that are worked out in one row each."""

import os

import pytest
from pyspark.sql import functions as F

from quire import book_queries, queries  # noqa: F401  registers its queries
from quire.operators import structure

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
BOOKS = ("chapter_markers", "introductions", "book_sections", "book_violations", "book_blocks", "nested_books", "book_units", "unit_violations", "sparse_manifest", "book_summary")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", BOOKS)
def test_nothing_is_shuffled_or_sent_to_python(spark, name):
    plan = queries.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Exchange", "Window", "Join", "Python", "Pandas"))


def test_records_as_rows_and_nested(spark):
    none, cover = [], [("a.png", " image "), ("b.png", "a cat")]
    one = [(["block_"], "GIỚI THIỆU", none), (["block_3"], "", cover), (["block_2"], "lời đầu", none), (["block_3"], "  ", none), (["block_"], "2", none), (["x"], None, none), (["x", "block_"], "hai", none), (["block_10"], "　", cover), (["block_3"], "text", cover), (["block_3"], "more", none), (["block_"], "1", none), (["block_"], "một", none), (["block_2"], "s", none), (["block_"], "2", none), (["block_"], "hai", none), (["block_2"], "s", none), (["x"], "t", none)]
    two = [(["block_3"], "no heading", cover)]
    rows = spark.createDataFrame([(b, 10 * o, *r) for b, records in enumerate((one, two)) for o, r in enumerate(records)], "book_id long, ord long, classes array<string>, text string, images array<struct<src:string,alt:string>>")
    books = structure.outlined(rows, 3).cache()
    assert sorted(map(tuple, structure.chapter_markers(books).select("number", "marker_ord", "title_ord", "subtitle_ord").collect())) == [(1, 100, 110, 120), (2, 40, 60, 70), (2, 130, 140, 150)]
    assert sorted((r.rule, r.key, r.detail) for r in structure.outline_violations(books, 3).collect()) == [("chapter count", "1", ""), ("chapter order", "0", "2,1,2"), ("introduction", "1", None)]
    nested = structure.structured(structure.outlined(structure.by_book(rows.orderBy(F.rand(1))), 3)).cache()
    assert nested.collect() == structure.structured(books).collect()
    # the cover's images stand in the introduction, those of a heading in its section, before a record's own text
    blocks = structure.flattened(nested)[1].orderBy("section_ord", "block_ord").collect()
    assert [(r.section_id, r.block_ord, r.type, r.display_text or r.src, r.id, r.needs_alt_review) for r in blocks] == [
        ("introduction", 1, "image", "a.png", None, True), ("introduction", 2, "image", "b.png", None, False), ("introduction", 3, "paragraph", "  ", "introduction_p0001", None),
        ("chapter_02", 1, "image", "a.png", None, True), ("chapter_02", 2, "image", "b.png", None, False), ("chapter_02", 3, "image", "a.png", None, True), ("chapter_02", 4, "image", "b.png", None, False), ("chapter_02", 5, "paragraph", "text", "chapter_02_p0001", None), ("chapter_02", 6, "paragraph", "more", "chapter_02_p0002", None),
        ("chapter_02", 1, "paragraph", "t", "chapter_02_p0001", None),
    ]
    assert tuple(structure.summary(nested).first()) == (0, 3, True, 4, 6, 3) == tuple(structure.summary(*structure.flattened(nested)).first())
    # a second chapter 2: its section's id and the ids of its title and first paragraph come twice; a subtitle is blank
    broken = structure.unit_violations(structure.with_units(nested), spark.range(0).selectExpr("'' AS id", "'' AS tts_text")).collect()
    assert sorted((r.rule, r.key, r.detail) for r in broken) == [("duplicate section id", "0/chapter_02", "2"), ("duplicate unit id", "0/chapter_02_p0001", "2"), ("duplicate unit id", "0/chapter_02_title", "2"), ("paragraph without text", "introduction_p0001", None)]


def test_padded_ids_of_long_sections(spark):
    n = spark.range(1).select(structure._padded(F.lit(7)).alias("a"), structure._padded(F.lit(12345)).alias("b")).first()
    assert tuple(n) == ("0007", "12345")


def test_alt_texts_are_judged_as_in_their_normal_form(spark):
    from quire.functions import text

    base = ["image", "a.png", "a.jpeg", "undefined", " ", "x.gif", "IMAGE"]
    marks = ["́", "̇", "̸", " ", "K", "`", "İ", ";", "　"]
    values = sorted({b[:k] + m + b[k:] for b in base for m in marks for k in range(len(b) + 1)})
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", text.needs_alt_review(F.col("v")).alias("here"), text.needs_alt_review(text.nfc(F.col("v"))).alias("there"), text.has_text(F.col("v")).alias("some"), (text.spoken_form(F.col("v")) != "").alias("said"))
    assert not [r for r in rows.collect() if r.here != r.there or r.some != r.said]
