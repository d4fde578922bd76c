"""Golden values of the text rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.functions import ids, text
from quire.functions.speech import integer_words, number_words, with_speech_text
from quire.operators.chunks import chunks, exploded, with_chunks

DECOMPOSED = "Tiếng"


def values(spark, rows, make):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, x string")
    return [r.v for r in df.select("i", make(F.col("x")).alias("v")).orderBy("i").collect()]


def test_normal_forms(spark):
    rows = [f" {DECOMPOSED}  a\n\tb ", "", None, "a\x1cb"]
    assert values(spark, rows, text.strict) == ["Tiếng a b", "", None, "a b"]
    assert values(spark, ["a  b\n c , d !", " x ", None], text.spoken_form) == ["a b\n c, d!", "x", None]


def test_heading_case_and_override(spark):
    rows = ["CHUYỆN TIỀN", "Chương 1. MÈO ĐI HỌC.", "Chương 2. May mắn", "Thường", "123"]
    assert values(spark, rows, text.heading_case) == ["Chuyện tiền", "Chương 1. Mèo đi học.", "Chương 2. May mắn", "Thường", "123"]
    table = {"NẮNG >< MƯA": "Nắng khác mưa"}
    rows = ["NẮNG >< MƯA", "Chương 3. NẮNG >< MƯA.", "khác"]
    assert values(spark, rows, lambda c: text.heading_override(c, table)) == ["Nắng khác mưa", "Chương 3. Nắng khác mưa.", "khác"]


def test_chapter_heading(spark):
    assert values(spark, ["Chương 1: a", "CHAPTER iv x", "chapterhouse", None], text.is_chapter_heading) == [True, True, False, False]


def test_longest_replacement_first_and_cascading(spark):
    assert values(spark, ["abc ab"], lambda c: text.replace_all(c, {"ab": "x", "abc": "ab!"})) == ["x! x"]


@pytest.mark.parametrize(
    ("n", "words"),
    [
        ("0", "không"), ("000", "không"), ("5", "năm"), ("10", "mười"), ("15", "mười lăm"), ("21", "hai mươi mốt"), ("25", "hai mươi lăm"), ("40", "bốn mươi"), ("101", "một trăm lẻ một"), ("115", "một trăm mười lăm"),
        ("300", "ba trăm"), ("1000", "một nghìn"), ("1005", "một nghìn năm"), ("2000000", "hai triệu"), ("1000000001", "một tỷ một"), ("1234000000000", "một hai trăm ba mươi bốn tỷ"),
    ],
)
def test_integer_words(spark, n, words):
    assert values(spark, [n], integer_words) == [words]


def test_number_words(spark):
    rows = ["1.000", "0.125", "3,5", "3,000", "1,000,000", "1.234,5", "2.5", "", "12"]
    want = ["một nghìn", "một trăm hai mươi lăm", "ba phẩy năm", "ba phẩy không không không", "1,000,000", "1.234,5", "hai phẩy năm", "", "mười hai"]
    assert values(spark, rows, number_words) == want


SPEECH = {
    "5kg gạo": "năm ki-lô-gam gạo",
    "10 m²": "mười mét vuông",
    "½ cốc": "một phần hai cốc",
    "gọi 555-1234 ngay": "gọi năm năm năm, một hai ba bốn ngay",
    "quỹ 401(k) và 401 (k)": "quỹ bốn không một k và bốn không một k",
    "mở 24/7": "mở hai mươi bốn giờ một ngày, bảy ngày một tuần",
    "ăn 3/4 cái": "ăn ba phần tư cái",
    "tỉ lệ 7/9": "tỉ lệ bảy/chín",
    "$5/tháng": "năm đô la mỗi tháng",
    "tăng 2x – 3x": "tăng gấp hai đến ba lần",
    "tăng 10x": "tăng gấp mười lần",
    "2 + 3": "hai cộng ba",
    "2 × 3": "hai nhân ba",
    "10–20 người": "từ mười đến hai mươi người",
    "20-25°C": "từ hai mươi đến hai mươi lăm độ C",
    "lạnh 5°C": "lạnh năm độ C",
    "giá $1.000": "giá một nghìn đô la",
    "lãi 7,5%": "lãi bảy phẩy năm phần trăm",
    "năm 140. Rồi": "năm 140. Rồi",
    "R & D": "R và D",
    "không có số": "không có số",
}


def test_speech_rules(spark):
    df = spark.createDataFrame(list(SPEECH.items()), "x string, want string")
    got = with_speech_text(df, "x", "v").collect()
    assert [(r.x, r.v) for r in got if r.v != r.want] == []


def test_speech_of_headings_only(spark):
    df = spark.createDataFrame([("CHUYỆN TIỀN", "heading"), ("CHUYỆN TIỀN", "paragraph"), (None, "paragraph")], "x string, t string")
    assert [r.v for r in with_speech_text(df, "x", "v", "t").collect()] == ["Chuyện tiền", "CHUYỆN TIỀN", None]


def test_clocks(spark):
    ms = [0, 3590, 14126, 61500, 3661001, 3661007, -1, None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(ms)], "i int, m long").withColumn("c", ids.clock(F.col("m"))).withColumn("d", ids.duration(F.col("m")))
    rows = df.withColumn("back", ids.clock_ms(F.col("c"))).orderBy("i").collect()
    assert [r.c for r in rows] == ["0:00:00.000", "0:00:03.590", "0:00:14.126", "0:01:01.500", "1:01:01.001", "1:01:01.007", None, None]
    assert rows[4].d == "01:01:01.001"
    assert [r.back for r in rows] == [0, 3590, 14126, 61500, 3661001, 3661007, None, None]
    assert values(spark, ["npt=1s", "0:60:00", "1:2:3", "0:00:01.5", " 0:00:01 ", ""], ids.clock_ms) == [None, None, None, 1500, 1000, None]


def test_isbn(spark):
    rows = ["978-1-2345-6789-7", "urn:isbn:9781234567897", "ISBN 978 1 2345 6789 7", "9781234567898", "0-306-40615-2", "", None]
    assert values(spark, rows, ids.isbn13) == ["9781234567897"] * 3 + [None] * 4
    assert values(spark, rows[:1], ids.isbn_urn) == ["urn:isbn:9781234567897"]


def test_book_uid_matches_the_standard_library(spark):
    import json
    import uuid

    meta = {"author": 'Ai "đó"', "language": "vi", "title": "Tiền\\x"}
    want = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(meta, ensure_ascii=False, sort_keys=True, separators=(',', ':')))}"
    df = spark.createDataFrame([(meta["title"], meta["author"], meta["language"]), (" ", "a", "vi")], "t string, a string, l string")
    assert [r.u for r in df.select(ids.book_uid(F.col("t"), F.col("a"), F.col("l")).alias("u")).collect()] == [want, None]


def test_signature_matches_json(spark):
    import hashlib
    import json

    inputs = {"tts_text": 'một "hai"\n', "voice": "v", "rate": "-5%", "max_chars_per_request": 2500}
    want = hashlib.sha256(json.dumps(inputs, ensure_ascii=False, sort_keys=True).encode()).hexdigest()
    assert values(spark, [inputs["tts_text"]], lambda c: ids.request_signature(c, F.lit("v"), F.lit("-5%"), F.lit(2500))) == [want]


def test_excerpt(spark):
    long = "a" * 200 + " 12% " + "b" * 200
    got = values(spark, [long, "short 12%", "c" * 200], lambda c: text.excerpt(c, F.lit("12%")))
    assert len(got[0]) == 160 and got[0].startswith("...") and got[0].endswith("...") and "12%" in got[0]
    assert got[1] == "short 12%" and got[2] == "c" * 157 + "..."


def test_predicates(spark):
    assert values(spark, ["", "Image", "a b.png", "x.jpeg", "A cat"], text.needs_alt_review) == [True, True, False, True, False]
    assert values(spark, ["a", "..", "a/b", "a\\b", ""], text.is_safe_id) == [True, False, False, False, False]
    assert values(spark, ["1,5", "1,000,0", "1.000", "1.5", "15"], text.is_decimal_token) == [True, False, False, True, False]
    assert values(spark, ["a.html", "../x/./b%20c+d.png?q#f", "../../y", "/abs"], lambda c: text.resolved_path(F.lit("OPS/text/doc.html"), c, query=True)) == ["OPS/text/a.html", "OPS/x/b c+d.png", "y", None]


def test_ssml_escapes(spark):
    assert values(spark, ["a < b & c"], lambda c: text.ssml(c, F.lit("v"), F.lit("-5%"))) == ['<speak version="1.0" xml:lang="vi-VN"><voice name="v"><prosody rate="-5%">a &lt; b &amp; c</prosody></voice></speak>']


def chunks_by_hand(source, limit):
    """Chunks by their definition, on plain strings."""
    if len(source) <= limit:
        return [source] if source else []
    out, line = [], None
    for sentence in filter(None, map(str.strip, re.split(r"(?<=[.!?…])\s+", source))):
        if line is not None and len(line) + 1 + len(sentence) <= limit:
            line += " " + sentence
            continue
        if line is not None:
            out.append(line)
        while len(sentence) > limit:
            cut = sentence.rfind(" ", 0, limit + 1)
            cut = cut if cut > 0 else limit
            out.append(sentence[:cut].strip())
            sentence = sentence[cut:].lstrip()
        line = sentence
    return out + ([line] if line else [])


@pytest.mark.parametrize("limit", [1, 2, 5, 17, 40, 1000])
def test_chunks_equal_their_definition(spark, limit):
    rng = random.Random(limit)
    rows = ["", "a", "Một hai ba. Bốn! " * 9 + "x" * 55 + " cuối cùng…", "x" * 120, "a b", None]
    for _ in range(150):
        rows.append("".join(rng.choice(["a", "bé", "dài" * 9, " ", " ", ". ", "! ", "…\n", ".", "?  ", "\n", "\t"]) for _ in range(rng.randint(0, 60))).strip())
    got = values(spark, rows, lambda c: chunks(c, limit))
    assert got == [None if r is None else chunks_by_hand(r, limit) for r in rows]
    assert all(0 < len(c) <= limit for r in got if r for c in r)
    with pytest.raises(ValueError):
        chunks(F.lit("a"), 0)


def test_exploded_chunks(spark):
    df = with_chunks(spark.createDataFrame([(1, "Một hai. Ba bốn."), (2, ""), (3, None)], "i int, x string"), "x", "c", 9)
    assert [tuple(r) for r in exploded(df, "c").select("i", "chunk_id", "chunk").orderBy("i", "chunk_id").collect()] == [(1, "chunk_0001", "Một hai."), (1, "chunk_0002", "Ba bốn.")]
