"""What is in normal form already isn't sent to Python."""

import re
import sys
import unicodedata

from pyspark.sql import functions as F

from quire.functions import text


def test_settled_characters_never_compose_or_move():
    settled = re.compile("[" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: rf"\U{int(m[1], 16):08x}", text.SETTLED) + "]")
    # all but the first character of a decomposition may compose with what is before them; so may vowels and finals of syllables
    later = {x for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.decomposition(c) and "<" not in unicodedata.decomposition(c) for x in unicodedata.normalize("NFD", c)[1:]}
    later |= {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    wrong = [hex(ord(c)) for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000 and settled.match(c) and (unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c or c in later)]
    assert not wrong


def test_only_texts_that_may_change_are_sent(spark):
    values = ["", "abc", "Tiếng Việt “đủ” dấu – 5 °C…", "Tie\u0302\u0301ng", "a\u0323\u0302", "\u212b \u212a", "\u1100\u1161\u11a8", "가\u11a8", "\u0344", "漢字 😀", "q\u0307\u0323", "שׁ", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").withColumn("sent", F.col("v").rlike(f"[^{text.SETTLED}]")).select("i", "sent", text.nfc(F.col("v")).alias("n"))
    got = {r.i: (r.sent, r.n) for r in rows.collect()}
    assert [got[i][1] for i in range(len(values))] == [None if v is None else unicodedata.normalize("NFC", v) for v in values]
    assert [i for i in got if got[i][0] is False] == [0, 1, 2, 9]
