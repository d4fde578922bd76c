"""Speech normalization of Vietnamese text: numbers, units, fractions, money, ranges, in a fixed order of rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import NUM, WS, heading_case, heading_override, literal_map, regex_sub, replace_all, respaced, spoken_form

# Words, units, fractions and phrases of spoken Vietnamese.
DIGITS = ("không", "một", "hai", "ba", "bốn", "năm", "sáu", "bảy", "tám", "chín")
SCALES = ("", " nghìn", " triệu", " tỷ")
UNITS = {"cm": "xen-ti-mét", "kg": "ki-lô-gam", "gb": "ghi-ga-bai", "m2": "mét vuông", "m²": "mét vuông"}
GLYPHS = {
    "¼": "một phần tư", "½": "một phần hai", "¾": "ba phần tư", "⅐": "một phần bảy", "⅑": "một phần chín", "⅓": "một phần ba",
    "⅔": "hai phần ba", "⅛": "một phần tám", "⅜": "ba phần tám", "⅝": "năm phần tám", "⅞": "bảy phần tám",
}
FRACTIONS = {
    "1/2": "một phần hai", "1/3": "một phần ba", "2/3": "hai phần ba", "1/4": "một phần tư", "3/4": "ba phần tư",
    "1/5": "một phần năm", "1/6": "một phần sáu", "1/8": "một phần tám", "3/8": "ba phần tám", "1/10": "một phần mười",
}
SLASHED = {"24/7": "hai mươi bốn giờ một ngày, bảy ngày một tuần", "11/9": "ngày mười một tháng chín", "50/50": "năm mươi năm mươi"}
RETIREMENT_PLAN = "bốn không một k"


def _hundreds(n: int) -> str:
    """Words of 0 to 999."""
    tens, ones = divmod(n % 100, 10)
    ending = {0: "", 5: " lăm"} | ({1: " mốt"} if tens > 1 else {})
    low = DIGITS[ones] if not tens else ("mười" if tens == 1 else f"{DIGITS[tens]} mươi") + ending.get(ones, f" {DIGITS[ones]}")
    if n < 100:
        return low
    link = "" if n % 100 == 0 else f" lẻ {low}" if n % 100 < 10 else f" {low}"
    return f"{DIGITS[n // 100]} trăm{link}"


#: The words of 0 to 999 as one constant of the plan, built from the rule above.
_TABLE = "|".join(map(_hundreds, range(1000)))


def _word(n: Column) -> Column:
    return F.element_at(F.split(F.lit(_TABLE), "[|]"), n.cast("int") + 1)


def integer_words(digits: Column) -> Column:
    """Words of a string of digits of any length. Groups of three that are zero are silent; from 10**12 on groups have no scale word."""
    groups = F.ceil(F.length(digits) / 3).cast("int")
    padded = F.lpad(digits, groups * 3, "0")
    names = F.array(*[F.lit(s) for s in SCALES])

    def group(i: Column) -> Column:
        n = F.substring(padded, i * 3 - 2, F.lit(3)).cast("int")
        scale = F.coalesce(F.try_element_at(names, groups - i + 1), F.lit(""))
        return F.when(n > 0, F.concat(_word(n), scale))

    words = F.array_join(F.filter(F.transform(F.sequence(F.lit(1), groups), group), lambda x: x.isNotNull()), " ")
    return F.when(words == "", DIGITS[0]).otherwise(words)


def digit_words(digits: Column) -> Column:
    return F.array_join(F.transform(F.filter(F.split(digits, ""), lambda d: d != ""), _word), " ")


def decimal_words(whole: Column, fraction: Column) -> Column:
    return F.concat(F.when(whole.isin("", "0"), DIGITS[0]).otherwise(integer_words(whole)), F.lit(" phẩy "), digit_words(fraction))


def number_words(c: Column) -> Column:
    """Groups of three after dots are thousands, one dot or comma otherwise a decimal; anything else stays as it is."""
    c = F.replace(F.trim(c), F.lit(" "), F.lit(""))
    return (
        F.when(c.rlike(r"^[0-9]+(?:\.[0-9]{3})+$"), integer_words(F.replace(c, F.lit("."), F.lit(""))))
        .when(c.rlike(r"^[0-9]+[.,][0-9]+$"), decimal_words(F.regexp_extract(c, r"^([0-9]+)[.,]", 1), F.regexp_extract(c, r"[.,]([0-9]+)$", 1)))
        .when(c.rlike(r"^[0-9]+$"), integer_words(c))
        .otherwise(c)
    )


def _first(m: Column) -> Column:
    return number_words(F.regexp_extract(m, f"({NUM})", 1))


def _last(m: Column) -> Column:
    return number_words(F.regexp_extract(m, rf"^.*?{NUM}[^0-9]+({NUM})", 1))


def _unit_word(m: Column) -> Column:
    return F.try_element_at(literal_map(UNITS), F.lower(F.regexp_extract(m, r"(?iU)(cm|kg|GB|m2|m²)$", 1)))


def _measures(c: Column) -> Column:
    return regex_sub(c, rf"(?iU){NUM}{WS}*(?:cm|kg|GB|m2|m²)", lambda m: F.concat(_first(m), F.lit(" "), _unit_word(m)))


def _units(c: Column) -> Column:
    return regex_sub(c, r"(?iU)(?<![A-Za-zÀ-ỹ])(?:cm|kg|GB|m2|m²)(?![A-Za-zÀ-ỹ])", _unit_word)


def _phones(c: Column) -> Column:
    return regex_sub(c, r"(?<![0-9])[0-9]{3}-[0-9]{4}(?![0-9])", lambda m: F.concat(digit_words(F.substring(m, 1, 3)), F.lit(", "), digit_words(F.substring(m, 5, 4))))


def _fractions(c: Column) -> Column:
    number = lambda m, i: F.regexp_replace(F.regexp_extract(m, rf"(?U)^([0-9]+){WS}*/{WS}*([0-9]+)$", i), "^0+(?=[0-9])", "")
    return regex_sub(c, rf"(?U)(?<!\w)[0-9]+{WS}*/{WS}*[0-9]+(?!\w)", lambda m: F.coalesce(F.try_element_at(literal_map(FRACTIONS), F.concat(number(m, 1), F.lit("/"), number(m, 2))), m))


def _ranges(c: Column) -> Column:
    suffix = lambda m: F.when(m.endswith("°C"), " độ C").otherwise("")
    return regex_sub(c, rf"(?U)(?<!\w){NUM}{WS}*(?:–|—|-){WS}*{NUM}(?:{WS}*°C)?(?!\w)", lambda m: F.concat(F.lit("từ "), _first(m), F.lit(" đến "), _last(m), suffix(m)))


def _infix(c: Column, sign: str, word: str) -> Column:
    return regex_sub(c, rf"(?U){NUM}{WS}*{sign}{WS}*{NUM}", lambda m: F.concat(_first(m), F.lit(f" {word} "), _last(m)))


def rules(pronunciation: Mapping[str, str]) -> list[tuple[str, object]]:
    """(name, Column -> Column) in the order that is their meaning; the first two are for headings only."""
    after = lambda s: (lambda m: F.concat(_first(m), F.lit(s)))
    period = rf"(?U)\$({NUM}){WS}*/{WS}*(tháng|năm|tuần|ngày)"

    def slashed(c: Column) -> Column:
        for k, v in SLASHED.items():
            c = F.regexp_replace(c, rf"(?U)(?<!\w){k}(?!\w)", v)
        return c

    return [
        ("heading override", lambda c: heading_override(c, pronunciation)),
        ("heading case", heading_case),
        ("ampersand", lambda c: F.regexp_replace(c, rf"(?U)(?<={WS})&(?={WS})", "và")),
        ("fraction glyphs", lambda c: replace_all(c, GLYPHS)),
        ("phone", _phones),
        ("retirement plan", lambda c: F.regexp_replace(c, rf"(?iU)(?<!\w)[0-9]{{3}}{WS}*\({WS}*k{WS}*\)(?!\w)", RETIREMENT_PLAN)),
        ("slashed", slashed),
        ("fractions", _fractions),
        ("measures", _measures),
        ("units", _units),
        ("currency rate", lambda c: regex_sub(c, period, lambda m: F.concat(number_words(F.regexp_extract(m, period, 1)), F.lit(" đô la mỗi "), F.regexp_extract(m, period, 2)))),
        ("multiple range", lambda c: regex_sub(c, rf"(?U){NUM}x{WS}*(?:–|-){WS}*{NUM}x", lambda m: F.concat(F.lit("gấp "), _first(m), F.lit(" đến "), _last(m), F.lit(" lần")))),
        ("multiple", lambda c: regex_sub(c, rf"(?U)(?<!\w){NUM}x(?!\w)", lambda m: F.concat(F.lit("gấp "), _first(m), F.lit(" lần")))),
        ("plus", lambda c: _infix(c, r"\+", "cộng")),
        ("times", lambda c: _infix(c, "×", "nhân")),
        ("range", _ranges),
        ("temperature", lambda c: regex_sub(c, rf"(?U){NUM}{WS}*°C", after(" độ C"))),
        ("currency", lambda c: regex_sub(c, rf"\${NUM}", after(" đô la"))),
        ("percent", lambda c: regex_sub(c, rf"{NUM}%", after(" phần trăm"))),
        ("number", lambda c: regex_sub(c, rf"(?U)(?<![\w.,]){NUM}(?![\w.,(])", number_words)),
        ("pronunciation", lambda c: replace_all(c, pronunciation)),
    ]


#: What a text must have somewhere for a rule to find anything.
SIGNS = {
    "phone": "[0-9]-[0-9]", "retirement plan": r"\(", "slashed": "/", "fractions": "/", "measures": "(?i)cm|kg|gb|m2|m²", "units": "(?i)cm|kg|gb|m2|m²", "currency rate": r"\$[0-9]", "multiple range": "[0-9]x", "multiple": "[0-9]x",
    "plus": r"\+", "times": "×", "range": "[–—-]", "temperature": "°C", "currency": r"\$[0-9]", "percent": "[0-9]%",
}


def with_speech_text(df, source: str, target: str, unit_type: str | None = None, pronunciation: Mapping[str, str] | None = None):
    """`df` with `target`, the speech form of `source`; unit_type names the column of heading, subtitle or paragraph.

    Each rule is a projection of its own: rules use their input several times, so one
    nested expression would grow with each. No rule writes digits, so texts that have
    none after the headings' rules skip all rules on numbers, and each rule is skipped
    where its sign is missing.
    """
    text, numeric = F.col(f"`{target}`"), f"{target} has digits"
    df = df.withColumn(target, spoken_form(F.col(f"`{source}`")))
    for name, rule in rules(pronunciation or {}):
        if name.startswith("heading"):
            if unit_type is not None:
                df = df.withColumn(target, F.when(F.col(f"`{unit_type}`").isin("heading", "title", "subtitle"), rule(text)).otherwise(text))
            continue
        if name == "ampersand":
            df = df.withColumn(numeric, text.rlike("[0-9]"))
        plain = name in ("ampersand", "fraction glyphs", "units", "pronunciation")
        gate = None if plain else F.col(f"`{numeric}`")
        if name in SIGNS:
            sign = text.rlike(SIGNS[name])
            gate = sign if gate is None else gate & sign
        df = df.withColumn(target, rule(text) if gate is None else F.when(gate, rule(text)).otherwise(text))
    return df.withColumn(target, respaced(text)).drop(numeric)
