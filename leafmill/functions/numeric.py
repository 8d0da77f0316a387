"""Damaged numbers: detectors, repair and parsing, in Column expressions.

Detectors use Unicode-aware classes, so that Arabic-Indic digits are digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

# The patterns that define the detectors.
MALFORMED = r"(?U)\b\d+[\.,]\d+[\.,]\d+\b|\b\d{1,3}(?:,\d{3})*\.\d+\.\d+\b"
NEGATIVE_TOTAL = r"(?iU)(total\s+(assets|revenue|equity|liabilities)|net\s+(profit|income))\s*[:\-]?\s*-\s*\d"
DELIMITERS = r"(?U)\d[\.,]{2,}\d|\b\d{1,3}(?:[\.,]\d{1,2}){3,}\b|\b\d{3,},\d{1,2}\b"
TOKEN = r"\(?[A-Za-z0-9٠-٩]{1,4}[\.,][A-Za-z0-9٠-٩]{1,4}\)?"
GROUPED = r"(?U)\(?\b\d{1,3}(?:,\d{3})+\b\)?"
TRUNCATED = r"(?U)\b\d{1,3},\d{1,2}\b"

# Letters that recognition confuses with digits, by digit; and the Arabic-Indic digits.
GLYPHS = {"0": "OoDQ", "1": "IlL", "2": "Zz", "3": "EecC", "4": "Aa", "5": "Ss", "6": "Ggd", "7": "T", "8": "B", "9": "q"}
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"

def _from(starts: str, pattern: str) -> str:
    """``pattern``, which looks for word boundaries only where it may start: these are dear in Unicode."""
    flags, body = pattern.split(")", 1)
    return f"{flags})(?={starts})(?:{body})"


CODES = ("delimiter_corruption", "digit_glyph_confusion", "impossible_negative_total", "malformed_decimal")


def malformed_decimal(c: Column | str) -> Column:
    return _col(c).rlike(_from(r"\d", MALFORMED))


def impossible_negative_total(c: Column | str) -> Column:
    return _col(c).rlike(NEGATIVE_TOTAL)


def delimiter_corruption(c: Column | str) -> Column:
    return _col(c).rlike(_from(r"\d", DELIMITERS))


def _tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(TOKEN), F.lit(0))


def glyph_confusion(c: Column | str) -> Column:
    """Some number-like token mixes Latin letters with digits, or ASCII digits with Arabic-Indic ones."""
    letter, digit, arabic = (lambda x: x.rlike("[A-Za-z]")), (lambda x: x.rlike("[0-9]")), (lambda x: x.rlike("[٠-٩]"))
    return F.exists(_tokens(c), lambda x: (letter(x) & (digit(x) | arabic(x))) | (digit(x) & arabic(x)))


def reason_codes(c: Column | str) -> Column:
    """The sorted codes of the detectors that fire; none for an empty text."""
    found = [F.when(test(c), F.lit(code)) for code, test in zip(CODES, (delimiter_corruption, glyph_confusion, impossible_negative_total, malformed_decimal), strict=True)]
    return F.when(_col(c).isNotNull(), F.array_compact(F.array(*found)))


def digits_of(c: Column) -> Column:
    """Each sign as the digit that it stands for; others go."""
    signs = "".join(GLYPHS.values()) + ARABIC_DIGITS
    digits = "".join(d * len(s) for d, s in GLYPHS.items()) + "0123456789"
    return F.regexp_replace(F.translate(c, signs, digits), "[^0-9]", "")


def repair_token(token: Column) -> Column:
    """Both sides of the delimiter as digits, at most three on the right; the delimiter becomes a comma; a token with an empty side stays."""
    sides = F.split(F.translate(token, "()", ""), "[.,]")
    left, right = digits_of(sides[0]), digits_of(sides[1])
    opened, closed = F.when(token.startswith("("), "(").otherwise(""), F.when(token.endswith(")"), ")").otherwise("")
    return F.when((left == "") | (right == ""), token).otherwise(F.concat(opened, left, F.lit(","), F.substring(right, 1, 3), closed))


def repair_numbers(c: Column | str) -> Column:
    """Every number-like token repaired, the text between unchanged."""
    gaps = F.split(_col(c), TOKEN, -1)
    return F.array_join(F.zip_with(gaps, F.transform(_tokens(c), repair_token), lambda g, t: F.concat(g, F.coalesce(t, F.lit("")))), "")


def grouped_fidelity(c: Column | str) -> Column:
    """Well-grouped numbers less truncated ones, at least 0."""
    return F.greatest(F.regexp_count(_col(c), F.lit(_from(r"[(\d]", GROUPED))) - F.regexp_count(_col(c), F.lit(_from(r"\d", TRUNCATED))), F.lit(0))


def sanity_status(codes: Column, second_pass: Column) -> Column:
    return F.when(F.size(codes) > 0, "suspicious").when(second_pass, "repaired").otherwise("clean")


def parse_decimal(c: Column | str) -> Column:
    """The number at the start, after spaces and grouping signs are removed; null if there is none."""
    bare = F.regexp_replace(_col(c), "[ ,٬]", "")
    return F.nullif(F.regexp_extract(bare, r"^[+-]?(?:\d+\.?\d*|\.\d+)", 0), F.lit("")).try_cast("decimal(38,9)")
