"""Currency units of financial pages, and values scaled to them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import parse_decimal
from .text import _col

THOUSANDS, UNITS = "KD_000", "KWD"


def latin_form(c: Column | str) -> Column:
    """Upper case, with one kind of apostrophe."""
    return F.translate(F.upper(_col(c)), "’‘´`", "''''")


def arabic_form(c: Column | str) -> Column:
    """Lower case, with one form of alef, yeh and teh marbuta, without tatweel."""
    return F.translate(F.lower(_col(c)), "أإآىةـ", "ااايه")


def source_unit(c: Column | str) -> Column:
    """``KD_000`` if the text, without spaces, hints at thousands, else ``KWD``."""
    bare = lambda x: F.regexp_replace(x, r"[\s\p{Z}]+", "")
    hint = bare(latin_form(c)).rlike(r"KW?D'?000|000KW?D") | bare(arabic_form(c)).rlike("الف|الاف")
    return F.when(hint, THOUSANDS).when(_col(c).isNotNull(), UNITS)


def scale_value(value: Column, unit: Column) -> Column:
    """Thousands multiplied out."""
    return F.when(unit == THOUSANDS, value * 1000).otherwise(value)


def value_from_text(literal: Column | str, hint: Column | str) -> Column:
    """A literal parsed and scaled by the unit in the hint; null if it is no number."""
    return scale_value(parse_decimal(literal), source_unit(hint))
