"""Text scalars as Column expressions: all run in the JVM and take null to null, unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as trimming sees it: all separators, tab to carriage return, and the next-line control.
SPACE = r"[\p{Z}\t\n\x0B\f\r\x{85}]"
LINE_SPACE = r"[\p{Zs}\t]"
#: Characters that count as sane besides letters, marks, numbers and separators.
SANE = r"""\p{L}\p{M}\p{N}\p{Z}\t\n\x0B\f\r\x{85}+\-–—()\[\]{}%.,:;/\\'"&\x{0600}-\x{06FF}"""
CHUNK_BYTES = 1200


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_space(c: Column | str) -> Column:
    """Strip white space of any kind at both ends."""
    return F.regexp_replace(_col(c), rf"\A{SPACE}+|{SPACE}+\z", "")


def blank_to_null(c: Column | str) -> Column:
    """Trimmed; blank as null."""
    t = trim_space(c)
    return F.when(t != "", t)


#: Characters that may be one with another: carriage returns, and all beyond the letters and signs of Latin, Greek, Cyrillic and Arabic and common punctuation.
JOINING = r"[\r\x{300}-\x{36F}\x{483}-\x{489}\x{530}-\x{61F}\x{64B}-\x{65F}\x{670}-\x{200F}\x{2028}-\x{202F}\x{205F}-\x{209F}\x{20D0}-\x{10FFFF}]"


def grapheme_count(c: Column | str) -> Column:
    """User-perceived characters: a letter with its marks, or a line end of two characters, counts once. Most texts have nothing that joins, and are as long as they have code points."""
    return F.when(_col(c).rlike(JOINING), F.length(F.regexp_replace(_col(c), r"\X", "x"))).otherwise(F.length(_col(c)))


def language_sanity(c: Column | str) -> Column:
    """The share of sane code points; 0 for an empty text."""
    t = _col(c)
    kept = F.length(F.regexp_replace(t, f"[^{SANE}]", ""))
    return F.when(t == "", 0.0).otherwise(kept / F.nullif(F.length(t), F.lit(0)))


def normalize_text(c: Column | str) -> Column:
    """Lines trimmed of horizontal space, blank ones dropped; carriage returns end lines too."""
    lines = F.split(F.translate(_col(c), "\r", "\n"), "\n", -1)
    trimmed = F.transform(lines, lambda x: F.regexp_replace(x, rf"\A{LINE_SPACE}+|{LINE_SPACE}+\z", ""))
    return F.array_join(F.filter(trimmed, lambda x: trim_space(x) != ""), "\n")


def chunk_count(c: Column | str, size: int = CHUNK_BYTES) -> Column:
    """The number of chunks when code points are added until a chunk has ``size`` bytes of UTF-8.

    A chunk may exceed the size by the rest of its last code point, at most 3
    bytes. Where the count is the same without that and with the most of it,
    it is plain arithmetic; only the other texts are folded.
    """
    t = trim_space(c)
    n = F.octet_length(t)
    least, most = F.ceil(n / (size + 3)), F.ceil(n / size)
    point = lambda a, x: F.when(
        a["c"] + F.octet_length(x) >= size, F.struct((a["n"] + 1).alias("n"), F.lit(0).alias("c"))
    ).otherwise(F.struct(a["n"].alias("n"), (a["c"] + F.octet_length(x)).alias("c")))
    folded = F.aggregate(F.split(t, ""), F.struct(F.lit(0).alias("n"), F.lit(0).alias("c")), point, lambda a: a["n"] + F.when(a["c"] > 0, 1).otherwise(0))
    return F.when(least == most, most).otherwise(folded.cast("bigint"))


def parse_languages(c: Column | str, default: str = "en") -> Column:
    """Entries between commas, trimmed, without empty ones; ``default`` if there is none."""
    entries = F.filter(F.transform(F.split(F.coalesce(_col(c), F.lit("")), ",", -1), trim_space), lambda x: x != "")
    return F.when(F.size(entries) == 0, F.array(F.lit(default))).otherwise(entries)


def cli_languages(c: Column | str) -> Column:
    """As on the command line: empty pieces go before trimming, so blank ones stay as empty entries."""
    return F.transform(F.filter(F.split(F.coalesce(_col(c), F.lit("")), ",", -1), lambda x: x != ""), trim_space)


def safe_pdf_name(name: Column | str, sha: Column | str) -> Column:
    """A file name without path separators that ends in .pdf; made of the hash if it would be empty."""
    clean = F.translate(trim_space(F.coalesce(_col(name), F.lit(""))), "/:", "--")
    named = F.when(clean == "", F.concat(F.lit("upload-"), F.substring(_col(sha), 1, 8), F.lit(".pdf"))).otherwise(clean)
    return F.when(F.lower(named).endswith(".pdf"), named).otherwise(F.concat(named, F.lit(".pdf")))


def escape_html(c: Column | str) -> Column:
    """The four characters of markup as entities."""
    out = _col(c)
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out


def page_caption(method: Column, quality: Column, dpi: Column, status: Column) -> Column:
    """The parts with bullets between; what is null is left out, and a score of NaN is ``nan``."""
    score = F.when(F.isnan(quality), "nan").when(quality.isNotNull(), F.format_string("%.3f", quality))
    return F.concat_ws(" • ", method, F.concat(F.lit("q="), score), F.concat(F.lit("dpi="), dpi), status)


def utc_stamp(c: Column | str) -> Column:
    """ISO 8601 to the second; the session's time zone is UTC."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def orientation_of(rotation: Column | str) -> Column:
    """A page's rotation in degrees as 0, 90, 180 or 270; anything else is upright."""
    r = F.pmod(_col(rotation), F.lit(360))
    return F.when(r.isin(90, 180, 270), r).otherwise(0)


def has_pdf_magic(content: Column | str) -> Column:
    return F.substring(_col(content), 1, 4) == F.lit(b"%PDF")


def clamp_limit(raw: Column | str, default: int = 20, least: int = 1, most: int = 100) -> Column:
    """A requested number of rows within bounds; what is no number is the default."""
    return F.least(F.greatest(F.coalesce(_col(raw).try_cast("int"), F.lit(default)), F.lit(least)), F.lit(most))


def contains_arabic_hint(hints: Column | str) -> Column:
    return F.exists(_col(hints), lambda x: F.lower(x).rlike("^ar(-|$)"))


def recognition_languages(configured: Column | str, hints: Column | str) -> Column:
    """The configured languages, or the page's hints if none is configured."""
    return F.when(F.size(_col(configured)) > 0, _col(configured)).otherwise(_col(hints))


def use_language_correction(mode: str, hints: Column | str) -> Column:
    """``on``, ``off``, or ``auto``: not for pages with an Arabic hint."""
    return F.lit(True) if mode == "on" else F.lit(False) if mode == "off" else ~F.coalesce(contains_arabic_hint(hints), F.lit(False))
