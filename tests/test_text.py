import pytest
from pyspark.sql import functions as F

from leafmill.functions import finance, numeric, quality, text


def values(spark, column, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_trim_takes_white_space_of_any_kind_and_keeps_nulls(spark):
    assert values(spark, text.trim_space("t"), [" \t a b \n", "　", "", None]) == ["a b", "", "", None]
    assert values(spark, text.blank_to_null("t"), [" x ", " ", None]) == ["x", None, None]


def test_graphemes(spark):
    assert values(spark, text.grapheme_count("t"), ["é", "a\r\nb", "👩‍🚀", "", None]) == [1, 3, 1, 0, None]


def test_sanity_of_empty_is_zero(spark):
    assert values(spark, text.language_sanity("t"), ["abc 1", "", "##ab", None]) == [1.0, 0.0, 0.5, None]


def test_normalize(spark):
    assert values(spark, text.normalize_text("t"), ["  a \r\n\r\n\t b \n \n", "", None]) == ["a\nb", "", None]


def reference_chunks(t, size=1200):
    n = c = 0
    for x in t.strip():
        c += len(x.encode())
        if c >= size:
            n, c = n + 1, 0
    return n + (c > 0)


def test_chunk_count_against_the_fold(spark):
    rows = ["", "a" * 1199, "a" * 1200, "a" * 1201, "é" * 1300, "ab" + "م" * 6000, "😀" * 901, "x😀" * 2000, "a" * 1199 + "😀" + "b" * 1200]
    assert values(spark, text.chunk_count("t"), rows) == [reference_chunks(r) for r in rows]


def test_names_languages_and_html(spark):
    name = text.safe_pdf_name("t", F.lit("0123456789abcdef"))
    assert values(spark, name, [" a/b:c.PDF ", "report", "  ", None]) == ["a-b-c.PDF", "report.pdf", "upload-01234567.pdf", "upload-01234567.pdf"]
    assert values(spark, text.parse_languages("t"), [" de , ,fr", "", None]) == [["de", "fr"], ["en"], ["en"]]
    assert values(spark, text.cli_languages("t"), ["de, ,fr,,", ""]) == [["de", "", "fr"], []]
    assert values(spark, text.escape_html("t"), ['<a href="x">&']) == ["&lt;a href=&quot;x&quot;&gt;&amp;"]
    assert values(spark, text.clamp_limit("t"), ["500", "0", "7", "x", None]) == [100, 1, 7, 20, 20]
    assert values(spark, text.orientation_of(F.col("t").cast("int")), ["-90", "450", "45", "360"]) == [270, 90, 0, 0]


@pytest.mark.parametrize(
    ("given", "codes"),
    [
        ("balance 1,,2", ["delimiter_corruption"]),
        ("sum 1234,56 today", ["delimiter_corruption"]),
        ("value 4.5.6", ["malformed_decimal"]),
        ("Net profit: -5", ["impossible_negative_total"]),
        ("paid 4S,300", ["digit_glyph_confusion"]),
        ("paid 4٣,300", ["digit_glyph_confusion"]),
        ("all 1,234 is well", []),
        ("", []),
    ],
)
def test_detectors(spark, given, codes):
    assert values(spark, numeric.reason_codes("t"), [given]) == [codes]


def test_repair(spark):
    rows = ["rev 7l,d2 (0SS,82S) 2٣8.001 end", "e.g. this", "example.com", "3.1415", "1,234,567", "a.b", "", None]
    assert values(spark, numeric.repair_numbers("t"), rows) == ["rev 71,62 (055,825) 238,001 end", "3,6. this", "exa13,30", "3,141", "1,234,567", "a.b", "", None]


def test_fidelity_and_decimals(spark):
    assert values(spark, numeric.grouped_fidelity("t"), ["1,234 and (5,678)", "12,3 45,6", "1,234 5,6"]) == [2, 0, 0]
    assert [None if v is None else float(v) for v in values(spark, numeric.parse_decimal("t"), ["1 234,567.5", "12.5abc", "abc", "-3", "", None])] == [1234567.5, 12.5, None, -3.0, None, None]


def test_units(spark):
    rows = ["amounts in KD'000", "amounts in kwd 000", "1,000 KD", "بالالف دينار", "dinars", None]
    assert values(spark, finance.source_unit("t"), rows) == ["KD_000", "KD_000", "KD_000", "KD_000", "KWD", None]
    assert float(values(spark, finance.value_from_text("t", F.lit("KD'000")), ["12.5"])[0]) == 12500.0


def test_quality_gate_uses_its_own_baseline(spark):
    score = lambda n: quality.quality_score("t", F.lit(1.0), n)
    assert values(spark, score(10), ["a" * 10, "a" * 5, ""]) == pytest.approx([1.0, 0.775, 0.0])
    assert values(spark, quality.passes_gate("t", F.lit(0.9)), ["a" * 40, "a" * 39]) == [True, False]
