import dataclasses

from pyspark.sql import functions as F

from leafmill.functions.quality import LIBRARY
from leafmill.functions.text import trim_space
from leafmill.operators import candidates
from leafmill.plans import catalogue

GOOD = "The ledger lists 31,250 units of stock at the year's end. " * 4
NOISY = "The ledger lists 3l,2S units, 3125,0 in all and 7.8.9 more. " * 4


def choose(spark, found, layer=None, orientation=0, t=LIBRARY):
    pages = spark.createDataFrame([("p", layer, orientation)], "page_id string, text_layer_text string, orientation int")
    return candidates.choose(pages, spark.createDataFrame([("p", *x) for x in found], "page_id string, orientation int, dpi int, text string, confidence double"), t)


def test_a_good_text_layer_needs_no_recognition(spark):
    r = choose(spark, [], GOOD).first()
    assert (r.source, r.error, r.swept, r.retried_high_dpi, r.second_pass) == ("text_layer", None, False, False, False)


def test_sweep_takes_the_first_best_orientation(spark):
    r = choose(spark, [(0, 180, "x", 0.2), (90, 180, GOOD, 0.9), (180, 180, GOOD, 0.9), (270, 180, "poor", 0.2)]).first()
    assert (r.orientation, r.swept, r.error) == (90, True, None)


def test_a_tie_goes_to_the_high_resolution(spark):
    r = choose(spark, [(0, 180, "too short", 0.5), (0, 320, "too short", 0.5)]).first()
    assert (r.dpi, r.error) == (320, "quality_gate_failed")


def test_nothing_recognised_fails_and_is_recorded(spark):
    out = choose(spark, [])
    assert out.first().error == "quality_gate_failed"
    assert [(r.stage, r.severity, r.reason_code) for r in candidates.error_records(out).collect()] == [("quality_gate", "error", "quality_gate_failed")]


def test_retries_stop_at_a_clean_candidate(spark):
    found = [(0, 180, NOISY, 0.88), (0, 320, NOISY, 0.9), (90, 390, GOOD, 0.92)]
    r = choose(spark, found, orientation=90).first()
    assert (r.orientation, r.dpi, r.second_pass, list(r.reason_codes)) == (90, 390, True, [])
    assert "31,250" in r.text and r.raw_text.startswith("The ledger")


def test_numbers_are_never_made_up(spark):
    r = choose(spark, [(0, 180, NOISY, 0.9), (0, 320, NOISY, 0.9)]).first()
    assert r.reason_codes and "31,250" not in r.text


def test_a_much_worse_candidate_is_not_preferred(spark):
    r = choose(spark, [(0, 180, NOISY, 0.95), (0, 320, "1,234 clean", 0.6), (90, 390, "1,234 clean", 0.6)]).first()
    assert r.dpi == 180


def test_retry_signals(spark):
    def signals(seed, meta, passes):
        t = dataclasses.replace(LIBRARY, retry_passes=passes)
        row = spark.range(1).select(candidates.retry_signals(F.lit(seed), F.lit(meta), F.lit(180), t).alias("s")).first().s
        return [(x.orientation, x.dpi) for x in row]

    assert signals(0, 90, 6) == [(0, 320), (90, 390), (270, 460), (180, 530), (0, 600), (90, 640)]
    assert signals(0, 90, 0) == [(0, 320)]


def test_text_layer_only_has_no_gate(spark):
    pages = spark.createDataFrame([("a", "short", 0), ("b", "  ", 0), ("c", None, 0)], "page_id string, text_layer_text string, orientation int")
    assert {r.page_id: r.error for r in candidates.text_layer_only(pages).collect()} == {"a": None, "b": "no_text_layer", "c": "no_text_layer"}


def test_equal_keys_and_shared_texts(spark):
    # of equal keys the most confident counts, then the greater text; a text shared by keys keeps each key's confidence
    found = [(0, 180, GOOD, 0.3), (0, 180, GOOD + "b", 0.7), (0, 180, GOOD + "a", 0.7), (90, 180, GOOD, 0.5), (180, 180, None, 0.9)]
    r = choose(spark, found).first()
    assert (r.raw_text, r.confidence, r.orientation) == (GOOD + "b", 0.7, 0)
    assert choose(spark, [(0, 180, GOOD, 0.1), (90, 180, GOOD, 0.9)]).first().orientation == 90


def test_queries_choose_from_whole_texts(spark, data):
    texts = {str(r.doc_id): r.text for r in catalogue.table(spark, data, "documents").where("text IS NOT NULL").collect()}
    assert any(len(x) > 400 for x in texts.values())
    pages, made = catalogue._candidate_table(spark, data)
    forms = lambda t: {t, t.replace("1", "l"), t.replace(",", ",,"), t.replace(".", ".."), ""}
    assert all(r.text in forms(texts[r.page_id]) for r in made.collect())
    chosen = candidates.choose(pages, made).collect()
    trimmed = {r.page_id: r.layer for r in pages.select("page_id", trim_space("text_layer_text").alias("layer")).collect()}
    assert all(r.raw_text == trimmed[r.page_id] if r.source == "text_layer" else r.raw_text in forms(texts[r.page_id]) for r in chosen if r.error is None)
    # both branches, and a text layer that sets off retries
    assert {r.source for r in chosen} == {"text_layer", "vision_ocr"}
    assert any(r.second_pass and r.source == "text_layer" for r in chosen)
    # and every rule decides somewhere
    assert any(r.swept for r in chosen) and any(r.retried_high_dpi for r in chosen) and any(r.dpi == 390 for r in chosen)


def test_a_suspicious_layer_is_recognised_again(spark):
    layer = "Total Assets: - 22,765.4.3 KD'000s " * 4
    r = choose(spark, [(0, 320, GOOD, 0.91)], layer).first()
    assert (r.source, r.second_pass, list(r.reason_codes), r.dpi) == ("vision_ocr", True, [], 320) and r.first_codes


def test_a_glyph_is_put_right_by_repair(spark):
    r = choose(spark, [(0, 180, "Operating income of the year 58l,6Z3 and net 69,829 " * 4, 0.88)]).first()
    assert "581,623" in r.text and "58l,6Z3" in r.raw_text and not r.reason_codes


def test_two_retries_where_the_metadata_is_turned(spark):
    # nothing at the metadata's orientation: the sweep finds the upright one, retries take turns
    found = [(0, 180, NOISY, 0.88), (0, 320, NOISY, 0.91), (90, 390, GOOD, 0.92)]
    r = choose(spark, found, orientation=90).first()
    assert (r.swept, r.second_pass, r.orientation, r.dpi, list(r.reason_codes)) == (True, True, 90, 390, [])


def test_codes_remain_where_all_candidates_are_noisy(spark):
    r = choose(spark, [(0, 180, NOISY, 0.88), (0, 320, NOISY, 0.91), (90, 390, NOISY, 0.92)], orientation=90).first()
    assert r.second_pass and r.reason_codes and list(r.first_codes) == list(r.reason_codes) and r.error is None


def test_ids_go_through(spark):
    pages = spark.createDataFrame([("p", 17, 12, None, 0)], "page_id string, document_id bigint, page_number int, text_layer_text string, orientation int")
    out = candidates.choose(pages, spark.createDataFrame([("p", 0, 180, NOISY, 0.92)], "page_id string, orientation int, dpi int, text string, confidence double"))
    assert (out.first().document_id, out.first().page_number) == (17, 12)
    assert {(r.run_id, r.page_id, r.severity) for r in candidates.error_records(out, 11).collect()} == {(11, "p", "warning")}


def test_the_rendering_serves_every_try():
    assert candidates.render_dpi() == 640 and candidates.render_dpi(dataclasses.replace(LIBRARY, max_dpi=300)) == 320
