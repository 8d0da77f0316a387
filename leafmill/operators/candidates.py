"""Choosing a page's text: text layer, orientation sweep, high-resolution retry, numeric retries.

Recognition is a table of candidates, (page_id, orientation, dpi, text,
confidence), filled by whatever recogniser there is. A page's few candidates
meet in one row, by one shuffle; the choice is a chain of expressions, each
bound once, and the retries, whose preference isn't transitive, a fold. A
candidate is measured when the chain comes to it: the sweep only where the base
is poor, retries only where numbers are suspicious. Candidates that don't exist
count as empty with confidence 0.01.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import grouped_fidelity, reason_codes, repair_numbers
from ..functions.quality import RUNTIME, Thresholds, gate_of, quality_of, quality_score
from ..functions.text import grapheme_count, language_sanity, trim_space
from ..session import materialize, spread, stored_bytes

TEXT_LAYER, RECOGNISED = "text_layer", "vision_ocr"
LAYER_CONFIDENCE, MISSING_CONFIDENCE = 0.99, 0.01
ORIENTATIONS = (0, 90, 180, 270)
#: How much worse a candidate may be and still replace one with more issues.
TOLERANCE = 0.05


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scored(text: Column, confidence: Column, t: Thresholds) -> Callable[[Callable], Column]:
    chars, sanity = grapheme_count(text), language_sanity(text)
    return lambda body: _let(F.struct(chars.alias("chars"), sanity.alias("sanity")), lambda m: _let(quality_of(m["chars"], m["sanity"], confidence, t.min_chars), lambda q: body(q, gate_of(m["chars"], m["sanity"], q, confidence, t))))


def _tried(text: Column, confidence: Column, orientation: Column, dpi: Column, source: str, t: Thresholds) -> Column:
    """A candidate before its numbers are looked at."""
    head = (text.alias("text"), confidence.alias("confidence"), orientation.cast("int").alias("orientation"), dpi.cast("int").alias("dpi"), F.lit(source).alias("source"))
    return _scored(text, confidence, t)(lambda q, gate: F.struct(*head, q.alias("quality"), gate.alias("gate")))


def _repaired(c: Column, t: Thresholds) -> Column:
    """A candidate with its numbers repaired (r_), and the issues that are left."""
    head = [c[k].alias(k) for k in ("text", "confidence", "orientation", "dpi", "source", "quality", "gate")]
    return _let(
        repair_numbers(c["text"]),
        lambda r: _scored(r, c["confidence"], t)(
            lambda q, gate: F.struct(*head, r.alias("r_text"), q.alias("r_quality"), gate.alias("r_gate"), reason_codes(r).alias("codes"), grouped_fidelity(r).alias("fidelity"))
        ),
    )


def _recognised(orientation: Column, dpi: Column, t: Thresholds) -> Column:
    """The candidate of an orientation and a resolution; of equal keys the most confident counts, then the greater text."""
    key = (orientation * 10_000 + dpi).cast("int")
    best = F.array_max(F.transform(F.filter("candidates", lambda x: x["key"] == key), lambda x: F.struct(x["confidence"].alias("confidence"), x["text"].alias("text"))))
    found = F.coalesce(best, F.struct(F.lit(MISSING_CONFIDENCE).alias("confidence"), F.lit("").alias("text")))
    return _let(found, lambda x: _tried(x["text"], x["confidence"], orientation, dpi, RECOGNISED, t))


def retry_signals(seed_orientation: Column, metadata_orientation: Column, seed_dpi: Column, t: Thresholds = RUNTIME) -> Column:
    """The (orientation, dpi) of each numeric retry, at least one: orientations in turn, resolution rising."""
    turn = lambda quarters: F.pmod(seed_orientation + 90 * quarters, F.lit(360))
    cycle = F.array_distinct(F.array(seed_orientation, metadata_orientation, turn(1), turn(3), turn(2)))
    most = max(t.high_dpi, t.max_dpi)
    start, step = F.least(F.lit(most), F.greatest(F.lit(t.high_dpi), seed_dpi)), max(40, (t.high_dpi - t.base_dpi) // 2)
    return F.transform(
        F.sequence(F.lit(0), F.lit(max(1, t.retry_passes) - 1)),
        lambda i: F.struct(F.get(cycle, F.pmod(i, F.size(cycle))).alias("orientation"), F.least(F.lit(most), start + i * step).cast("int").alias("dpi")),
    )


def preferred(new: Column, old: Column) -> Column:
    """Whether a repaired candidate replaces the current one."""
    n_new, n_old = F.size(new["codes"]), F.size(old["codes"])
    return (
        F.when(trim_space(new["r_text"]) == "", False).when(trim_space(old["r_text"]) == "", True).when(new["r_quality"] + TOLERANCE < old["r_quality"], False)
        .when(n_new != n_old, n_new < n_old).when(new["fidelity"] != old["fidelity"], new["fidelity"] > old["fidelity"])
        .when(new["r_quality"] != old["r_quality"], new["r_quality"] > old["r_quality"]).otherwise(new["confidence"] > old["confidence"])
    )


def with_candidates(pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """``pages`` with the array of each page's ``candidates``: (key, confidence, text).

    What follows is dear for its bytes, so the pages are spread over all cores,
    which a shuffle of so few bytes wouldn't do; the other steps keep to it.
    """
    size = stored_bytes(candidates)
    pages, candidates = spread(pages, "page_id", size=size), spread(candidates, "page_id", size=size)
    key = (F.col("orientation") * 10_000 + F.col("dpi")).cast("int")
    found = candidates.groupBy("page_id").agg(F.collect_list(F.struct(key.alias("key"), F.col("confidence").cast("double").alias("confidence"), F.coalesce("text", F.lit("")).alias("text"))).alias("candidates"))
    return pages.join(found, "page_id", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast(found.schema["candidates"].dataType)))


def _choice(t: Thresholds) -> Column:
    """All that is chosen of a page, from its layer_text, orientation and candidates."""
    own, base_dpi = F.col("orientation"), F.lit(t.base_dpi)

    def retried(seed: Column, swept: Column, high: Column, by_layer: Column) -> Column:
        second = F.size(seed["codes"]) > 0
        better = lambda a, c: F.when(preferred(c, a), c).otherwise(a)
        fold = F.aggregate(
            F.when(second, retry_signals(seed["orientation"], own, seed["dpi"], t)).otherwise(F.array().cast("array<struct<orientation:int,dpi:int>>")), seed,
            lambda a, s: F.when(F.size(a["codes"]) > 0, _let(_recognised(s["orientation"], s["dpi"], t), lambda c: _let(_repaired(c, t), lambda r: better(a, r)))).otherwise(a),
        )
        return _let(fold, lambda c: F.struct(c.alias("chosen"), seed["codes"].alias("first_codes"), swept.alias("swept"), high.alias("high"), by_layer.alias("by_layer"), second.alias("second_pass")))

    def from_base(base: Column) -> Column:
        swept = base["quality"] < t.sweep_trigger
        others = F.filter(F.array(*map(F.lit, ORIENTATIONS)), lambda o: o != own)
        first_best = F.aggregate(others, base, lambda a, o: _let(_recognised(o, base_dpi, t), lambda c: F.when(c["quality"] > a["quality"], c).otherwise(a)))
        return _let(F.when(swept, first_best).otherwise(base), lambda turned: from_turned(turned, swept))

    def from_turned(turned: Column, swept: Column) -> Column:
        high = ~turned["gate"]
        sharp = _let(_recognised(turned["orientation"], F.lit(t.high_dpi), t), lambda c: F.when(c["quality"] >= turned["quality"], c).otherwise(turned))
        return _let(F.when(high, sharp).otherwise(turned), lambda c: _let(_repaired(c, t), lambda seed: retried(seed, swept, high, F.lit(False))))

    layer = _tried(F.coalesce("layer_text", F.lit("")), F.lit(LAYER_CONFIDENCE), own, base_dpi, TEXT_LAYER, t)
    by_layer = lambda c: _let(_repaired(c, t), lambda seed: retried(seed, F.lit(False), F.lit(False), F.lit(True)))
    return _let(layer, lambda c: F.when((c["text"] != "") & c["gate"], by_layer(c)).otherwise(_let(_recognised(own, base_dpi, t), from_base)))


def choose(pages: DataFrame, candidates: DataFrame, t: Thresholds = RUNTIME) -> DataFrame:
    """The chosen text of each page, or why there is none.

    Columns: page_id, document_id and page_number (if ``pages`` has them),
    text, raw_text, quality, confidence, orientation, dpi, source, swept,
    retried_high_dpi, second_pass, reason_codes, first_codes, error. ``error``
    is null, ``quality_gate_failed`` or ``no_candidate``; such pages keep their
    row, so that a page never fails its task. ``raw_text`` is the text before
    repair. ``first_codes`` are the codes that called for retries. A null or
    blank text layer counts as none, a null orientation as upright.
    """
    kept = [c for c in ("document_id", "page_number") if c in pages.columns]
    own = pages.select("page_id", *kept, trim_space("text_layer_text").alias("layer_text"), F.coalesce("orientation", F.lit(0)).cast("int").alias("orientation"))
    df = with_candidates(own, candidates).select("page_id", *kept, _choice(t).alias("of")).select("page_id", *kept, "of.*")
    error = F.when(~F.col("chosen.r_gate"), "quality_gate_failed").when(trim_space("chosen.r_text") == "", "no_candidate")
    source = F.when(F.col("by_layer"), F.col("chosen.source")).otherwise(F.lit(RECOGNISED))
    high = F.when(F.col("by_layer"), F.col("chosen.source") == RECOGNISED).otherwise(F.col("high") | (F.col("chosen.dpi") >= t.high_dpi))
    out = df.select(
        "page_id", *kept, F.col("chosen.r_text").alias("text"), F.col("chosen.text").alias("raw_text"), F.col("chosen.r_quality").alias("quality"), F.col("chosen.confidence").alias("confidence"),
        F.col("chosen.orientation").alias("orientation"), F.col("chosen.dpi").alias("dpi"), source.alias("source"), "swept", high.alias("retried_high_dpi"), "second_pass",
        F.col("chosen.codes").alias("reason_codes"), "first_codes", error.alias("error"),
    )
    # written once: a filter pushed into this chain would run it again
    return materialize(out, "chosen")


def text_layer_only(pages: DataFrame, t: Thresholds = RUNTIME) -> DataFrame:
    """With recognition off: the text layer without a gate; a page without one has the error ``no_text_layer``."""
    text = repair_numbers(trim_space("text_layer_text"))
    df = pages.select("*", text.alias("text"), F.lit(LAYER_CONFIDENCE).alias("confidence"))
    return df.withColumn("quality", quality_score("text", F.col("confidence"), t.min_chars)).withColumn("reason_codes", reason_codes("text")).withColumn("error", F.when(F.coalesce("text", F.lit("")) == "", "no_text_layer"))


def error_records(chosen: DataFrame, run_id: int | None = None) -> DataFrame:
    """A row for each warning and error: (run_id, page_id, stage, severity, reason_code, message, context)."""
    base = chosen.select("page_id", "quality", "confidence", F.explode("first_codes").alias("reason_code"))
    warnings = base.select("page_id", F.lit("numeric_sanity").alias("stage"), F.lit("warning").alias("severity"), "reason_code", F.lit("suspicious number; further candidates were tried").alias("message"), F.lit(None).cast("string").alias("context"))
    failed = chosen.where("error IS NOT NULL").select("page_id", F.lit("quality_gate").alias("stage"), F.lit("error").alias("severity"), F.col("error").alias("reason_code"), F.lit("no candidate was good enough").alias("message"), F.to_json(F.struct("quality", "confidence")).alias("context"))
    return warnings.unionByName(failed).select(F.lit(run_id).cast("int").alias("run_id"), "*")


def result_metadata(chosen: DataFrame) -> DataFrame:
    """Each page's result as a map of strings."""
    entries = {"source": F.col("source"), "orientation": F.col("orientation").cast("string"), "dpi": F.col("dpi").cast("string"), "quality_score": F.col("quality").cast("string"), "numeric_reason_codes": F.array_join("reason_codes", ",")}
    return chosen.select("page_id", "text", "confidence", F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v)]).alias("metadata"))


def render_dpi(t: Thresholds = RUNTIME) -> int:
    """The resolution at which one rendering serves every try."""
    return max(t.base_dpi, t.high_dpi, t.max_dpi)
