"""Quality of a text candidate and the gate that it must pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import grapheme_count, language_sanity


@dataclass(frozen=True)
class Thresholds:
    """What a candidate must reach, and when more is tried."""

    min_chars: int = 120
    min_confidence: float = 0.55
    min_sanity: float = 0.58
    min_quality: float = 0.62
    sweep_trigger: float = 0.72
    base_dpi: int = 180
    high_dpi: int = 320
    max_dpi: int = 640
    retry_passes: int = 2


LIBRARY = Thresholds()
#: What an ingest run uses.
RUNTIME = Thresholds(min_chars=40, min_confidence=0.20, min_sanity=0.40, min_quality=0.45, sweep_trigger=0.60)


def quality_of(chars: Column, sanity: Column, confidence: Column, baseline: int) -> Column:
    """The score from what is measured of a text: 0.45 for length up to the baseline, 0.35 for confidence, 0.2 for sanity; 0 for an empty text."""
    length = F.least(F.lit(1.0), chars / F.lit(float(max(baseline, 1))))
    clipped = F.least(F.greatest(confidence, F.lit(0.0)), F.lit(1.0))
    return F.when(chars == 0, 0.0).otherwise(0.45 * length + 0.35 * clipped + 0.20 * sanity)


def gate_of(chars: Column, sanity: Column, quality: Column, confidence: Column, t: Thresholds = RUNTIME) -> Column:
    return (chars >= t.min_chars) & (confidence >= t.min_confidence) & (sanity >= t.min_sanity) & (quality >= t.min_quality)


def quality_score(text: Column | str, confidence: Column, baseline: int) -> Column:
    return quality_of(grapheme_count(text), language_sanity(text), confidence, baseline)


def passes_gate(text: Column | str, confidence: Column, t: Thresholds = RUNTIME) -> Column:
    """Whether a candidate is long, confident, sane and good enough."""
    chars, sanity = grapheme_count(text), language_sanity(text)
    return gate_of(chars, sanity, quality_of(chars, sanity, confidence, t.min_chars), confidence, t)
