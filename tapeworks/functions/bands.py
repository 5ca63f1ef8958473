"""Threshold bands and keyword classes.

Rules that share a name but differ in thresholds (price trend of the stream, the warehouse and
the batch job) are kept as separate rule sets on purpose.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Labels by falling threshold; the first threshold passed wins, else ``otherwise``."""

    inclusive: bool
    steps: tuple[tuple[float, str], ...]
    otherwise: str


@dataclass(frozen=True)
class Keywords:
    """Labels by keyword; the first class with a keyword in the text wins."""

    classes: tuple[tuple[str, tuple[str, ...]], ...]
    otherwise: str


# Thresholds and labels that results are compared on.
MARKET_CAP = Bands(True, (
    (200_000_000_000, "Mega Cap"),
    (10_000_000_000, "Large Cap"),
    (2_000_000_000, "Mid Cap"),
    (300_000_000, "Small Cap"),
), "Micro Cap")
TREND_STREAM = Bands(False, (
    (2, "Strong Up"), (0, "Up"), (-2, "Sideways"), (-5, "Down"),
), "Strong Down")
TREND_WAREHOUSE = Bands(False, (
    (5, "Strong Up"), (0, "Up"), (-5, "Sideways"), (-10, "Down"),
), "Strong Down")
TREND_BATCH = Bands(False, ((2, "Strong Up"), (0, "Up"), (-2, "Sideways")), "Down")
PERFORMANCE = Bands(False, (
    (10, "Outstanding"), (5, "Excellent"), (0, "Good"), (-5, "Poor"),
), "Terrible")

NEWS_CATEGORY = Keywords((
    ("Financial", ("earnings", "revenue", "profit")),
    ("M&A", ("merger", "acquisition", "deal")),
    ("Product", ("product", "launch", "release")),
    ("Leadership", ("ceo", "executive", "management")),
), "General")
SECTOR_BY_NAME = Keywords((
    ("Technology", ("technology", "tech")),
    ("Healthcare", ("health", "medical")),
    ("Financial Services", ("financial", "bank")),
    ("Energy", ("energy", "oil", "gas")),
    ("Consumer Discretionary", ("consumer", "retail")),
    ("Utilities", ("utility",)),
    ("Industrials", ("industrial",)),
    ("Materials", ("material",)),
    ("Real Estate", ("real estate", "reit")),
), "Other")
INDUSTRY_BY_NAME = Keywords((
    ("Software", ("software",)),
    ("Hardware", ("hardware",)),
    ("Pharmaceuticals", ("pharmaceutical",)),
    ("Banking", ("bank",)),
    ("Insurance", ("insurance",)),
    ("Oil & Gas", ("oil",)),
    ("Retail", ("retail",)),
    ("Automotive", ("automotive",)),
), "Other")
POSITIVE_WORDS = ("positive", "growth", "gain")
NEGATIVE_WORDS = ("negative", "decline", "loss")
STYLE_BY_SECTOR = {
    "Technology": "Growth",
    "Healthcare": "Defensive",
    "Financial Services": "Cyclical",
    "Consumer Discretionary": "Cyclical",
    "Consumer Staples": "Defensive",
    "Energy": "Cyclical",
    "Industrials": "Cyclical",
    "Materials": "Cyclical",
    "Real Estate": "Defensive",
    "Utilities": "Defensive",
    "Communication Services": "Growth",
}
STYLE_OTHER = "Other"

FALL_THROUGH = object()


def band(value: Column, rules: Bands, null_label=FALL_THROUGH) -> Column:
    """Label of ``value``. NULL falls through to the last label unless ``null_label`` is given."""
    labels = F
    if null_label is not FALL_THROUGH:
        labels = labels.when(value.isNull(), F.lit(null_label))
    for threshold, label in rules.steps:
        passed = value >= threshold if rules.inclusive else value > threshold
        labels = labels.when(passed, label)
    return labels.otherwise(rules.otherwise)


def mentions(text: Column, words: tuple[str, ...]) -> Column:
    """True when the text holds any of the (lower-case) words, in any case."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [lowered.contains(word) for word in words])


def classify(text: Column, rules: Keywords) -> Column:
    labels = F
    for label, words in rules.classes:
        labels = labels.when(mentions(text, words), label)
    return labels.otherwise(rules.otherwise)


def sentiment_score(title: Column) -> Column:
    """1, -1 or 0; a positive word outweighs a negative one."""
    return (F.when(mentions(title, POSITIVE_WORDS), 1)
            .when(mentions(title, NEGATIVE_WORDS), -1).otherwise(0))


def style_of(sector: Column) -> Column:
    """Investment style of a sector; no sector, no style."""
    pairs = [F.lit(part) for pair in STYLE_BY_SECTOR.items() for part in pair]
    style = F.coalesce(F.create_map(*pairs)[sector], F.lit(STYLE_OTHER))
    return F.when(sector.isNotNull() & (sector != ""), style)


def market_sentiment(gainers: Column, losers: Column, strong_factor: float | None = None) -> Column:
    """Bullish, Bearish or Neutral; with ``strong_factor`` also the two Very labels."""
    labels = F
    if strong_factor is not None:
        labels = labels.when(gainers > losers * strong_factor, "Very Bullish")
    labels = labels.when(gainers > losers, "Bullish")
    if strong_factor is not None:
        labels = labels.when(losers > gainers * strong_factor, "Very Bearish")
    return labels.when(losers > gainers, "Bearish").otherwise("Neutral")
