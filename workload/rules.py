"""Rules for labels as tables of the SQL checks, and the look-ups in them."""

from __future__ import annotations

from workload.registry import cte

# Labels with the lowest value of their band, from the top; '-infinity' is the rest.
BANDS = {
    "market_cap": (("Mega Cap", 2e11), ("Large Cap", 1e10), ("Mid Cap", 2e9), ("Small Cap", 3e8),
                   ("Micro Cap", None)),
    "trend_warehouse": (("Strong Up", 5), ("Up", 0), ("Sideways", -5), ("Down", -10), ("Strong Down", None)),
    "trend_stream": (("Strong Up", 2), ("Up", 0), ("Sideways", -2), ("Down", -5), ("Strong Down", None)),
    "trend_batch": (("Strong Up", 2), ("Up", 0), ("Sideways", -2), ("Down", None)),
    "performance": (("Outstanding", 10), ("Excellent", 5), ("Good", 0), ("Poor", -5), ("Terrible", None)),
}
# Labels with their words, by precedence; the empty word is in every text.
WORDS = {
    "news": (
        ("Financial", ("earnings", "revenue", "profit")),
        ("M&A", ("merger", "acquisition", "deal")),
        ("Product", ("product", "launch", "release")),
        ("Leadership", ("ceo", "executive", "management")),
        ("General", ("",)),
    ),
    "news_stream": (
        ("Financial", ("earnings", "revenue")),
        ("M&A", ("merger", "acquisition")),
        ("Product", ("product", "launch", "release")),
        ("Leadership", ("ceo", "executive")),
        ("General", ("",)),
    ),
    "mood": (
        ("1", ("positive", "growth", "gain")),
        ("-1", ("negative", "decline", "loss")),
        ("0", ("",)),
    ),
    "sector": (
        ("Technology", ("technology", "tech")),
        ("Healthcare", ("health", "medical")),
        ("Financial Services", ("financial", "bank")),
        ("Energy", ("energy", "oil", "gas")),
        ("Consumer Discretionary", ("consumer", "retail")),
        ("Utilities", ("utility",)),
        ("Industrials", ("industrial",)),
        ("Materials", ("material",)),
        ("Real Estate", ("real estate", "reit")),
        ("Other", ("",)),
    ),
    "industry": (
        ("Software", ("software",)),
        ("Hardware", ("hardware",)),
        ("Pharmaceuticals", ("pharmaceutical",)),
        ("Banking", ("bank",)),
        ("Insurance", ("insurance",)),
        ("Oil & Gas", ("oil",)),
        ("Retail", ("retail",)),
        ("Automotive", ("automotive",)),
        ("Other", ("",)),
    ),
}

cte("band_rules", "select * from (values\n" + ",\n".join(
    f"  ('{rule}', '{label}', cast('{'-infinity' if floor is None else floor}' as double))"
    for rule, bands in BANDS.items() for label, floor in bands) + ") t(rule, label, floor)")
cte("word_rules", "select * from (values\n" + ",\n".join(
    f"  ('{rule}', '{label}', {place}, '{word}')"
    for rule, classes in WORDS.items() for place, (label, words) in enumerate(classes)
    for word in words) + ") t(rule, label, place, word)")


def banded(rule: str, value: str, reached: str = "<") -> str:
    """SQL for the label of the highest floor below ``value``, with "<=" also at it; no value has the last."""
    return (f"(select arg_max(label, floor) from band_rules "
            f"where rule = '{rule}' and floor {reached} coalesce({value}, -1e18))")


def worded(rule: str, text: str) -> str:
    """SQL for the first label of which ``text`` holds a word."""
    return (f"(select arg_min(label, place) from word_rules "
            f"where rule = '{rule}' and contains(lower(coalesce({text}, '')), word))")


def sentiment(up: str, down: str, very: bool = False) -> str:
    """SQL for the side with more stocks; ``very`` marks a lead of more than half."""
    side = f"['Bearish', 'Neutral', 'Bullish'][cast(sign({up} - {down}) as integer) + 2]"
    lead = f"if(greatest({up}, {down}) > 1.5 * least({up}, {down}), 'Very ', '')"
    return f"{lead} || {side}" if very else side
