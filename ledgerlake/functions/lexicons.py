"""Word lists and keyword tables; every text operator takes its own as arguments."""

from __future__ import annotations

# The six news topics, in tie-break order.
TOPICS = ["Earnings", "M&A", "Regulation", "Macroeconomy", "Product", "Analyst Rating"]

# English finance words; a default, any other lists serve as well.
FINANCE_POSITIVE = [
    "accelerated", "beat", "beats", "bullish", "expanding", "gain", "gains", "growth", "higher",
    "profit", "raise", "raised", "raises", "record", "resilient", "strong", "surge", "upgrade",
]
FINANCE_NEGATIVE = [
    "bearish", "cut", "cuts", "decline", "downgrade", "dropped", "fell", "flagged", "loss", "miss",
    "misses", "pressure", "probe", "short", "slowing", "softening", "warned", "warns", "weak",
]
FINANCE_TOPICS = {
    "Earnings": {"earnings": 2, "revenue": 1, "quarterly": 1, "guidance": 1, "profit": 1},
    "M&A": {"acquire": 2, "acquisition": 2, "merger": 2, "takeover": 2, "stake": 1},
    "Regulation": {"regulator": 2, "regulators": 2, "probe": 2, "lawsuit": 1, "compliance": 1},
    "Macroeconomy": {"inflation": 2, "rates": 1, "economy": 2, "market": 1, "tariff": 1},
    "Product": {"product": 2, "launch": 1, "unveils": 2, "line": 1, "reviews": 1},
    "Analyst Rating": {"analyst": 1, "analysts": 1, "upgrade": 2, "downgrade": 2, "rating": 2},
}

# Frequent words of the invented test prose (four languages). The split is
# arbitrary; it only makes every branch occur.
PROSE_POSITIVE = ["the", "and", "in", "that", "der", "und", "la", "que", "les", "for", "with", "es"]
PROSE_NEGATIVE = ["of", "to", "a", "is", "die", "von", "de", "le", "un", "was", "on", "en"]
PROSE_TOPICS = {
    "Earnings": {"the": 1, "der": 2, "la": 2, "be": 3},
    "M&A": {"of": 2, "die": 3, "de": 1, "as": 4},
    "Regulation": {"and": 3, "und": 4, "que": 4, "this": 5},
    "Macroeconomy": {"to": 3, "von": 5, "les": 5, "are": 6},
    "Product": {"in": 2, "den": 6, "en": 3, "from": 8},
    "Analyst Rating": {"a": 3, "es": 2, "un": 4, "by": 7},
}
