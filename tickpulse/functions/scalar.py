"""Column-level functions: timestamps, tickers, ids, bands (all JVM-side).

Each function takes and returns ``Column`` objects, so they stay inside
whole-stage codegen and work on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that define results.
# Default ticker pattern: "$" followed by upper-case letters; group 1 is the symbol.
TICKER_PATTERN = r"\$([A-Z]+)"
# Optional pattern that keeps a one-letter class suffix such as BRK.B.
TICKER_PATTERN_WITH_CLASS = r"\$([A-Z]+(?:\.[A-Z])?)"
# Label thresholds on the signed score: bullish >= 0.05, bearish <= -0.05.
BULLISH_AT = 0.05
BEARISH_AT = -0.05
# Fear/greed gauge band lower bounds (inclusive), lowest first.
FEAR_GREED_BANDS = [
    (-1.0, "extreme_fear"),
    (-0.5, "fear"),
    (-0.05, "neutral"),
    (0.05, "greed"),
    (0.5, "extreme_greed"),
]
# Symbol renames between the price source and the post corpus.
SYMBOL_REMAP = {"META": "FB", "BRK-B": "BRK.B"}
PREVIEW_CHARS = 80
DEFAULT_AUTHOR = "twitter_user"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_ts(col) -> Column:
    """String -> TIMESTAMP, ISO 'T' and space forms; bad input -> NULL.

    ``try_to_timestamp`` keeps the NULL-on-garbage behaviour under ANSI mode.
    """
    return F.try_to_timestamp(_c(col))


def extract_ticker(col, pattern: str = TICKER_PATTERN) -> Column:
    """First ``$TICKER`` in the text ('' when none, NULL for NULL)."""
    return F.regexp_extract(_c(col), pattern, 1)


def extract_all_tickers(col, pattern: str = TICKER_PATTERN) -> Column:
    """P02 option: every ticker in the text, as an array (explode to fan out)."""
    return F.regexp_extract_all(_c(col), F.lit(pattern), 1)


def has_ticker(col) -> Column:
    """Keep rows whose ticker is neither NULL nor empty."""
    c = _c(col)
    return c.isNotNull() & (c != "")


def row_id(*cols) -> Column:
    """Deterministic, replay-safe row identity: sha256 of 'a|b|...'."""
    return F.sha2(F.concat_ws("|", *[_c(c) for c in cols]), 256)


def random_id() -> Column:
    """P05 option: a random UUID per row (not replay-safe; prefer ``row_id``)."""
    return F.expr("uuid()")


def blank_to_null(col) -> Column:
    """NULL or whitespace-only text -> NULL."""
    c = _c(col)
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(None).cast("string")).otherwise(c)


def text_preview(col, n: int = PREVIEW_CHARS) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(col), 1, n)


def sentiment_label(score) -> Column:
    """A05/M03 banding of a signed score into BULLISH / BEARISH / NEUTRAL."""
    s = _c(score)
    return (F.when(s >= BULLISH_AT, "BULLISH")
            .when(s <= BEARISH_AT, "BEARISH")
            .when(s.isNotNull(), "NEUTRAL"))


def fear_greed_band(score) -> Column:
    """Gauge band; each band's lower bound is inclusive, below -1 is NULL."""
    s = _c(score)
    expr = None
    for lower, name in reversed(FEAR_GREED_BANDS):
        expr = F.when(s >= lower, name) if expr is None else expr.when(s >= lower, name)
    return expr


def remap_symbol(col, mapping: dict | None = None) -> Column:
    """Rename symbols through a small fixed map (unmapped pass through)."""
    mapping = SYMBOL_REMAP if mapping is None else mapping
    c = _c(col)
    if not mapping:
        return c
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[c], c)


def minutes_between(start, end) -> Column:
    """(unix seconds of end - unix seconds of start) / 60 (whole seconds)."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / 60.0


def plus_interval(col, interval: str) -> Column:
    """Timestamp + interval literal, e.g. '1 day'."""
    return _c(col) + F.expr(f"INTERVAL {interval}")


def safe_div(a, b) -> Column:
    """Division that yields NULL (not an ANSI error) on a zero divisor."""
    return F.try_divide(_c(a), _c(b))


def safe_ln(col) -> Column:
    """ln(x) for x > 0, NULL otherwise (numpy would give -inf / NaN)."""
    c = _c(col)
    return F.when(c > 0, F.ln(c))
