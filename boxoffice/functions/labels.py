"""Display labels for numbers and changes."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks used in labels.
UP, DOWN, FLAT = "▲", "▼", "—"

THOUSAND, MILLION, BILLION = 10**3, 10**6, 10**9


def grouped(c: Column) -> Column:
    """``1234567.8`` as ``1,234,568``; zero is shown as an empty text."""
    whole = F.round(c, 0)
    return F.when(whole != 0, F.format_string("%,.0f", whole.cast("double"))).when(
        whole == 0, F.lit("")
    )


def _scaled(c: Column, unit: int, digits: int, mark: str) -> Column:
    # Rounding happens in decimal arithmetic, so that a tie never depends on binary fractions.
    kept = F.round(c.cast("decimal(28,4)"), digits - len(str(unit)) + 1)
    shown = F.format_string(f"%.{digits}f", kept.cast("double") / F.lit(float(unit)))
    return F.concat(F.regexp_replace(shown, r"^0\.", "."), F.lit(mark))


def compact_number(c: Column, style: str = "money") -> Column:
    """A short label for an amount.

    ``kpi`` shows thousands with one digit below a million, ``money`` shows all whole
    digits there, ``label`` shows whole thousands from 1,000 on. ``whole`` and, without a
    currency sign, ``count`` never shorten.
    The thresholds look at the signed value: a loss is not shortened.
    """
    c = c.cast("decimal(28,4)")
    if style == "count":
        return grouped(c)
    size, sign = F.abs(c), F.when(c < 0, F.lit("-$")).otherwise(F.lit("$"))
    if style == "whole":
        return F.concat(sign, grouped(size))
    large = [
        (c < BILLION, _scaled(size, MILLION, 2, "M")),
        (c >= BILLION, _scaled(size, BILLION, 2, "B")),
    ]
    small = {
        "kpi": [(c < MILLION, _scaled(size, THOUSAND, 1, "K"))],
        "money": [(c < MILLION, grouped(size))],
        "label": [
            (c < THOUSAND, F.format_string("%.0f", F.round(size, 0).cast("double"))),
            (c < MILLION, _scaled(size, THOUSAND, 0, "K")),
        ],
    }[style]
    out = F.when(*small[0])
    for condition, value in small[1:] + large:
        out = out.when(condition, value)
    return F.concat(sign, out)


def percent(c: Column, digits: int = 0) -> Column:
    """``0.125`` as ``13%`` (or ``12.5%`` with one digit)."""
    scaled = F.round(c.cast("decimal(28,10)") * 100, digits)
    return F.concat(F.format_string(f"%.{digits}f", scaled.cast("double")), F.lit("%"))


def arrow(pct: Column, body: Column, flat: str = FLAT) -> Column:
    """``body`` after an arrow in the direction of ``pct``; ``flat`` where there is none."""
    return (
        F.when(pct > 0, F.concat(F.lit(f"{UP} "), body))
        .when(pct == 0, F.lit(flat))
        .when(pct < 0, F.concat(F.lit(f"{DOWN} "), body))
    )


def trend_label(pct: Column, detail: Column | None = None, flat: str = FLAT) -> Column:
    """``▲ 12% ($1.2K)``: arrow by the sign of ``pct``, its size, and an optional detail."""
    body = percent(F.abs(pct))
    if detail is not None:
        body = F.concat(body, F.lit(" ("), detail, F.lit(")"))
    return arrow(pct, body, flat)


# How a comparison is named.
SINCE = {"PD": " vs previous day", "PY": " vs same period last year"}


def card_parts() -> dict[str, Column]:
    """The pieces of card labels, from the columns ``previous``, ``change`` and ``pct``."""
    change = F.col("change")
    return {
        "_pct": percent(F.abs("pct")),
        "_points": percent(F.abs(change), 1),
        "_before": percent(F.col("previous"), 1),
        "_kpi": compact_number(F.abs(change), "kpi"),
        "_count": compact_number(change, "count"),
        "_whole": compact_number(change, "whole"),
    }


# The text of each card after its arrow.
CARD_TEXTS = {
    "profit": "{_pct} ({_kpi})",
    "tickets": "{_pct} ({_count})",
    "complete_orders": "{_pct} ({_count})",
    "new_customers": "{_pct} ({_count})",
    "avg_tickets_per_order": "{_pct}",
    "profit_margin": "{_points}{since}",
    "completion_rate": "{_points}{since} ({_before})",
    "avg_new_customers_value": "{_pct} ({_whole}){since}",
}


def card_label(metric: str, versus: str) -> Column:
    """The label of a card from its pieces.

    Amounts and counts show their change, averages its percentage, and rates the change in
    points. Profit shows the direction in the arrow only, counts keep their sign.
    """
    pieces = []
    for literal, name, _, _ in Formatter().parse(CARD_TEXTS[metric]):
        pieces.append(F.lit(literal))
        if name:
            pieces.append(F.lit(SINCE[versus]) if name == "since" else F.col(name))
    return F.concat(*pieces)


def overall_label(pct: Column, change: Column, money: bool) -> Column:
    """``▲ 1,235% | $1,234``, or ``No Change``; a share that rounds to 0 shows no digit."""
    size = compact_number(F.abs(change), "money" if money else "count")
    shown = grouped(F.abs(pct).cast("decimal(28,10)") * 100)
    return arrow(pct, F.concat(shown, F.lit("% | "), size), "No Change")


def share_label(value: Column, share: Column, money: bool) -> Column:
    """``$12K | 34%``."""
    shown = compact_number(value, "label" if money else "count")
    return F.concat(shown, F.lit(" | "), percent(share))
