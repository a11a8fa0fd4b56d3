"""Letter/score banding of the recency, frequency and intensity measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _band(conditions: list[tuple[Column, object]]) -> Column:
    expr = None
    for cond, value in conditions:
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr


def recency(days: Column, edges=(7, 30, 90)) -> tuple[Column, Column]:
    """<= a: A/4, (a, b]: B/3, (b, c]: C/2, > c: D/1, NULL otherwise."""
    a, b, c = edges
    conds = [days <= a, (days > a) & (days <= b), (days > b) & (days <= c), days > c]
    return (_band(list(zip(conds, "ABCD"))), _band(list(zip(conds, (4, 3, 2, 1)))))


def activity(value: Column, edges=(5, 2), zero_label: str | None = "D") -> tuple[Column, Column]:
    """>= hi: A/4, [lo, hi): B/3, (0, lo]: C/2, = 0: D/1 (level ``zero_label``), NULL otherwise."""
    hi, lo = edges
    conds = [value >= hi, (value >= lo) & (value < hi), (value > 0) & (value <= lo), value == 0]
    labels = ["A", "B", "C", zero_label]
    level_pairs = [(c, v) for c, v in zip(conds, labels) if v is not None]
    return (_band(level_pairs).cast("string"), _band(list(zip(conds, (4, 3, 2, 1)))))


def cohort(*levels: Column) -> Column:
    """Joined letters; NULL when any level is NULL (string ``+`` semantics)."""
    return F.concat(*levels)


def described(level: Column, texts: tuple[str, str, str, str]) -> Column:
    """The text of a level A to D; NULL for other levels."""
    return _band([(level == letter, text) for letter, text in zip("ABCD", texts)])
