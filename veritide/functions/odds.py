"""Prices and probabilities as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("home", "draw", "away")
RULES = ("finite", "positive", "above_one", "above_one_margin")


def _cols(*names: str | Column) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def devig(*prices: str | Column, rule: str = "above_one") -> Column:
    """struct(p array, margin) of decimal prices: p_i = (1/o_i) / sum. Null where the rule rejects the row.

    rule: 'finite' takes any finite inverses with a positive sum, 'positive' wants each inverse positive,
    'above_one' and 'above_one_margin' want each price above 1. margin is the sum of inverses.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    prices = _cols(*prices)
    inverses = [1 / F.nullif(p.cast("double"), F.lit(0.0)) for p in prices]
    total = inverses[0]
    for x in inverses[1:]:
        total = total + x
    ok = F.lit(True)
    for p, x in zip(prices, inverses, strict=True):
        ok = ok & (p > 1 if rule.startswith("above_one") else x > 0 if rule == "positive" else x.isNotNull()) & ~F.isnan(p.cast("double")) & (F.abs(p.cast("double")) < float("inf"))
    ok = ok & (total > 0)
    return F.when(ok, F.struct(F.array(*(x / F.nullif(total, F.lit(0.0)) for x in inverses)).alias("p"), total.alias("margin")))


def devig_pair(first: str | Column, second: str | Column) -> Column:
    """Probabilities of two net prices (profit per unit): p = 1/(1+x), normalised. Null unless both are positive."""
    a, b = _cols(first, second)
    pa, pb = 1 / (1 + a), 1 / (1 + b)
    return F.when((a > 0) & (b > 0), F.array(pa / (pa + pb), pb / (pa + pb)))


def american_to_decimal(value: str | Column) -> Column:
    """+600 is 7.0, -500 is 1.2; zero is null. Rounded to 6 places."""
    (a,) = _cols(value)
    return F.when(a != 0, F.round(1 + F.when(a > 0, a / 100).otherwise(100 / F.nullif(F.abs(a), F.lit(0))), 6))


def outcome(home_goals: str | Column, away_goals: str | Column) -> Column:
    """0 home, 1 draw, 2 away."""
    h, a = _cols(home_goals, away_goals)
    return F.when(h > a, 0).when(h == a, 1).when(h < a, 2)


def favourite(p: str | Column) -> Column:
    """Index of the greatest probability, ties to the first."""
    (p,) = _cols(p)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def favourite_side(p: str | Column) -> Column:
    """home, draw or away, ties to the first; null without probabilities (element_at() of fixed entries takes a null index for the last one)."""
    return F.get(F.array(*map(F.lit, SIDES)), favourite(p))


def gap(p: str | Column) -> Column:
    """Greatest minus second probability."""
    (p,) = _cols(p)
    order = F.sort_array(p, asc=False)
    return order[0] - order[1]


def log_ratios(p: str | Column) -> Column:
    """struct(home_draw, away_draw) of natural logarithms."""
    (p,) = _cols(p)
    return F.struct(F.ln(p[0] / p[1]).alias("home_draw"), F.ln(p[2] / p[1]).alias("away_draw"))


def favourite_line(line: str | Column, side: str | Column) -> Column:
    """A handicap line as the favourite sees it."""
    line, side = _cols(line, side)
    return F.when(side == "home", -line).otherwise(line)


def half_open(value: str | Column, edges: list[tuple[float, str]], last: str) -> Column:
    """The label of the first edge that value lies below."""
    (v,) = _cols(value)
    out = F
    for edge, label in edges:
        out = out.when(v < edge, label)
    return F.when(v.isNotNull(), out.otherwise(last))


def probability_bin(value: str | Column) -> Column:
    return half_open(value, [(0.40, "<0.40"), (0.45, "0.40-0.45"), (0.50, "0.45-0.50"), (0.55, "0.50-0.55")], ">=0.55")


def gap_bin(value: str | Column) -> Column:
    return half_open(value, [(0.05, "<0.05"), (0.10, "0.05-0.10"), (0.20, "0.10-0.20")], ">=0.20")


def line_bucket(value: str | Column) -> Column:
    """Buckets of a favourite's line: quarter lines match exactly."""
    (v,) = _cols(value)
    return F.when(v < 0, "unsupported").when(v == 0, "level").when(v.isin(0.25, 0.5), "shallow").when(v.isin(0.75, 1.0), "medium").when(v.isNotNull(), "deep")


def total_bucket(value: str | Column) -> Column:
    (v,) = _cols(value)
    return F.when(v <= 2.0, "<=2.00").when(v == 2.25, "2.25").when(v == 2.5, "2.50").when(v.isNotNull(), ">=2.75")


def strength_label(value: str | Column, medium: float = 0.07, high: float = 0.15) -> Column:
    return half_open(value, [(medium, "weak"), (high, "moderate")], "strong")


def maturity(fixtures: str | Column, days: str | Column, some: int = 30, gate: int = 200, span: int = 90) -> Column:
    """unvalidated, provisional or sample_gate_met."""
    n, d = _cols(fixtures, days)
    return F.when((n >= gate) & (d >= span), "sample_gate_met").when(n >= some, "provisional").otherwise("unvalidated")


def presented(action: str | Column, p: str | Column, confidence: str | Column) -> Column:
    """struct(direction, confidence) after a guardrail action."""
    action, p, confidence = _cols(action, p, confidence)
    side = favourite_side(p)
    return F.struct(
        F.when((action != "abstain") & p.isNotNull(), side).alias("direction"),
        F.when(action == "abstain", "observation_only").when((action == "downgrade") & confidence.isin("medium", "high"), "low").otherwise(confidence).alias("confidence"),
    )


def history_row(p: Column, line: Column, line_delta: Column, home_delta: Column, away_delta: Column, total: Column) -> Column:
    """The shape of a past fixture: favourite, its line and moves (null where the draw is on top), and bins."""
    norm = F.transform(p, lambda x: x / F.aggregate(p, F.lit(0.0), lambda a, y: a + y))
    top = favourite_side(norm)
    draw = top == "draw"
    own = F.when(~draw, favourite_line(line, top))
    return F.struct(
        norm.alias("p"),
        top.alias("top_outcome"),
        F.array_max(norm).alias("top_probability"),
        gap(norm).alias("top_gap"),
        draw.alias("draw_is_top"),
        F.when(norm[0] >= norm[2], "home").otherwise("away").alias("directional"),
        own.alias("favourite_line"),
        F.when(~draw, favourite_line(line_delta, top)).alias("favourite_line_delta"),
        F.when(top == "home", home_delta).when(top == "away", away_delta).alias("favourite_odds_delta"),
        probability_bin(F.array_max(norm)).alias("probability_bin"),
        gap_bin(gap(norm)).alias("gap_bin"),
        line_bucket(own).alias("line_bucket"),
        total_bucket(total).alias("total_bucket"),
    )
