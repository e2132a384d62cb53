"""Means and rounding that do not depend on the order of rows, as SQL text."""

from __future__ import annotations


def round_half_even(value: str, digits: int) -> str:
    """Round the double itself, ties to even.

    ``bround`` decides ties on the printed digits: 36.6175 is really
    36.61749999999999971..., so it must give 36.617, while ``bround`` gives
    36.618. Here the rounding error of ``value * 10**digits`` breaks the tie;
    it is exact because the value is split at float precision. Values too
    large to have that many decimals stay as they are.
    """
    scale = f"{10.0**digits}D"
    scaled = f"({value} * {scale})"
    high = f"CAST(CAST({value} AS FLOAT) AS DOUBLE)"
    error = f"(({high} * {scale} - {scaled}) + ({value} - {high}) * {scale})"
    nudge = f"CASE WHEN {scaled} - floor({scaled}) = 0.5D THEN signum({error}) * 0.25D ELSE 0D END"
    return f"CASE WHEN abs({value}) < {2.0**53 / 10**digits}D THEN rint({scaled} + {nudge}) / {scale} ELSE {value} END"


def steady_mean(value: str) -> str:
    """Mean that is the same in every run, whatever the order of partial sums.

    Readings are short decimal numbers, so their sum as decimals is exact. A
    double sum varies in its last bit with the order, which is enough to turn
    a tie of the later rounding. The stated domain is values below 1e18, to ten
    decimals. Larger ones are added as doubles by the same formula: they count,
    but the last bits of their part may depend on the order.
    """
    short = f"try_cast({value} AS DECIMAL(28, 10))"
    rest = f"coalesce(sum(CASE WHEN {short} IS NULL THEN {value} END), 0D)"
    return f"(coalesce(CAST(sum({short}) AS DOUBLE), 0D) + {rest}) / nullif(count({value}), 0)"
