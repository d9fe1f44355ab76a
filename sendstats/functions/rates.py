"""Percentages of the reports, as numbers and as the text that is shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rate column -> (counter, base).
EMAIL_RATES = {
    "Delivered_PCT": ("Delivered", "Sent"),
    "Open_PCT": ("Open", "Delivered"),
    "Unique_Open_PCT": ("Unique_Open", "Delivered"),
    "Unique_Click_PCT": ("Unique_Click", "Delivered"),
    "Bounce_PCT": ("Bounce", "Sent"),
    "Spam_PCT": ("Spam", "Delivered"),
}
PUSH_RATES = {
    "Open_PCT": ("Open", "Sent"),
    "Bounce_PCT": ("Bounce", "Sent"),
}


def percent(part: str, base: str) -> Column:
    """100 * part / base of two counter columns, and 0.0 on an empty base."""
    ratio = f"cast({part} AS double) / cast({base} AS double) * 100.0D"
    return F.expr(f"CASE WHEN {base} > 0 THEN {ratio} ELSE 0.0D END")


def percent_text(pct: Column) -> Column:
    """First four characters of the plain decimal text, then ``%``.

    Spark writes doubles below 1e-3 and from 1e7 on with an exponent, so those
    two ranges get their plain digits here.
    """
    plain = (
        F.when((pct > 0) & (pct < 1e-3), F.lit("0.00"))
        .when(pct >= 1e7, pct.cast("decimal(38,1)").cast("string"))
        .otherwise(pct.cast("string"))
    )
    return F.concat(F.substring(plain, 1, 4), F.lit("%"))


def with_rates(df: DataFrame, rates: dict[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({name: percent(part, base) for name, (part, base) in rates.items()})


def with_display(df: DataFrame) -> DataFrame:
    """Add a ``*_display`` text next to every ``*_PCT`` number."""
    rates = [c for c in df.columns if c.endswith("_PCT")]
    return df.withColumns({f"{c}_display": percent_text(F.col(c)) for c in rates})
