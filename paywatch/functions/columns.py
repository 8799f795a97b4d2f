"""Column expressions shared by the plans. All run inside Spark's generated code."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000

# Night covers 23:00 to 05:59.
NIGHT_START_HOUR = 23
NIGHT_END_HOUR = 5

# Lower bounds of the risk tiers, both inclusive.
HIGH_FROM = 0.70
MEDIUM_FROM = 0.40


def micros(ts: Column) -> Column:
    """Wall-clock microseconds since 1970 of a timestamp without a zone.

    Built from the calendar fields, so it is exact and in order in every session
    time zone, daylight saving included.
    """
    second_of_day = F.hour(ts) * 3600 + F.minute(ts) * 60
    seconds = F.extract(F.lit("SECOND"), ts)
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * F.lit(MICROS_PER_DAY)
        + second_of_day.cast("bigint") * F.lit(1_000_000)
        + (seconds * 1_000_000).cast("bigint")
    )


def present(value: Column) -> Column:
    """NaN turned into null: Spark sorts NaN above every number, so NaN >= x holds."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double half up with plain arithmetic.

    `round` goes through the decimal text of the double, other engines do not;
    these few operations give the same digits everywhere.
    """
    scale = F.lit(float(10**digits))
    return F.floor(value.cast("double") * scale + F.lit(0.5)).cast("double") / scale


def rounded_quotient(part: Column, whole: Column, digits: int) -> Column:
    """part / whole of whole numbers, rounded half away from zero without any loss;
    null for an empty whole, which is never negative."""
    scaled = F.abs(part).cast("decimal(38,0)") * F.lit(2 * 10**digits)
    bottom = F.nullif(whole, F.lit(0).cast("bigint")).cast("decimal(38,0)")
    steps = F.call_function(
        "div", (scaled + bottom).cast("decimal(38,0)"), (bottom * F.lit(2)).cast("decimal(38,0)")
    )
    return F.signum(part.cast("double")) * steps.cast("double") / F.lit(float(10**digits))


def rate_pct(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, rounded; null for an empty whole."""
    return rounded_quotient(part * F.lit(100), whole, digits)


def risk_tier(probability: Column) -> Column:
    """HIGH, MEDIUM or LOW; a missing or NaN probability is LOW."""
    p = present(probability)
    return F.when(p >= HIGH_FROM, "HIGH").when(p >= MEDIUM_FROM, "MEDIUM").otherwise("LOW")


def calendar_day_range(ts: Column, first: date, last: date | None = None) -> Column:
    """`ts` on the days first..last, as a half-open range that Parquet can push down."""
    end = (last or first) + timedelta(days=1)
    start_text, end_text = first.isoformat(), end.isoformat()
    return (ts >= F.lit(start_text).cast("timestamp_ntz")) & (
        ts < F.lit(end_text).cast("timestamp_ntz")
    )
