"""Rounding, clamping, noise and the air-quality index."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# PM2.5 concentration bands (low, high) and their index bands (low, high).
AQI_BANDS = (
    (0.0, 9.0, 0, 50),
    (9.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 125.4, 151, 200),
    (125.5, 225.4, 201, 300),
    (225.5, 500.4, 301, 500),
)
AQI_CEILING = 500


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def stable_round(value: Column | str, digits: int = 2) -> Column:
    """Half-up rounding that does not depend on the order in which doubles were summed.

    A distributed sum of doubles carries noise in its last bits that changes with the shuffle order and
    flips results that sit on a rounding tie.  Rounding to eight places first removes the noise.
    """
    return F.round(F.round(_column(value), 8), digits)


def clamp(value: Column | str, low: float | None, high: float | None) -> Column:
    """Keep a number inside [low, high]; null stays null."""
    col = _column(value)
    out = col
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(col.isNotNull(), out)


def relative_noise(value: Column | str, half_width: float, seed: int) -> Column:
    """Multiply by a uniform factor in [1 - half_width, 1 + half_width)."""
    return _column(value) * (F.lit(1.0) + (F.rand(seed) - F.lit(0.5)) * F.lit(2.0 * half_width))


def pm25_to_aqi(value: Column | str) -> Column:
    """Air-quality index of a PM2.5 reading as text: linear inside a band, half-even rounding, empty if unusable."""
    reading = _column(value).try_cast("double")
    level = F.when(F.isnan(reading), F.lit(0.0)).otherwise(F.greatest(reading, F.lit(0.0)))
    index = F.lit(float(AQI_CEILING))
    for low, high, index_low, index_high in reversed(AQI_BANDS):
        slope = (index_high - index_low) / (high - low)
        index = F.when(level <= high, (level - low) * slope + index_low).otherwise(index)
    bounded = F.least(F.greatest(F.bround(index, 0), F.lit(0.0)), F.lit(float(AQI_CEILING)))
    return F.when(reading.isNull(), F.lit("")).otherwise(bounded.cast("int").cast("string"))
