"""Weather bins and the wind-chill expression used to rank hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bin labels and edges.  A temperature strictly between 10 and 10.01 belongs to no middle bin and
# falls through to the warm label; consumers rely on that, so the gap stays.
TEMPERATURE_LABELS = (
    "Unknown", "Freezing (<0°C)", "Cold (0°C to 10°C)", "Moderate (10°C to 20°C)", "Warm (>20°C)",
)
WIND_LABELS = ("Unknown", "Calm (<2 m/s)", "Moderate Wind (2-6 m/s)", "High Wind (>6 m/s)")


def temperature_bin(value: Column | str) -> Column:
    t = F.col(value) if isinstance(value, str) else value
    unknown, freezing, cold, moderate, warm = TEMPERATURE_LABELS
    return (
        F.when(t.isNull(), unknown)
        .when(t < 0, freezing)
        .when(t.between(0, 10), cold)
        .when(t.between(10.01, 20), moderate)
        .otherwise(warm)
    )


def wind_bin(value: Column | str) -> Column:
    w = F.col(value) if isinstance(value, str) else value
    unknown, calm, moderate, high = WIND_LABELS
    return F.when(w.isNull(), unknown).when(w < 2, calm).when(w.between(2, 6), moderate).otherwise(high)


def wind_chill_index(wind: Column | str, temperature: Column | str) -> Column:
    """Heat loss by wind and cold; null when either input is null.

    It rises as it gets colder, so ascending quartiles start with the mildest hours even though the products
    name the first quartile ``coldest``.  The names are part of the published schema and stay as they are.
    """
    w = F.col(wind) if isinstance(wind, str) else wind
    t = F.col(temperature) if isinstance(temperature, str) else temperature
    return (F.lit(10) * F.sqrt(w) - w + F.lit(10.5)) * (F.lit(33) - t)
