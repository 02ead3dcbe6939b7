"""strata: a PySpark lakehouse for trip analytics (bronze, silver, gold, data products)."""

from strata.lake import Lake

__all__ = ["Lake"]
