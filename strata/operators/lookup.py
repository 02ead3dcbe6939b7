"""Which side of a join may be broadcast."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's own size estimate of the plan; no job runs."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # a session without a local JVM
        return None


def auto_broadcast_bytes(df: DataFrame) -> int:
    """The session's automatic broadcast threshold in bytes; zero when switched off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    match = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text)
    return int(match[1]) * 1024 ** " kmgt".index(match[2] or " ") if match else 0


def fits_broadcast(df: DataFrame) -> bool:
    """True when Spark itself would broadcast the frame: its own estimate is within the session's threshold.

    Write a derived side to a table first: the files' size is then the estimate, and nothing has to be counted.
    """
    estimate = estimated_bytes(df)
    return estimate is not None and estimate <= auto_broadcast_bytes(df)
