"""Independent Spark jobs submitted side by side, so that short ones do not leave the cluster idle."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], Result]], width: int = 4) -> dict[str, Result]:
    """Run the jobs from a few driver threads and return their results by name.

    All jobs run to their end; then the first failure, if any, is raised.
    """
    jobs = dict(jobs)
    if not jobs:
        return {}
    with ThreadPoolExecutor(max_workers=min(width, len(jobs))) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
    return {name: future.result() for name, future in futures.items()}
