"""Running several Spark jobs at once from one driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def own_properties(spark: SparkSession, jobs: Sequence[Callable]) -> list[Callable]:
    """The jobs, each with its own copy of the caller's local properties.

    A copy is made when the decorator is called and is installed in every thread
    that runs the result, so jobs that share one would change it under each other.
    """
    return [inheritable_thread_target(spark)(job) for job in jobs]
