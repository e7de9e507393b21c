"""Expressions that are built once: each of their parts is a call from Python to the JVM, seconds for a large one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import TypeVar

from pyspark import SparkContext

Built = TypeVar("Built")


def once(build: Callable[[], Built]) -> Callable[[], Built]:
    """What `build` gives, kept for as long as the application runs. It may hold columns by their names only, never those of a frame."""
    kept: dict[str, Built] = {}

    @wraps(build)
    def built() -> Built:
        application = SparkContext._active_spark_context.applicationId
        if application not in kept:
            found = build()
            kept.clear()
            kept[application] = found
        return kept[application]

    return built
