"""Column expressions; every one stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Hashable

from pyspark import SparkContext
from pyspark.sql import Column

_BUILT: dict[Hashable, Column] = {}


def built_once(key: Hashable, build: Callable[[], Column]) -> Column:
    """A Column that names its inputs, kept for the life of the context.

    Building a large expression costs a second of calls into the JVM; a
    micro-batch should not pay for it each time.
    """
    context = SparkContext._active_spark_context
    place = (context.applicationId if context else None, key)
    if place not in _BUILT:
        _BUILT[place] = build()
    return _BUILT[place]
