"""Session settings for a block of work."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def with_settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """What is planned and run within has these settings; afterwards they are as before."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
