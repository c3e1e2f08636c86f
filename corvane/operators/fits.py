"""Independent model fits side by side, as the parameter search of pyspark.ml does."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

PARALLEL_FITS = 4


def fit_each(spark: SparkSession, fit: Callable, items: Sequence, parallelism: int = PARALLEL_FITS) -> list:
    items = list(items)
    if not items:
        return []
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(fit), items)
