"""Independent Spark actions, run at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def run_together(
    spark: SparkSession, action: Callable[[Item], Result], items: Iterable[Item]
) -> list[Result]:
    """``action`` of each item, in the items' order. Waits for all, then raises the first failure.

    The tasks of small actions fill executors that would wait for a large one's last tasks. Each
    thread gets its own copy of the caller's job group and other local properties.
    """
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action), item) for item in items]
    return [future.result() for future in running]
