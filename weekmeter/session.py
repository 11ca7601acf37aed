"""Session settings the results or the plans depend on."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Results depend on these two.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Plans depend on these. Broadcasts are left to Spark: it compares the size it estimated, and then
# the size it measured after the shuffle, with the broadcast thresholds, so no plan in this
# package carries a broadcast hint.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Replaces a sort-merge join by a hash join when every build partition was measured below this,
    # which spares sorting the event side when contracts are too many to broadcast.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Size estimates come from compressed files. Until a size is measured, count them five times,
    # so that a table that is small on disk but large in memory is not broadcast.
    "spark.sql.sources.fileCompressionFactor": "5.0",
}


MIB, GIB = 1 << 20, 1 << 30

# What a shuffle writes per byte of the extracts that are read: the schedule table's join carries whole
SHUFFLED_PER_INPUT_BYTE = 1.3


def shuffle_partitions(shuffled_bytes: float, least: int = 8, usual: int = 256 * MIB) -> int:
    """Shuffle partitions for a shuffle of a known size; adaptive execution merges small ones.

    ``usual`` bytes each up to 4096 of them; above that their size and their number both grow with the square
    root, to 4 GiB each, because the blocks of a shuffle are map tasks times partitions.
    """
    return max(least, math.ceil(shuffled_bytes / _each(shuffled_bytes, usual, 4 * GIB)))


def scan_bytes(input_bytes: float) -> int:
    """Bytes of input per map task: 128 MiB up to 4096 tasks, then growing likewise, to 2 GiB."""
    return int(_each(input_bytes, 128 * MIB, 2 * GIB))


def _each(total: float, usual: int, most: int) -> float:
    return min(most, usual * math.sqrt(max(1.0, total / usual / 4096)))


def estimated_bytes(frames: Iterable[DataFrame]) -> int:
    """Bytes of the files that some tables are read from, by the planner's sizes of their scans.

    Scans whose size is not known count nothing.
    """
    total = 0.0
    for df in frames:
        factor = float(df.sparkSession.conf.get("spark.sql.sources.fileCompressionFactor"))
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for k in range(leaves.size()):
            size = int(str(leaves.apply(k).stats().sizeInBytes()))
            if size < 1 << 60:
                total += size / factor
    return int(total)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Raise shuffle partitions and bytes per map task for an input, and set them back afterwards."""
    wanted = {
        "spark.sql.shuffle.partitions": shuffle_partitions(input_bytes * SHUFFLED_PER_INPUT_BYTE),
        "spark.sql.files.maxPartitionBytes": scan_bytes(input_bytes),
    }
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        if value > setting_number(before[key]):
            spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def setting_number(setting: str) -> int:
    """A count, or a size as Spark writes it: 134217728b, 128m ..."""
    digits = setting.rstrip("bBkKmMgGtT")
    unit = setting[len(digits) :].lower().rstrip("b")
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def billing_session(
    app_name: str = "weekmeter",
    master: str | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session with this package's settings; ``input_bytes`` of events size its shuffles and scans."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sizes = {} if input_bytes is None else {
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes * SHUFFLED_PER_INPUT_BYTE)),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes(input_bytes)),
    }
    for key, value in {**PLAN_SETTINGS, **sizes, **(extra or {}), **RESULT_SETTINGS}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_billing_settings(spark: SparkSession) -> SparkSession:
    """Set what the results depend on, in a session made elsewhere and for good.

    Everything planned later in that session gets the time zone UTC and ANSI errors, too.
    """
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
