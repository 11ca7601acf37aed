"""Stored tables: Parquet folders, one per finished run, and a log of commits that says which count.

A run writes its tables to new folders. Only when all are written does it commit them, all at once
(``commits``); readers follow the newest commit. A run that fails, or loses its driver, changes nothing, a table
without a finished write cannot be read, and runs may overlap.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weekmeter.schemas import Table
from weekmeter.sources.commits import Counted, Version, children, history, newest, remove

__all__ = [
    "children", "current_versions", "discard", "new_run", "read_audit", "read_table", "read_tables", "read_totals",
    "read_version", "remove", "shared_folder", "table_path", "write_version",
]


def new_run() -> str:
    """A name for a run; names of runs that start later sort after it."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def table_path(folder: str, name: str, run: str) -> str:
    return f"{folder.rstrip('/')}/{name}/{run}"


def current_versions(spark: SparkSession, folder: str) -> dict[str, Version]:
    """The current version of each table of a folder, from the newest commit."""
    return dict(newest(spark, folder).versions)


def read_version(spark: SparkSession, folder: str, name: str, version: Version) -> DataFrame:
    """The schema is given, so no file footer is read to plan a query."""
    columns = [part.split()[0] for part in version.ddl.split(", ")]
    return spark.read.schema(version.ddl).parquet(table_path(folder, name, version.run)).select(*columns)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The current version of a stored table."""
    return read_tables(spark, folder, [name])[name]


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Several stored tables, all as one list names them."""
    versions = current_versions(spark, folder)
    names = list(names)
    missing = [name for name in names if name not in versions]
    if missing:
        raise ValueError(f"no finished write of {', '.join(missing)} in {folder}")
    return {name: read_version(spark, folder, name, versions[name]) for name in names}


def read_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of all finished runs."""
    return history(spark, folder).drop("totals")


def read_totals(spark: SparkSession, folder: str) -> dict[str, dict[str, str]]:
    """The sums that were seen while the current version of each table was written, with ``rows``; few rows."""
    current = {name: version.run for name, version in current_versions(spark, folder).items()}
    rows = history(spark, folder).where("totals is not null").collect() if current else []
    return {r.table_name: r.totals for r in rows if current.get(r.table_name) == r.run}


def write_version(
    df: DataFrame, folder: str, name: str, table: Table, run: str, totals: Mapping[str, Column] | None = None,
    split_by: tuple[str, ...] = (),
) -> Counted:
    """Write a table for a run and return its row count and some sums, without a second scan.

    Partitioned tables are first rebalanced on the partition column: small weeks share a task and a
    week that holds much of the table is split over several, so files are neither tiny nor huge. Tables are
    ``split_by`` few values as their rows come, without a shuffle; a reader need not know of these columns.

    They are observed last, in the stage that writes. Spark counts each task of that stage
    once, also when an executor is lost and tasks run again; before a shuffle it could count twice.
    """
    if table.partition_by:
        df = df.hint("rebalance", *table.partition_by)
    seen = Observation()
    sums = {"rows": F.count(F.lit(1)), **(totals or {})}
    writer = df.observe(seen, *[total.cast("string").alias(key) for key, total in sums.items()]).write
    if table.partition_by or split_by:
        writer = writer.partitionBy(*table.partition_by, *split_by)
    writer.parquet(table_path(folder, name, run))
    found = {key: value for key, value in seen.get.items() if value is not None}
    return Counted(None, int(found["rows"]), found)


def discard(spark: SparkSession, folder: str, run: str, names: Iterable[str]) -> None:
    """Remove what an unfinished run has written."""
    for name in names:
        remove(spark, table_path(folder, name, run))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for written tables, under the shared folder named in ``spark.checkpoint.dir``.

    Only a local session, whose one machine is shared by all its tasks, may go without the setting
    or name a folder of that machine (``file:``).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not spark.sparkContext.master.startswith("local") and (not base or base.startswith("file:")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    base = base or tempfile.mkdtemp(prefix="weekmeter-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
