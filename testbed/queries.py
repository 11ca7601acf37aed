"""One query per table and check, each over the whole tables of a test data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from testbed.fixture import raw_tables
from weekmeter.operators import pricing, quality, rejects
from weekmeter.plans.lazy import LazyTables
from weekmeter.plans.rebuild import rebuild
from weekmeter.schemas import RAW_COLUMNS, TABLES
from weekmeter.session import use_billing_settings
from weekmeter.sources.csv_extracts import Dialect, read_raw, write_raw
from weekmeter.sources.tables import remove, shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def lazy_tables(spark: SparkSession, folder: str) -> LazyTables:
    return LazyTables(raw_tables(use_billing_settings(spark), folder))


def _table(name: str) -> Query:
    return lambda spark, folder: lazy_tables(spark, folder).table(name)


def _layers(spark: SparkSession, folder: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    """Tables a check looks at, as lazy plans: nothing is written, and columns it does not use are not read."""
    t = lazy_tables(spark, folder)
    return {name: t.table(name) for name in names}


# Dialects that extracts are written in, and not named when they are read.
DIALECTS = {"raw_locations": Dialect(";", "'"), "raw_memberships": Dialect("\t"), "raw_rests": Dialect("|", "'")}


def raw_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write the raw tables as CSV, in several dialects, read them back unnamed, and compare them as bags of rows.

    Some shifts and contracts hold line breaks and quotes, so their records go on over lines and ranges. A row is
    compared by a digest of its values, so that rows of any width move as 32 bytes.
    """
    written = dict(raw_tables(use_billing_settings(spark), folder))
    broken = F.concat(F.col("id"), F.lit('\n"two", lines\r\n\n'))
    for name, column in (("raw_shifts", "planification_type"), ("raw_user_contracts", "contract_type")):
        torn = F.when(F.xxhash64("id") % 50 == 0, broken).otherwise(F.col(column))
        written[name] = written[name].withColumn(column, torn)
    target = shared_folder(spark, "extracts")

    def digests(df: DataFrame, name: str, side: str) -> DataFrame:
        values = F.to_json(F.struct(*RAW_COLUMNS[name]), {"ignoreNullFields": "false"})
        own = [F.lit(int(side == s)).alias(s) for s in ("w", "r")]
        return df.select(F.lit(name).alias("table_name"), F.unhex(F.sha2(values, 256)).alias("row"), *own)

    try:
        write_raw(spark, written, target, DIALECTS)
        read = read_raw(spark, target)
        sides = [digests(tables[name], name, side) for tables, side in ((written, "w"), (read, "r")) for name in RAW_COLUMNS]
        per_row = reduce(DataFrame.unionByName, sides).groupBy("table_name", "row").agg(F.sum("w").alias("w"), F.sum("r").alias("r"))
        counts = per_row.groupBy("table_name").agg(
            F.sum("w").alias("rows_written"), F.sum("r").alias("rows_read"), F.sum(F.abs(F.col("w") - F.col("r"))).alias("rows_differing")
        )
        # Six counts; the files go before the result is used.
        found = {row.table_name: tuple(row) for row in counts.collect()}
    finally:
        remove(spark, target)
    rows = [found.get(name, (name, 0, 0, 0)) for name in RAW_COLUMNS]
    return spark.createDataFrame(rows, "table_name string, rows_written bigint, rows_read bigint, rows_differing bigint")


def row_count_audit(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_tables(use_billing_settings(spark), folder)
    target = shared_folder(spark, "audit")
    try:
        return rebuild(spark, raw, target)
    finally:
        remove(spark, target)


def price_boundary_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Every part key, from 0 upwards, as a head count."""
    parts = spark.read.schema("p_partkey bigint").parquet(f"{folder}/part.parquet")
    return pricing.price_grid(parts.distinct())


def dq_orphan_events(spark: SparkSession, folder: str) -> DataFrame:
    t = lazy_tables(spark, folder)
    return quality.orphan_events(t.events, t.stg_user_contracts)


def dq_orphan_contracts(spark: SparkSession, folder: str) -> DataFrame:
    t = lazy_tables(spark, folder)
    return quality.orphan_contracts(t.stg_user_contracts, t.stg_memberships)


def dq_boolean_spellings(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_tables(use_billing_settings(spark), folder)
    return quality.boolean_spellings(raw["raw_locations"], raw["raw_memberships"])


def dq_contract_parse(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_tables(use_billing_settings(spark), folder)
    return quality.contract_parse(raw["raw_user_contracts"])


def dq_multi_contract_members(spark: SparkSession, folder: str) -> DataFrame:
    t = lazy_tables(spark, folder)
    return quality.multi_contract_members(
        t.active_days, t.stg_user_contracts, t.stg_memberships
    )


def dq_inactive_members(spark: SparkSession, folder: str) -> DataFrame:
    t = lazy_tables(spark, folder)
    return quality.inactive_members(t.stg_memberships, t.stg_user_contracts, t.events)


def dq_grain_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return quality.grain_duplicates(_layers(spark, folder, tuple(TABLES)))


def dq_layer_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return quality.layer_reconciliation(_layers(spark, folder, quality.RECONCILED))


def dq_attribution_losses(spark: SparkSession, folder: str) -> DataFrame:
    t = lazy_tables(spark, folder)
    return quality.attribution_losses(
        t.int_employee_activity_weekly, t.stg_user_contracts, t.stg_memberships, t.stg_locations
    )


def dq_rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    t = lazy_tables(spark, folder)
    staged = {name: rejects.staged(name, t.raw) for name in rejects.STAGED}
    return rejects.rejected(staged, t.int_employee_activity_weekly)


CHECKS = (
    raw_csv_roundtrip,
    row_count_audit,
    price_boundary_grid,
    dq_orphan_events,
    dq_orphan_contracts,
    dq_boolean_spellings,
    dq_contract_parse,
    dq_multi_contract_members,
    dq_inactive_members,
    dq_grain_duplicates,
    dq_layer_reconciliation,
    dq_attribution_losses,
    dq_rejected_rows,
)


def queries() -> dict[str, Query]:
    return {**{name: _table(name) for name in TABLES}, **{check.__name__: check for check in CHECKS}}
