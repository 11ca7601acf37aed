"""Data-quality reports.

Each that counts groups before it joins and keeps NULL keys out of the joins, so that a hot key, a missing key
or a mass of copies costs a few rows instead of one overfull task. Grouping the side that is only
looked up takes no shuffle of its own: the join needs the same partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmeter.functions.dates import contract_date
from weekmeter.functions.text import category, flag, hours
from weekmeter.operators.attribution import (
    CONTRACT_KEY,
    LOCATION_KEY,
    MEMBER_KEY,
    contract_activity,
)
from weekmeter.schemas import MONEY, TABLES

# Fixed value: hours with minutes after the "h", which the hours parser runs together.
HOURS_AND_MINUTES = r"\dh\s*\d"


def _rows() -> Column:
    return F.count(F.lit(1)).alias("row_count")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphan_events(events: DataFrame, contracts: DataFrame) -> DataFrame:
    """Events whose contract id is NULL or unknown, counted by type and reason."""
    per_contract = events.groupBy("event_type", "user_contract_id").agg(_rows())
    orphans = per_contract.join(
        contracts.select("user_contract_id").distinct(), "user_contract_id", "left_anti"
    )
    reason = F.when(F.col("user_contract_id").isNull(), "null_id").otherwise("unknown_id")
    return orphans.groupBy("event_type", reason.alias("reason")).agg(
        F.sum("row_count").alias("event_count")
    )


def orphan_contracts(contracts: DataFrame, memberships: DataFrame) -> DataFrame:
    """Contracts whose membership is NULL or unknown, with one scan of the contracts.

    Contracts without a membership match nothing and stay. Every copy is a row of the result, so rows are
    not grouped: they stream through the join, where the adaptive skew join may split a hot membership.
    """
    known = memberships.select("membership_id").distinct()
    return contracts.select("user_contract_id", "account_id", "membership_id").join(
        known, "membership_id", "left_anti"
    ).select("user_contract_id", "account_id", "membership_id")


def boolean_spellings(raw_locations: DataFrame, raw_memberships: DataFrame) -> DataFrame:
    """Raw flag texts with what they are read as (NULL if not recognised) and how often they occur.

    Each distinct text is read once, after the grouping.
    """
    texts = _union(
        [
            raw_locations.select(
                F.lit("locations.archived").alias("source_column"),
                F.col("archived").cast("string").alias("raw_value"),
            ),
            raw_memberships.select(
                F.lit("memberships.active").alias("source_column"),
                F.col("active").cast("string").alias("raw_value"),
            ),
        ]
    )
    counts = texts.groupBy("source_column", "raw_value").agg(_rows())
    return counts.select(
        "source_column", "raw_value", flag(F.col("raw_value")).alias("normalised"), "row_count"
    )


def contract_parse(raw_contracts: DataFrame) -> DataFrame:
    """Contract dates and hours that read as NULL, and hours with minutes. Never fails on bad text."""
    fields = ("contract_start", "contract_end", "contract_time")
    texts = raw_contracts.select(
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("raw_value"))
                    for name in fields
                )
            )
        ).alias("entry")
    ).select("entry.field", "entry.raw_value")
    counts = (
        texts.filter(F.col("raw_value").isNotNull()).groupBy("field", "raw_value").agg(_rows())
    )
    text = F.col("raw_value")
    suspicious = F.when(
        F.col("field") == "contract_time",
        hours(text, permissive=True).isNull() | category(text).rlike(HOURS_AND_MINUTES),
    ).otherwise(contract_date(text, permissive=True).isNull())
    return counts.filter(suspicious)


def multi_contract_members(
    activity: DataFrame, contracts: DataFrame, memberships: DataFrame
) -> DataFrame:
    """Members with more than one contract active in a week, with their contracts and locations.

    ``activity`` is as for ``contract_activity``. Contracts and locations of a member become rows of their
    own, distinct before they are counted, so that a member of very many fills no task's memory.
    """
    rows = contract_activity(activity, contracts, memberships)
    member = ["account_id", "week_start", "membership_id"]
    names = ("user_contract_id", "location_id")
    entries = F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in names))
    distinct = (
        rows.select(*member, F.explode(entries).alias("entry"))
        .select(*member, "entry.kind", "entry.value")
        .filter("value is not null")
        .distinct()
    )
    counts = [
        F.count(F.when(F.col("kind") == c, True)).alias(name)
        for c, name in zip(names, ("contract_count", "location_count"), strict=True)
    ]
    return distinct.groupBy(*member).agg(*counts).filter("contract_count > 1")


def inactive_members(memberships: DataFrame, contracts: DataFrame, activity: DataFrame) -> DataFrame:
    """Memberships without any attributed activity.

    ``activity`` may be events or any roll-up of them: only which contract and account it names
    counts, so weeks are dropped before anything is shuffled.
    """
    worked = activity.select(*CONTRACT_KEY).distinct()
    active = contracts.join(worked, CONTRACT_KEY, "left_semi").select(*MEMBER_KEY).distinct()
    return memberships.select(*MEMBER_KEY).join(active, MEMBER_KEY, "left_anti")


def grain_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys that occur more than once at each table's grain, and the rows beyond the first.

    All tables share one exchange: a row is its table's name and a 256-bit digest of its key, counted per map
    task first, so a key that repeats often moves little. The digest is of the key as JSON with NULLs in it,
    which tells values and columns apart.
    """

    def keys(name: str, df: DataFrame) -> DataFrame:
        key = F.to_json(F.struct(*TABLES[name].grain), {"ignoreNullFields": "false"})
        return df.select(F.lit(name).alias("table_name"), F.unhex(F.sha2(key, 256)).alias("key"))

    counts = _union([keys(name, df) for name, df in tables.items()]).groupBy("table_name", "key").agg(_rows())
    more = F.col("row_count") > 1
    found = counts.groupBy("table_name").agg(
        F.count(F.when(more, True)).alias("duplicate_keys"), F.sum(F.when(more, F.col("row_count") - 1)).alias("extra_rows")
    )
    # A table without rows has a result, too.
    names = F.explode(F.array(*map(F.lit, tables))).alias("table_name")
    every = next(iter(tables.values())).sparkSession.range(1).select(names)
    zero = F.lit(0).cast("bigint")
    return every.join(found, "table_name", "left").select(
        "table_name",
        F.coalesce("duplicate_keys", zero).alias("duplicate_keys"),
        F.coalesce("extra_rows", zero).alias("extra_rows"),
    )


# Totals that must agree: of a check, two sides, each a table and what is summed of it.
_ROWS = "count(1)"
LAYER_CHECKS = {
    "events_vs_daily_counts": (
        ("int_all_schedules", _ROWS),
        ("int_employee_activity_daily", "sum(schedule_count)"),
    ),
    "daily_rows_vs_active_days": (
        ("int_employee_activity_daily", _ROWS),
        ("int_employee_activity_weekly", "sum(active_days_in_week)"),
    ),
    "location_vs_account_revenue": (
        ("fct_location_revenue_weekly", "sum(total_location_revenue)"),
        ("fct_account_billing_weekly", "sum(expected_weekly_revenue)"),
    ),
}

# The tables whose totals are compared.
RECONCILED = tuple(dict.fromkeys(table for sides in LAYER_CHECKS.values() for table, _ in sides))


def layer_totals(table: str) -> dict[str, Column]:
    """The totals of a table that checks compare, by name, to be seen while the table is written."""
    return {what: F.expr(what) for sides in LAYER_CHECKS.values() for name, what in sides if name == table}


def layer_reconciliation(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Totals that must agree between a table and the one built from it, from the tables' rows.

    Each table is read once for all its totals.
    """

    def totals(table: str) -> DataFrame:
        found = tables[table].agg(*[total.cast(MONEY).alias(what) for what, total in layer_totals(table).items()])
        entries = [
            F.struct(F.lit(check).alias("check_name"), F.lit(side).alias("side"), F.col(f"`{what}`").alias("total"))
            for check, sides in LAYER_CHECKS.items()
            for side, (name, what) in zip(("left", "right"), sides, strict=True)
            if name == table
        ]
        return found.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")

    return _agreement(_union([totals(table) for table in RECONCILED]))


def reconciled_totals(spark: SparkSession, seen: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """The same from the totals that were seen while the tables were written: no table is read.

    ``seen`` has the totals by table (``sources.tables.read_totals``); a sum over no rows is not among them.
    """
    rows = [
        (check, side, seen[table].get(what))
        for check, sides in LAYER_CHECKS.items()
        for side, (table, what) in zip(("left", "right"), sides, strict=True)
    ]
    given = spark.createDataFrame(rows, "check_name string, side string, total string")
    return _agreement(given.withColumn("total", F.col("total").cast(MONEY)))


def _agreement(totals: DataFrame) -> DataFrame:
    def one(side: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == side, F.col("total"))), F.lit(0).cast(MONEY))

    return (
        totals.groupBy("check_name")
        .agg(one("left").alias("left_total"), one("right").alias("right_total"))
        .withColumn("agrees", F.col("left_total") == F.col("right_total"))
    )


def contract_reasons(contracts: DataFrame, memberships: DataFrame, locations: DataFrame) -> DataFrame:
    """Distinct contracts, their copies, and the first reason for which activity reaches no location, or ``none``."""

    def known(df: DataFrame, key: list[str], name: str) -> DataFrame:
        return df.select(*key).distinct().withColumn(name, F.lit(True))

    return (
        contracts.groupBy(*CONTRACT_KEY, "membership_id", "location_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .join(known(memberships, MEMBER_KEY, "member_known"), MEMBER_KEY, "left")
        .join(known(locations, LOCATION_KEY, "location_known"), LOCATION_KEY, "left")
        .select(
            *CONTRACT_KEY,
            "membership_id",
            "location_id",
            "copies",
            F.when(F.col("membership_id").isNull(), "membership_missing")
            .when(F.col("member_known").isNull(), "membership_not_in_account")
            .when(F.col("location_id").isNull(), "location_missing")
            .when(F.col("location_known").isNull(), "location_not_in_account")
            .otherwise("none")
            .alias("reason"),
        )
    )


def attribution_losses(
    weekly: DataFrame, contracts: DataFrame, memberships: DataFrame, locations: DataFrame
) -> DataFrame:
    """Weekly rows that reach no location, counted by the first reason that applies.

    The reason is found per distinct contract; activity joins last, as one row per contract and
    account. A repeated contract counts each of its copies.
    """
    reasons = contract_reasons(contracts, memberships, locations)
    per_contract = weekly.groupBy(*CONTRACT_KEY).agg(_rows())
    return (
        per_contract.join(reasons, CONTRACT_KEY, "left")
        .select(
            F.coalesce("reason", F.lit("contract_not_in_account")).alias("reason"),
            (F.col("row_count") * F.coalesce("copies", F.lit(1))).alias("row_count"),
        )
        .filter("reason <> 'none'")
        .groupBy("reason")
        .agg(F.sum("row_count").alias("row_count"))
    )
