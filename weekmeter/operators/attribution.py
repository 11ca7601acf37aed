"""From contract activity to billable employees and head counts per location."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmeter.operators.activity import weeks_of
from weekmeter.operators.pricing import STANDARD_RATES, RateCard

MEMBER_KEY = ["membership_id", "account_id"]
CONTRACT_KEY = ["user_contract_id", "account_id"]
LOCATION_KEY = ["location_id", "account_id"]


def staffed_contracts(contracts: DataFrame, memberships: DataFrame) -> DataFrame:
    """Contracts whose membership exists in the same account, each once.

    Copies of a contract or membership would only repeat rows that the next steps group away, so
    they are merged (on the map side first) before any join can multiply them. For memberships
    this takes no shuffle of its own: the join needs the same partitioning.
    """
    known = memberships.select(*MEMBER_KEY).distinct()
    return (
        contracts.select(*CONTRACT_KEY, "membership_id", "location_id")
        .distinct()
        .join(known, MEMBER_KEY, "left_semi")
    )


def contract_activity(activity: DataFrame, contracts: DataFrame, memberships: DataFrame) -> DataFrame:
    """Weekly activity with the member and home location of its contract; accounts must agree.

    ``activity`` is the weekly table, or the active days of events, which are unpacked into weeks
    after the join.
    """
    attributed = activity.join(staffed_contracts(contracts, memberships), CONTRACT_KEY)
    if "span_days" in activity.columns:
        attributed = weeks_of(attributed)
    return attributed.select(
        "account_id",
        "week_start",
        "membership_id",
        "user_contract_id",
        "location_id",
        "active_days_in_week",
    )


def billable_employees(attributed: DataFrame) -> DataFrame:
    """One row per account, week, member and home location.

    Contract ids are text, so the smallest is the first in text order. The day count is the largest
    of the member's contracts, not the union of their days.
    """
    return (
        attributed.groupBy("account_id", "week_start", "membership_id", "location_id")
        .agg(
            F.min("user_contract_id").alias("user_contract_id"),
            F.max("active_days_in_week").alias("active_days_in_week"),
        )
        .withColumn("is_billable_employee", F.lit(1))
    )


def head_counts(employees: DataFrame) -> DataFrame:
    """Members per account, location and week.

    A plain count: the grain of ``employees`` already holds each member once, and never NULL.
    """
    return employees.groupBy("account_id", "location_id", "week_start").agg(
        F.count(F.lit(1)).alias("billable_employee_count")
    )


def location_metrics(
    employees: DataFrame, locations: DataFrame, rates: RateCard = STANDARD_RATES
) -> DataFrame:
    """Head counts with the location's archived flag and size; an unknown flag is not billable.

    Counting comes before the join, so the join sees one row per location and week.
    """
    flags = locations.select(*LOCATION_KEY, "is_archived")
    return (
        head_counts(employees)
        .join(flags, LOCATION_KEY)
        .select(
            "account_id",
            "location_id",
            "week_start",
            "billable_employee_count",
            "is_archived",
            F.coalesce(~F.col("is_archived"), F.lit(False)).alias("is_billable_location"),
            rates.size_of(F.col("billable_employee_count")).alias("location_size"),
        )
    )
