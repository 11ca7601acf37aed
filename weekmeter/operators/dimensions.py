"""Dimension tables: accounts, locations, memberships and the weekly calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmeter.operators.activity import of_known_contracts


def accounts(staged: DataFrame) -> DataFrame:
    return staged.select("*")


def locations(staged: DataFrame) -> DataFrame:
    return staged.select("*")


def memberships(staged: DataFrame) -> DataFrame:
    return staged.select("*")


def _weeks(span: DataFrame) -> DataFrame:
    """Every Monday of a one-row (first, last) table."""
    mondays = F.expr("sequence(first, last, interval 7 days)")
    return span.select(F.explode(mondays).alias("week_start")).select(
        "week_start",
        F.date_add("week_start", 6).alias("week_end"),
        F.weekofyear("week_start").alias("iso_week"),
    )


def weekly_calendar(weekly: DataFrame) -> DataFrame:
    """Every week from the first to the last active one, whether or not a week has activity."""
    return _weeks(weekly.agg(F.min("week_start").alias("first"), F.max("week_start").alias("last")))


def weekly_calendar_of_events(events: DataFrame, contracts: DataFrame) -> DataFrame:
    """The same weeks from events: one row per contract, then those of known contracts."""
    spans = events.groupBy("user_contract_id").agg(
        F.min("week_start").alias("first"), F.max("week_start").alias("last")
    )
    known = of_known_contracts(spans, contracts)
    return _weeks(known.agg(F.min("first").alias("first"), F.max("last").alias("last")))
