"""Shifts and rests as one activity table, and its daily and weekly roll-ups.

Each roll-up exists twice: from the table before it (when that table is stored), and straight from
the events. The second form aggregates *before* it looks at contracts. Events are the only table
that grows without bound, so they should cross the network once, as partial aggregates: a contract
that holds a third of all events then sends one row per map task and day or week. Joining first
would shuffle every event by contract id and put that contract in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmeter.functions.dates import (
    SPAN_WEEKS,
    active_days,
    span_bit,
    span_start,
    week_of_span,
    week_start,
)

CONTRACT = "user_contract_id"
ACCOUNT = "account_id"


def _tagged(events: DataFrame, id_name: str, kind: str) -> DataFrame:
    day = F.col("starts_at_utc").cast("date")
    return events.select(
        F.col(id_name).cast("string").alias("event_id"),
        F.lit(kind).alias("event_type"),
        CONTRACT,
        ACCOUNT,
        "starts_at_utc",
        "ends_at_utc",
        day.alias("activity_date"),
        week_start(day).alias("week_start"),
    )


def events(shifts: DataFrame, rests: DataFrame) -> DataFrame:
    """All shifts and rests, dated by their start, whether or not their contract exists."""
    return _tagged(shifts, "shift_id", "shift").unionByName(_tagged(rests, "rest_id", "rest"))


def all_schedules(shifts: DataFrame, rests: DataFrame, contracts: DataFrame) -> DataFrame:
    """Events whose contract id exists. A repeated contract id repeats its events (inner join).

    One join over the union reads contracts once. The result is event-level, so the join cannot
    move behind an aggregate; a hot contract is split by the adaptive skew join, which applies as
    nothing after the join needs its partitioning.
    """
    tagged = events(shifts, rests)
    return tagged.join(contracts.select(CONTRACT), CONTRACT).select(*tagged.columns)


def _daily_counts(schedules: DataFrame) -> DataFrame:
    # The week follows from the day, so it need not be a grouping key.
    return schedules.groupBy(CONTRACT, ACCOUNT, "activity_date").agg(
        F.count(F.lit(1)).alias("schedule_count")
    )


def daily_activity(schedules: DataFrame) -> DataFrame:
    """One row per contract, account and day, from the schedule table."""
    return _daily_counts(schedules).select(
        CONTRACT,
        ACCOUNT,
        "activity_date",
        week_start(F.col("activity_date")).alias("week_start"),
        "schedule_count",
        F.lit(1).alias("had_activity"),
    )


def daily_activity_of_events(tagged: DataFrame, contracts: DataFrame) -> DataFrame:
    """The same rows from events: count first, then keep known contracts.

    A contract id that occurs n times repeats each event n times in the schedule table, so the
    counts are multiplied by n.
    """
    copies = contracts.groupBy(CONTRACT).agg(F.count(F.lit(1)).alias("copies"))
    return (
        _daily_counts(tagged)
        .join(copies, CONTRACT)
        .select(
            CONTRACT,
            ACCOUNT,
            "activity_date",
            week_start(F.col("activity_date")).alias("week_start"),
            (F.col("schedule_count") * F.col("copies")).alias("schedule_count"),
            F.lit(1).alias("had_activity"),
        )
    )


def weekly_activity(daily: DataFrame) -> DataFrame:
    """One row per contract, account and week, from the daily table."""
    return (
        daily.groupBy(CONTRACT, ACCOUNT, "week_start")
        .agg(F.count(F.lit(1)).alias("active_days_in_week"))
        .withColumn("had_activity_in_week", F.lit(1))
    )


def active_days_of_events(tagged: DataFrame) -> DataFrame:
    """The active days of all events, known contract or not: one row per contract, account and span.

    A span is nine weeks and its days are the bits of one number, so the aggregation combines well
    on the map side and shuffles (and later joins) about a ninth of the weekly rows. Events without
    a start have no span; the daily table holds them as one (NULL) day, so one bit is set.
    """
    day = F.col("activity_date")
    spans = tagged.select(
        CONTRACT, ACCOUNT, span_start(day).alias("span_start"), span_bit(day).alias("bit")
    )
    return spans.groupBy(CONTRACT, ACCOUNT, "span_start").agg(
        F.coalesce(F.bit_or("bit"), F.lit(1).cast("bigint")).alias("span_days")
    )


def weeks_of(spans: DataFrame) -> DataFrame:
    """Unpack spans into their active weeks; other columns are kept."""
    others = [c for c in spans.columns if c not in ("span_start", "span_days")]
    number = F.col("number")
    return (
        spans.select("*", F.explode(F.sequence(F.lit(0), F.lit(SPAN_WEEKS - 1))).alias("number"))
        .select(
            *others,
            week_of_span(F.col("span_start"), number).alias("week_start"),
            active_days(F.col("span_days"), number).alias("active_days_in_week"),
        )
        .filter("active_days_in_week > 0")
    )


def weekly_activity_of_events(tagged: DataFrame, contracts: DataFrame) -> DataFrame:
    """The rows of ``weekly_activity`` from events: roll up, keep known contracts, unpack."""
    return weeks_of(of_known_contracts(active_days_of_events(tagged), contracts)).withColumn(
        "had_activity_in_week", F.lit(1)
    )


def of_known_contracts(rows: DataFrame, contracts: DataFrame) -> DataFrame:
    """Rows whose contract id exists; for rows already grouped, where copies make no difference."""
    return rows.join(contracts.select(CONTRACT).distinct(), CONTRACT, "left_semi")
