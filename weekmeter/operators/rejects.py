"""The rows behind the data-quality counts: what was set aside or lost, with the reason and the raw text.

Staging finds unreadable texts in the pass that types them: each row carries its ``problems``, and rows that have
any are written to files of their own (``set_aside``) by the same job. References are checked on the typed rows.

A row of ``rejected`` is one reason of one row. ``row_id`` is the row's id (of a week: its contract), ``field`` the raw
column at fault, ``raw_value`` its text as it came. ``row_count`` is 1, or the copies of the contract through which
a week is lost. Rows are listed, not removed: staging keeps every row, with NULL for what cannot be read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmeter.functions.dates import contract_date, utc_timestamp
from weekmeter.functions.text import category, flag, hours
from weekmeter.operators import staging
from weekmeter.operators.attribution import CONTRACT_KEY
from weekmeter.operators.quality import HOURS_AND_MINUTES, contract_reasons
from weekmeter.schemas import Table

REJECTED = Table(
    "quality",
    "table_name string, row_id string, account_id string, week_start date, "
    "field string, reason string, raw_value string, row_count bigint",
    ("table_name", "row_id", "account_id", "week_start", "field", "reason"),
)

# Columns that staged rows have beyond those of their table.
PROBLEM_DDL = "problems array<struct<field:string,reason:string,raw_value:string>>, set_aside boolean"
SPLIT_BY = ("set_aside",)

NULL_SALTS = 1024


def _unless(read: Callable[[Column], Column], reason: str) -> Callable[[Column], Column]:
    return lambda text: F.when(text.isNotNull() & read(text).isNull(), reason)


def _hours(text: Column) -> Column:
    unread = _unless(lambda t: hours(t, permissive=True), "unreadable_hours")(text)
    return F.when(category(text).rlike(HOURS_AND_MINUTES), "hours_with_minutes").otherwise(unread)


_time = _unless(lambda text: utc_timestamp(text, permissive=True), "unreadable_time")
_date = _unless(lambda text: contract_date(text, permissive=True), "unreadable_date")
_flag = _unless(flag, "unknown_flag")

# Of each staged table: its raw table, its operator, its id, and the reason (or NULL) for each text it reads.
STAGED = {
    "stg_accounts": ("raw_accounts", staging.accounts, "account_id", {"created_at": _time}),
    "stg_locations": ("raw_locations", staging.locations, "location_id", {"archived": _flag}),
    "stg_memberships": ("raw_memberships", staging.memberships, "membership_id", {"active": _flag}),
    "stg_rests": ("raw_rests", staging.rests, "rest_id", {"starts_at": _time, "ends_at": _time}),
    "stg_shifts": ("raw_shifts", staging.shifts, "shift_id", {"starts_at": _time, "ends_at": _time}),
    "stg_user_contracts": (
        "raw_user_contracts", staging.user_contracts, "user_contract_id",
        {"contract_start": _date, "contract_end": _date, "contract_time": _hours},
    ),
}


def staged(name: str, raw: Mapping[str, DataFrame]) -> DataFrame:
    """A staged table, read permissively, with its rows' problems (NULL if none): one pass, no shuffle."""
    source, operator, _, checks = STAGED[name]

    def problem(field: str, check: Callable[[Column], Column]) -> Column:
        text = F.col(field).cast("string")
        entry = F.struct(F.lit(field).alias("field"), check(text).alias("reason"), text.alias("raw_value"))
        return F.when(check(text).isNotNull(), entry)

    found = F.array_compact(F.array(*(problem(*item) for item in checks.items())))
    problems = F.when(F.size(found) > 0, found)
    return operator(raw[source], True, problems.alias("problems"), problems.isNotNull().alias("set_aside"))


def rejected(tables: Mapping[str, DataFrame], weekly: DataFrame) -> DataFrame:
    """All set-aside texts, references that lead nowhere, and weeks that reach no location.

    ``tables`` are the staged tables with ``problems`` and ``set_aside``; stored ones are split by the
    latter, so that only the set-aside files are read for the texts. ``weekly`` is the weekly activity. The counts of
    ``orphan_events``, ``orphan_contracts``, ``contract_parse`` and ``attribution_losses`` are those of these rows.
    """
    contracts, memberships = tables["stg_user_contracts"], tables["stg_memberships"]
    parts = [
        *(_unreadable(name, tables[name]) for name in STAGED),
        *(_dangling(name, tables[name], "user_contract_id", contracts) for name in ("stg_shifts", "stg_rests")),
        _dangling("stg_user_contracts", contracts, "membership_id", memberships),
        _lost_weeks(weekly, contract_reasons(contracts, memberships, tables["stg_locations"])),
    ]
    return reduce(DataFrame.unionByName, parts)


def _listed(table: str, rows: DataFrame, row_id: str, **columns: Column) -> DataFrame:
    given = {"week_start": F.lit(None).cast("date"), "row_count": F.lit(1).cast("bigint"), **columns}
    known = {"table_name": F.lit(table), "row_id": F.col(row_id), "account_id": F.col("account_id"), **given}
    return rows.select(*(known[name].alias(name) for name in REJECTED.columns))


def _unreadable(name: str, rows: DataFrame) -> DataFrame:
    row_id = STAGED[name][2]
    entries = rows.where("set_aside").select(F.col(row_id).alias("row_id"), "account_id", F.explode("problems").alias("entry"))
    return _listed(name, entries, "row_id", **{c: F.col(f"entry.{c}") for c in ("field", "reason", "raw_value")})


def _dangling(name: str, rows: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Rows whose key is NULL or unknown. NULL keys match nothing, so they are salted over many tasks."""
    row_id = STAGED[name][2]
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(row_id), F.lit(NULL_SALTS)).cast("int")).otherwise(0)
    columns = dict.fromkeys((row_id, "account_id", key))
    found = rows.select(*columns, salt.alias("salt")).join(
        known.select(key).distinct().withColumn("salt", F.lit(0)), [key, "salt"], "left_anti"
    )
    reason = F.when(F.col(key).isNull(), "null_id").otherwise("unknown_id")
    return _listed(name, found, row_id, field=F.lit(key), reason=reason, raw_value=F.col(key))


def _lost_weeks(weekly: DataFrame, reasons: DataFrame) -> DataFrame:
    at_fault = F.when(F.col("reason").startswith("location"), "location_id").otherwise("membership_id")
    text = F.when(at_fault == "location_id", F.col("location_id")).otherwise(F.col("membership_id"))
    causes = reasons.groupBy(*CONTRACT_KEY, "reason", at_fault.alias("field"), text.alias("raw_value")).agg(
        F.sum("copies").alias("row_count")
    )
    lost = weekly.select(*CONTRACT_KEY, "week_start").join(causes, CONTRACT_KEY, "left").where("reason is null or reason <> 'none'")
    absent = F.col("reason").isNull()
    return _listed(
        "int_employee_activity_weekly", lost, "user_contract_id",
        week_start=F.col("week_start"),
        field=F.when(absent, "user_contract_id").otherwise(F.col("field")),
        reason=F.coalesce("reason", F.lit("contract_not_in_account")),
        raw_value=F.when(absent, F.col("user_contract_id")).otherwise(F.col("raw_value")),
        row_count=F.coalesce("row_count", F.lit(1).cast("bigint")),
    )
