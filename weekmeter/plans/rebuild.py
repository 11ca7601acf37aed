"""Rebuild the stored tables, each from the stored tables before it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from weekmeter.operators import activity, attribution, dimensions, pricing, rejects, staging
from weekmeter.operators.pricing import STANDARD_RATES, RateCard
from weekmeter.operators.quality import layer_totals
from weekmeter.schemas import GROUPS
from weekmeter.session import estimated_bytes, sized_shuffles
from weekmeter.sources.commits import Counted, Version, commit, leased, newest, sweep
from weekmeter.sources.tables import discard, new_run, read_version, write_version
from weekmeter.sources.together import run_together

AUDIT = "table_name string, rows_before bigint, rows_after bigint"

# What is written at the same time, phase by phase; the tables of one line one after the other.
PHASES = (
    (
        ("stg_accounts",), ("stg_locations",), ("stg_memberships",),
        ("stg_rests",), ("stg_shifts",), ("stg_user_contracts",),
    ),
    (
        (
            "int_all_schedules", "int_employee_activity_daily", "int_employee_activity_weekly",
            "int_billable_employees_weekly", "int_location_metrics_weekly",
        ),
        ("dim_accounts",), ("dim_locations",), ("dim_memberships",),
    ),
    (
        ("dim_calendar_weekly",),
        ("fct_location_revenue_weekly", "fct_account_billing_weekly"),
        ("rejected",),
    ),
)


def rebuild(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    folder: str,
    groups: Iterable[str] = GROUPS,
    rates: RateCard = STANDARD_RATES,
    permissive: bool = False,
) -> DataFrame:
    """Replace the tables of the chosen groups and return the audit: one row per written table.

    All of them change together once the last is written; a run that fails leaves every table as it
    was. Runs may overlap: those of other groups are both kept, and of two that replace the same table the one
    that finishes first wins and the other raises ``Overtaken``. Tables of groups left out must be in
    ``folder`` already, and are read as they were when the run began. ``rows_before`` is given for the
    two roll-ups and counts the table they read. The audit is stored with the run, too, and so are the totals
    that ``quality.reconciled_totals`` compares.

    A permissive run splits the staged tables into good and set-aside rows as it writes them, and with the
    intermediate group it also stores ``rejected``: which rows have texts that cannot be read, lead nowhere or are lost,
    each with its reason and raw text (``operators.rejects``). A strict run leaves ``rejected`` as it was.

    Shuffles are sized from the estimated size of the raw tables, if the session's setting is lower.
    """
    run = new_run()
    with leased(spark, folder, run) as lease:
        return _rebuild(spark, raw, folder, groups, rates, permissive, run, lease)


def _rebuild(spark, raw, folder, groups, rates, permissive, run, lease) -> DataFrame:
    tables = rates.tables()
    if permissive:
        tables["rejected"] = replace(rejects.REJECTED, group="intermediate")
    begun = newest(spark, folder)
    written: dict[str, Counted] = {}

    def stored(name: str, more: str = "") -> DataFrame:
        version = Version(run, tables[name].ddl) if name in written else begun.versions.get(name)
        if version is None:
            raise ValueError(f"no finished write of {name} in {folder}")
        return read_version(spark, folder, name, Version(version.run, version.ddl + more))

    steps = {
        "rejected": lambda: rejects.rejected(
            {name: stored(name, f", {rejects.PROBLEM_DDL}") for name in rejects.STAGED},
            stored("int_employee_activity_weekly"),
        ),
        "stg_accounts": lambda: staging.accounts(raw["raw_accounts"], permissive),
        "stg_locations": lambda: staging.locations(raw["raw_locations"], permissive),
        "stg_memberships": lambda: staging.memberships(raw["raw_memberships"], permissive),
        "stg_rests": lambda: staging.rests(raw["raw_rests"], permissive),
        "stg_shifts": lambda: staging.shifts(raw["raw_shifts"], permissive),
        "stg_user_contracts": lambda: staging.user_contracts(raw["raw_user_contracts"], permissive),
        "int_all_schedules": lambda: activity.all_schedules(
            stored("stg_shifts"), stored("stg_rests"), stored("stg_user_contracts")
        ),
        "int_employee_activity_daily": lambda: activity.daily_activity(stored("int_all_schedules")),
        "int_employee_activity_weekly": lambda: activity.weekly_activity(
            stored("int_employee_activity_daily")
        ),
        "int_billable_employees_weekly": lambda: attribution.billable_employees(
            attribution.contract_activity(
                stored("int_employee_activity_weekly"),
                stored("stg_user_contracts"),
                stored("stg_memberships"),
            )
        ),
        "int_location_metrics_weekly": lambda: attribution.location_metrics(
            stored("int_billable_employees_weekly"), stored("stg_locations"), rates
        ),
        "dim_accounts": lambda: dimensions.accounts(stored("stg_accounts")),
        "dim_locations": lambda: dimensions.locations(stored("stg_locations")),
        "dim_memberships": lambda: dimensions.memberships(stored("stg_memberships")),
        "dim_calendar_weekly": lambda: dimensions.weekly_calendar(
            stored("int_employee_activity_weekly")
        ),
        "fct_location_revenue_weekly": lambda: pricing.location_revenue(
            stored("int_location_metrics_weekly"), rates
        ),
        "fct_account_billing_weekly": lambda: pricing.account_billing(
            stored("fct_location_revenue_weekly"), rates
        ),
    }

    split_by: dict[str, tuple[str, ...]] = {}
    if permissive:
        steps |= {name: partial(rejects.staged, name, raw) for name in rejects.STAGED}
        split_by = dict.fromkeys(rejects.STAGED, rejects.SPLIT_BY)

    chosen = set(groups)
    unknown = chosen.difference(GROUPS)
    if unknown:
        raise ValueError(f"unknown groups {sorted(unknown)}; choose from {list(GROUPS)}")

    started: list[str] = []

    def write(names: tuple[str, ...]) -> None:
        for name in names:
            if name in tables and tables[name].group in chosen:
                started.append(name)
                written[name] = write_version(
                    steps[name](), folder, name, tables[name], run, layer_totals(name), split_by.get(name, ())
                )

    def counted(name: str) -> Counted:
        before = written.get(tables[name].counts_input)
        return Counted(before and before.rows_after, written[name].rows_after, written[name].totals)

    try:
        with sized_shuffles(spark, estimated_bytes(raw.values())):
            for phase in PHASES:
                run_together(spark, write, [x for x in phase if any(n in tables and tables[n].group in chosen for n in x)])
        counts = {name: counted(name) for name in tables if name in written}
        lease.confirm()
        commit(spark, folder, run, {name: tables[name].ddl for name in counts}, counts, begun)
    except BaseException:
        discard(spark, folder, run, started)
        raise
    sweep(spark, folder, counts)
    return spark.createDataFrame([(name, c.rows_before, c.rows_after) for name, c in counts.items()], AUDIT)
