"""Every table as one lazily composed plan over the raw extracts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from weekmeter.operators import activity, attribution, dimensions, pricing, staging
from weekmeter.operators.pricing import STANDARD_RATES, RateCard


class LazyTables:
    """The tables of the model as attributes, each a DataFrame over the raw tables.

    Nothing is stored between the steps, so Spark prunes columns across all of them: account
    billing reads three columns of the events. Roll-ups go straight from the events (see
    ``operators.activity``). For account billing, activity is not checked against contract ids
    first, as the attribution join on contract *and* account is stricter; so events meet contracts
    once, already rolled up.

    A pruned column is never parsed. Bad text in, say, ``ends_at`` fails a rebuild of the stored
    tables but not a lazy query that does not use it.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        rates: RateCard = STANDARD_RATES,
        permissive: bool = False,
    ):
        self.raw = raw
        self.rates = rates
        self.permissive = permissive

    @cached_property
    def stg_accounts(self) -> DataFrame:
        return staging.accounts(self.raw["raw_accounts"], self.permissive)

    @cached_property
    def stg_locations(self) -> DataFrame:
        return staging.locations(self.raw["raw_locations"], self.permissive)

    @cached_property
    def stg_memberships(self) -> DataFrame:
        return staging.memberships(self.raw["raw_memberships"], self.permissive)

    @cached_property
    def stg_rests(self) -> DataFrame:
        return staging.rests(self.raw["raw_rests"], self.permissive)

    @cached_property
    def stg_shifts(self) -> DataFrame:
        return staging.shifts(self.raw["raw_shifts"], self.permissive)

    @cached_property
    def stg_user_contracts(self) -> DataFrame:
        return staging.user_contracts(self.raw["raw_user_contracts"], self.permissive)

    @cached_property
    def events(self) -> DataFrame:
        return activity.events(self.stg_shifts, self.stg_rests)

    @cached_property
    def active_days(self) -> DataFrame:
        return activity.active_days_of_events(self.events)

    @cached_property
    def contract_activity(self) -> DataFrame:
        return attribution.contract_activity(
            self.active_days, self.stg_user_contracts, self.stg_memberships
        )

    @cached_property
    def int_all_schedules(self) -> DataFrame:
        return activity.all_schedules(self.stg_shifts, self.stg_rests, self.stg_user_contracts)

    @cached_property
    def int_employee_activity_daily(self) -> DataFrame:
        return activity.daily_activity_of_events(self.events, self.stg_user_contracts)

    @cached_property
    def int_employee_activity_weekly(self) -> DataFrame:
        return activity.weekly_activity_of_events(self.events, self.stg_user_contracts)

    @cached_property
    def int_billable_employees_weekly(self) -> DataFrame:
        return attribution.billable_employees(self.contract_activity)

    @cached_property
    def int_location_metrics_weekly(self) -> DataFrame:
        return attribution.location_metrics(
            self.int_billable_employees_weekly, self.stg_locations, self.rates
        )

    @cached_property
    def fct_location_revenue_weekly(self) -> DataFrame:
        return pricing.location_revenue(self.int_location_metrics_weekly, self.rates)

    @cached_property
    def fct_account_billing_weekly(self) -> DataFrame:
        return pricing.account_billing(self.fct_location_revenue_weekly, self.rates)

    @cached_property
    def dim_accounts(self) -> DataFrame:
        return dimensions.accounts(self.stg_accounts)

    @cached_property
    def dim_locations(self) -> DataFrame:
        return dimensions.locations(self.stg_locations)

    @cached_property
    def dim_memberships(self) -> DataFrame:
        return dimensions.memberships(self.stg_memberships)

    @cached_property
    def dim_calendar_weekly(self) -> DataFrame:
        return dimensions.weekly_calendar_of_events(self.events, self.stg_user_contracts)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
