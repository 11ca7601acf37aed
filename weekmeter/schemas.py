"""Names, columns and grains of every table, in one place."""

from __future__ import annotations

from dataclasses import dataclass

# The six raw extracts, their files and the columns read from each.
RAW_FILES = {
    "raw_accounts": "accounts.csv",
    "raw_locations": "locations.csv",
    "raw_memberships": "memberships.csv",
    "raw_rests": "rests.csv",
    "raw_shifts": "shifts.csv",
    "raw_user_contracts": "user_contracts.csv",
}

RAW_COLUMNS = {
    "raw_accounts": ["id", "name", "created_at", "time_zone", "country"],
    "raw_locations": ["id", "name", "account_id", "archived", "city", "zipcode", "country"],
    "raw_memberships": ["id", "user_id", "account_id", "active", "role", "firstname", "lastname"],
    "raw_rests": ["id", "user_contract_id", "account_id", "starts_at", "ends_at", "rest_type"],
    "raw_shifts": ["id", "user_contract_id", "account_id", "starts_at", "ends_at", "planification_type"],
    "raw_user_contracts": [
        "id", "membership_id", "location_id", "account_id",
        "contract_start", "contract_end", "contract_type", "contract_time",
    ],
}

def money(decimals: int) -> str:
    """An exact amount below 10**16 with so many decimals."""
    return f"decimal({16 + decimals},{decimals})"


MONEY = money(2)


@dataclass(frozen=True)
class Table:
    """One output table: the group it is rebuilt with, its columns and its grain."""

    group: str
    ddl: str
    grain: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    counts_input: str | None = None  # the audit also reports this table's rows

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.ddl.split(", ")]


_ACCOUNT = "account_id string, account_name string, created_at timestamp_ntz, time_zone string, country string"
_LOCATION = (
    "location_id string, location_name string, account_id string, is_archived boolean, "
    "city string, zipcode string, country string"
)
_MEMBERSHIP = (
    "membership_id string, user_id string, account_id string, is_active boolean, "
    "role string, first_name string, last_name string"
)

# In rebuild order: a table only reads tables above it. Names, columns and types.
TABLES = {
    "stg_accounts": Table("staging", _ACCOUNT, ("account_id",)),
    "stg_locations": Table("staging", _LOCATION, ("location_id",)),
    "stg_memberships": Table("staging", _MEMBERSHIP, ("membership_id",)),
    "stg_rests": Table(
        "staging",
        "rest_id string, user_contract_id string, account_id string, "
        "starts_at_utc timestamp_ntz, ends_at_utc timestamp_ntz, rest_type string",
        ("rest_id",),
    ),
    "stg_shifts": Table(
        "staging",
        "shift_id string, user_contract_id string, account_id string, "
        "starts_at_utc timestamp_ntz, ends_at_utc timestamp_ntz, planification_type string",
        ("shift_id",),
    ),
    "stg_user_contracts": Table(
        "staging",
        "user_contract_id string, membership_id string, location_id string, account_id string, "
        "contract_start date, contract_end date, contract_type string, contract_time double",
        ("user_contract_id",),
    ),
    "int_all_schedules": Table(
        "intermediate",
        "event_id string, event_type string, user_contract_id string, account_id string, "
        "starts_at_utc timestamp_ntz, ends_at_utc timestamp_ntz, activity_date date, week_start date",
        ("event_type", "event_id"),
    ),
    "int_employee_activity_daily": Table(
        "intermediate",
        "user_contract_id string, account_id string, activity_date date, week_start date, "
        "schedule_count bigint, had_activity int",
        ("user_contract_id", "account_id", "activity_date"),
        partition_by=("week_start",),
        counts_input="int_all_schedules",
    ),
    "int_employee_activity_weekly": Table(
        "intermediate",
        "user_contract_id string, account_id string, week_start date, "
        "active_days_in_week bigint, had_activity_in_week int",
        ("user_contract_id", "account_id", "week_start"),
        partition_by=("week_start",),
        counts_input="int_employee_activity_daily",
    ),
    "int_billable_employees_weekly": Table(
        "intermediate",
        "account_id string, week_start date, membership_id string, location_id string, "
        "user_contract_id string, active_days_in_week bigint, is_billable_employee int",
        ("account_id", "week_start", "membership_id", "location_id"),
        partition_by=("week_start",),
    ),
    "int_location_metrics_weekly": Table(
        "intermediate",
        "account_id string, location_id string, week_start date, billable_employee_count bigint, "
        "is_archived boolean, is_billable_location boolean, location_size string",
        ("account_id", "location_id", "week_start"),
        partition_by=("week_start",),
    ),
    "dim_accounts": Table("dimensions", _ACCOUNT, ("account_id",)),
    "dim_locations": Table("dimensions", _LOCATION, ("location_id",)),
    "dim_memberships": Table("dimensions", _MEMBERSHIP, ("membership_id",)),
    "dim_calendar_weekly": Table(
        "dimensions", "week_start date, week_end date, iso_week int", ("week_start",)
    ),
    "fct_location_revenue_weekly": Table(
        "facts",
        "account_id string, location_id string, week_start date, billable_employee_count bigint, "
        "location_size string, is_billable_location boolean, base_price int, "
        "employees_in_7_39_band bigint, employees_in_40_plus_band bigint, "
        f"extra_employee_cost {MONEY}, total_location_revenue {MONEY}",
        ("account_id", "location_id", "week_start"),
        partition_by=("week_start",),
    ),
    "fct_account_billing_weekly": Table(
        "facts",
        "account_id string, week_start date, billable_locations bigint, "
        f"billable_employees bigint, expected_weekly_revenue {MONEY}",
        ("account_id", "week_start"),
        partition_by=("week_start",),
    ),
}

GROUPS = ("staging", "intermediate", "dimensions", "facts")
