"""The rate card, weekly revenue per location and weekly billing per account."""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmeter.schemas import TABLES, Table, money


@dataclass(frozen=True)
class Tier:
    """A location size: up to ``most`` employees (no limit if None) at a base price."""

    size: str
    most: int | None
    base_price: int


@dataclass(frozen=True)
class Band:
    """A surcharge per employee for the ``first``-th to the ``last``-th one of a location."""

    column: str
    first: int
    last: int | None
    rate: Decimal

    def employees(self, head_count: Column) -> Column:
        upper = head_count if self.last is None else F.least(head_count, F.lit(self.last))
        return F.greatest(upper - F.lit(self.first - 1), F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class RateCard:
    tiers: tuple[Tier, ...]
    bands: tuple[Band, ...]

    @property
    def money(self) -> str:
        """The type of amounts: with as many decimals as the rates have, two at least."""
        return money(max([2, *(-band.rate.as_tuple().exponent for band in self.bands)]))

    def tables(self) -> dict[str, Table]:
        """All tables, the facts with this card's bands and amounts."""
        bands = "".join(f"{band.column} bigint, " for band in self.bands)
        own = {
            "fct_location_revenue_weekly": "account_id string, location_id string, week_start date, "
            "billable_employee_count bigint, location_size string, is_billable_location boolean, "
            f"base_price int, {bands}extra_employee_cost {self.money}, total_location_revenue {self.money}",
            "fct_account_billing_weekly": "account_id string, week_start date, billable_locations bigint, "
            f"billable_employees bigint, expected_weekly_revenue {self.money}",
        }
        return {name: replace(table, ddl=own.get(name, table.ddl)) for name, table in TABLES.items()}

    def size_of(self, head_count: Column) -> Column:
        *limited, largest = self.tiers
        size = F.lit(largest.size)
        for tier in reversed(limited):
            size = F.when(head_count <= tier.most, tier.size).otherwise(size)
        return size

    def base_price_of(self, size: Column) -> Column:
        first, *others = self.tiers
        price = F.when(size == first.size, first.base_price)
        for tier in others:
            price = price.when(size == tier.size, tier.base_price)
        return price


# The price list. The large base price and the whole 7-39 band add up.
STANDARD_RATES = RateCard(
    tiers=(
        Tier("micro", 5, 60),
        Tier("small", 39, 80),
        Tier("large", None, 216),
    ),
    bands=(
        Band("employees_in_7_39_band", 7, 39, Decimal("4.0")),
        Band("employees_in_40_plus_band", 40, None, Decimal("2.4")),
    ),
)


def location_revenue(metrics: DataFrame, rates: RateCard = STANDARD_RATES) -> DataFrame:
    """Price each location and week. Locations that are not billable stay, at zero.

    Rates are decimals and amounts keep all their decimals, so money is exact.
    """
    head_count = F.col("billable_employee_count")

    def if_billable(value: Column) -> Column:
        return F.when(~F.col("is_billable_location"), 0).otherwise(value)

    priced = metrics.select(
        "account_id",
        "location_id",
        "week_start",
        "billable_employee_count",
        "location_size",
        "is_billable_location",
        if_billable(rates.base_price_of(F.col("location_size"))).alias("base_price"),
        *(if_billable(band.employees(head_count)).alias(band.column) for band in rates.bands),
    )
    extra = reduce(
        Column.__add__, (F.col(band.column) * F.lit(band.rate) for band in rates.bands)
    )
    return priced.select(
        "*",
        extra.cast(rates.money).alias("extra_employee_cost"),
        (F.col("base_price") + extra).cast(rates.money).alias("total_location_revenue"),
    )


def account_billing(revenue: DataFrame, rates: RateCard = STANDARD_RATES) -> DataFrame:
    """Billable locations, their employees, and revenue per account and week.

    Employees are summed over locations: a member at two locations counts twice.
    """
    billable = F.col("is_billable_location")
    return revenue.groupBy("account_id", "week_start").agg(
        F.count_if(billable).alias("billable_locations"),
        F.sum(F.when(billable, F.col("billable_employee_count")).otherwise(0)).alias(
            "billable_employees"
        ),
        F.sum("total_location_revenue").cast(rates.money).alias("expected_weekly_revenue"),
    )


def price_grid(head_counts: DataFrame, rates: RateCard = STANDARD_RATES) -> DataFrame:
    """Price every head count of a one-column table, for a billable and a non-billable location."""
    head_count = F.col(head_counts.columns[0]).cast("bigint")
    grid = head_counts.select(
        F.lit(None).cast("string").alias("account_id"),
        F.lit(None).cast("string").alias("location_id"),
        F.lit(None).cast("date").alias("week_start"),
        head_count.alias("billable_employee_count"),
        rates.size_of(head_count).alias("location_size"),
        F.explode(F.array(F.lit(True), F.lit(False))).alias("is_billable_location"),
    )
    return location_revenue(grid, rates).drop("account_id", "location_id", "week_start")
