"""Typed and cleaned copies of the raw extracts: one row in, one row out, none filtered.

Each operator takes further columns over the raw ones, to be computed in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmeter.functions.dates import contract_date, utc_timestamp
from weekmeter.functions.text import category, flag, hours


def _text(source: str, name: str | None = None) -> Column:
    return F.col(source).cast("string").alias(name or source)


def accounts(raw: DataFrame, permissive: bool = False, *more: Column) -> DataFrame:
    return raw.select(
        _text("id", "account_id"),
        _text("name", "account_name"),
        utc_timestamp(_text("created_at"), permissive).alias("created_at"),
        _text("time_zone"),
        _text("country"),
        *more,
    )


def locations(raw: DataFrame, permissive: bool = False, *more: Column) -> DataFrame:
    return raw.select(
        _text("id", "location_id"),
        _text("name", "location_name"),
        _text("account_id"),
        flag(_text("archived")).alias("is_archived"),
        _text("city"),
        _text("zipcode"),
        _text("country"),
        *more,
    )


def memberships(raw: DataFrame, permissive: bool = False, *more: Column) -> DataFrame:
    return raw.select(
        _text("id", "membership_id"),
        _text("user_id"),
        _text("account_id"),
        flag(_text("active")).alias("is_active"),
        category(_text("role")).alias("role"),
        _text("firstname", "first_name"),
        _text("lastname", "last_name"),
        *more,
    )


def _events(raw: DataFrame, id_name: str, kind: str, permissive: bool, more: tuple[Column, ...]) -> DataFrame:
    return raw.select(
        _text("id", id_name),
        _text("user_contract_id"),
        _text("account_id"),
        utc_timestamp(_text("starts_at"), permissive).alias("starts_at_utc"),
        utc_timestamp(_text("ends_at"), permissive).alias("ends_at_utc"),
        category(_text(kind)).alias(kind),
        *more,
    )


def rests(raw: DataFrame, permissive: bool = False, *more: Column) -> DataFrame:
    return _events(raw, "rest_id", "rest_type", permissive, more)


def shifts(raw: DataFrame, permissive: bool = False, *more: Column) -> DataFrame:
    return _events(raw, "shift_id", "planification_type", permissive, more)


def user_contracts(raw: DataFrame, permissive: bool = False, *more: Column) -> DataFrame:
    return raw.select(
        _text("id", "user_contract_id"),
        _text("membership_id"),
        _text("location_id"),
        _text("account_id"),
        contract_date(_text("contract_start"), permissive).alias("contract_start"),
        contract_date(_text("contract_end"), permissive).alias("contract_end"),
        category(_text("contract_type")).alias("contract_type"),
        hours(_text("contract_time"), permissive).alias("contract_time"),
        *more,
    )
