"""The six raw extracts, derived from the whole ``customer``, ``nation`` and ``events`` tables.

An account is a block of 75 customers, a membership is a customer, and every event is a shift or a
rest. ``FIXTURES.md`` gives the rules.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Event types that become rests; all others, also ones not seen before, become shifts.
REST_TYPES = ("signup", "error")


def _read(spark: SparkSession, folder: str, name: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(f"{folder}/{name}.parquet")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their account and, by position in its block, their home site 0, 1, 2 or none."""
    return _read(spark, folder, "customer", "c_custkey bigint").selectExpr(
        "c_custkey as k",
        "c_custkey div 75 as acc",
        "case when c_custkey % 75 < 50 then 0 when c_custkey % 75 < 65 then 1 when c_custkey % 75 < 72 then 2 end as n",
    )


def _accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _customers(spark, folder).select("acc").distinct()


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "nation", "n_nationkey int, n_name string")


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _accounts(spark, folder)
        .selectExpr("*", "acc % 25 as n_nationkey")
        .join(_nations(spark, folder), "n_nationkey")
        .selectExpr(
            "string(acc) as id",
            "concat('Account ', acc) as name",
            "concat('2020-01-', lpad(string(acc % 28 + 1), 2, '0'), ' 08:00:00') as created_at",
            "element_at(array('Europe/Madrid', 'Europe/Paris', 'UTC'), int(acc % 3) + 1) as time_zone",
            "n_name as country",
        )
    )


def locations(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _accounts(spark, folder)
        .selectExpr("acc", "explode(array(0, 1, 2, 3, 4)) as n_nationkey")
        .join(_nations(spark, folder), "n_nationkey")
        .selectExpr("*", "acc * 10 + n_nationkey as site")
        .selectExpr(
            "string(site) as id",
            "concat('Site ', site) as name",
            "string(acc) as account_id",
            """case n_nationkey
                 when 3 then element_at(array('Yes', 'true', '1'), int(acc % 3) + 1)
                 when 4 then if(acc % 2 = 0, 'unknown', null)
                 else element_at(array('No', 'FALSE', ' 0 '), int((acc + n_nationkey) % 3) + 1)
               end as archived""",
            "concat('City ', acc) as city",
            "lpad(string(acc), 5, '0') as zipcode",
            "n_name as country",
        )
    )


def memberships(spark: SparkSession, folder: str) -> DataFrame:
    return _customers(spark, folder).selectExpr(
        "string(k) as id",
        "string(k + 100000) as user_id",
        "string(acc) as account_id",
        "element_at(array('true', 'NO', ' 1 ', 'n/a'), int(k % 4) + 1) as active",
        "element_at(array(' Employee ', 'MANAGER', 'admin'), int(k % 3) + 1) as role",
        "concat('First', k) as firstname",
        "concat('Last', k) as lastname",
    )


def user_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """A main contract (suffix 1) per member, and further ones (2 to 7) for some."""
    return (
        _customers(spark, folder)
        .selectExpr(
            "k",
            "acc",
            "acc * 10 + n as home",
            """explode(array_compact(array(
                 1,
                 if(k % 10 = 0, 2, null),
                 if(k % 10 in (1, 2, 3), 3, null),
                 if(k % 25 = 4, 4, null),
                 if(k % 25 = 5, 5, null),
                 if(k % 25 = 6, 6, null),
                 if(k % 25 = 7, 7, null)))) as suffix""",
        )
        .selectExpr(
            "string(k * 10 + suffix) as id",
            "string(case suffix when 4 then null when 7 then k + 1000000000 else k end) as membership_id",
            """string(case suffix
                 when 3 then acc * 10 + case k % 10 when 1 then 3 when 2 then 4 else 1 end
                 when 6 then (acc + 1) * 10
                 else home end) as location_id""",
            "string(if(suffix = 5, acc + 1, acc)) as account_id",
            "element_at(array('2023-01-15', '15/01/2023', ' 2023-02-01 ', 'n/a'), int(k % 4) + 1) as contract_start",
            "element_at(array(null, '31/12/2024', null, '2024-12-31'), int(k % 4) + 1) as contract_end",
            "element_at(array(' Full_Time ', 'PART_TIME'), int(k % 2) + 1) as contract_type",
            "element_at(array('35h', ' 39H ', '37,5', null, '35h30'), int(k % 5) + 1) as contract_time",
        )
    )


def _events(spark: SparkSession, folder: str, rests: bool, kind: str) -> DataFrame:
    """Rests or shifts. Regular members mostly work on their main contract (suffix 1).

    Times keep their fraction of a second. Every 29th event starts in local time, two hours ahead.
    """
    listed = ", ".join(f"'{t}'" for t in REST_TYPES)
    is_rest = f"coalesce(event_type in ({listed}), false)"
    ddl = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"
    return (
        _read(spark, folder, "events", ddl)
        .filter(is_rest if rests else f"not {is_rest}")
        .selectExpr(
            "string(event_id) as id",
            """string(if(event_id % 37 = 0, null, user_id * 10 + case
                 when event_id % 10 > 3 then event_id % 10 - 2
                 when user_id % 5 < 3 or event_id % 20 = 0 then 1
                 else 8 end)) as user_contract_id""",
            "string(user_id div 75) as account_id",
            """case when event_id % 53 = 0 then null
                 when event_id % 29 = 0 then concat(string(ts + interval 2 hours), '+02:00')
                 else string(ts) end as starts_at""",
            "string(ts + interval 8 hours) as ends_at",
            kind,
        )
    )


def shifts(spark: SparkSession, folder: str) -> DataFrame:
    kind = "if(event_id % 2 = 0, ' Planned ', 'ADHOC') as planification_type"
    return _events(spark, folder, False, kind)


def rests(spark: SparkSession, folder: str) -> DataFrame:
    kind = "element_at(array('Vacation', ' SICK ', 'rest'), int(event_id % 3) + 1) as rest_type"
    return _events(spark, folder, True, kind)


class RawTables(Mapping):
    """The six raw tables; each is planned when first asked for."""

    _builders = {
        "raw_accounts": accounts,
        "raw_locations": locations,
        "raw_memberships": memberships,
        "raw_rests": rests,
        "raw_shifts": shifts,
        "raw_user_contracts": user_contracts,
    }

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self._spark, self._folder)
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def raw_tables(spark: SparkSession, folder: str) -> RawTables:
    return RawTables(spark, folder)
