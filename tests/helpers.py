"""Tiny raw tables for tests: name the columns that matter, the rest is NULL."""

import pyarrow as pa

from weekmeter.plans.lazy import LazyTables
from weekmeter.schemas import RAW_COLUMNS

MONDAY = "2024-01-01"


def raw_frame(spark, name, rows):
    columns = RAW_COLUMNS[name]
    schema = pa.schema([(c, pa.string()) for c in columns])
    return spark.createDataFrame(pa.Table.from_pylist([{c: row.get(c) for c in columns} for row in rows], schema))


def raw_tables(spark, **rows):
    return {name: raw_frame(spark, name, rows.get(name.removeprefix("raw_"), [])) for name in RAW_COLUMNS}


def tables(spark, permissive=False, **rows):
    return LazyTables(raw_tables(spark, **rows), permissive=permissive)


def contract(id, member="m1", location="l1", account="a1", **more):
    return {"id": id, "membership_id": member, "location_id": location, "account_id": account, **more}


def member(id, account="a1", **more):
    return {"id": id, "account_id": account, **more}


def location(id, account="a1", archived="no", **more):
    return {"id": id, "account_id": account, "archived": archived, **more}


def event(id, contract, start=f"{MONDAY} 09:00:00", end=None, account="a1", **more):
    return {"id": id, "user_contract_id": contract, "account_id": account, "starts_at": start, "ends_at": end, **more}


def dicts(df):
    return [row.asDict() for row in df.collect()]


def values(df, *columns):
    """The rows of some columns as a sorted list of tuples; NULL sorts first."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])
