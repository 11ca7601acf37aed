import pytest
from pyspark.sql import functions as F

from weekmeter.llm import common


def test_rank_is_gapless_over_the_whole_table(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit(None).cast("int").alias("n"))
    rows = common.ranked(df.unionAll(df.where("v < 5")).repartition(7), ["v"], "place").collect()
    assert sorted(r["place"] for r in rows) == list(range(1005))
    assert [r["v"] for r in sorted(rows, key=lambda r: r["place"])] == sorted([*range(1000), *range(5)])
    assert common.ranked(df.limit(0), ["v"]).collect() == []


@pytest.mark.parametrize("given, after", [("64m", str(common.BATCH)), ("67108864b", str(common.BATCH)), ("1m", "1m")])
def test_batches_are_only_ever_made_smaller(spark, given, after):
    before = spark.conf.get(common.BATCH_SETTING)
    try:
        spark.conf.set(common.BATCH_SETTING, given)
        common.prepare(spark)
        assert spark.conf.get(common.BATCH_SETTING).rstrip("b") == after.rstrip("b")
    finally:
        spark.conf.set(common.BATCH_SETTING, before)


def test_only_own_folders_are_removed(spark):
    with pytest.raises(ValueError):
        common.remove(spark, "/tmp/elsewhere")


def test_columns_set_aside_come_back(spark):
    df = spark.createDataFrame([(1, "x", 2, 3)], "text int, `a.b` string, _c0 int, node int")
    hidden, named = common.set_aside(df, "text")
    assert [tuple(r) for r in named(hidden.withColumn("node", F.lit(9))).collect()] == [(1, "x", 2, 3)]
    assert named(hidden).columns == df.columns
