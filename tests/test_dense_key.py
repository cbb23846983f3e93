import random

import pytest
from conftest import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from starweir.operators import dense_key


ORDERS = {
    "ascending": lambda: ["a", "b"],
    "descending": lambda: [F.desc("a"), "b"],
    "nulls first": lambda: [F.desc_nulls_first("b")],
}


@pytest.mark.parametrize("name", ORDERS)
def test_same_as_one_window_over_everything(spark, name):
    order = ORDERS[name]()
    rng = random.Random(1)
    given = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"]), i) for i in range(2000)]
    df = spark.createDataFrame(given, "a int, b string, i int").repartition(7)
    number = F.row_number().over(Window.orderBy(*order, "a", "b", "i"))
    expected = df.select(number.cast("bigint").alias("key"), "*")
    assert rows(dense_key(df, order, "key")) == rows(expected)


def test_copies_of_one_row_are_divided(spark):
    df = spark.range(0, 8000, 1, 8).selectExpr("'same' AS a")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        keyed = dense_key(df, ["a"], "key")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.key for r in keyed.collect()) == list(range(1, 8001))
    biggest = keyed.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert biggest <= 4000


def test_no_task_gets_every_row(spark):
    keyed = dense_key(spark.range(100), ["id"], "key")
    physical = plan(keyed).split("Physical Plan")[1]
    assert "SinglePartition" not in physical and "Window" not in physical


def test_empty(spark):
    assert dense_key(spark.range(0), ["id"], "key").collect() == []


def test_keys_stay_when_read_again(spark):
    keyed = dense_key(spark.range(0, 500, 1, 5).select(F.col("id") % 7, "id").toDF("a", "b"), ["a"], "key")
    assert rows(keyed) == rows(keyed)
