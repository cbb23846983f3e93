"""Contents compared, keys counted by fingerprints, tables published whole, reads counted."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starweir.operators import lookup
from starweir.operators.quality import Constraints, compare_contents, constraint_report, contents
from starweir.plans.warehouse import FolderWarehouse, load_table
from starweir.sources import read_table, write_table


def test_contents_do_not_depend_on_order_but_on_every_value(spark):
    given = [(1, "a", None), (2, None, "b"), (2, None, "b"), (3, "", "x")]
    schema = "i int, s string, t string"
    df = spark.createDataFrame(given, schema)
    assert contents(df) == contents(spark.createDataFrame(given[::-1], "i long, s string, t string").repartition(3))
    for changed in (
        given[:3],
        [*given[:3], (3, None, "x")],
        [given[0], given[0], given[1], given[3]],
        [(1, None, "a"), *given[1:]],
        [(1, "aNULL", None), *given[1:]],
    ):
        assert contents(df) != contents(spark.createDataFrame(changed, schema))
    none = df.where("false")
    assert contents(none) == contents(none.repartition(2)) != contents(df)
    assert rows(compare_contents({"t": (df, df.limit(3))})) == [("t", 4, 3, False)]


class Damaging(FolderWarehouse):
    """Changes one value on the way, with the right number of rows."""

    def replace(self, df, table):
        return super().replace(df.withColumn("v", F.when(F.col("id") == 5, -1).otherwise(F.col("v"))), table)


def test_a_damaged_value_is_found_after_the_load(spark, tmp_path):
    df = spark.range(9).withColumn("v", F.col("id") * 2)
    assert load_table(df, FolderWarehouse(spark, str(tmp_path / "good")), "t") == 9
    with pytest.raises(ValueError, match="values"):
        load_table(df, Damaging(spark, str(tmp_path / "bad")), "t")


def found(report):
    return {(r.check_name, r.column_name): r.violations for r in report.collect()}


def test_constraints_in_one_scan(spark):
    given = [(1, "a", "xx"), (1, "a", None), (1, "b", "xxx"), (None, "a", "x"), (None, "a", "x"), (2, None, "x")]
    df = spark.createDataFrame(given, "k int, l string, v string")
    promised = Constraints(("k", "l"), ("v",), {"v": 2})
    expected = {("unique", "k,l"): 1, ("not_null", "k"): 2, ("not_null", "l"): 1, ("not_null", "v"): 1, ("length", "v"): 1}
    assert found(constraint_report(df, promised)) == expected
    assert found(constraint_report(df.where("false"), promised)) == dict.fromkeys(expected, 0)
    assert found(constraint_report(df, Constraints(max_length={"l": 0}))) == {("length", "l"): 5}


def counting(spark, df):
    """``df`` with a count of how often its rows are made."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(i):
        made.add(1)
        return i

    return df.withColumn("k", seen.asNondeterministic()("k")), made


def test_a_table_without_repeated_keys_is_read_once(spark):
    df, made = counting(spark, spark.range(100).select(F.col("id").alias("k")))
    assert found(constraint_report(df, Constraints(("k",), ("k",))))[("unique", "k")] == 0
    assert made.value == 100


@pytest.mark.parametrize("limit, max_rows", [(1 << 20, 20), (1, 20), (1, 1 << 20), (0, 20)])
def test_the_right_side_is_read_twice_at_most(spark, limit, max_rows):
    right, made = counting(spark, spark.range(200).selectExpr("id DIV 50 AS k", "id AS v"))
    left = spark.range(40).selectExpr("id % 5 AS k", "id AS i")
    out = lookup(left, right, ("k", "k"), {"v": "v"}, limit, max_rows)
    assert len(out.collect()) == 32 * 50 + 8
    assert made.value <= 2 * 200


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(5), path) == 5
    bad = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_table(bad, path)
    assert [r.id for r in read_table(spark, path).orderBy("id").collect()] == [0, 1, 2, 3, 4]
    assert os.listdir(tmp_path) == ["t"]


def test_a_table_may_be_replaced_by_what_is_made_of_it(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    assert write_table(read_table(spark, path).where("id > 1"), path) == 3
    assert read_table(spark, path).count() == 3
    assert os.listdir(tmp_path) == ["t"]
