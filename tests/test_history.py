import datetime
import random
import time

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from starweir.operators import current_version, latest_per_key, validity_ranges

DAY = datetime.date(2025, 10, 1)


def day(n):
    return None if n is None else DAY + datetime.timedelta(days=n)


def test_latest_per_key(spark):
    given = [(1, day(5), "a"), (1, None, "b"), (1, day(6), "c"), (2, None, "d"), (None, day(9), "e")]
    df = spark.createDataFrame(given, "k int, d date, v string")
    assert rows(latest_per_key(df.where("k IS NOT NULL"), ["k"], "d")) == [
        (1, day(6), "c"),
        (2, None, "d"),
    ]
    assert rows(latest_per_key(df, ["k"], "d"))[-1] == (None, day(9), "e")


def test_latest_per_key_does_not_depend_on_row_order(spark):
    given = [(1, day(1), v) for v in "cabd"]
    for seed in range(4):
        random.Random(seed).shuffle(given)
        df = spark.createDataFrame(given, "k int, d date, v string").repartition(3)
        assert rows(latest_per_key(df, ["k"], "d")) == [(1, day(1), "a")]
        assert rows(latest_per_key(df, ["k"], "d", [F.desc("v")])) == [(1, day(1), "d")]


def test_latest_per_key_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS d")
    executed = plan(latest_per_key(df, ["k"], "d")).split("Physical Plan")[1]
    above, below = executed.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_validity_ranges(spark):
    given = [("HL", day(0), 1), ("HL", day(365), 2), ("RB", day(3), 3)]
    df = spark.createDataFrame(given, "k string, d date, v int")
    assert rows(validity_ranges(df, ["k"], "d", "e")) == [
        ("HL", day(0), 1, day(364)),
        ("HL", day(365), 2, None),
        ("RB", day(3), 3, None),
    ]
    current = current_version(validity_ranges(df, ["k"], "d", "e"), "e")
    assert [r[2] for r in rows(current)] == [2, 3]


def test_validity_ranges_replace_an_end_in_place(spark):
    df = spark.createDataFrame([("a", day(9), day(0)), ("a", day(5), day(0))], "k string, e date, d date")
    out = validity_ranges(df.withColumnRenamed("d", "x"), ["k"], "x", "e")
    assert out.columns == ["k", "e", "x"]


def python_ends(given):
    """Brute force: the next start of each key in the order (start, v), less a day."""
    out = []
    ordered = sorted(given, key=lambda r: (repr(r[0]), r[1] is not None, r[1] or DAY, r[2]))
    for row, following in zip(ordered, [*ordered[1:], (object(), None, None)]):
        start = following[1] if following[0] == row[0] else None
        out.append((*row, start and start - datetime.timedelta(days=1)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 40, 300])
def test_validity_ranges_of_hot_keys_match_brute_force(spark, partitions):
    rng = random.Random(partitions)
    given = []
    for _ in range(1500):
        key = rng.choice(["hot", "hot", None, None, *(f"k{i}" for i in range(30))])
        given.append((key, day(rng.choice([None, *range(60)])), rng.randrange(10**6)))
    # Copies of one row, more than a partition takes.
    given += [("hot", day(7), 5)] * 400
    df = spark.createDataFrame(given, "k string, d date, v int").repartition(6)
    out = validity_ranges(df, ["k"], "d", "e", partitions=partitions)
    assert rows(out) == python_ends(given)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_keys_and_orders_of_any_type(spark, zone):
    df = spark.range(0, 600, 1, 4).selectExpr(
        "CAST(id % 2 AS DECIMAL(20, 3)) AS k1",
        "TIMESTAMP_NTZ'2024-03-10 02:30:00' + MAKE_INTERVAL(0, 0, 0, CAST(id % 3 AS INT)) AS k2",
        "TIMESTAMP_NTZ'2024-03-09 00:30:00' + MAKE_INTERVAL(0, 0, 0, 0, CAST(id % 90 AS INT)) AS s",
        "CAST(TIMESTAMP_NTZ'2024-03-09 00:30:00' AS TIMESTAMP) + MAKE_DT_INTERVAL(0, id) AS t",
        "id",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        plain = validity_ranges(df, ["k1", "k2"], "s", "e")
        hot = validity_ranges(df, ["k1", "k2"], "s", "e", partitions=35)
        assert hot.exceptAll(plain).count() == plain.exceptAll(hot).count() == 0
        assert hot.count() == 600
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hot_keys_are_divided_over_tasks(spark):
    df = spark.range(0, 4000, 1, 8).selectExpr(
        "'hot' AS k", "date_add(DATE'2000-01-01', cast(id AS int)) AS d", "id"
    )
    out = validity_ranges(df, ["k"], "d", "e", partitions=8)
    # The rows were dealt by key and version, and are not shuffled again.
    assert "Exchange hashpartitioning" not in plan(out)
    sizes = [r.n for r in out.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) <= 1200


def test_wide_rows_cost_the_same_in_any_number_of_partitions(spark):
    wide = spark.range(0, 20_000, 1, 8).selectExpr(
        "'hot' AS k", "date_add(DATE'2000-01-01', cast(id AS int)) AS d", "repeat('x', 1000) AS v", "id"
    ).cache()
    wide.count()

    def seconds(partitions: int) -> float:
        begin = time.perf_counter()
        out = validity_ranges(wide, ["k"], "d", "e", ["id"], partitions=partitions)
        assert out.where("e IS NULL").count() == 1
        return time.perf_counter() - begin

    seconds(4)
    few, many = seconds(4), seconds(32)
    wide.unpersist()
    assert many < 3 * few + 3


def test_latest_needs_a_tie_break_for_columns_without_order(spark):
    df = spark.sql("SELECT 1 AS k, DATE'2000-01-01' AS d, map('a', 1) AS m")
    with pytest.raises(TypeError):
        latest_per_key(df, ["k"], "d")
    assert latest_per_key(df, ["k"], "d", []).count() == 1


def test_ranges_leave_no_gap_and_do_not_overlap(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderkey"
    )
    out = validity_ranges(orders, ["o_custkey"], "d", "e").toPandas()
    assert len(out) == orders.count()
    for _, versions in out.groupby("o_custkey"):
        versions = versions.sort_values(["d", "o_orderkey"])
        ends, following = list(versions.e), list(versions.d)[1:]
        assert ends[-1] is None
        assert ends[:-1] == [d - datetime.timedelta(days=1) for d in following]
