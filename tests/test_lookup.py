import random

import pytest
from conftest import plan, rows

from starweir.operators import lookup
from starweir.operators.lookups import fits_in_memory
from starweir.operators.skew import hot_keys


def brute_force(left, right):
    out = []
    for i, key in left:
        partners = [v for k, v in right if k == key and key is not None]
        out += [(i, key, v) for v in partners or [None]]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    left = [(i, rng.choice(["hot", "hot", None, "both", "missing", *"abcdefgh"])) for i in range(900)]
    right = [(k, j) for j, k in enumerate("aabcdef")]
    right += [("right-hot", j) for j in range(300)] + [("both", j) for j in range(120)]
    right += [("hot", 1), (None, 2), ("other", 3)]
    left += [(1000 + i, "right-hot") for i in range(5)] + [(2000, "z")] * 200
    return (
        left,
        right,
        spark.createDataFrame(left, "i int, k string").repartition(5),
        spark.createDataFrame(right, "k string, v int").repartition(5),
    )


@pytest.mark.parametrize(
    ("broadcast", "max_key_rows"), [(10**8, 10**7), (0, 10**7), (0, 20), (0, 100), (0, 1)]
)
def test_every_strategy_gives_the_same_rows(tables, broadcast, max_key_rows):
    left, right, left_df, right_df = tables
    out = lookup(left_df, right_df, ("k", "k"), {"v": "found"}, broadcast, max_key_rows)
    assert out.columns == ["i", "k", "found"]
    assert rows(out) == brute_force(left, right)


def test_small_tables_are_broadcast_and_big_ones_are_not(tables):
    _, _, left, right = tables
    assert "BroadcastHashJoin" in plan(lookup(left, right, ("k", "k"), {"v": "f"}))
    big = plan(lookup(left, right, ("k", "k"), {"v": "f"}, 0, 20)).split("Physical Plan")[1]
    assert "_left_slice" in big and "_right_slice" in big


def test_size_is_measured(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "s string")
    assert fits_in_memory(df, 20_000) and not fits_in_memory(df, 10_000)
    assert fits_in_memory(df.where("false"), 1) and not fits_in_memory(df.where("false"), 0)
    assert not fits_in_memory(df.selectExpr("parse_json('[1]') AS v"))
    assert not fits_in_memory(df.selectExpr("array(s) AS a"))


def test_keys_of_two_integer_types_match(spark):
    left = spark.createDataFrame([(1,), (5,)], "k int")
    right = spark.createDataFrame([(5, "five")], "k bigint, v string")
    for limit in (0, 10**6):
        for rows_per_key in (10**7,):
            out = lookup(left, right, ("k", "k"), {"v": "v"}, limit, rows_per_key)
            assert rows(out) == [(1, None), (5, "five")]
    many = spark.createDataFrame([(5,)] * 50, "k int")
    assert lookup(many, right, ("k", "k"), {"v": "v"}, 0, 10).where("v = 'five'").count() == 50


def test_keys_of_unlike_types_are_refused(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([("1", "x")], "k string, v string")
    with pytest.raises(TypeError):
        lookup(left, right, ("k", "k"), {"v": "v"})


def test_sampling_another_table_does_not_change_the_result(tables):
    left, right, left_df, right_df = tables
    other = left_df.limit(3)
    out = lookup(left_df, right_df, ("k", "k"), {"v": "v"}, 0, 20, sample_from=other)
    assert rows(out) == brute_force(left, right)


def test_hot_keys_are_found_by_sampling(spark):
    df = spark.range(0, 400_000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE cast(id AS string) END AS k"
    )
    found = {r["k"]: r["parts"] for r in hot_keys(df, ["k"], 20_000).to_pylist()}
    assert set(found) == {"hot", None}
    assert all(5 <= parts <= 9 for parts in found.values())


def test_nothing_is_measured_at_limit_0(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("limit-0", "")
    try:
        df = spark.range(10)
        lookup(df, spark.range(5), ("id", "id"), {"id": "found"}, 0, sample_from=spark.range(0))
        assert len(tracker.getJobIdsForGroup("limit-0")) <= 2  # the two samples
        assert not fits_in_memory(df, 0)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("max_key_rows", [10**7, 20])
def test_columns_that_cannot_be_hashed(spark, max_key_rows):
    left = spark.range(200).selectExpr(
        "'hot' AS k", "id AS i", "map('a', id) AS m", "parse_json(CAST(id AS STRING)) AS v"
    )
    right = spark.sql("SELECT 'hot' AS k, map('b', 1) AS n, parse_json('2') AS w")
    out = lookup(left, right, ("k", "k"), {"n": "n", "w": "w"}, 0, max_key_rows)
    found = out.selectExpr("i", "m['a'] AS a", "n['b'] AS b", "CAST(w AS INT) AS w")
    assert rows(found) == sorted([(i, i, 1, 2) for i in range(200)], key=repr)
