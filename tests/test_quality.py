import pytest
from conftest import rows
from pyspark.sql import types as T

from starweir.operators.quality import (
    ERP_CONSTRAINTS,
    Constraints,
    compare_counts,
    constraint_report,
    date_rejects,
    duplicate_keys,
    readiness,
    require_ready,
    row_counts,
)


def test_counts(spark):
    counts = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(counts) == [("a", 3), ("b", 0)]
    compared = compare_counts(counts, {"a": 3, "b": 1, "c": 2})
    assert rows(compared) == [("a", 3, 3, True), ("b", 0, 1, False), ("c", None, 2, False)]


def test_constraints(spark):
    df = spark.createDataFrame(
        [("A", "x"), ("A", None), (None, "long text"), (None, "y"), ("B", "")], "cid string, cntry string"
    )
    declared = T.StructType.fromDDL("cid STRING, cntry INT, gone STRING")
    promised = Constraints(("cid",), ("cntry",), {"cid": 20, "cntry": 5})
    assert rows(constraint_report(df, promised, declared)) == [
        ("length", "cid", 0),
        ("length", "cntry", 1),
        ("not_null", "cid", 2),
        ("not_null", "cntry", 1),
        ("schema", "cid", 0),
        ("schema", "cntry", 1),
        ("schema", "gone", 1),
        ("unique", "cid", 1),
    ]
    assert rows(duplicate_keys(df, ["cid"])) == [("A", 2)]


def test_erp_constraints(spark):
    good = spark.createDataFrame([("AW1", "Germany")], "cid string, cntry string")
    report = constraint_report(good, ERP_CONSTRAINTS["customer_locations"])
    assert {r.violations for r in report.collect()} == {0}


def test_date_rejects(spark):
    df = spark.createDataFrame(
        [(20250101, 20250230), (0, 5489), (20251301, None)], "a int, b int"
    )
    assert rows(date_rejects(df, ["a", "b"])) == [("a", 1), ("b", 1)]


def test_readiness(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "full"))
    (tmp_path / "empty").mkdir()
    paths = {name: str(tmp_path / name) for name in ("full", "empty", "absent")}
    found = {r["name"]: r for r in readiness(spark, paths).collect()}
    assert found["full"].present and found["full"].bytes > 0
    assert not found["empty"].present and not found["absent"].present
    assert not (tmp_path / "absent").exists()
    with pytest.raises(FileNotFoundError, match="absent, empty"):
        require_ready(spark, paths)
    require_ready(spark, {"full": paths["full"]})
