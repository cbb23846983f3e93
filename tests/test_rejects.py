"""Nothing is lost between the raw and the cleansed layer without being counted."""

import pytest
from conftest import rows

from starweir.functions import recode
from starweir.operators.quality import readiness
from starweir.plans import run
from starweir.plans.run import Layers, cleanse, validate
from starweir.schemas import SOURCES
from starweir.sources import land_csv_folder, write_table
from pyspark.sql import functions as F


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path))


def raw(layers, table, *given):
    schema = ", ".join(f"{c} string" for c in SOURCES[table].names)
    layers.write("raw", table, layers.spark.createDataFrame(list(given), schema))


def test_a_customer_whose_id_is_no_number_is_written_aside(layers):
    raw(layers, "cust_info", ("A12", "K", "a", "b", "S", "M", "2025-01-01"),
        ("3000000000", "L", "a", "b", "S", "M", "x"))
    done = cleanse(layers, tables=["cust_info"])
    assert done.rows == {"cust_info": 1}
    assert done.rejects == {"cust_info": {"cst_id": 1, "cst_create_date": 1}}
    assert layers.read("cleansed", "cust_info").first().cst_id == 3_000_000_000
    assert sorted(r.cst_id for r in layers.read("rejected", "cust_info").collect()) == [
        "3000000000", "A12"
    ]


def test_amounts_may_be_large_and_fractional(layers):
    raw(layers, "sales_details",
        ("S1", "P", "1", "20250101", "0", None, "3000000000", "1", None),
        ("S2", "P", "1", "20250101", "0", None, "25", "2", "10.5"),
        ("S3", "P", "1", " ", "0", None, "5", "1", "5"))
    done = cleanse(layers, tables=["sales_details"])
    assert done.rejects == {"sales_details": {}}
    found = layers.read("cleansed", "sales_details").orderBy("sls_ord_num").collect()
    assert [(r.sls_sales, r.sls_price) for r in found] == [
        (3e9, 3e9), (21.0, 10.5), (5.0, 5.0)
    ]


def test_a_table_cleansed_row_by_row_is_written_once(layers, monkeypatch):
    staged, stage = [], run.stage
    monkeypatch.setattr(run, "stage", lambda df, name: staged.append(df.columns) or stage(df, name))
    raw(layers, "sales_details",
        ("S1", "P", "?1", "20250101", "0", None, "5", "1", "5"),
        ("S2", "P", "1", "20250101", "0", "x", "y", "2", "z"))
    raw(layers, "cust_info", ("A12", "K", "a", "b", "S", "M", "2025-01-01"))
    done = cleanse(layers, tables=["sales_details", "cust_info"])
    assert staged == [SOURCES["cust_info"].names]
    assert done.rows == {"sales_details": 2, "cust_info": 0}
    assert done.rejects == {
        "sales_details": {"sls_cust_id": 1, "sls_due_dt": 1, "sls_sales": 1, "sls_price": 1},
        "cust_info": {"cst_id": 1},
    }
    assert layers.read("rejected", "sales_details").count() == 2


def test_ragged_lines_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text("a,b\n1,2\n4,5,6\n7\n")
    landed = land_csv_folder(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    assert [(r.table_name, r.row_count, r.malformed) for r in landed.collect()] == [("t", 3, 2)]
    kept = spark.read.parquet(str(tmp_path / "raw_malformed" / "t"))
    assert sorted(r._malformed for r in kept.collect()) == ["4,5,6", "7"]
    assert "t.csv" in kept.first().file


def test_readiness_counts_rows(spark, tmp_path):
    for name, n in (("some", 3), ("none", 0)):
        write_table(spark.range(n), str(tmp_path / name))
    paths = {n: str(tmp_path / n) for n in ("some", "none", "absent")}
    found = readiness(spark, paths, spark.read.parquet).select("name", "present", "rows")
    assert rows(found) == [("absent", False, None), ("none", False, 0), ("some", True, 3)]


def test_recode_without_labels(spark):
    df = spark.createDataFrame([("a",)], "c string")
    assert df.select(recode(F.col("c"), {}).alias("c")).first().c == "n/a"


def test_validate_reports_what_is_broken(layers):
    raw(layers, "customers", ("x" * 30, None, None), (None, None, None))
    raw(layers, "customer_locations", ("a", "DE"), ("a", None))
    raw(layers, "product_categories", ("a", "b", "c", "No"))
    from starweir.schemas import WAREHOUSE

    for table, schema in WAREHOUSE.items():
        layers.write("star", table, layers.spark.createDataFrame([], schema))
    broken = validate(layers).where("violations > 0").select("table_name", "check_name", "column_name")
    assert rows(broken) == [
        ("customer_locations", "not_null", "cntry"),
        ("customer_locations", "unique", "cid"),
        ("customers", "length", "cid"),
        ("customers", "not_null", "cid"),
    ]
