import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starweir import schemas
from starweir.operators.quality import row_counts
from starweir.plans.run import Layers, run, star_table
from starweir.plans.warehouse import FolderWarehouse, LoadError, load_table, load_warehouse


@pytest.fixture
def tables(spark):
    return {
        "dim_customer": spark.range(3),
        "dim_product": spark.range(2),
        "fact_sales": spark.createDataFrame([(1, None), (2, 3)], "product_key bigint, customer_key bigint"),
    }


def test_load(spark, tmp_path, tables):
    warehouse = FolderWarehouse(spark, str(tmp_path))
    result = load_warehouse(tables, warehouse)
    assert [tuple(r)[:3] for r in result.collect()] == [
        ("dim_customer", 3, "loaded"),
        ("dim_product", 2, "loaded"),
        ("fact_sales", 2, "loaded"),
    ]
    facts = warehouse.read("fact_sales")
    assert {f.dataType.simpleString() for f in facts.schema} == {"int"}


class Broken(FolderWarehouse):
    broken = "dim_product"

    def replace(self, df, table):
        if table == self.broken:
            raise OSError("refused")
        return super().replace(df, table)


def test_facts_wait_for_every_dimension(spark, tmp_path, tables):
    with pytest.raises(LoadError, match="dim_product") as caught:
        load_warehouse(tables, Broken(spark, str(tmp_path)))
    assert [(r.table_name, r.status) for r in caught.value.result.collect()] == [
        ("dim_customer", "loaded"),
        ("dim_product", "failed"),
        ("fact_sales", "skipped"),
    ]
    assert not (tmp_path / "fact_sales").exists()


class Doubling(FolderWarehouse):
    """Sends rows twice for the first ``times`` loads, as a repeated task does."""

    times = 1

    def replace(self, df, table):
        sent = super().replace(df, table)
        if self.times:
            self.times -= 1
            super().replace(df.union(df), table)
        return sent


def test_rows_sent_twice_are_noticed(spark, tmp_path):
    warehouse = Doubling(spark, str(tmp_path))
    assert load_table(spark.range(4), warehouse, "t") == 4
    assert warehouse.count("t") == 4
    warehouse.times = 2
    with pytest.raises(ValueError, match="holds 8 rows after 4"):
        load_table(spark.range(4), warehouse, "t")


def test_a_key_beyond_the_warehouse_type_is_not_cut(spark, tmp_path):
    facts = spark.createDataFrame([(2**40, 1)], "product_key bigint, customer_key bigint")
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        load_table(facts, FolderWarehouse(spark, str(tmp_path)), "fact_sales")


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_whole_run(spark, tmp_path, format):
    crm = tmp_path / "crm"
    crm.mkdir()
    (crm / "cust_info.csv").write_text(
        "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n"
        "1,A, Jon,Yang ,M,M,2025-10-06\n1,A,Jon,Yang,S,M,2025-10-07\n,B,x,y,S,F,2025-10-07\n"
        "2,C,Eve,Li,M,,2025-10-01\n"
    )
    (crm / "prd_info.csv").write_text(
        "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\n"
        "1,AC-HE-P1,Old,,R ,2011-07-01,2007-12-28\n2,AC-HE-P1,New,12,R ,2012-07-01,\n"
    )
    (crm / "sales_details.csv").write_text(
        "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,"
        "sls_sales,sls_quantity,sls_price\n"
        "SO1,P1,1,20101229,0,5489,,2,10\nSO2,P9,7,20101229,20101230,20101231,20,2,\n"
    )
    erp = {
        "customers": spark.createDataFrame(
            [("NASA", "1980-01-01", "F"), ("C", "2999-01-01", "Female")], schemas.ERP_CUSTOMER
        ),
        "customer_locations": spark.createDataFrame([("A-", "DE"), ("C", "")], schemas.ERP_LOCATION),
        "product_categories": spark.createDataFrame(
            [("AC_HE", "Accessories", "Helmets", "Yes")], schemas.ERP_CATEGORY
        ),
    }
    layers = Layers(spark, str(tmp_path / "layers"), format)
    warehouse = FolderWarehouse(spark, str(tmp_path / "warehouse"))
    as_of = F.lit(datetime.date(2025, 1, 1))
    result = run(layers, str(crm), erp, erp.__getitem__, warehouse, as_of)
    assert rows(result) == [
        ("dim_customer", 2, 2, True),
        ("dim_product", 1, 1, True),
        ("fact_sales", 2, 2, True),
    ]
    loaded = {name: warehouse.read(name) for name in schemas.WAREHOUSE}
    assert rows(row_counts(loaded)) == [(r[0], r[1]) for r in rows(result)]
    people = [tuple(r)[:9] for r in loaded["dim_customer"].orderBy("customer_key").collect()]
    assert people == [
        (1, 1, "A", "Jon", "Yang", "Germany", "Single", "Male", "1980-01-01"),
        (2, 2, "C", "Eve", "Li", "n/a", "Married", "Female", None),
    ]
    assert [tuple(r)[:4] for r in loaded["dim_product"].collect()] == [(1, 2, "P1", "New")]
    facts = [tuple(map(str, r)) for r in loaded["fact_sales"].orderBy("order_number").collect()]
    assert facts == [
        ("SO1", "1", "1", "2010-12-29", "None", "None", "20.0", "2", "10.0"),
        ("SO2", "None", "None", "2010-12-29", "2010-12-30", "2010-12-31", "20.0", "2", "10.0"),
    ]
    # Run again, everything is replaced.
    assert rows(run(layers, str(crm), erp, erp.__getitem__, warehouse, as_of)) == rows(result)
    assert star_table(layers, "fact_sales").count() == 2


def test_a_run_without_sources_fails(spark, tmp_path):
    (tmp_path / "crm").mkdir()
    layers = Layers(spark, str(tmp_path / "layers"))
    with pytest.raises(RuntimeError):
        run(layers, str(tmp_path / "crm"), [], None, FolderWarehouse(spark, str(tmp_path / "w")))
