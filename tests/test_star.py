import datetime

import pytest
from pyspark.sql import types as T
from conftest import rows

from starweir import schemas
from starweir.plans.cleanse import cleanse_crm_customer, cleanse_crm_product, cleansers
from starweir.plans.star import build_dim_customer, build_dim_product, build_star
from starweir.staging import stage

DAY = datetime.date(2011, 7, 1)


def later(n):
    return DAY + datetime.timedelta(days=n)


def table(spark, given, schema):
    doubles = [isinstance(f.dataType, T.DoubleType) for f in schema]
    typed = [
        tuple(float(v) if d and v is not None else v for v, d in zip(row, doubles)) for row in given
    ]
    return spark.createDataFrame(typed, schema)


def test_latest_customer_record(spark):
    given = [
        (1, "A", " Jon ", "Yang", "m", "M", datetime.date(2025, 10, 6)),
        (1, "A", "Jon", "Yang", "S", "F", None),
        (1, "A", " Jo ", " Yang  ", "s ", "f", datetime.date(2025, 10, 7)),
        (None, "B", "x", "y", "S", "F", datetime.date(2025, 10, 7)),
    ]
    out = cleanse_crm_customer(table(spark, given, schemas.CRM_CUSTOMER))
    assert rows(out) == [(1, "A", "Jo", "Yang", "Single", "Female", datetime.date(2025, 10, 7))]
    assert out.columns == schemas.CRM_CUSTOMER.names


def test_product_key_and_validity(spark):
    given = [
        (1, "AC-HE-HL-U509-R", "Helmet", 12.0, "S ", later(0), later(-99)),
        (2, "AC-HE-HL-U509-R", "Helmet", None, "R ", later(366), None),
    ]
    out = cleanse_crm_product(table(spark, given, schemas.CRM_PRODUCT))
    assert rows(out) == [
        (1, "AC_HE", "HL-U509-R", "Helmet", 12.0, "Other Sales", later(0), later(365)),
        (2, "AC_HE", "HL-U509-R", "Helmet", 0.0, "Road", later(366), None),
    ]
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.CLEAN_PRODUCT]


def customer(i, key, gender="n/a"):
    return (i, key, "f", "l", "Single", gender, DAY)


def test_location_hangs_on_the_erp_customer(spark):
    crm = table(spark, [customer(1, "A"), customer(2, "B"), customer(3, None)], schemas.CRM_CUSTOMER)
    erp = table(
        spark,
        [("A", "1980-01-01", "Male"), ("A", "1980-01-01", "Male"), (None, None, None)],
        schemas.ERP_CUSTOMER,
    )
    loc = table(spark, [("A", "US"), ("B", "DE"), (None, "FR")], schemas.ERP_LOCATION)
    out = build_dim_customer(crm, erp, loc)
    assert [f.name for f in out.schema] == schemas.DIM_CUSTOMER.names
    found = [(r.customer_key, r.customer_number, r.country, r.gender) for r in out.collect()]
    assert sorted(found) == [
        (1, "A", "US", "Male"),
        (2, "A", "US", "Male"),
        (3, "B", None, "n/a"),
        (4, None, None, "n/a"),
    ]


def test_crm_gender_comes_first(spark):
    crm = table(spark, [customer(1, "A", "Female"), customer(2, "B")], schemas.CRM_CUSTOMER)
    erp = table(spark, [("A", None, "Male"), ("B", None, "Male")], schemas.ERP_CUSTOMER)
    loc = table(spark, [], schemas.ERP_LOCATION)
    out = build_dim_customer(crm, erp, loc).collect()
    assert sorted((r.customer_number, r.gender) for r in out) == [("A", "Female"), ("B", "Male")]


def golden_products():
    """Rows of the shape of a real product master: 218 keys with one version, 52
    with two, 25 with three; 7 pedals without category, 17 without line and 2
    without cost among the current versions."""
    given = []
    for key in range(295):
        versions = 1 if key < 218 else 2 if key < 270 else 3
        for version in range(versions):
            last = version == versions - 1
            category = "CO-PE" if key < 7 else "CO-PD" if key < 14 else "AC-BR"
            given.append(
                (
                    len(given) + 210,
                    f"{category}-K{key:03d}",
                    f"Product {key}",
                    None if last and key in (30, 31) else 10,
                    None if last and 100 <= key < 117 else "R ",
                    later(366 * version),
                    later(-1) if not last else None,
                )
            )
    return given


def test_golden_shape_of_products(spark):
    given = golden_products()
    assert len(given) == 397
    cleansed = stage(cleanse_crm_product(table(spark, given, schemas.CRM_PRODUCT)), "products")
    assert cleansed.count() == 397
    categories = table(
        spark,
        [("CO_PD", "Components", "Pedals", "No"), ("AC_BR", "Accessories", "Bike Racks", "Yes")],
        schemas.ERP_CATEGORY,
    )
    dim = build_dim_product(cleansed, categories)
    assert dim.count() == 295
    assert dim.where("category IS NULL AND category_id = 'CO_PE'").count() == 7
    assert dim.where("product_line = 'n/a'").count() == 17
    assert dim.where("cost = 0").count() == 2
    keys = [r.product_key for r in dim.orderBy("start_date", "product_number").collect()]
    assert keys == list(range(1, 296))


@pytest.fixture(scope="module")
def cleansed(spark):
    sources = {
        "cust_info": [(1, "A", "a", "b", "S", "M", DAY), (2, "B", "a", "b", "M", "x", DAY)],
        "prd_info": [(7, "AC-HE-P1", "p", 5, "M", DAY, None), (8, "AC-HE-P2", "q", 6, "T", DAY, None)],
        "sales_details": [
            ("SO1", "P1", 1, 20250101, 20250102, 0, None, 2, 10),
            ("SO1", "P9", 2, 0, 5489, None, 7, None, 7),
            ("SO2", None, None, 20251345, 20250102, 20250103, 20, 2, 0),
            ("SO2", "P2", 99, 20250101, 20250102, 20250103, 15, 2, 10),
        ],
        "customers": [("NASA", "1970-01-01", "F"), ("B", "2999-01-01", "Female")],
        "customer_locations": [("A-", "DE"), ("-B", " ")],
        "product_categories": [("AC_HE", "Accessories", "Helmets", "Yes")],
    }
    transforms = cleansers()
    return {
        name: stage(transforms[name](table(spark, given, schemas.SOURCES[name])), name)
        for name, given in sources.items()
    }


def test_cleansed_schemas_are_the_declared_ones(cleansed):
    for name, df in cleansed.items():
        assert df.schema == schemas.CLEANSED[name], name


def test_star(cleansed):
    star = build_star(cleansed)
    for name, df in star.items():
        declared = [(f.name, f.dataType) for f in schemas.WAREHOUSE[name]]
        assert [(f.name, f.dataType) for f in df.schema] == declared
    assert rows(star["fact_sales"]) == sorted(
        [
            ("SO1", 1, 1, datetime.date(2025, 1, 1), datetime.date(2025, 1, 2), None, 20.0, 2, 10.0),
            ("SO1", None, 2, None, None, None, 7.0, None, 7.0),
            ("SO2", None, None, None, datetime.date(2025, 1, 2), datetime.date(2025, 1, 3), 0.0, 2, 0.0),
            (
                "SO2",
                2,
                None,
                *(datetime.date(2025, 1, d) for d in (1, 2, 3)),
                20.0,
                2,
                10.0,
            ),
        ],
        key=repr,
    )
    people = star["dim_customer"].collect()
    found = sorted((r.customer_number, r.country, r.gender, r.birthdate) for r in people)
    assert found == [("A", "Germany", "Male", "1970-01-01"), ("B", "n/a", "Female", None)]
