"""The column rules, one case per branch."""

import datetime

import pytest
from pyspark.sql import functions as F

from starweir.functions import (
    null_future,
    parse_int_date,
    prefer,
    recode,
    recode_shadowed,
    remove_chars,
    split_key,
    strip_prefix,
)
from starweir.operators import repair_amounts
from starweir.plans.cleanse import (
    COUNTRY,
    ERP_GENDER,
    GENDER,
    MARITAL_STATUS,
    PRODUCT_LINE,
    cleanse_erp_location,
)


def apply(spark, kind, values, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_int_date(spark):
    values = [20101229, 0, 5489, None, 20101345, -2010122, 123456789]
    assert apply(spark, "int", values, parse_int_date) == [
        datetime.date(2010, 12, 29),
        *[None] * 6,
    ]


def test_country(spark):
    values = [" DE ", "USA", "US", "us", "", "  ", None, " France "]
    expected = ["Germany", "United States", "United States", "us", "n/a", "n/a", "n/a", "France"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "cid string, cntry string")
    assert [r.cntry for r in cleanse_erp_location(df).orderBy("cid").collect()] == expected
    assert COUNTRY["Germany"] == ["DE"]


@pytest.mark.parametrize(
    ("labels", "values", "expected"),
    [
        (MARITAL_STATUS, ["S", " m ", "x", "", None], ["Single", "Married", "n/a", "n/a", "n/a"]),
        (GENDER, ["f", "M ", "FEMALE", None], ["Female", "Male", "n/a", "n/a"]),
        (
            PRODUCT_LINE,
            ["M ", "r", "S", " T", "Q", None],
            ["Mountain", "Road", "Other Sales", "Touring", "n/a", "n/a"],
        ),
        (
            ERP_GENDER,
            ["F", "Female", " m ", "", None, "x"],
            ["Female", "Female", "Male", "n/a", "n/a", "n/a"],
        ),
    ],
)
def test_recode(spark, labels, values, expected):
    assert apply(spark, "string", values, lambda c: recode(c, labels)) == expected


def test_recode_shadowed(spark):
    values = ["F", "Female", " m ", "", None, "x"]
    assert apply(spark, "string", values, recode_shadowed) == ["F", "FEMALE", "M", "", "n/a", "X"]


def test_ids(spark):
    values = ["NASAW00011000", "AW00011000", "xNASy", "nasA", "NAS", None]
    assert apply(spark, "string", values, lambda c: strip_prefix(c, "NAS")) == [
        "AW00011000",
        "AW00011000",
        "xNASy",
        "nasA",
        "",
        None,
    ]
    assert apply(spark, "string", ["A-B-C", "-", None], lambda c: remove_chars(c, "-")) == [
        "ABC",
        "",
        None,
    ]


def test_birth_date(spark):
    as_of = F.lit(datetime.date(2025, 1, 1))
    values = ["2010-01-01", "9999-11-20", None, "unknown", "2025-01-01"]
    assert apply(spark, "string", values, lambda c: null_future(c, as_of)) == [
        "2010-01-01",
        None,
        None,
        "unknown",
        "2025-01-01",
    ]
    # Without a date, today is the limit.
    assert apply(spark, "string", ["2010-01-01", "9999-11-20"], null_future) == ["2010-01-01", None]


def test_split_key_keeps_whole_texts(spark):
    long_key = "AC-HE-" + "x" * 500
    values = ["AC-HE-HL-U509-R", long_key, "AC", None]
    assert apply(spark, "string", values, lambda c: split_key(c, 5)[0]) == ["AC_HE", "AC_HE", "AC", None]
    assert apply(spark, "string", values, lambda c: split_key(c, 5)[1]) == [
        "HL-U509-R",
        "x" * 500,
        "",
        None,
    ]


def test_prefer(spark):
    df = spark.createDataFrame(
        [(1, "Male", "Female"), (2, "n/a", "Female"), (3, None, "Male"), (4, "n/a", None)],
        "i int, a string, b string",
    )
    out = df.select("i", prefer(F.col("a"), F.col("b")).alias("out")).orderBy("i").collect()
    assert [r.out for r in out] == ["Male", "Female", "Male", "n/a"]


REPAIRS = [
    ((None, 2, 10), (20, 10.0)),
    ((20, 2, 10), (20, 10.0)),
    ((15, 2, 10), (20, 10.0)),
    ((-20, 2, 10), (20, 10.0)),
    ((20, 2, -10), (20, 10.0)),
    ((20, 2, None), (20, 10.0)),
    ((None, 2, None), (None, None)),
    ((20, 2, 0), (0, 0.0)),
    ((20, 0, None), (20, None)),
    ((0, 0, 5), (0, 5.0)),
    ((7, None, 7), (7, 7.0)),
    # Beyond the range of INT.
    ((None, 2_000_000_000, 2_000_000_000), (4_000_000_000_000_000_000, 2_000_000_000.0)),
]


def test_amount_repair(spark):
    df = spark.createDataFrame(
        [(i, *given) for i, (given, _) in enumerate(REPAIRS)], "i int, s int, q int, p int"
    )
    out = repair_amounts(df, "s", "q", "p").orderBy("i").collect()
    assert [(r.s, r.p) for r in out] == [expected for _, expected in REPAIRS]
    assert repair_amounts(df, "s", "q", "p").columns == ["i", "s", "q", "p"]


def test_amount_repair_of_fractions(spark):
    df = spark.createDataFrame([(1.0, 3, 0.5), (None, 2, 2.25)], "s double, q int, p double")
    assert [(r.s, r.p) for r in repair_amounts(df, "s", "q", "p").collect()] == [
        (1.5, 0.5),
        (4.5, 2.25),
    ]
