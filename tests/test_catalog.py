"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry_point
from starweir.catalog import derived, oracle, queries

QUERIES, SQL = queries.queries(), oracle.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in places) for r in result.fetchall()), key=repr)
    assert found == expected


def test_sales_are_joined_in_short_types(spark, sf_dir):
    """Days and whole units cross the network, not what they are taken from."""
    plan = derived.crm_sales(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join LeftOuter"):].splitlines()
    lines = next(line for line in joined if "l_partkey" in line)
    assert " AS unit" in lines and " AS q" in lines and "AS l_shipdate" in lines


def test_files_the_queries_make_are_packed(spark, sf_dir, monkeypatch):
    made, write = {}, queries.write_table

    def seen(df, path, format="parquet", **options):
        rows = write(df, path, format, **options)
        made[path] = df.sparkSession.read.format("binaryFile").load(path).select("path").collect()
        return rows

    monkeypatch.setattr(queries, "write_table", seen)
    counts = queries.whole_run(spark, sf_dir)
    assert counts.where("NOT matches").count() == 0
    found = [row.path for files in made.values() for row in files]
    assert len(made) == 3 and all(path.endswith(".csv.gz") for path in found)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["order_number", "product_key", "customer_key"]
    assert df.count() > 0
