import pytest
from conftest import plan, rows

from starweir import schemas
from starweir.sources import (
    IngestError,
    conform,
    import_delimited,
    ingest_tables,
    land_csv_folder,
    read_csv,
    read_table,
    write_table,
)
from starweir.sources.ingest import ingest_summary


def test_csv_readers(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text('ID,NAME,DAY\n007,"Smith, J",2025-01-01\n8,,x\n')
    assert rows(read_csv(spark, str(file))) == [("007", "Smith, J", "2025-01-01"), ("8", None, "x")]
    declared = read_csv(spark, str(file), schemas.T.StructType.fromDDL("k INT, n STRING, d DATE"))
    assert [(r.k, r.n, str(r.d)) for r in declared.orderBy("k").collect()] == [
        (7, "Smith, J", "2025-01-01"),
        (8, None, "None"),
    ]
    inferred = read_csv(spark, str(file), infer=True)
    assert inferred.schema["ID"].dataType.simpleString() == "int"


def test_import_with_assignments(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("ignored,line\n'x;y';1\n'z';2\n")
    taken = import_delimited(spark, str(file), ["a", "b"], separator=";", quote="'")
    assert rows(taken) == [("x;y", "1"), ("z", "2")]
    assigned = import_delimited(
        spark, str(file), ["a", "b"], {"B": "CAST(b AS INT) + 1", "a": "upper(a)"}, ";", "'"
    )
    assert rows(assigned) == [(2, "X;Y"), (3, "Z")]


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_written_tables_come_back(spark, tmp_path, format):
    df = spark.createDataFrame(
        [(1, "a,b", 'say "x"', None), (2, "ü", "", 2.5)], "i int, a string, b string, d double"
    ).repartition(2)
    path = str(tmp_path / "t")
    assert write_table(df, path, format) == 2
    back = read_table(spark, path, df.schema, format)
    expected = rows(df) if format == "parquet" else rows(df.replace("", None))
    assert rows(back) == expected
    # Written again, it is replaced.
    assert write_table(df.where("i = 1"), path, format) == 1
    assert read_table(spark, path, df.schema, format).count() == 1


def test_written_parquet_is_packed_unless_told(spark, tmp_path):
    for name, options, ending in (("a", {}, ".zstd.parquet"), ("b", {"compression": "none"}, ".parquet")):
        write_table(spark.range(3), str(tmp_path / name), **options)
        parts = [f.name for f in (tmp_path / name).glob("part-*")]
        assert parts and all(f.endswith(f"c000{ending}") for f in parts)


def test_an_empty_table_keeps_its_columns(spark, tmp_path):
    assert write_table(spark.range(0), str(tmp_path / "t")) == 0
    assert read_table(spark, str(tmp_path / "t")).columns == ["id"]
    assert write_table(spark.createDataFrame([], "a int"), str(tmp_path / "u")) == 0


def test_csv_blanks_are_lost_unless_kept(spark, tmp_path):
    df = spark.createDataFrame([(" x ",)], "a string")
    write_table(df, str(tmp_path / "a"), "csv")
    assert rows(read_table(spark, str(tmp_path / "a"), format="csv")) == [("x",)]
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    write_table(df, str(tmp_path / "b"), "csv", **keep)
    assert rows(read_table(spark, str(tmp_path / "b"), format="csv")) == [(" x ",)]


def test_conform(spark):
    given = [("7", "x", "2025-02-30"), ("z", "y", "2025-02-03")]
    df = spark.createDataFrame(given, "B string, a string, c string")
    out = conform(df, schemas.T.StructType.fromDDL("a STRING, b INT, c DATE"))
    assert [(r.a, r.b, str(r.c)) for r in out.orderBy("a").collect()] == [
        ("x", 7, "None"),
        ("y", None, "2025-02-03"),
    ]


def test_ingest(spark, tmp_path):
    tables = {"full": spark.range(5), "empty": spark.range(0)}
    result = ingest_tables(spark, tables, tables.__getitem__, str(tmp_path))
    assert rows(result) == [("empty", 0, "empty", None), ("full", 5, "loaded", None)]
    assert rows(ingest_summary(result)) == [(2, 2, 5)]
    assert spark.read.parquet(str(tmp_path / "empty")).columns == ["id"]


def test_ingest_goes_on_after_a_failure_and_then_raises(spark, tmp_path):
    def read(name):
        if name == "bad":
            raise ValueError("no such table")
        return spark.range(2)

    with pytest.raises(IngestError, match="bad") as caught:
        ingest_tables(spark, ["bad", "good"], read, str(tmp_path))
    found = {r.table_name: (r.row_count, r.status, r.message) for r in caught.value.result.collect()}
    assert found == {"bad": (None, "failed", "no such table"), "good": (2, "loaded", None)}
    with pytest.raises(IngestError, match="no tables"):
        ingest_tables(spark, [], read, str(tmp_path))


def test_land_folder(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    (source / "one.csv").write_text("a,b\n001,x\n002,\n")
    (source / "note.txt").write_text("not a table")
    spark.range(6).repartition(3).write.option("header", True).csv(str(source / "many.csv"))
    result = land_csv_folder(spark, str(source), str(tmp_path / "raw"))
    assert [(r.table_name, r.row_count) for r in result.orderBy("table_name").collect()] == [
        ("many", 6),
        ("one", 2),
    ]
    assert rows(read_table(spark, str(tmp_path / "raw" / "one"))) == [("001", "x"), ("002", None)]
    with pytest.raises(IngestError):
        land_csv_folder(spark, str(tmp_path / "nowhere"), str(tmp_path / "raw"))


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    write_table(spark.range(9).selectExpr("id", "id AS b", "id AS c"), str(tmp_path / "t"))
    physical = plan(read_table(spark, str(tmp_path / "t")).where("id > 3").select("b"))
    assert "GreaterThan(id,3)" in physical
    assert "ReadSchema: struct<id:bigint,b:bigint>" in physical
