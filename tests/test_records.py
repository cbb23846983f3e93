"""Records of CSV files whose values have line breaks, against Python's csv module."""

import csv
import random

import pytest
from conftest import rows

from starweir.sources import Dialect, csv_records, land_csv_folder, parse_records, read_table, records
from starweir.sources.records import has_open_lines

DOUBLED = Dialect(escape='"')


@pytest.fixture
def small_blocks(spark):
    """Files cut into blocks of a few lines, also within records."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "8000")
    spark.conf.set(names[1], "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def random_table(seed, n):
    rng = random.Random(seed)

    def value():
        return "".join(rng.choice('ab ,"\n\r\\xé;') for _ in range(rng.randrange(0, 30)))

    made = [[str(i), value(), value()] for i in range(n)]
    made[n // 2][1] = "long\n" * 1500 + '"'
    return made


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_over_blocks(spark, tmp_path, small_blocks, ending):
    made = random_table(1, 300)
    for part in range(2):
        with open(tmp_path / f"{part}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator=ending)
            writer.writerow(["id", "b", "c"])
            writer.writerows(made[part * 150 : (part + 1) * 150])
    path = str(tmp_path)
    assert has_open_lines(spark, path, DOUBLED)
    found = parse_records(csv_records(spark, path, DOUBLED), ["id", "b", "c"], "bad", DOUBLED)
    expected = sorted(((i, b or None, c or None, None) for i, b, c in made), key=repr)
    assert rows(found) == expected


@pytest.mark.parametrize(
    "held_bytes, end, told",
    [(records.HELD_BYTES, '"y', True), (400, '"y', True), (records.HELD_BYTES, '",', False)],
)
def test_text_inside_blocks_is_not_shuffled(
    spark, tmp_path, small_blocks, monkeypatch, held_bytes, end, told
):
    """Only lines at the ends of blocks, or of records too long to hold, go over the blocks,
    and whole blocks, after a file's first, of which no line tells what is quoted."""
    rng = random.Random(5)
    made = [[str(i), "x\n" * rng.randrange(9) + end, "é" * rng.randrange(20)] for i in range(2000)]
    made[700][1] = "long\n" * 1000 + '"'
    with open(tmp_path / "0.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([["id", "b", "c"], *made])
    left, settled, over = [], records._settled, records._over_blocks
    monkeypatch.setattr(records, "_settled", lambda: settled(held_bytes))
    monkeypatch.setattr(records, "_over_blocks", lambda lines: left.append(lines) or over(lines))
    found = parse_records(csv_records(spark, str(tmp_path), DOUBLED), ["id", "b", "c"], "bad", DOUBLED)
    assert rows(found) == sorted(((i, b or None, c or None, None) for i, b, c in made), key=repr)
    blocks = left[0].select("_block").distinct().count()
    assert blocks > 5
    assert 0 < left[0].count() < (1050 + 25 * blocks if told else 11_500)


def test_another_escape(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;b\n1;"x\\" \n y"\n2;"z"\n')
    dialect = Dialect(separator=";")
    assert has_open_lines(spark, str(tmp_path), dialect)
    found = parse_records(csv_records(spark, str(tmp_path), dialect), ["a", "b"], "bad", dialect)
    assert rows(found) == [("1", 'x" \n y', None), ("2", "z", None)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('a,b\n1,"x\ny"\n2,z\n', [("1", "x\ny"), ("2", "z")]),
        # Quotes inside a value that is not quoted are plain.
        ('a,b\n1,5" pipe\n2,"u\nv"\n3,6" "\n', [("1", '5" pipe'), ("2", "u\nv"), ("3", '6" "')]),
        # Quotes that are never closed hold one line only.
        ('a,b\n1,"x\n\ny"\n2,"z\n3,w\n4,v', [("1", "x\n\ny"), ("2", "z"), ("3", "w"), ("4", "v")]),
        ('a,b\n\n1,""""\n2,"\n"\n\n', [("1", '"'), ("2", "\n")]),
        ("a,b\n", []),
        ("a,b\n1,2", [("1", "2")]),
    ],
)
def test_odd_files(spark, tmp_path, text, expected):
    source = tmp_path / "source"
    source.mkdir()
    (source / "t.csv").write_text(text)
    result = land_csv_folder(spark, str(source), str(tmp_path / "raw"), dialect=DOUBLED)
    assert [r.row_count for r in result.collect()] == [len(expected)]
    assert rows(read_table(spark, str(tmp_path / "raw" / "t"))) == expected


def test_malformed_records_are_kept(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    (source / "t.csv").write_text('a,b\n1,"x\ny",more\n2\n3,"p\nq"\n')
    result = land_csv_folder(spark, str(source), str(tmp_path / "raw"), dialect=DOUBLED)
    assert [(r.row_count, r.malformed) for r in result.collect()] == [(3, 2)]
    assert rows(read_table(spark, str(tmp_path / "raw" / "t"))) == [("1", "x\ny"), ("2", None), ("3", "p\nq")]
    bad = read_table(spark, str(tmp_path / "raw_malformed" / "t"))
    assert sorted(r._malformed for r in bad.collect()) == ['1,"x\ny",more', "2"]
    assert all(r.file.endswith("t.csv") for r in bad.collect())
