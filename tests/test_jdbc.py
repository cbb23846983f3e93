"""What is asked of Spark's JDBC source. No database is started: these tests look
at the options only."""

import pytest

from starweir.sources import jdbc
from starweir.sources.jdbc import JdbcDatabase


class Recorder:
    """Stands for reader, writer and DataFrame, and notes what it is given."""

    def __init__(self, answers=()):
        self.given, self.answers, self.calls = {}, list(answers), []

    read = write = property(lambda self: self)

    def format(self, name):
        self.given = {"format": name}
        return self

    def options(self, **options):
        self.given |= options
        return self

    def mode(self, mode):
        self.given["mode"] = mode
        return self

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return self

    def observe(self, *_):
        return self

    def load(self):
        self.calls.append(self.given)
        return self

    save = load

    def collect(self):
        return self.answers.pop(0)

    first = collect


@pytest.fixture
def database():
    def make(*answers):
        recorder = Recorder(answers)
        return recorder, JdbcDatabase(
            recorder, "jdbc:some:db", "some.Driver", {"user": "u", "password": "p"}, connections=4
        )

    return make


CONNECTION = {"url": "jdbc:some:db", "driver": "some.Driver", "user": "u", "password": "p"}


def test_tables_are_listed_by_the_database(database):
    recorder, db = database([("orders",), ("customers",)])
    assert db.tables("source_erp") == ["customers", "orders"]
    (call,) = recorder.calls
    assert "information_schema.tables" in call["query"] and "'source_erp'" in call["query"]
    assert CONNECTION.items() <= call.items()


def test_plain_read(database):
    recorder, db = database()
    db.read("customers")
    (call,) = recorder.calls
    assert call == {"format": "jdbc", "dbtable": "customers", "fetchsize": "10000", **CONNECTION}


def test_read_divided_by_range(database):
    recorder, db = database((5, 95))
    db.read("customers", partition_column="id")
    bounds, read = recorder.calls
    assert bounds["query"] == "SELECT MIN(id), MAX(id) FROM customers"
    assert read["partitionColumn"] == "id" and read["numPartitions"] == "4"
    assert (read["lowerBound"], read["upperBound"]) == ("5", "95")


def test_an_empty_table_is_not_divided(database):
    recorder, db = database((None, None))
    db.read("customers", partition_column="id")
    assert "partitionColumn" not in recorder.calls[-1]


def test_read_divided_by_predicates(database):
    recorder, db = database()
    db.read("customers", predicates=["cid < 'M'", "cid >= 'M'"])
    assert recorder.calls[0]["predicates"] == ["cid < 'M'", "cid >= 'M'"]


def test_read_divided_by_a_key_of_text(database):
    recorder, db = database([(3, "N"), (1, "A"), (4, "O'Neil"), (2, "c")])
    db.read("customers", divide_by="cid")
    cuts, read = recorder.calls
    assert "NTILE(4) OVER (ORDER BY cid)" in cuts["query"] and "FROM customers" in cuts["query"]
    assert read["predicates"] == [
        "cid < 'c' OR cid IS NULL",
        "cid >= 'c' AND cid < 'N'",
        "cid >= 'N'",
    ]


def test_ranges_of_a_key_match_each_row_once(database, duck):
    duck.execute("CREATE OR REPLACE TABLE k AS SELECT range % 37 AS v FROM range(500) UNION ALL SELECT NULL")
    tiles = duck.execute(
        "SELECT tile, MIN(v) FROM (SELECT v, NTILE(4) OVER (ORDER BY v) AS tile FROM k "
        "WHERE v IS NOT NULL) GROUP BY tile"
    ).fetchall()
    for answer in (tiles, []):
        _, db = database(list(answer))
        predicates = db.key_ranges("k", "v")
        counts = [duck.execute(f"SELECT count(*) FROM k WHERE {p}").fetchall()[0][0] for p in predicates]
        assert sum(counts) == 501
        assert max(counts) < 200 or not answer


def test_replace(spark, database, monkeypatch):
    recorder, db = database()
    monkeypatch.setattr(jdbc, "Observation", lambda: type("O", (), {"get": {"rows": 7}}))
    assert db.replace(recorder, "dim") == 7
    assert recorder.calls[-1] == {
        "format": "jdbc",
        "mode": "overwrite",
        "dbtable": "dim",
        "numPartitions": "4",
        "batchsize": "10000",
        "truncate": "false",
        **CONNECTION,
    }
    db.replace(recorder, "dim", "name VARCHAR(255)", "ENGINE=x", truncate=True)
    typed = recorder.calls[-1]
    assert typed["createTableColumnTypes"] == "name VARCHAR(255)"
    assert typed["createTableOptions"] == "ENGINE=x" and typed["truncate"] == "true"


def test_count_is_asked_of_the_database(database):
    recorder, db = database((12,))
    assert db.count("dim") == 12
    assert recorder.calls[0]["query"] == "SELECT COUNT(*) FROM dim"
