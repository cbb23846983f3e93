"""SQL databases over JDBC, as source and as warehouse."""

from __future__ import annotations

import decimal
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Lists the tables of the connection's own schema; databases without an
# information schema need another query with one column.
TABLES_QUERY = (
    "SELECT table_name FROM information_schema.tables "
    "WHERE table_schema = '{schema}' AND table_type = 'BASE TABLE'"
)


@dataclass
class JdbcDatabase:
    """A database. ``connections`` bounds how many tasks talk to it at once,
    however many executors there are."""

    spark: SparkSession
    url: str
    driver: str
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 16
    batch_rows: int = 10_000

    def _options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.properties}

    def query(self, sql: str) -> DataFrame:
        """The result of a query that the database runs."""
        return self.spark.read.format("jdbc").options(**self._options(), query=sql).load()

    def tables(self, schema: str, query: str = TABLES_QUERY) -> list[str]:
        """Names of the tables in ``schema``."""
        return sorted(row[0] for row in self.query(query.format(schema=schema)).collect())

    def columns(self, table: str) -> list[str]:
        """Column names of ``table`` in declared order."""
        return self.read(table).columns

    def read(
        self,
        table: str,
        divide_by: str | None = None,
        partition_column: str | None = None,
        predicates: Sequence[str] | None = None,
    ) -> DataFrame:
        """The whole table, over several connections if it is divided.

        ``divide_by`` is a key of any type: the database tells where to cut it so
        that the ranges hold equally many rows. ``partition_column`` is a number,
        date or timestamp that is cut into ranges of equal width. ``predicates``,
        one per task, must together match each row once.
        """
        options = {**self._options(), "fetchsize": str(self.batch_rows)}
        if divide_by is not None:
            predicates = self.key_ranges(table, divide_by)
        if predicates is not None:
            return self.spark.read.jdbc(
                self.url, table, predicates=list(predicates), properties=options
            )
        if partition_column is not None:
            bounds = self.query(
                f"SELECT MIN({partition_column}), MAX({partition_column}) FROM {table}"
            ).first()
            if bounds[0] is not None:
                options |= {
                    "partitionColumn": partition_column,
                    "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]),
                    "numPartitions": str(self.connections),
                }
        return self.spark.read.format("jdbc").options(**options, dbtable=table).load()

    def key_ranges(self, table: str, key: str) -> list[str]:
        """Conditions that cut ``table`` into ranges of ``key``, one per connection.

        The cuts come from the database in its own order, which need not be ours.
        Leaving one out only makes a range wider, so texts that would need
        escaping are not used.
        """
        tiles = (
            f"SELECT {key} AS k, NTILE({self.connections}) OVER (ORDER BY {key}) AS tile "
            f"FROM {table} WHERE {key} IS NOT NULL"
        )
        found = self.query(f"SELECT tile, MIN(k) AS k FROM ({tiles}) t GROUP BY tile").collect()
        lows = [low for _, low in sorted(tuple(row) for row in found)][1:]
        cuts = [c for c in dict.fromkeys(map(_literal, lows)) if c]
        starts = [None, *(f"{key} >= {c}" for c in cuts)]
        stops = [*(f"{key} < {c}" for c in cuts), None]
        ranges = [" AND ".join(filter(None, both)) for both in zip(starts, stops)]
        if not cuts:
            return ["1 = 1"]
        return [f"{ranges[0]} OR {key} IS NULL", *ranges[1:]]

    def replace(
        self,
        df: DataFrame,
        table: str,
        column_types: str | None = None,
        table_options: str | None = None,
        truncate: bool = False,
    ) -> int:
        """Replace ``table`` by ``df`` and return the number of rows sent.

        The table is dropped and created, with ``column_types`` such as
        ``name VARCHAR(30)`` instead of the default types and ``table_options``
        after the column list; ``truncate`` keeps it and only empties it.
        """
        options = {
            **self._options(),
            "dbtable": table,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_rows),
            "truncate": str(truncate).lower(),
        }
        if column_types:
            options["createTableColumnTypes"] = column_types
        if table_options:
            options["createTableOptions"] = table_options
        counted = Observation()
        observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        observed.write.format("jdbc").options(**options).mode("overwrite").save()
        return counted.get["rows"]

    def count(self, table: str) -> int:
        """Rows in ``table``, counted by the database."""
        return int(self.query(f"SELECT COUNT(*) FROM {table}").first()[0])


def _literal(value: object) -> str | None:
    """A cut as SQL; None for text with characters that databases escape in
    different ways."""
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    text = str(value)
    return None if "'" in text or "\\" in text else f"'{text}'"
