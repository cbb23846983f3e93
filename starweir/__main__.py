"""The steps of a run as Spark jobs.

    spark-submit --py-files starweir.zip starweir/__main__.py STEP --root FOLDER [options]
    python -m starweir STEP --root FOLDER [options]

``STEP`` is ingest, cleanse, model, load, validate or all. Databases are given as
``url=jdbc:... driver=... user=... password=...``.
"""

from __future__ import annotations

import argparse
import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweir.operators.quality import ERP_CONSTRAINTS, reject_report
from starweir.plans import run as steps
from starweir.sources import JdbcDatabase, ingest_summary

STEPS = ("ingest", "cleanse", "model", "load", "validate")


def _pairs(words: list[str]) -> dict[str, str]:
    return dict(word.split("=", 1) for word in words)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="starweir", description="Build the warehouse.")
    parser.add_argument("step", choices=[*STEPS, "all"])
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--crm", help="folder of the CRM's CSV files")
    parser.add_argument("--erp", nargs="+", default=[], metavar="KEY=VALUE", help="ERP database")
    parser.add_argument("--erp-schema", help="schema whose tables are ingested; default: known ones")
    parser.add_argument("--warehouse", nargs="+", default=[], metavar="KEY=VALUE")
    parser.add_argument("--as-of", type=datetime.date.fromisoformat, help="instead of today")
    parser.add_argument(
        "--observed-gender", action="store_true", help="fold ERP genders, do not label them"
    )
    parser.add_argument("--tables", nargs="+", help="cleanse only these")
    return parser


def _database(spark: SparkSession, words: list[str]) -> JdbcDatabase:
    properties = _pairs(words)
    return JdbcDatabase(spark, properties.pop("url"), properties.pop("driver"), properties)


def _read_divided(erp: JdbcDatabase, table: str) -> DataFrame:
    """Tables whose key is known are read over several connections."""
    known = ERP_CONSTRAINTS.get(table)
    return erp.read(table, divide_by=known.key[0] if known else None)


def main(arguments: list[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"starweir {options.step}").getOrCreate()
    layers = steps.Layers(spark, options.root, options.format)
    wanted = {options.step} if options.step != "all" else set(STEPS)

    if "ingest" in wanted:
        erp = _database(spark, options.erp)
        tables = erp.tables(options.erp_schema) if options.erp_schema else steps.ERP_TABLES
        arrived = steps.ingest(layers, options.crm, tables, partial(_read_divided, erp))
        arrived.show(truncate=False)
        ingest_summary(arrived).show()
    if "cleanse" in wanted:
        as_of = F.lit(options.as_of) if options.as_of else None
        chosen = options.tables or (*steps.CRM_TABLES, *steps.ERP_TABLES)
        cleansed = steps.cleanse(layers, as_of, not options.observed_gender, chosen)
        print(cleansed.rows)
        reject_report(cleansed.rejects, spark).show(truncate=False)
    if "model" in wanted:
        print(steps.model(layers))
    if "load" in wanted:
        steps.load(layers, _database(spark, options.warehouse)).show(truncate=False)
    if "validate" in wanted:
        steps.validate(layers).where("violations > 0").show(1000, truncate=False)


if __name__ == "__main__":
    main()
