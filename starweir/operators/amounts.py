"""Repair of sales amounts that disagree with quantity and price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NARROW = (T.ByteType, T.ShortType, T.IntegerType)


def _widened(df: DataFrame, name: str) -> Column:
    """Small integers as BIGINT: their products may leave the INT range."""
    column = F.col(name)
    return column.cast("bigint") if isinstance(df.schema[name].dataType, _NARROW) else column


def repair_amounts(df: DataFrame, sales: str, quantity: str, price: str) -> DataFrame:
    """Replace ``sales`` and ``price`` where they are missing or inconsistent.

    ``sales`` becomes quantity * |price| when it is NULL, not positive, or
    differs from that product. ``price`` becomes the repaired sales / quantity
    when it is NULL or not positive; it is NULL if that cannot be computed. If
    the product is NULL a positive ``sales`` stays. The result is double for price.
    """
    amount, unit_price = _widened(df, sales), _widened(df, price)
    product = _widened(df, quantity) * F.abs(unit_price)
    wrong = amount.isNull() | (amount <= 0) | (amount != product)
    repaired = df.withColumn("_repaired", F.when(wrong, product).otherwise(amount))
    derived = F.try_divide(F.col("_repaired").cast("double"), F.col(quantity))
    missing = F.col(price).isNull() | (F.col(price) <= 0)
    return repaired.withColumns(
        {
            price: F.when(missing, derived).otherwise(F.col(price).cast("double")),
            sales: F.col("_repaired"),
        }
    ).drop("_repaired")
