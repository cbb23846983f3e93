"""Keys that carry prefixes, separators or two parts in one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_key(
    column: Column, width: int, separator: str = "-", replacement: str = "_"
) -> tuple[Column, Column]:
    """Split a compound key into its leading part of ``width`` characters, with
    ``separator`` replaced, and everything after the separator that follows."""
    head = F.replace(F.substring(column, 1, width), F.lit(separator), F.lit(replacement))
    tail = F.substring(column, F.lit(width + 2), F.length(column))
    return head, tail


def strip_prefix(column: Column, prefix: str) -> Column:
    """Remove ``prefix`` from the start only; case counts."""
    return F.when(
        F.startswith(column, F.lit(prefix)), F.substring(column, F.lit(len(prefix) + 1), F.length(column))
    ).otherwise(column)


def remove_chars(column: Column, text: str) -> Column:
    """Remove every occurrence of ``text``."""
    return F.replace(column, F.lit(text), F.lit(""))
