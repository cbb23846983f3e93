"""Turning source codes into labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from starweir.schemas import UNKNOWN


def fold_codes(column: Column, fold_case: bool = True) -> Column:
    """The form in which codes are compared: trimmed, and upper case if asked."""
    trimmed = F.trim(column)
    return F.upper(trimmed) if fold_case else trimmed


def recode(
    column: Column,
    labels: Mapping[str, Iterable[str]],
    default: Column | str = UNKNOWN,
    fold_case: bool = True,
) -> Column:
    """Replace codes by labels.

    ``labels`` maps each label to the codes that mean it. Anything else, NULL
    included, becomes ``default``, which may be a column.
    """
    other = default if isinstance(default, Column) else F.lit(default)
    if not labels:
        return other
    code = fold_codes(column, fold_case)
    result = F
    for label, codes in labels.items():
        result = result.when(code.isin(*codes), F.lit(label))
    return result.otherwise(other)


def recode_shadowed(column: Column, unknown: str = UNKNOWN) -> Column:
    """A recode whose first branch takes every value that is not NULL, so that
    codes are folded but never turned into labels."""
    return F.coalesce(fold_codes(column), F.lit(unknown))


def prefer(first: Column, second: Column, unknown: str = UNKNOWN) -> Column:
    """``first`` where it is known, else ``second``, else ``unknown``."""
    return F.when(first != unknown, first).otherwise(F.coalesce(second, F.lit(unknown)))
