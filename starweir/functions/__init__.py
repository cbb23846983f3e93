"""Column rules: each takes columns and returns a column."""

from starweir.functions.codes import fold_codes, prefer, recode, recode_shadowed
from starweir.functions.dates import null_future, parse_int_date
from starweir.functions.text import remove_chars, split_key, strip_prefix

__all__ = [
    "fold_codes",
    "null_future",
    "parse_int_date",
    "prefer",
    "recode",
    "recode_shadowed",
    "remove_chars",
    "split_key",
    "strip_prefix",
]
