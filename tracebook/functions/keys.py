"""Key building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracebook.fixed_values import KEY_NULL_TOKEN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the string forms of the key columns; a null part gets a fixed token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def parent_code(code: Column | str) -> Column:
    """The part of a dotted code before its first dot."""
    return F.substring_index(_col(code), ".", 1)


def file_key(ticker: Column | str, year: Column | str) -> Column:
    """``ticker-year``: the name under which a report is landed."""
    return F.concat_ws("-", _col(ticker), _col(year).cast("string"))
