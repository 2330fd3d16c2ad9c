"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public key recipe's stand-in for NULL and its separator.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 over the text of the columns; NULL and empty text stay distinct."""
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in cols
    ]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
