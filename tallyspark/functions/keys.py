"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder for NULL parts and the separator of the public
# surrogate-key macro, so keys equal those built by the SQL project.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the parts cast to string, NULL parts replaced by a placeholder."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_PLACEHOLDER))
             for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
