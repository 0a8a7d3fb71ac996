"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Fixed value: native units per token (lamports per SOL).
UNITS_PER_TOKEN = 1e9


def to_tokens(c: Column) -> Column:
    """``x / power(10, 9)`` as a double (Catalyst folds the literal)."""
    return c / F.lit(UNITS_PER_TOKEN)


def round_doubles(df: DataFrame, scale: int = 4) -> DataFrame:
    """Round every double column half-up at ``scale`` via decimal.

    Used only at presentation (result comparison): sums of doubles may differ
    in the last bits with summation order; rounding through decimal(28,8)
    first removes that noise the same way on every engine.
    """
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.round(F.col(f.name).cast("decimal(28,8)"), scale).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
