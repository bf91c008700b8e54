"""Missing-value tokens of the reference's CSV reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text tokens a pandas CSV read turns into a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def is_missing(c: Column) -> Column:
    """True for null text or one of the NA tokens."""
    return c.isNull() | c.isin(*NA_TOKENS)


def na_token_to_null(c: Column) -> Column:
    """Null when the (untrimmed) text is one of the NA tokens."""
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def na_tokens_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Apply :func:`na_token_to_null` to the given (string) columns."""
    names = set(columns if columns is not None else df.columns)
    return df.select(*[
        na_token_to_null(F.col(f"`{n}`")).alias(n) if n in names else F.col(f"`{n}`")
        for n in df.columns
    ])
