"""User functions. Column expressions come first; these are for what they cannot say."""

from __future__ import annotations

from pyspark.sql import functions as F


def vectorised(fn, returns: str):
    """A function of pandas Series, applied batch by batch through Arrow."""
    return F.pandas_udf(fn, returns)
