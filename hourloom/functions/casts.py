"""Casts that turn bad text into null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: plain decimal text, no exponent.
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c: Column | str) -> Column:
    """Text to double; unreadable text gives null."""
    return as_column(c).try_cast("double")


def lenient_int(c: Column | str) -> Column:
    """Text to int, dropping the fraction (``16.00`` gives 16); unreadable text gives null."""
    text = as_column(c).cast("string")
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double").try_cast("int"))


def null_default(c: Column | str, default) -> Column:
    return F.coalesce(as_column(c), F.lit(default))
