"""Feature arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourloom.functions.casts import as_column
from hourloom.functions.predicates import all_present


def pack_features(cols: Sequence[Column | str]) -> Column:
    """Columns to one float array; null if any of them is null, so a later drop removes the row."""
    packed = F.array(*[as_column(c).cast("float") for c in cols])
    return F.when(all_present(cols), packed)


def concat_features(*arrays: Column | str) -> Column:
    return F.concat(*[as_column(a) for a in arrays]).cast("array<float>")
