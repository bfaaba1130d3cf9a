"""Row predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourloom.functions.casts import as_column, lenient_int


def all_present(cols: Sequence[Column | str]) -> Column:
    return reduce(and_, [as_column(c).isNotNull() for c in cols])


def absent_or_zero(c: Column | str) -> Column:
    """Null, or reads as the whole number 0. Unreadable text fails."""
    return as_column(c).isNull() | F.coalesce(lenient_int(c) == 0, F.lit(False))


def eligible(
    cause: Column | str, other_causes: Sequence[Column | str], total: Column | str, cancelled: Column | str
) -> Column:
    """Delayed by ``cause``, or not delayed at all; and not cancelled."""
    by_cause = F.coalesce(lenient_int(cause) > 0, F.lit(False))
    no_delay = reduce(and_, [absent_or_zero(c) for c in [*other_causes, total]])
    return (by_cause | no_delay) & absent_or_zero(cancelled)


def threshold_label(c: Column | str, threshold: float) -> Column:
    """1 above the threshold, else 0; null counts as 0."""
    return F.when(as_column(c) > threshold, 1).otherwise(0)


def complete_at(ts: Column | str, required: Sequence[Column | str]) -> Column:
    """``ts`` where every required column is present, else null."""
    return F.when(all_present(required), as_column(ts))
