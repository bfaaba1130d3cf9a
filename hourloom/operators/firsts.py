"""The attributes of the first row of each group, by a number instead of the attributes.

A minimum over text can't be updated in place, so Spark sorts what it aggregates. The
attributes therefore get ids in their own order, and the minimum is one over a number: the
time with the id in its low bits. The table of ids is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourloom.operators.frames import join_on_keys
from hourloom.session import stored

#: Distinct attributes, and their bytes, that are numbered and sent to every task, at most.
MOST_ROWS, MOST_BYTES = 200_000, 32 << 20
ID_BITS = 31


def attribute_ids(df: DataFrame, attrs: Sequence[str], most_rows: int = MOST_ROWS) -> DataFrame | None:
    """The distinct ``attrs`` with ``_id``, in their order, nulls first; None if they are too
    many or too long to be sent to every task. Both are counted first (an action)."""
    found = stored(df.select(*attrs).distinct(), "attributes")
    width = F.sum(F.octet_length(F.to_json(F.struct(*attrs))))
    n, size = found.agg(F.count("*"), F.coalesce(width, F.lit(0))).first()
    if n > most_rows or size > MOST_BYTES:
        return None
    # One task, for at most as many rows as were just counted.
    return found.withColumn("_id", F.row_number().over(Window.orderBy(*attrs)).cast("long") - 1)


def with_attribute_id(df: DataFrame, ids: DataFrame, attrs: Sequence[str], time: Column) -> DataFrame:
    """Add ``_first``: ``time`` (from 0, below 2**32) and the id of the row's attributes."""
    numbered = join_on_keys(df, F.broadcast(ids), attrs)
    return numbered.withColumn("_first", F.shiftleft(time.cast("long"), ID_BITS) + F.col("_id")).drop("_id")
