"""Text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourloom.functions.casts import as_column


def suffix_key(c: Column | str, width: int = 5) -> Column:
    """The last ``width`` characters."""
    return F.right(as_column(c).cast("string"), F.lit(width))


def concat_parts(parts: list[Column | str], separator: str) -> Column:
    """Parts joined by ``separator``; null if any part is null (unlike ``concat_ws``)."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(as_column(part).cast("string"))
    return F.concat(*pieces)
