"""Rules that turn flagged instrument text into numbers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions.casts import as_column, lenient_double
from hourloom.schemas import MEASUREMENTS


@dataclass(frozen=True)
class ColumnRule:
    """How one measurement column is read.

    ``strip_flags`` lists the quality letters that may end a value; a value that
    ends in one loses it and is not looked up again. ``null_tokens`` mark a
    missing value. ``trace_token`` marks an amount too small to measure; it
    becomes ``trace_value``, null by default.
    """

    strip_flags: str = "sV"
    null_tokens: tuple[str, ...] = ("*",)
    trace_token: str | None = None
    trace_value: float | None = None
    radians: bool = False


def clean_value(c: Column | str, rule: ColumnRule) -> Column:
    raw = as_column(c).cast("string")
    text = F.when(raw.isin(*rule.null_tokens), None).otherwise(raw) if rule.null_tokens else raw
    if rule.strip_flags:
        flagged = F.right(text, F.lit(1)).isin(*rule.strip_flags)
        text = F.when(flagged, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    value = lenient_double(text)
    if rule.trace_token is not None:
        value = F.when(raw == rule.trace_token, F.lit(rule.trace_value).cast("double")).otherwise(value)
    return F.radians(value) if rule.radians else value


def clean_measurements(df: DataFrame, rules: Mapping[str, ColumnRule]) -> DataFrame:
    """Replace every column named in ``rules`` in one projection."""
    return df.withColumns({name: clean_value(name, rule) for name, rule in rules.items()})


def station_rules(trace_value: float | None = None) -> dict[str, ColumnRule]:
    """Rules of the nine station measurements; pass 0.004 to keep trace rain."""
    rules = {m: ColumnRule() for m in MEASUREMENTS}
    rules["HourlyWindDirection"] = ColumnRule(strip_flags="", null_tokens=("VRB",), radians=True)
    rules["HourlyPrecipitation"] = ColumnRule(
        strip_flags="s", null_tokens=(), trace_token="T", trace_value=trace_value
    )
    return rules
