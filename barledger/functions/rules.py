"""The ordered price rules, as one list of columns.

Each column is null where its rule holds and the name of the reason where it fails, so a row's
reasons are the non-null ones. The order of the list is the order of reporting.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F, types as T

from barledger import fixed_values as fv
from barledger.functions.values import is_finite, is_infinite, is_missing, number_of_text

SEPARATOR = ","


def date_rules(day: Column, start: Column, end: Column, duplicate: Column) -> list[Column]:
    return [
        F.when(day.isNull(), F.lit("missing_date")),
        F.when(day.isNotNull() & ~((day >= start) & (day < end)), F.lit("date_outside_request")),
        F.when(day.isNotNull() & duplicate, F.lit("duplicate_date")),
    ]


def field_rule(label: str, value: Column, dtype: T.DataType) -> Column:
    """First failing test of one cell: a missing cell is not also non-finite or non-positive."""
    rule = F.when(is_missing(value, dtype), F.lit("missing:" + label)).when(
        is_infinite(value, dtype), F.lit("nonfinite:" + label)
    )
    if label == "Volume":
        return rule.when(value < 0, F.lit("negative:Volume")).when(value % 1 != 0, F.lit("fractional:Volume"))
    return rule.when(value <= 0, F.lit("nonpositive:" + label))


def adjusted_rule(value: Column, dtype: T.DataType) -> Column:
    """The adjusted close is optional, but what is there must be a finite positive number."""
    if isinstance(dtype, T.NumericType):
        present, number, number_type = ~is_missing(value, dtype), value, dtype
    elif isinstance(dtype, T.StringType):
        present, number, number_type = value.isNotNull(), number_of_text(value), T.DoubleType()
    else:
        return F.when(value.isNotNull(), F.lit("invalid:" + fv.ADJUSTED_LABEL))
    valid = F.coalesce(is_finite(number, number_type) & (number > 0), F.lit(False))
    return F.when(present & ~valid, F.lit("invalid:" + fv.ADJUSTED_LABEL))


def order_rule(prices: Mapping[str, tuple[Column, T.DataType]]) -> Column:
    """High and low must bound the bar; judged only when all four prices are usable."""
    usable = F.lit(True)
    for value, dtype in prices.values():
        usable = usable & is_finite(value, dtype) & (value > 0)
    opened, high, low, close = (prices[name][0] for name in ("Open", "High", "Low", "Close"))
    crossed = (high < F.greatest(opened, close, low)) | (low > F.least(opened, close, high))
    return F.when(F.when(usable, crossed).otherwise(F.lit(False)), F.lit("ohlc_order"))


def row_rules(
    schema: T.StructType, columns: Mapping[str, str], adjusted: str | None,
    day: Column, start: Column, end: Column, duplicate: Column,
) -> list[Column]:
    """All rules of one row. ``columns`` maps provider labels to column names."""
    cells = {label: (F.col(name), schema[name].dataType) for label, name in columns.items()}
    rules = date_rules(day, start, end, duplicate)
    rules += [field_rule(label, *cell) for label, cell in cells.items()]
    if adjusted is not None and adjusted in schema.names:
        rules.append(adjusted_rule(F.col(adjusted), schema[adjusted].dataType))
    rules.append(order_rule({label: cell for label, cell in cells.items() if label != "Volume"}))
    return rules


def reasons_text(rules: list[Column]) -> Column:
    """Names of the failing rules in order as one text, empty when none fails.

    Joining text skips nulls inside generated code, which is several times faster over all rows
    than building and compacting an array.
    """
    return F.concat_ws(SEPARATOR, *rules)


def reasons_of(text: Column) -> Column:
    """The text as an array; no reason contains the separator."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, SEPARATOR))
