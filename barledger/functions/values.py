"""Value tests and conversions that keep null, NaN, infinity and zero apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from barledger import fixed_values as fv

INFINITY = float("inf")
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_missing(value: Column, dtype: T.DataType) -> Column:
    """Null, or NaN where the type can hold one."""
    return value.isNull() | F.isnan(value) if is_floating(dtype) else value.isNull()


def is_infinite(value: Column, dtype: T.DataType) -> Column:
    return F.abs(value) == F.lit(INFINITY) if is_floating(dtype) else F.lit(False)


def is_finite(value: Column, dtype: T.DataType) -> Column:
    return ~is_missing(value, dtype) & ~is_infinite(value, dtype)


def nan_to_null(value: Column, dtype: T.DataType) -> Column:
    """One kind of missing, so that NaN is never the largest value of a sort."""
    return F.when(~F.isnan(value), value) if is_floating(dtype) else value


def number_of_text(value: Column) -> Column:
    """Parse plain decimal text; anything else is null rather than an error."""
    return F.when(value.rlike(DECIMAL_TEXT), F.trim(value).try_cast("double"))


def missing_text_to_null(value: Column) -> Column:
    """Turn the text tokens of a missing value into null; other text is untouched."""
    return F.when(~value.isin(*fv.MISSING_TOKENS), value)


def cell_type(value: Column, dtype: T.DataType) -> Column:
    """Type name of one cell; a null cell has the type 'null' whatever its column."""
    return F.when(value.isNull(), F.lit("null")).otherwise(F.lit(dtype.simpleString()))


def cell_text(value: Column, dtype: T.DataType) -> Column:
    """Text of one cell that never writes missing, infinite, zero and text alike."""
    if isinstance(dtype, T.StringType):
        return F.when(value.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), value, F.lit("'")))
    return F.coalesce(value.cast("string"), F.lit("NULL"))


def typed_cell(label: str, value: Column, dtype: T.DataType) -> Column:
    return F.struct(
        F.lit(label).alias("column"),
        cell_type(value, dtype).alias("type"),
        cell_text(value, dtype).alias("repr"),
    )


def once(value: Column) -> Column:
    """Generate ``value`` as a column of its own.

    A predicate on what is derived from an expensive expression would be pushed below it with the
    expression copied into every place it is used; nothing is pushed below a generator's output.
    """
    return F.explode(F.array(value))


def held(value: Column) -> Column:
    """``value`` as a column that no filter of the columns beside it passes.

    What is known of keys, such as that those of a join are not null, is otherwise tested below the exchange that brought
    them together, in each branch of a plan in another way: then they share none.
    """
    return F.when(F.spark_partition_id() >= 0, value)
