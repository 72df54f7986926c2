"""Cleansing column expressions and frame-level projections.

All are built-in expressions: they stay inside whole-stage codegen and are
applied in a single projection per layer.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.constants import (FIRST_NUMBER_PATTERN, RAW_NUMERIC_COLUMNS,
                                RAW_TEXT_COLUMNS, SILVER_NAMES, USER_ID_DIGITS, USER_ID_PREFIX,
                                USER_ID_PATTERN, WAREHOUSE_DECIMAL)


def normalise_name(name: str) -> str:
    """Strip, lower-case, spaces and hyphens to underscores."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    """C1 applied once to the whole frame (one projection, not a rename loop)."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def clean_text(c: Column | str) -> Column:
    """``trim(lower(x))`` — trim removes spaces only, not tabs."""
    return F.trim(F.lower(F.col(c) if isinstance(c, str) else c))


def clean_number(c: Column | str) -> Column:
    """Trim, drop thousands commas, cast to double; unparsable -> null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.trim(col), ",", "").try_cast("double")


def first_number(c: Column | str) -> Column:
    """First unsigned decimal number in the text, as double ('' -> null)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_extract(col, FIRST_NUMBER_PATTERN, 1), F.lit("")).try_cast("double")


def raw_to_bronze(raw: DataFrame) -> DataFrame:
    """Normalise names, clean text and numbers, whole-row distinct.

    Columns that are absent are skipped (apply-if-present, C7). The distinct
    is a hash aggregate with map-side combine, so duplicated rows are reduced
    before the shuffle.
    """
    df = normalise_columns(raw)
    present = set(df.columns)
    exprs = {c: clean_text(c) for c in RAW_TEXT_COLUMNS if c in present}
    exprs.update({c: clean_number(c) for c in RAW_NUMERIC_COLUMNS if c in present})
    return df.withColumns(exprs).dropDuplicates()


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename only the columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Keep the wanted columns that are present, in wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def to_warehouse_decimal(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Numeric columns are stored as DECIMAL(10,2) at the warehouse edge."""
    p, s = WAREHOUSE_DECIMAL
    have = set(df.columns)
    return df.withColumns({c: F.col(c).cast(f"decimal({p},{s})") for c in cols if c in have})


def bronze_text_and_serving(df: DataFrame) -> DataFrame:
    """Silver prelude: re-clean text, add ``serving_size_value`` (C2, C5), rename."""
    present = set(df.columns)
    exprs = {c: clean_text(c) for c in RAW_TEXT_COLUMNS if c in present}
    if "weight" in present:
        exprs["serving_size_value"] = first_number(clean_text("weight"))
    return rename_present(df.withColumns(exprs), SILVER_NAMES)


def is_user_id(c: Column | str) -> Column:
    """C17: ids shaped ``U<digits>``."""
    col = F.col(c) if isinstance(c, str) else c
    return col.rlike(USER_ID_PATTERN)


def user_id_number(c: Column | str) -> Column:
    """C17: numeric part of a ``U<digits>`` id as a decimal of 38 digits (null for
    other shapes, and for longer numbers, which no allocated id can reach)."""
    col = F.col(c) if isinstance(c, str) else c
    digits = F.regexp_replace(F.substring(col, 2, 1 << 20), "^0+(?=[0-9])", "")
    return F.when(is_user_id(col) & (F.length(digits) <= 38), digits.try_cast("decimal(38,0)"))


def format_user_id(n: Column | str) -> Column:
    """``U`` + at least three digits (widens after 999)."""
    col = F.col(n) if isinstance(n, str) else n
    digits = col.cast("string")  # integers of any width; format_string takes 64 bits at most
    return F.concat(F.lit(USER_ID_PREFIX), F.when(F.length(digits) < USER_ID_DIGITS, F.lpad(digits, USER_ID_DIGITS, "0")).otherwise(digits))


def dataset_profile(df: DataFrame) -> DataFrame:
    """Per-column row count, null count and distinct-free type name.

    One aggregate pass over the data (``count_if`` per column), then an
    unpivot of the single result row; no per-column jobs.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(i + 1).alias("ordinal"),
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col(f"n_{i}").alias("null_count"),
        )
        for i, c in enumerate(df.columns)
    ]
    return (one.select(F.col("__rows").alias("row_count"),
                       F.lit(len(df.columns)).alias("column_count"),
                       F.explode(F.array(*entries)).alias("e"))
            .select(F.col("e.ordinal").alias("ordinal"), F.col("e.column_name").alias("column_name"),
                    F.col("e.data_type").alias("data_type"), "row_count", "column_count",
                    F.col("e.null_count").alias("null_count")))
