"""Silver clean-up: safe casts, null filters, keep the latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnflow.functions import parsing


def ensure_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Cast to TIMESTAMP without raising; a table without the column is left alone."""
    if column not in df.columns:
        return df
    return df.withColumn(column, parsing.as_timestamp(F.col(column), df.schema[column].dataType))


def ensure_date(df: DataFrame, column: str) -> DataFrame:
    """Cast to DATE without raising; a table without the column is left alone."""
    if column not in df.columns:
        return df
    return df.withColumn(column, parsing.as_date(F.col(column), df.schema[column].dataType))


def add_if_absent(df: DataFrame, column: str, value) -> DataFrame:
    """Add a constant (or a column expression), never over a column that is there."""
    if column in df.columns:
        return df
    return df.withColumn(column, F.lit(value))


def run_batch_id():
    """Default batch id of a run, by the clock of the query."""
    return F.concat(F.lit("run_"), F.date_format(F.current_timestamp(), "yyyyMMddHHmmss"))


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()) if column in df.columns else df


def keep_latest(df: DataFrame, key: str = "event_id", by: str = "event_ts") -> DataFrame:
    """The row with the greatest ``by`` per key.

    ``row_number = 1`` lets Spark cut each key to one row per task before the shuffle (window
    group limit), so a key that holds a third of all rows arrives as one row per task. Ties fall
    to the last ingested row, then to the last batch id, then to the remaining columns, so that
    the answer does not depend on the order of files.
    """
    if key not in df.columns or by not in df.columns:
        return df
    first = [by] + [c for c in ("ingested_at", "batch_id") if c in df.columns and c != by]
    rest = [f.name for f in df.schema if f.name not in (key, *first) and _orderable(f.dataType)]
    order = [F.col(c).desc_nulls_last() for c in first + sorted(rest)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def standardize(df: DataFrame) -> DataFrame:
    """Types, null filters and dedupe of one increment."""
    df = ensure_date(ensure_timestamp(df, "event_ts"), "event_date")
    return keep_latest(drop_null(drop_null(df, "event_id"), "event_ts"))
