"""Silver features: normalized strings, hour, device family, region, category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnflow.functions import fixed_values as fixed
from tarnflow.functions.buckets import bucket_by_regex, bucket_by_values


def normalize_strings(df: DataFrame) -> DataFrame:
    """platform, event_type: lower-case and trimmed; device, country: trimmed (spaces only)."""
    rules = {
        "platform": lambda c: F.lower(F.trim(c)),
        "event_type": lambda c: F.lower(F.trim(c)),
        "device": F.trim,
        "country": F.trim,
    }
    present = {name: rule(F.col(name)) for name, rule in rules.items() if name in df.columns}
    return df.withColumns(present) if present else df


def derive_features(df: DataFrame) -> DataFrame:
    """Derived columns over normalized strings; a missing input gives the fixed default."""
    features = {}
    if "event_ts" in df.columns:
        features["event_hour"] = F.hour("event_ts")
    features["device_family"] = (
        bucket_by_regex(F.col("device"), fixed.DEVICE_FAMILIES, fixed.DEVICE_FAMILY_ELSE)
        if "device" in df.columns
        else F.lit(fixed.DEVICE_FAMILY_ABSENT)
    )
    features["geo_region"] = (
        bucket_by_values(F.col("country"), fixed.GEO_REGIONS, fixed.GEO_REGION_ELSE)
        if "country" in df.columns
        else F.lit(fixed.GEO_REGION_ELSE)
    )
    features["event_category"] = (
        bucket_by_values(F.col("event_type"), fixed.EVENT_CATEGORIES, fixed.EVENT_CATEGORY_ELSE)
        if "event_type" in df.columns
        else F.lit(fixed.EVENT_CATEGORY_ELSE)
    )
    return df.withColumns(features)


def add_features(df: DataFrame) -> DataFrame:
    return df.transform(normalize_strings).transform(derive_features)


def sample_projection(df: DataFrame) -> DataFrame:
    """The sample columns that exist."""
    return df.select(*[c for c in fixed.SAMPLE_COLUMNS if c in df.columns])


def sample_rows(df: DataFrame, rows: int = fixed.SAMPLE_ROWS, order_by: str | None = None) -> DataFrame:
    """A few rows to look at; with ``order_by`` always the same ones (top-k, not a full sort)."""
    ordered = df.orderBy(order_by) if order_by else df
    return sample_projection(ordered.limit(rows))
