"""Ordered bucket columns: the first rule that fits gives the label."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_by_regex(column: Column, rules: Iterable[tuple[str, str]], default: str) -> Column:
    """Label of the first pattern found in the text, else ``default`` (also for NULL)."""
    return _first_match([(column.rlike(pattern), label) for pattern, label in rules], default)


def bucket_by_values(
    column: Column, rules: Iterable[tuple[Sequence[str], str]], default: str
) -> Column:
    """Label of the first list holding the value, else ``default`` (also for NULL)."""
    return _first_match([(column.isin(*values), label) for values, label in rules], default)


def _first_match(arms: Sequence[tuple[Column, str]], default: str) -> Column:
    result = F.lit(default)
    for condition, label in reversed(arms):
        result = F.when(condition, F.lit(label)).otherwise(result)
    return result
