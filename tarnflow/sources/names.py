"""Table names: quoting and choice of the merge target."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def quote(identifier: str) -> str:
    """One identifier in back-ticks; back-ticks inside are doubled."""
    return "`" + identifier.replace("`", "``") + "`"


def split_name(name: str) -> list[str]:
    """``db.table`` or ``catalog.db.table`` as its parts; anything else is an error."""
    parts = [part for part in map(str.strip, name.split(".")) if part]
    if not 2 <= len(parts) <= 3:
        raise ValueError(f"expected db.table or catalog.db.table, got {name!r}")
    return parts


def quote_name(name: str) -> str:
    return ".".join(quote(part) for part in split_name(name))


def candidates(name: str) -> list[str]:
    """Names to try in order: as given, then without the catalog."""
    parts = split_name(name)
    return [".".join(parts[start:]) for start in range(len(parts) - 1)]


def resolve(spark: SparkSession, name: str) -> str:
    """Quoted name of the first candidate that exists.

    Decided by existence: a merge that fails for a real reason is not repeated on another table.
    """
    for candidate in candidates(name):
        if _exists(spark, quote_name(candidate)):
            return quote_name(candidate)
    raise ValueError(f"no such table: {name} (tried {', '.join(candidates(name))})")


def _exists(spark: SparkSession, quoted: str) -> bool:
    try:
        return spark.catalog.tableExists(quoted)
    except AnalysisException:
        # The catalog or the database is not known to this session.
        return False
