"""The stored high-water mark: last processed event time, one small JSON document."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.functions import parsing
from tarnflow.sources import storage

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_FIELD, _SEEN, _GENERATION = "last_processed_event_ts", "last_ingested_at", "generation"


class MarkMoved(RuntimeError):
    """Another run has stored a mark since this one read it."""


@dataclass(frozen=True)
class Mark:
    """The stored mark, the latest ingest time of the run that stored it, and how often it has moved."""

    event_ts: datetime
    ingested_at: datetime | None
    generation: int


def read_mark(spark: SparkSession, path: str, strict: bool = False) -> datetime:
    """The stored mark as a UTC datetime; see ``read_document``."""
    return read_document(spark, path, strict).event_ts


def read_document(spark: SparkSession, path: str, strict: bool = False) -> Mark:
    """The stored mark.

    A missing, empty or unreadable mark means the epoch, that is, a full reprocess; with
    ``strict`` a document that is there but cannot be understood is an error instead. A store
    that cannot be reached is always an error. A writer that died after it had taken its generation, and
    before the document was replaced, has moved the mark all the same.
    """
    mark = _read(spark, path, strict) if storage.path_exists(spark, path) else Mark(EPOCH, None, 0)
    while storage.path_exists(spark, following := _generation(path, mark.generation + 1)):
        mark = _read(spark, following, strict=True)
    return mark


def _read(spark: SparkSession, path: str, strict: bool) -> Mark:
    document = spark.read.schema(schemas.MARK_DOCUMENT).option("multiLine", "true").json(path)
    # As microseconds since the epoch: no driver-side time zone comes into it.
    micros = [F.max(F.unix_micros(parsing.iso_timestamp(F.col(name)))) for name in (_FIELD, _SEEN)]
    row = document.agg(*micros, F.max(_GENERATION)).first()
    if row[0] is None and strict:
        raise ValueError(f"no usable {_FIELD} in {path}")
    return Mark(
        EPOCH if row[0] is None else from_micros(row[0]),
        None if row[1] is None else from_micros(row[1]),
        row[2] or 0,
    )


def _generation(path: str, number: int) -> str:
    return f"{path}.generations/{number:012d}.json"


def write_mark(
    spark: SparkSession,
    path: str,
    iso_text: str,
    read: Mark | None = None,
    ingested_at: str | None = None,
) -> int:
    """Store a new mark, unless another run did so since ``read``; gives its generation.

    The next generation is a file that only one writer can create, so of two runs that read the same mark
    the second is refused (``MarkMoved``) and changes nothing. The document itself stays in place until
    the new one is complete. Generations are kept: a writer that slept for many of them is refused as well.
    Without ``read`` the mark is taken as it is now.
    """
    read = read or read_document(spark, path)
    document = {_FIELD: iso_text, _GENERATION: read.generation + 1}
    if ingested_at:
        document[_SEEN] = ingested_at
    text = json.dumps(document)
    if not storage.create_text(spark, _generation(path, read.generation + 1), text):
        raise MarkMoved(f"{path} has moved past generation {read.generation}")
    storage.replace_text(spark, path, text)
    return read.generation + 1


def mark_literal(mark: datetime) -> Column:
    """The mark as a TIMESTAMP literal that does not depend on the session or driver zone."""
    return F.timestamp_micros(F.lit(to_micros(mark)))


def to_micros(mark: datetime) -> int:
    delta = mark.astimezone(timezone.utc) - EPOCH
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def from_micros(micros: int) -> datetime:
    seconds, rest = divmod(micros, 1_000_000)
    return datetime.fromtimestamp(seconds, tz=timezone.utc).replace(microsecond=rest)
