"""Data-quality rules, the good/bad split and the batch accounting."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnflow.functions import fixed_values as fixed
from tarnflow.operators.normalize import ENVELOPE_STAGE, SCHEMA_STAGE
from tarnflow.sources.mark import mark_literal

DQ_STAGE = "dq"
SUMMED = ("received", "good", "bad_schema", "bad_dq", "bad_envelope")


def dq_reason(
    as_of: datetime | Column | None = None,
    platforms: Sequence[str] = fixed.ALLOWED_PLATFORMS,
) -> Column:
    """First data-quality rule a normalized row breaks: platform list, then future time."""
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, datetime):
        as_of = mark_literal(as_of)
    latest = as_of + F.make_dt_interval(mins=F.lit(fixed.FUTURE_TOLERANCE_MINUTES))
    return F.when(
        F.col("platform").isNotNull() & ~F.col("platform").isin(*platforms),
        fixed.INVALID_PLATFORM,
    ).when(F.col("event_ts") > latest, fixed.EVENT_TS_IN_FUTURE)


def apply_dq(
    normalized: DataFrame,
    as_of: datetime | Column | None = None,
    platforms: Sequence[str] = fixed.ALLOWED_PLATFORMS,
) -> DataFrame:
    """Add the rule verdict to rows that passed the schema stage; the others stay as they are."""
    untested = F.col("dq_reason").isNull() & F.col("pos").isNotNull()
    verdict = F.when(untested, dq_reason(as_of, platforms)).otherwise(F.col("dq_reason"))
    stage = F.when(untested & verdict.isNotNull(), F.lit(DQ_STAGE)).otherwise(F.col("dq_stage"))
    return normalized.withColumns({"dq_stage": stage, "dq_reason": verdict})


def good_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("dq_reason").isNull() & F.col("pos").isNotNull())


def bad_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("dq_reason").isNotNull())


def split_good_bad(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    return good_rows(classified), bad_rows(classified)


def concat_bad(bad_dq: DataFrame, bad_schema: DataFrame) -> DataFrame:
    """UNION ALL of two reject sets by column name; a column one of them lacks is NULL there."""
    return bad_dq.unionByName(bad_schema, allowMissingColumns=True)


def reason_histogram(classified: DataFrame) -> DataFrame:
    """Rejects per stage and reason. Partial sums make a dominant reason harmless."""
    return (
        bad_rows(classified)
        .groupBy("dq_stage", "dq_reason")
        .agg(F.count("*").alias("n"))
    )


def batch_summary(classified: DataFrame) -> DataFrame:
    """Accounting per batch and envelope date; an empty batch is listed with zero received.

    Lines that are no envelope belong to no batch: they are counted as ``bad_envelope`` under the
    unknown batch of the day they came in, never as events.

    One hash aggregate with map-side partial sums: a batch that holds a third of all rows reaches
    the reducer as one row per task. The reason map needs no second pass, as the reasons are a
    fixed list; it holds the data-quality stage only and leaves out reasons that did not occur.
    """
    is_event = F.col("pos").isNotNull()
    at_stage = F.col("dq_stage")
    per_reason = [
        (reason, F.count_if((at_stage == DQ_STAGE) & (F.col("dq_reason") == reason)))
        for reason in fixed.DQ_REASONS
    ]
    reasons = F.map_filter(
        F.map_from_arrays(
            F.array(*[F.lit(reason) for reason, _ in per_reason]),
            F.array(*[count for _, count in per_reason]),
        ),
        lambda _, n: n > 0,
    )
    return classified.groupBy("batch_id", F.col("envelope_date").alias("event_date")).agg(
        F.count("pos").alias("received"),
        F.count_if(is_event & F.col("dq_reason").isNull()).alias("good"),
        F.count_if(at_stage == SCHEMA_STAGE).alias("bad_schema"),
        F.count_if(at_stage == DQ_STAGE).alias("bad_dq"),
        F.count_if(at_stage == ENVELOPE_STAGE).alias("bad_envelope"),
        reasons.alias("dq_reasons"),
    )


def ingest_totals(summary: DataFrame) -> DataFrame:
    """Run totals over the batch summary."""
    return summary.agg(
        F.coalesce(F.sum("good"), F.lit(0)).alias("total_good"),
        F.coalesce(F.sum(F.col("bad_schema") + F.col("bad_dq")), F.lit(0)).alias("total_bad"),
        F.coalesce(F.sum("bad_envelope"), F.lit(0)).alias("total_bad_envelope"),
    )


def merged_summaries(summaries: DataFrame, *by: str) -> DataFrame:
    """Sums of batch summaries, or of sums of them, by ``by`` (such as batch and date; none: all in one row).

    Every column is a sum, and the reason map a sum per reason, so that parts may be merged in any order
    and any grouping. Reasons are added up by name before the map is made: one row per group and reason.
    """
    counted = [c for c in SUMMED if c in summaries.columns]
    keyed = [F.col(c) for c in by]
    totals = summaries.groupBy(*keyed).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted])
    by_reason = summaries.select(*keyed, F.explode("dq_reasons").alias("reason", "n"))
    by_reason = by_reason.groupBy(*keyed, "reason").agg(F.sum("n").alias("n"))
    pairs = F.sort_array(F.collect_list(F.struct("reason", "n")))  # no more than there are reasons
    maps = by_reason.groupBy(*keyed).agg(F.map_from_entries(pairs).alias("dq_reasons"))
    maps = maps.select(*[F.col(c).alias(f"_{c}") for c in by], "dq_reasons")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    none = F.expr("map_from_arrays(array(), array())").cast("map<string,bigint>")
    return totals.join(maps, same, "left").select(
        *keyed, *counted, F.coalesce("dq_reasons", none).alias("dq_reasons")
    )
