"""One query per operator, over the driver's tables. Timestamps leave as text."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture as fx
from tarnflow import schemas
from tarnflow.functions import parsing
from tarnflow.operators import features, incremental, quality, standardize
from tarnflow.operators.upsert import upsert, upsert_parquet
from tarnflow.plans.ingest import IngestRun, run_ingest, run_ingest_stream
from tarnflow.plans.replay import replay_quarantine
from tarnflow.plans.silver import run_silver, silver_rows
from tarnflow.sources import accounting, compaction, names, raw
from tarnflow.sources import mark as marks
from tarnflow.sources.envelopes import read_envelopes
from tarnflow.streaming.dedupe_stream import run_dedupe_stream
from tarnflow.streaming.silver_stream import run_silver_stream


def as_text(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, so that the answer does not depend on a client's zone."""
    shown = {}
    for field in df.schema:
        kind = field.dataType.typeName()
        if kind == "timestamp":
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSS")
        elif kind == "date":
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd")
    return df.withColumns(shown) if shown else df


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


# ---- ingest ----


def envelope_scan(spark: SparkSession, sf: str) -> DataFrame:
    folder = fx.scratch(spark)
    fx.land_envelopes(spark, sf, f"{folder}/landed")
    events = read_envelopes(spark, f"{folder}/landed")
    return events.groupBy("batch_id", "envelope_dt").agg(F.count("pos").alias("events"))


def normalize_flatten(spark: SparkSession, sf: str) -> DataFrame:
    valid = fx.classified(spark, sf).where(
        F.col("dq_stage").isNull() | (F.col("dq_stage") == quality.DQ_STAGE)
    )
    return as_text(valid.select(*schemas.RAW.names))


def validate_reasons(spark: SparkSession, sf: str) -> DataFrame:
    schema_stage = F.when(F.col("dq_stage") == quality.SCHEMA_STAGE, F.col("dq_reason"))
    return fx.classified(spark, sf).select("seq", schema_stage.alias("dq_reason"))


def dq_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return quality.bad_rows(fx.classified(spark, sf)).select("seq", "dq_stage", "dq_reason")


def dq_reason_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reason_histogram(fx.classified(spark, sf))


def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = quality.batch_summary(fx.classified(spark, sf))
    return as_text(summary.withColumn("dq_reasons", F.to_json("dq_reasons")))


def ingest_totals(spark: SparkSession, sf: str) -> DataFrame:
    return quality.ingest_totals(quality.batch_summary(fx.classified(spark, sf)))


def quarantine_union(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = quality.split_good_bad(fx.classified(spark, sf))
    return quality.concat_bad(
        bad.where(F.col("dq_stage") == quality.DQ_STAGE).select("seq", "dq_stage", "dq_reason"),
        bad.where(F.col("dq_stage") == quality.SCHEMA_STAGE).select("seq", "dq_stage", "dq_reason"),
    )


def quarantine_table(spark: SparkSession, sf: str) -> DataFrame:
    folder = fx.scratch(spark)
    bad = quality.bad_rows(fx.classified(spark, sf))
    raw.write_quarantine(bad.select(*schemas.QUARANTINE.names), f"{folder}/bad")
    kept = raw.read_quarantine(spark, f"{folder}/bad")
    return as_text(
        kept.select(
            "event_date",
            "batch_id",
            "dq_stage",
            "dq_reason",
            F.get_json_object("raw", "$.id").alias("payload_id"),
            F.get_json_object("raw", "$.attributes.username").alias("payload_username"),
        )
    )


def _ingest(spark: SparkSession, sf: str) -> tuple[IngestRun, str]:
    folder = fx.scratch(spark)
    fx.land_envelopes(spark, sf, f"{folder}/landed")
    lake = f"{folder}/lake"
    return run_ingest(spark, f"{folder}/landed", lake, ingested_at=fx.AS_OF, as_of=fx.AS_OF), lake


def ingest_job(spark: SparkSession, sf: str) -> DataFrame:
    run, _ = _ingest(spark, sf)
    return as_text(run.summary.withColumn("dq_reasons", F.to_json("dq_reasons")))


def ingest_job_raw(spark: SparkSession, sf: str) -> DataFrame:
    _, lake = _ingest(spark, sf)
    rows = spark.read.schema(schemas.RAW).parquet(raw.raw_path(lake))
    return as_text(rows.select(*schemas.RAW.names))


def ingest_job_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, lake = _ingest(spark, sf)
    bad = raw.read_quarantine(spark, raw.quarantine_path(lake))
    return as_text(
        bad.select(
            "event_date",
            "batch_id",
            "dq_stage",
            "dq_reason",
            "username",
            F.get_json_object("raw", "$.id").alias("payload_id"),
        )
    )


def _landed(spark: SparkSession, sf: str) -> str:
    path = f"{fx.scratch(spark)}/landed"
    fx.land_envelopes(spark, sf, path)
    return path


def malformed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Whole lines that are not one envelope, in quarantine with their text."""
    path = f"{fx.scratch(spark)}/lake"
    run_ingest(spark, _landed(spark, sf), path, ingested_at=fx.AS_OF, as_of=fx.AS_OF)
    bad = raw.read_quarantine(spark, raw.quarantine_path(path)).where("dq_stage = 'envelope'")
    return as_text(bad.select("event_date", "batch_id", "dq_reason", "raw"))


def malformed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events that are no object, or whose attributes are none."""
    found = fx.classified(spark, sf).where(F.col("dq_reason") == "unexpected_normalize_error")
    return found.select("seq", "dq_stage", F.col("event_id").isNull().alias("no_id"))


def envelope_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes without a batch id or a date, valid events of theirs."""
    filled = fx.classified(spark, sf).where(
        "dq_reason IS NULL AND (batch_id = 'unknown' OR envelope_date = DATE '2024-01-31')"
    )
    return as_text(filled.select("seq", "batch_id", "envelope_date"))


def empty_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches that came without events; lines that are no envelope are none of them."""
    run = run_ingest(
        spark, _landed(spark, sf), f"{fx.scratch(spark)}/lake", ingested_at=fx.AS_OF, as_of=fx.AS_OF
    )
    empty = run.summary.where("received = 0 AND bad_envelope = 0")
    return as_text(empty.select("batch_id", "event_date", "received"))


def ingest_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Files that land in two parts, taken in three calls: each event is there once."""
    landed, folder = f"{fx.scratch(spark)}/landed", fx.scratch(spark)
    for part in ("seq % 3 = 0", "seq % 3 > 0", None):
        if part:
            fx.land_envelopes(spark, sf, landed, part)
        run_ingest_stream(
            spark, landed, f"{folder}/lake", f"{folder}/progress", ingested_at=fx.AS_OF, as_of=fx.AS_OF
        )
    rows = spark.read.schema(schemas.RAW).parquet(raw.raw_path(f"{folder}/lake"))
    return as_text(rows.select(*schemas.RAW.names))


def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Accounting over all runs: the stream in two calls, and its first micro-batch once more."""
    landed, folder = f"{fx.scratch(spark)}/landed", fx.scratch(spark)
    for part in ("seq % 3 = 0", "seq % 3 > 0"):
        fx.land_envelopes(spark, sf, landed, part)
        run_ingest_stream(
            spark, landed, f"{folder}/lake", f"{folder}/progress", ingested_at=fx.AS_OF, as_of=fx.AS_OF
        )
    lake, held = f"{folder}/lake", accounting.read_accounting(spark, f"{folder}/lake")
    again = held.agg(F.min("run_id")).first()[0]
    accounting.account(_held(spark)(held.where(F.col("run_id") == again).drop("run_id")), lake, again)
    totals = accounting.running_totals(spark, lake)
    return totals.withColumn("dq_reasons", F.to_json("dq_reasons"))


def _small_runs(spark: SparkSession, sf: str, runs: int) -> str:
    """A lake to which the events came in many small runs."""
    lake = f"{fx.scratch(spark)}/lake"
    rows = fx.classified(spark, sf)
    raw.write_ingest(rows, lake, F.format_string("run%02d", F.col("seq") % runs))
    return lake


def compacted_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table after twenty small runs and a compaction, and whether a tenth of the files are left."""
    lake = _small_runs(spark, sf, 20)
    packed = compaction.compact(spark, lake, older_than=timedelta(0))
    rows = spark.read.schema(schemas.RAW).parquet(raw.raw_path(lake))
    few = compaction.run_sizes(spark, lake).agg(F.sum("files")).first()[0] * 10 <= packed.files
    return as_text(rows.select(*schemas.RAW.names)).withColumn("few_files", F.lit(few))


def quarantine_replay(spark: SparkSession, sf: str) -> DataFrame:
    """What moves when one more platform is allowed and the clock has passed March, in two calls."""
    lake = f"{fx.scratch(spark)}/lake"
    raw.write_ingest(fx.classified(spark, sf).drop("seq"), lake, "first")
    later = {"ingested_at": fx.AS_OF, "as_of": fx.AS_OF + timedelta(days=60)}
    moves = [
        replay_quarantine(spark, lake, platforms=("web", "mobile", "tv"), **later),
        replay_quarantine(spark, lake, platforms=("web", "mobile", "tv"), **later),
    ]
    rows = spark.read.schema(schemas.WRITTEN).parquet(raw.raw_path(lake)).where("run_id LIKE 'replay-%'")
    return as_text(rows.select(*schemas.RAW.names)).withColumn("moved_again", F.lit(moves[1].moved))


# ---- incremental reads ----


def _raw_table(spark: SparkSession, sf: str) -> str:
    path = f"{fx.scratch(spark)}/raw"
    raw.write_raw(fx.raw_rows(spark, sf), path)
    return path


def partition_pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    scan = raw.read_raw_events(spark, _raw_table(spark, sf), fx.MARK, fx.LOOKBACK_DAYS)
    return as_text(count_by(scan, "event_date"))


def incremental_filter(spark: SparkSession, sf: str) -> DataFrame:
    new = incremental.newer_than_mark(fx.raw_rows(spark, sf, "seq"), fx.MARK)
    return as_text(new.select("seq", "event_id", "event_ts"))


def next_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.next_mark(
        silver_rows(incremental.newer_than_mark(fx.raw_rows(spark, sf), fx.MARK))
    )


def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    scanned = fx.raw_rows(spark, sf).where(raw.within_scan(fx.MARK, fx.LOOKBACK_DAYS))
    return incremental.run_stats(scanned, fx.MARK)


# ---- silver ----


def silver_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(standardize.standardize(fx.raw_rows(spark, sf)))


def string_normalize(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.normalize_strings(fx.raw_rows(spark, sf, "seq"))
    return rows.select("seq", "platform", "event_type", "device", "country")


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return features.add_features(fx.raw_rows(spark, sf))


def event_hour_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_by(_features(spark, sf), "event_hour")


def device_family_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_by(_features(spark, sf), "device_family")


def geo_region_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_by(_features(spark, sf), "geo_region")


def event_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_by(_features(spark, sf), "event_category")


def silver_features(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(silver_rows(fx.raw_rows(spark, sf)))


def silver_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: events to deduplicated, bucketed activity."""
    silver = silver_rows(fx.raw_rows(spark, sf))
    return count_by(silver, "geo_region", "device_family", "event_category")


def null_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a key or a time do not get into silver."""
    rows = fx.raw_rows(spark, sf, "seq").withColumns(
        {
            "event_id": F.when(F.col("seq") % 10 != 0, F.col("event_id")),
            "event_ts": F.when(F.col("seq") % 10 != 1, F.col("event_ts")),
        }
    )
    return as_text(standardize.standardize(rows).select("event_id", "event_ts"))


def run_batch_default(spark: SparkSession, sf: str) -> DataFrame:
    """Without a batch id, rows get one id made from the current time."""
    rows = silver_rows(fx.raw_rows(spark, sf).drop("batch_id"))
    made = F.col("batch_id").rlike("^run_[0-9]{14}$")
    return rows.groupBy(made.alias("from_time")).agg(
        F.count("*").alias("n"), F.countDistinct("batch_id").alias("ids")
    )


def missing_column_defaults(spark: SparkSession, sf: str) -> DataFrame:
    lacking = fx.raw_rows(spark, sf).drop("device", "country", "event_type", "batch_id")
    return as_text(silver_rows(standardize.add_if_absent(lacking, "batch_id", "run_fixed")))


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return features.sample_rows(silver_rows(fx.raw_rows(spark, sf)), order_by="event_id")


# ---- upsert ----


def _upsert_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = _held(spark)(fx.raw_rows(spark, sf, "seq"))
    old = standardize.keep_latest(rows.where(~incremental.is_new(fx.MARK)))
    corrected = old.where(F.col("seq") % 10 == 0).withColumn("os", F.lit(None).cast("string"))
    source = standardize.keep_latest(
        corrected.unionByName(incremental.newer_than_mark(rows, fx.MARK))
    )
    return old.withColumn("note", F.lit("kept")), source


def _held(spark: SparkSession):
    """Written once, so that a query that looks at a side twice does not derive it twice."""

    def hold(side: DataFrame) -> DataFrame:
        path = f"{fx.scratch(spark)}/side"
        side.write.parquet(path)
        return spark.read.schema(side.schema).parquet(path)

    return hold


def upsert_rows(spark: SparkSession, sf: str) -> DataFrame:
    target, source = map(_held(spark), _upsert_sides(spark, sf))
    return as_text(upsert(target.drop("note"), source, check_unique=False))


def upsert_target_only_columns(spark: SparkSession, sf: str) -> DataFrame:
    target, source = map(_held(spark), _upsert_sides(spark, sf))
    return upsert(target, source, check_unique=False).select("event_id", "os", "note")


def upsert_older_rows_ignored(spark: SparkSession, sf: str) -> DataFrame:
    """The optional guard: old rows offered to a table that already holds newer ones."""
    target, source = map(_held(spark), _upsert_sides(spark, sf))
    return as_text(
        upsert(source, target.drop("note"), newer_than="event_ts", check_unique=False)
    )


def upsert_parquet_table(spark: SparkSession, sf: str) -> DataFrame:
    target, source = map(_held(spark), _upsert_sides(spark, sf))
    path = f"{fx.scratch(spark)}/table"
    upsert_parquet(spark, path, target, check_unique=False)
    upsert_parquet(spark, path, source)
    return as_text(spark.read.parquet(path))


def upsert_random_keys(spark: SparkSession, sf: str) -> DataFrame:
    """An increment of few keys that no range tells apart, some of them new to the table."""
    rows = standardize.keep_latest(fx.raw_rows(spark, sf, "seq"))
    rows = _held(spark)(rows.withColumn("event_id", F.md5("event_id")))
    path = f"{fx.scratch(spark)}/table"
    upsert_parquet(spark, path, rows.where("seq % 194 <> 0"), check_unique=False)
    upsert_parquet(spark, path, rows.where("seq % 97 = 0").withColumn("os", F.lit("corrected")))
    return as_text(spark.read.parquet(path))


def target_names(spark: SparkSession, sf: str) -> DataFrame:
    """Merge targets by name: the first candidate that exists, and the rows found there."""
    fx.configure(spark)
    base = f"tarnflow_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{fx.scratch(spark)}/{base}'")
    good = _held(spark)(fx.raw_rows(spark, sf, "seq"))
    good.where("seq % 2 = 0").write.saveAsTable(f"{base}.events")
    good.where("seq % 2 = 1").write.saveAsTable(f"{base}.odd_events")
    asked = {
        "as given": f"{base}.events", "without its catalog": f"nowhere.{base}.events",
        "with a catalog": f"spark_catalog.{base}.odd_events",
    }
    out = None
    for how, name in asked.items():
        found = names.resolve(spark, name)
        rows = spark.table(found).agg(F.count("*").alias("n")).select(
            F.lit(how).alias("asked"), F.lit(found.replace(base, "db")).alias("found"), "n"
        )
        out = rows if out is None else out.unionAll(rows)
    return out


# ---- jobs ----


def incremental_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    folder = fx.scratch(spark)
    places = (f"{folder}/raw", f"{folder}/mark.json", f"{folder}/silver")
    rows = fx.raw_rows(spark, sf)
    raw.write_raw(rows.where(~incremental.is_new(fx.MARK)), places[0])
    run_silver(spark, *places)
    raw.write_raw(incremental.newer_than_mark(rows, fx.MARK), places[0])
    run_silver(spark, *places)
    return as_text(spark.read.schema(schemas.SILVER).parquet(places[2]))


def late_rows_tolerated(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that come after the mark has passed them by a week, read with a tolerance of ten days."""
    folder = fx.scratch(spark)
    places = (f"{folder}/raw", f"{folder}/mark.json", f"{folder}/silver")
    rows = fx.raw_rows(spark, sf, "seq")
    first = "event_ts <= TIMESTAMP '2024-01-15 00:00:00' AND NOT (seq % 11 = 0 AND event_ts > TIMESTAMP '2024-01-07 00:00:00')"
    raw.write_raw(rows.where(first), places[0])
    run_silver(spark, *places)
    raw.write_raw(rows.where(f"NOT ({first})"), places[0])
    run_silver(spark, *places, late_tolerance=timedelta(days=10), newer_than="event_ts")
    return as_text(spark.read.schema(schemas.SILVER).parquet(places[2]))


def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Where the rows of a second run went: the increment, late ones by date, those seen before."""
    folder = fx.scratch(spark)
    places = (f"{folder}/raw", f"{folder}/mark.json", f"{folder}/silver")
    rows = _held(spark)(fx.raw_rows(spark, sf, "seq"))
    first = "event_ts <= TIMESTAMP '2024-01-15 00:00:00' AND seq % 11 <> 0"
    raw.write_raw(rows.where(first), places[0])
    run_silver(spark, *places)
    second = rows.where(f"NOT ({first})").withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY"))
    raw.write_raw(second, places[0])
    run = run_silver(spark, *places, late_path=f"{folder}/late")
    late = count_by(as_text(spark.read.schema(schemas.RAW).parquet(f"{folder}/late")), "event_date")
    totals = [
        ("scanned", run.rows_raw_scanned), ("increment", run.rows_new), ("late", run.rows_late),
        ("seen", run.rows_seen), ("untimed", run.rows_untimed),
    ]
    counted = spark.createDataFrame(totals, "went_to string, n long").withColumn("event_date", F.lit(None).cast("string"))
    return counted.unionByName(late.withColumn("went_to", F.lit("late table")))


def guarded_mark(spark: SparkSession, sf: str) -> DataFrame:
    """Two increments, then a writer that read the mark before the second one: it is refused."""
    folder = fx.scratch(spark)
    places = (f"{folder}/raw", f"{folder}/mark.json", f"{folder}/silver")
    rows = _held(spark)(fx.raw_rows(spark, sf))
    raw.write_raw(rows.where(~incremental.is_new(fx.MARK)), places[0])
    run_silver(spark, *places)
    stale = marks.read_document(spark, places[1])
    raw.write_raw(incremental.newer_than_mark(rows, fx.MARK), places[0])
    run_silver(spark, *places)
    try:
        marks.write_mark(spark, places[1], "2024-01-01T00:00:00Z", stale)
        refused = False
    except marks.MarkMoved:
        refused = True
    return spark.read.schema(schemas.MARK_DOCUMENT).json(places[1]).select(
        "last_processed_event_ts", "generation", F.lit(refused).alias("refused")
    )


def stored_mark(spark: SparkSession, sf: str) -> DataFrame:
    """The mark document after a run over everything, read back."""
    folder = fx.scratch(spark)
    places = (_raw_table(spark, sf), f"{folder}/mark.json", f"{folder}/silver")
    run_silver(spark, *places)
    mark = marks.read_mark(spark, places[1])
    return spark.read.schema(schemas.MARK_DDL).json(places[1]).select(
        "last_processed_event_ts",
        parsing.iso_utc_text(marks.mark_literal(mark)).alias("parsed_back"),
    )


def stream_available_now(spark: SparkSession, sf: str) -> DataFrame:
    folder = fx.scratch(spark)
    run_silver_stream(
        spark, _raw_table(spark, sf), f"{folder}/progress", silver_path=f"{folder}/silver"
    )
    return as_text(spark.read.schema(schemas.SILVER).parquet(f"{folder}/silver"))


def stream_deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that come two times, in two of three micro-batches: each is in the append-only table once."""
    folder = fx.scratch(spark)
    rows = _held(spark)(standardize.keep_latest(fx.raw_rows(spark, sf, "seq")))
    for k in range(3):
        raw.write_raw(rows.where(F.col("seq") % 3 != k), f"{folder}/raw")
        run_dedupe_stream(spark, f"{folder}/raw", f"{folder}/progress", f"{folder}/once", within=timedelta(days=60))
    return as_text(spark.read.schema(schemas.RAW).parquet(f"{folder}/once"))


QUERIES = {
    f.__name__: f
    for f in (
        envelope_scan,
        normalize_flatten,
        validate_reasons,
        dq_reasons,
        dq_reason_histogram,
        batch_summary,
        ingest_totals,
        quarantine_union,
        quarantine_table,
        ingest_job,
        ingest_job_raw,
        ingest_job_quarantine,
        malformed_lines,
        malformed_events,
        envelope_defaults,
        empty_batches,
        ingest_repeated,
        running_totals,
        compacted_raw,
        quarantine_replay,
        partition_pruned_scan,
        incremental_filter,
        next_watermark,
        run_stats,
        silver_dedupe,
        string_normalize,
        event_hour_counts,
        device_family_counts,
        geo_region_counts,
        event_category_counts,
        silver_features,
        silver_counts,
        null_filters,
        run_batch_default,
        missing_column_defaults,
        sample_rows,
        upsert_rows,
        upsert_target_only_columns,
        upsert_older_rows_ignored,
        upsert_parquet_table,
        upsert_random_keys,
        target_names,
        incremental_two_runs,
        late_rows_tolerated,
        late_rows,
        guarded_mark,
        stored_mark,
        stream_available_now,
        stream_deduplicated,
    )
}
