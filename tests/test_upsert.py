import os
from datetime import date

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tarnflow.operators.upsert import matching_rows, merge_into_table, upsert, upsert_parquet
from tarnflow.operators import upsert as module
from tarnflow.sources import storage
from tests.conftest import plan_of

SCHEMA = "event_id string, event_date date, v string, n int"
D = [date(2024, 1, d) for d in range(1, 10)]
TARGET = [("a", D[1], "a1", 1), ("b", D[1], "b1", 2), ("c", D[2], "c1", 3), ("d", D[3], "d1", 4), (None, D[3], "null key", 5)]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def as_set(df):
    return sorted(map(str, df.select("event_id", "event_date", "v", "n").collect()))


def read(spark, path):
    return spark.read.parquet(path)


def both_ways(spark, folder, target, source, **options):
    """The DataFrame form and the Parquet-table form must agree; gives the rows."""
    pure = as_set(upsert(target, source, **options))
    upsert_parquet(spark, folder, target)
    upsert_parquet(spark, folder, source, **options)
    assert as_set(read(spark, folder)) == pure
    return pure


def test_update_insert_keep(spark, folder):
    source = frame(spark, [("a", D[1], None, 10), ("e", D[5], "e1", 11), (None, D[1], "also null", 12)])
    rows = both_ways(spark, folder, frame(spark, TARGET), source)
    expected = [("a", D[1], None, 10), *TARGET[1:], ("e", D[5], "e1", 11), (None, D[1], "also null", 12)]
    assert rows == as_set(frame(spark, expected))


def test_source_without_a_column_keeps_it_on_update_and_inserts_null(spark, folder):
    source = frame(spark, [("a", D[1], "a2"), ("e", D[5], "e1")], "event_id string, event_date date, v string")
    rows = both_ways(spark, folder, frame(spark, TARGET), source)
    assert rows == as_set(frame(spark, [("a", D[1], "a2", 1), *TARGET[1:], ("e", D[5], "e1", None)]))


def test_column_order_and_type_of_the_target_stay(spark, folder):
    source = frame(spark, [("a", "x", 7, D[1])], "event_id string, v string, n bigint, event_date date")
    out = upsert(frame(spark, TARGET), source)
    assert out.dtypes == frame(spark, TARGET).dtypes
    both_ways(spark, folder, frame(spark, TARGET), source)


def test_older_row_overwrites_unless_guarded(spark, folder):
    source = frame(spark, [("c", D[2], "older", 1), ("a", D[1], "newer", 9), ("b", D[1], "same", 2)])
    assert "older" in str(both_ways(spark, f"{folder}/1", frame(spark, TARGET), source))
    guarded = str(both_ways(spark, f"{folder}/2", frame(spark, TARGET), source, newer_than="n"))
    assert "older" not in guarded and "newer" in guarded and "same" in guarded


def test_guard_with_nulls(spark, folder):
    target = frame(spark, [("a", D[1], "t", None), ("b", D[1], "t", 1)])
    source = frame(spark, [("a", D[1], "s", 5), ("b", D[1], "s", None)])
    rows = both_ways(spark, folder, target, source, newer_than="n")
    assert rows == as_set(frame(spark, [("a", D[1], "s", 5), ("b", D[1], "t", 1)]))


def test_errors(spark, folder):
    target = frame(spark, TARGET)
    twice = frame(spark, [("a", D[1], "1", 1), ("a", D[2], "2", 2)])
    with pytest.raises(ValueError, match="duplicate"):
        upsert(target, twice)
    with pytest.raises(ValueError, match="merge key"):
        upsert(target, target.drop("event_id"))
    with pytest.raises(ValueError, match="not in the target"):
        upsert(target, target.withColumn("extra", F.lit(1)))
    upsert_parquet(spark, folder, target)
    with pytest.raises(ValueError, match="duplicate"):
        upsert_parquet(spark, folder, twice)
    with pytest.raises(ValueError, match="merge key"):
        upsert_parquet(spark, folder, target.drop("event_id"))
    with pytest.raises(ValueError, match="date or an integer"):
        upsert_parquet(spark, folder, target, partition="v")
    assert as_set(read(spark, folder)) == as_set(target)


def test_only_touched_partitions_are_rewritten(spark, folder):
    upsert_parquet(spark, folder, frame(spark, TARGET))
    before = {d: sorted(os.listdir(f"{folder}/{d}")) for d in os.listdir(folder) if d.startswith("event_date")}
    upsert_parquet(spark, folder, frame(spark, [("c", D[2], "c2", 0)]))
    after = {d: sorted(os.listdir(f"{folder}/{d}")) for d in os.listdir(folder) if d.startswith("event_date")}
    assert {d for d in before if before[d] != after[d]} == {f"event_date={D[2]}"}


def test_new_keys_rewrite_nothing(spark, folder):
    upsert_parquet(spark, folder, frame(spark, TARGET))
    files = set(read(spark, folder).inputFiles())
    upsert_parquet(spark, folder, frame(spark, [("x", D[2], "x", 0), ("y", D[7], "y", 0)]))
    assert files < set(read(spark, folder).inputFiles())
    assert read(spark, folder).count() == len(TARGET) + 2


def test_crash_between_append_and_rewrite(spark, folder, monkeypatch):
    """A moved row is appended to its new partition before its old copy goes; a rerun repairs it."""
    upsert_parquet(spark, folder, frame(spark, TARGET))
    source = frame(spark, [("c", D[5], "moved", 1), ("n", D[5], "new", 1), ("a", D[1], "a2", 1)])
    expected = as_set(upsert(frame(spark, TARGET), source))
    write = module._write

    def crash(df, path, partition, mode):
        if f"/{module.COMMITS}/" in path:
            raise RuntimeError("lost")
        write(df, path, partition, mode)

    with monkeypatch.context() as patch:
        patch.setattr(module, "_write", crash)
        with pytest.raises(RuntimeError):
            upsert_parquet(spark, folder, source)
    assert read(spark, folder).count() == len(TARGET) + 2
    upsert_parquet(spark, folder, source)
    assert as_set(read(spark, folder)) == expected


def test_row_that_moves_away_empties_its_partition(spark, folder):
    source = frame(spark, [("c", D[5], "moved", 1)])
    rows = both_ways(spark, folder, frame(spark, TARGET), source)
    assert len(rows) == len(TARGET) and not os.path.exists(f"{folder}/event_date={D[2]}")


def test_moves_in_a_circle_and_null_partition(spark, folder):
    target = frame(spark, [("a", D[1], "a", 1), ("b", D[2], "b", 2), ("c", None, "c", 3)])
    source = frame(spark, [("a", D[2], "a2", 1), ("b", None, "b2", 2), ("c", D[1], "c2", 3)])
    both_ways(spark, folder, target, source)
    upsert_parquet(spark, folder, frame(spark, [("b", D[7], "b3", 2)]))
    assert as_set(read(spark, folder)) == as_set(
        frame(spark, [("a", D[2], "a2", 1), ("b", D[7], "b3", 2), ("c", D[1], "c2", 3)])
    )


def test_again_changes_nothing(spark, folder):
    source = frame(spark, [("a", D[4], "a2", 10), ("e", D[5], "e1", 11)])
    rows = both_ways(spark, folder, frame(spark, TARGET), source)
    upsert_parquet(spark, folder, source)
    assert as_set(read(spark, folder)) == rows


def test_again_after_an_interrupted_commit_folds_copies(spark, folder):
    """The moved row is in its new partition, the old partition was not replaced yet."""
    upsert_parquet(spark, folder, frame(spark, TARGET))
    source = frame(spark, [("c", D[5], "moved", 1)])
    source.write.mode("append").partitionBy("event_date").parquet(folder)
    upsert_parquet(spark, folder, source)
    assert as_set(read(spark, folder)) == as_set(frame(spark, [*TARGET[:2], *TARGET[3:], ("c", D[5], "moved", 1)]))


def test_hot_partition_is_kept_whole(spark, folder):
    rows = spark.range(9000).select(
        F.concat(F.lit("k"), "id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(D[1])).otherwise(F.date_add(F.lit(D[2]), (F.col("id") % 5).cast("int"))).alias("event_date"),
        F.lit("v").alias("v"),
        F.col("id").cast("int").alias("n"),
    )
    upsert_parquet(spark, folder, rows)
    change = rows.where("n % 10 = 0").withColumn("v", F.lit("w")).withColumn("event_date", F.lit(D[1]))
    upsert_parquet(spark, folder, change)
    out = read(spark, folder)
    assert out.count() == 9000 and out.select("event_id").distinct().count() == 9000
    assert out.where("v = 'w'").count() == 900
    assert out.where(F.col("event_date") == F.lit(D[1])).count() == 3000 + 600


def test_repeated_target_key_is_updated_everywhere_in_the_dataframe_form(spark):
    target = frame(spark, [("a", D[1], str(i), i) for i in range(50)])
    out = upsert(target, frame(spark, [("a", D[2], "new", 0), ("b", D[2], "new", 0)]))
    assert out.where("event_id = 'a' and v = 'new'").count() == 50 and out.count() == 51


def test_plan_has_no_full_outer_join(spark):
    plan = plan_of(upsert(frame(spark, TARGET), frame(spark, TARGET[:1]), check_unique=False))
    assert "FullOuter" not in plan and "LeftOuter" in plan and "LeftAnti" in plan


def test_scratch_tables_are_gone(spark, folder):
    root = storage.scratch_root(spark).removeprefix("file:")
    before = sorted(os.listdir(root)) if os.path.isdir(root) else []
    both_ways(spark, folder, frame(spark, TARGET), frame(spark, TARGET[:1]))
    assert not os.path.isdir(root) or sorted(os.listdir(root)) == before


def test_merge_into_table_needs_a_table_with_row_level_operations(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    spark.sql(f"CREATE TABLE IF NOT EXISTS lake.plain ({SCHEMA}) USING parquet")
    # Names and columns resolve; a plain Parquet table then refuses MERGE.
    with pytest.raises(PySparkException) as error:
        merge_into_table(spark, frame(spark, TARGET), "spark_catalog.lake.plain", newer_than="n")
    assert error.value.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION"
    with pytest.raises(ValueError, match="no such table"):
        merge_into_table(spark, frame(spark, TARGET), "lake.absent")
    with pytest.raises(ValueError, match="merge key"):
        merge_into_table(spark, frame(spark, TARGET).drop("event_id"), "lake.plain")
    with pytest.raises((AnalysisException, PySparkException)):
        merge_into_table(spark, frame(spark, TARGET).withColumn("extra", F.lit(1)), "lake.plain")


def test_key_lookup_filters_before_it_shuffles(spark, folder, monkeypatch):
    """For a target too big for a broadcast: narrow read, bounds pushed down, Bloom filter first."""
    monkeypatch.setattr(module, "KEYS_AT_ONCE", 100)  # more keys than an IN predicate takes
    rows = spark.range(5000).select(
        F.format_string("k%05d", "id").alias("event_id"), F.lit(D[1]).alias("event_date"), F.lit("v").alias("v")
    )
    rows.write.parquet(f"{folder}/t")
    rows.where("substr(event_id, 6) = '7'").write.parquet(f"{folder}/s")
    target, source = spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/s")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = matching_rows(target.select("event_id", "event_date"), source, "event_id")
        plan = plan_of(found)
        assert "might_contain" in plan
        assert "GreaterThanOrEqual(event_id,k00007)" in plan and "v:string" not in plan
        assert found.count() == source.count() == 500
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_lookup_with_null_keys_only(spark, folder):
    upsert_parquet(spark, folder, frame(spark, TARGET))
    upsert_parquet(spark, folder, frame(spark, [(None, D[1], "x", 1)]))
    assert read(spark, folder).count() == len(TARGET) + 1


@pytest.mark.parametrize("at", ["delete_path", "rename_path"])
def test_a_driver_that_dies_in_the_swap_loses_nothing(spark, folder, monkeypatch, at):
    """Between the delete and the rename of a partition, or before it; the next upsert recovers."""
    upsert_parquet(spark, folder, frame(spark, TARGET))
    source = frame(spark, [("a", D[1], "a2", 10), ("d", D[5], "d2", 11)])
    calls = []

    def die(*args):
        if f"/{module.COMMITS}/" in args[1] or "event_date=" in args[1]:
            calls.append(args[1])
            raise RuntimeError("lost")
        return getattr(storage, at)(*args)

    with monkeypatch.context() as patch:
        real = getattr(storage, at)
        patch.setattr(module.storage, at, lambda *args: die(*args) if "event_date=" in args[1] else real(*args))
        with pytest.raises(RuntimeError):
            upsert_parquet(spark, folder, source)
    assert calls
    module.recover(spark, folder)
    expected = [("a", D[1], "a2", 10), *TARGET[1:3], ("d", D[5], "d2", 11), TARGET[4]]
    assert as_set(read(spark, folder)) == as_set(frame(spark, expected))
    upsert_parquet(spark, folder, source)
    assert as_set(read(spark, folder)) == as_set(frame(spark, expected))
    assert storage.child_folders(spark, f"{folder}/{module.COMMITS}") == []


def test_a_commit_without_a_record_is_cleared_away(spark, folder):
    upsert_parquet(spark, folder, frame(spark, TARGET))
    frame(spark, [("x", D[1], "x", 1)]).write.partitionBy("event_date").parquet(f"{folder}/{module.COMMITS}/half")
    module.recover(spark, folder)
    assert as_set(read(spark, folder)) == as_set(frame(spark, TARGET))
    assert storage.child_folders(spark, f"{folder}/{module.COMMITS}") == []


def test_an_increment_of_one_key_touches_one_bucket(spark, folder):
    rows = [(f"k{i}", D[i % 3], f"v{i}", i) for i in range(300)] + [(None, D[1], "null key", 0)]
    upsert_parquet(spark, folder, frame(spark, rows), buckets=8)

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}

    before = files()
    upsert_parquet(spark, folder, frame(spark, [("k4", D[1], "new", 4)]))
    gone, came = before - files(), files() - before
    folders = {os.path.relpath(os.path.dirname(f), folder) for f in gone | came}
    assert len(folders) == 1 and folders.pop().startswith(f"event_date={D[1]}/key_bucket=")
    # A key that moves to another day leaves one bucket and comes to another.
    upsert_parquet(spark, folder, frame(spark, [("k4", D[7], "moved", 4), ("fresh", D[7], "f", 1)]))
    expected = [r for r in rows if r[0] != "k4"] + [("k4", D[7], "moved", 4), ("fresh", D[7], "f", 1)]
    assert as_set(read(spark, folder)) == as_set(frame(spark, expected))


def test_bucket_lookup_reads_the_buckets_of_the_increment(spark, folder, monkeypatch):
    rows = [(f"k{i}", D[i % 3], f"v{i}", i) for i in range(300)]
    upsert_parquet(spark, folder, frame(spark, rows), buckets=8)
    seen = []
    real = module.matching_rows
    monkeypatch.setattr(module, "matching_rows", lambda t, s, k: seen.append(plan_of(t)) or real(t, s, k))
    upsert_parquet(spark, folder, frame(spark, [("k4", D[1], "new", 4)]))
    assert "key_bucket" in seen[0].split("PartitionFilters:")[1].split("]")[0]
