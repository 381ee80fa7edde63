"""Stored tables: layout, inserts that can be repeated, replacing aggregates."""

from __future__ import annotations

import datetime
import re

import pytest
from conftest import T0, by_id
from pyspark.sql import functions as F

from clickloom.operators import chain, constraints
from clickloom.operators.dedupe import first_per_key
from clickloom.schemas import METRICS_COLUMNS, PER_MINUTE, STORED_COLUMNS
from clickloom.operators import windows
from clickloom.plans import reports
from clickloom.sinks.tables import DEAD_LETTERS, EVENTS, KEY_INDEX, METRICS, Tables
from clickloom.operators.dead_letters import envelope


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "store"))


def stored(df):
    return chain.process(df).withColumnRenamed("timestamp", "event_timestamp_ms")


def test_empty_tables(tables):
    assert tables.events().count() == 0 and tables.metrics().count() == 0 and tables.dead_letters().count() == 0


@pytest.mark.parametrize("small", [False, True])
def test_insert_skips_stored_and_repeated_ids(spark, tmp_path, make, small):
    tables = Tables(spark, str(tmp_path))
    tables.insert(stored(make({"event_id": "a"}, {"event_id": "b", "timestamp": T0 + 86_400_000})), EVENTS)
    batch = stored(make({"event_id": "b", "timestamp": T0 + 86_400_000, "quantity": 9}, {"event_id": "c", "quantity": 3},
                        {"event_id": "c", "quantity": 4}))
    tables.insert(batch, EVENTS, small=small)
    tables.insert(batch, EVENTS, small=small)
    assert by_id(tables.events(), "quantity") == {"a": 1, "b": 1, "c": 3}
    assert tables.events().count() == 3
    days = {r.event_date for r in tables.events().select("event_date").collect()}
    assert days == {datetime.date(2024, 5, 24), datetime.date(2024, 5, 25)}


def test_an_id_is_unique_whatever_its_day(make, tables):
    tables.insert(stored(make({"event_id": "a"})), EVENTS)
    tables.insert(stored(make({"event_id": "a", "timestamp": T0 + 5 * 86_400_000})), EVENTS)
    assert tables.events().count() == 1


def test_a_small_batch_reads_ids_of_its_buckets_without_a_shuffle_of_the_table(make, tables):
    tables.append(stored(make(*[{"event_id": f"s{i}"} for i in range(200)])), EVENTS)
    batch = stored(make({"event_id": "s1"}, {"event_id": "n"})).persist()
    new = tables.new_rows(batch, EVENTS, small=True)
    plan = new._jdf.queryExecution().toString()
    scan = re.search(r"FileScan parquet.*?PartitionFilters: \[(.*?)\].*?ReadSchema: struct<(.*?)>", plan[plan.index("Physical Plan"):])
    assert "id_bucket" in scan.group(1) and scan.group(2) == "event_id:string"
    assert [r.event_id for r in new.collect()] == ["n"]
    batch.unpersist()


def test_a_small_batch_of_new_ids_reads_no_stored_ids(make, tables):
    tables.append(stored(make(*[{"event_id": f"s{i}"} for i in range(200)])), EVENTS)
    batch = stored(make(*[{"event_id": f"n{i}"} for i in range(50)])).persist()
    new = tables.new_rows(batch, EVENTS, small=True)
    assert EVENTS not in new._jdf.queryExecution().toString() and new.count() == 50
    batch.unpersist()


def test_ids_are_looked_up_in_the_dates_that_may_hold_them(make, tables):
    tables.append(stored(make(*[{"event_id": f"s{i}", "timestamp": T0 + i % 5 * 86_400_000} for i in range(200)])), EVENTS)
    batch = stored(make({"event_id": "s1"}, {"event_id": "n"})).persist()
    new = tables.new_rows(batch, EVENTS, small=True)
    plan = new._jdf.queryExecution().toString()
    assert "2024-05-25" in plan and "2024-05-24" not in plan and "2024-05-26" not in plan
    assert [r.event_id for r in new.collect()] == ["n"]
    batch.unpersist()


@pytest.mark.parametrize("small", [False, True])
def test_hashes_without_a_stored_id_change_nothing(spark, make, tables, small):
    tables.append(stored(make({"event_id": "a"})), EVENTS)
    # As after a write that broke off, or as if another id had the same hash.
    lost = stored(make({"event_id": "b"}, {"event_id": "c", "timestamp": T0 + 86_400_000}))
    tables._index(tables._laid_out(lost, EVENTS), small)
    tables.insert(lost, EVENTS, small=small)
    tables.insert(lost, EVENTS, small=small)
    assert sorted(r.event_id for r in tables.events().collect()) == ["a", "b", "c"]


def test_an_index_that_is_absent_or_unfinished_is_built_from_the_stored_ids(spark, make, tables, tmp_path):
    tables.append(stored(make({"event_id": "a"}, {"event_id": "b"})), EVENTS)
    other = Tables(spark, str(tmp_path / "moved"))
    # A table that was written without an index, and an index whose building broke off.
    tables.events().write.partitionBy("event_date", "id_bucket").parquet(other.path(EVENTS))
    tables._keys().limit(1).write.partitionBy("id_bucket").parquet(f"{other.path(KEY_INDEX)}/keys")
    other.insert(stored(make({"event_id": "a"}, {"event_id": "b"}, {"event_id": "c"})), EVENTS)
    assert sorted(r.event_id for r in other.events().collect()) == ["a", "b", "c"]
    assert other._keys().count() == 3


def test_dead_letters_without_a_position_are_all_kept(spark, make, tables):
    rejected = envelope(chain.rejected(chain.checked(make(*[{"timestamp": 0}] * 5, {"timestamp": -1}))))
    unplaced = rejected.withColumn("source_offset", F.lit(None).cast("long"))
    tables.insert(unplaced, DEAD_LETTERS)
    tables.insert(rejected.unionByName(unplaced), DEAD_LETTERS, small=True)
    assert tables.dead_letters().where("source_offset IS NULL").count() == 12
    assert tables.dead_letters().count() == 12 + rejected.select("source_partition", "source_offset").distinct().count()


def test_dead_letters_are_stored_once(make, tables):
    rejected = envelope(chain.rejected(chain.checked(make({"timestamp": 0}, {"timestamp": -1}))))
    tables.insert(rejected, DEAD_LETTERS)
    tables.insert(rejected, DEAD_LETTERS)
    assert sorted(r.error_reason for r in tables.dead_letters().collect()) == ["Invalid timestamp: -1", "Invalid timestamp: 0"]


def test_metrics_insert_and_replace(make, tables):
    def table(*rows):
        return windows.tumbling(chain.process(make(*rows)), 60, PER_MINUTE)

    first = table({"timestamp": T0}, {"timestamp": T0 + 60_000}, {"timestamp": T0 + 86_400_000})
    tables.insert(first, METRICS)
    tables.insert(first, METRICS)
    assert tables.metrics().count() == 3
    again = table({"timestamp": T0}, {"timestamp": T0 + 1}, {"timestamp": T0 + 600_000})
    tables.upsert_metrics(again)
    tables.upsert_metrics(again)
    found = tables.metrics().orderBy("window_start").collect()
    assert [r.event_count for r in found] == [2, 1, 1, 1]
    assert set(METRICS_COLUMNS) < set(tables.metrics().columns)


def once_per_row(spark, df):
    """The rows, and how often they have been worked out."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_a_large_insert_works_its_rows_out_once(spark, make, tables):
    rows, seen = once_per_row(spark, stored(make(*[{"event_id": f"e{i}"} for i in range(40)])))
    tables.insert(rows, EVENTS)
    assert tables.events().count() == 40 and seen.value == 40


def test_replaced_aggregates_are_worked_out_once(spark, make, tables):
    found = windows.tumbling(chain.process(make({"timestamp": T0}, {"timestamp": T0 + 86_400_000})), 60, PER_MINUTE)
    tables.insert(found, METRICS)
    rows, seen = once_per_row(spark, found)
    stale, looked = once_per_row(spark, found.limit(1))
    tables.upsert_metrics(rows, stale)
    assert tables.metrics().count() == 2 and (seen.value, looked.value) == (2, 1)


def test_upsert_into_nothing(make, tables):
    tables.upsert_metrics(windows.tumbling(chain.process(make({})), 60, PER_MINUTE))
    assert tables.metrics().count() == 1


def test_first_per_key_of_many_copies(make):
    rows = make(*[{"event_id": "copy", "quantity": 1 + i} for i in range(300)], {"event_id": "other"}, partitions=6)
    found = by_id(first_per_key(rows, ["event_id"], ["source_offset"]), "quantity")
    assert found == {"copy": 1, "other": 1}


def test_constraints(make):
    rows = chain.to_stored(chain.process(make({"event_id": "a"}, {"event_id": "a"}, {"event_id": "b"})))
    report = {(r.check_name, r.column_name): r.violations
              for r in constraints.constraint_report(rows, "clickstream_events").collect()}
    assert report[("unique", "event_id")] == 1 and report[("not_null", "user_id")] == 0
    assert rows.columns == STORED_COLUMNS


def test_recent_reports_read_recent_days_only(make, tables):
    tables.append(stored(make({"event_id": "a"}, {"event_id": "b", "timestamp": T0 + 3 * 86_400_000})), EVENTS)
    report = reports.events_over_time(tables.events(), T0 + 3 * 86_400_000 + 1)
    assert [r.event_count for r in report.collect()] == [1]
    plan = report._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan.split("PartitionFilters:")[1][:120]
    assert "GreaterThan(event_timestamp_ms," in plan
    # Only three columns are read.
    assert "ReadSchema: struct<event_timestamp_ms:bigint,user_id:string>" in plan
