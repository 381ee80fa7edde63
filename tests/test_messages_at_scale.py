"""Message files of queries: their tasks follow the rows, not the row groups of the log."""

from __future__ import annotations

import datetime

from clickloom.catalog import queries
from clickloom.sources import activity_log


def test_messages_are_spread_over_files_that_follow_the_rows(spark, tmp_path, monkeypatch):
    rows = [(i, datetime.datetime(2024, 1, 1, 0, 0, i % 60), i % 9, "view", 1.5, '{"k": 3}') for i in range(400)]
    log = spark.createDataFrame(rows, activity_log.LOG_SCHEMA)
    log.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries, "MESSAGES_PER_FILE", 20)
    files = queries.message_files(spark, str(tmp_path), str(tmp_path / "m"), 4)
    found = spark.read.parquet(str(tmp_path / "m"))
    assert files == 2 + 399 // 4 // 20 and len(found.inputFiles()) == 4 * files
    want = activity_log.to_messages(log)
    assert found.count() == 400 and found.exceptAll(want.select(found.columns)).count() == 0


def test_no_file_holds_more_than_a_task_reads_in_seconds():
    # 36 million messages in eight parts: more files a part than a cluster of 12 cores has tasks.
    assert queries.message_file_count(36_000_000 - 1, 8) > 48
