"""Windows that are seen while they are open: a stream in update mode, its rows replacing what it wrote of them before.

Closed windows (see state.py) hold exact users and come once. Here each window is one row of state with measures and sketches of a fixed size, and every
micro-batch hands on the windows it has changed, late ones included as long as they may be corrected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.config import Settings
from clickloom.functions import clock
from clickloom.functions.measures import ADDITIVE, event_measures
from clickloom.session import shared_dir
from clickloom.sinks.sketches import SCHEMA, read_windows, replace_windows, sketched
from clickloom.streaming.jobs import start
from clickloom.streaming.state import with_event_time

LIVE_SCHEMA = SCHEMA.replace("event_count long, mark long", ", ".join(f"{name} long" for name in ADDITIVE))


def growing_windows(events: DataFrame, seconds: int, correct_seconds: int) -> DataFrame:
    """One row per tumbling window of processed rows, measures and sketches. A window stays in the state, and can change, until
    `correct_seconds` after its end."""
    window = F.window("event_time", f"{seconds} seconds").alias("window")
    found = with_event_time(events, correct_seconds).groupBy(window).agg(*event_measures(), *sketched())
    start_ms = F.unix_millis("window.start")
    return found.withColumns({"window_start": start_ms, "window_date": clock.utc_date(start_ms)}).drop("window")


class LiveWindows:
    """The newest state of windows, partitioned by day. A row takes the place of the stored one that starts with it, so a
    micro-batch that runs again changes nothing. One window length and one writer per path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        return read_windows(self.spark, self.path, LIVE_SCHEMA)

    def upsert(self, rows: DataFrame) -> None:
        """Rows of `growing_windows`, a persisted micro-batch."""
        shared_dir(self.spark)
        dates = [r[0] for r in rows.select("window_date").distinct().collect()]  # one per day
        if dates:
            replace_windows(self.read(), rows, dates, self.path)


def update_windows(
    good: DataFrame, seconds: int, live: LiveWindows, checkpoint: str, settings: Settings, once: bool = False,
    correct_seconds: int | None = None,
) -> StreamingQuery:
    """Keep `live` up to date with processed rows; late ones count until `correct_seconds` after the end of their window, the lateness
    of the settings unless given."""
    found = growing_windows(good, seconds, settings.lateness_seconds if correct_seconds is None else correct_seconds)
    return start(found, f"live_{seconds}", live.upsert, checkpoint, settings, once, "update")
