"""An idle time-out per input of a stream with several watermarks.

The slowest input sets the watermark, so an input that has fallen silent holds all windows open. Here each input is
joined by a stream of beats, rows that carry a time and nothing else. A listener of the query follows how long each
input has been without rows; one that is silent longer than its time-out gets a beat with the greatest event time that
the query has seen, which moves its watermark on until rows come again. An input that is slow, but speaks within its
time-out, holds the watermark as before. Rows of an input that wakes up behind the watermark are late, as always.

Beats are one-row files in a folder that the driver writes and all executors can read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewater.session import new_dir

TIMEOUT = 120.0


class Beats(StreamingQueryListener):
    """Beats for the inputs of one query; ``inputs`` maps a name to the time-out in seconds.

    Make the inputs with ``input``, start the query under ``query_name``, and call ``stop`` when it has ended.
    """

    def __init__(self, spark: SparkSession, query_name: str, clock: Callable[[], float] = time.time):
        self.spark, self.query_name, self.clock = spark, query_name, clock
        self.timeouts: dict[str, float] = {}
        self.folders: dict[str, str] = {}
        self.heard: dict[str, float] = {}
        self.beaten: dict[str, datetime] = {}
        self.latest: datetime | None = None
        spark.streams.addListener(self)

    def input(self, name: str, rows: DataFrame, et: str, delay: str, timeout: float = TIMEOUT) -> DataFrame:
        """``rows`` with the watermark ``delay`` on ``et``, which beats move on when nothing has come for ``timeout`` seconds."""
        folder = new_dir(self.spark, f"beats-{name}")
        self.timeouts[name], self.folders[name], self.heard[name] = timeout, folder, self.clock()
        self._write(folder, None)  # the stream needs a file to begin with
        beats = self.spark.readStream.schema("beat timestamp").option("maxFilesPerTrigger", 1000).parquet(folder)
        beats = beats.where("beat is not null").select(F.col("beat").alias(et), F.lit(name).alias("_beat"))
        marked = rows.withColumn("_beat", F.lit(None).cast("string"))
        both = marked.unionByName(beats, allowMissingColumns=True).withWatermark(et, delay)
        # the condition names the time, so that it stays above the watermark
        return both.where(F.col("_beat").isNull() | F.col(et).isNull()).drop("_beat")

    def _write(self, folder: str, beat: datetime | None) -> None:
        fs, base = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        fs.create_dir(base, recursive=True)
        name = f"{base}/_{uuid.uuid4().hex}"
        pq.write_table(pa.table({"beat": pa.array([beat], pa.timestamp("us", "UTC"))}), name, filesystem=fs)
        fs.move(name, f"{base}/beat-{uuid.uuid4().hex}.parquet")

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.query_name:
            return
        seen = progress.eventTime.get("max") if progress.eventTime else None
        if seen:
            at = datetime.fromisoformat(seen.replace("Z", "+00:00"))
            self.latest = max(at, self.latest) if self.latest else at
        self.note({name: self._rows(progress, name) for name in self.timeouts})

    def _rows(self, progress, name: str) -> int:
        """Rows of an input in a batch: sources stand in the order of the plan, each input before its beats."""
        sources = [s for s in progress.sources]
        at = next((i for i, s in enumerate(sources) if self.folders[name] in s.description), None)
        if at is None:
            return 0
        before = max((i + 1 for i, s in enumerate(sources[:at]) if any(f in s.description for f in self.folders.values())), default=0)
        return sum(s.numInputRows for s in sources[before:at])

    def note(self, counts: dict[str, int]) -> None:
        """What each input has brought; the silent ones get a beat."""
        now = self.clock()
        for name, count in counts.items():
            if count:
                self.heard[name] = now
            elif self.latest is not None and now - self.heard[name] >= self.timeouts[name] and self.beaten.get(name) != self.latest:
                self._write(self.folders[name], self.latest)
                self.beaten[name] = self.latest  # the next beat waits for a greater time

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def stop(self) -> None:
        self.spark.streams.removeListener(self)
