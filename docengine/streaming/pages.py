"""Pages that are complete (an extension): crops arrive one by one, late, or twice; a page is told once it is quiet.

Keyed state holds a page's crops by name.  A crop that comes again unchanged is no news.  New or
changed ones move the page's event-time timer to their time plus ``quiet``; when the watermark
passes it, the page is told with its crops, and again (``version`` counts up) if others come later.
State and timers live in the checkpoint, so a restart neither repeats nor forgets a page.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docengine.sources import files

PAGE = ["file", "page"]
COMPLETE = "file string, page string, version int, images string, last timestamp"
"""``images`` are the names, sorted, a line each."""
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Quiet(StatefulProcessor):
    """The state of one page."""

    def __init__(self, quiet_ms: int) -> None:
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.images = handle.getMapState("images", "image string", "fingerprint string")
        self.page = handle.getValueState("page", "due long, last long, version int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        news = 0
        for frame in rows:
            for image, length, changed, at in zip(frame["image"], frame["length"], frame["changed"], frame["at"], strict=True):
                ms, own = int(at.timestamp() * 1000), f"{length}:{changed.isoformat()}"
                if self.images.containsKey((image,)) and self.images.getValue((image,))[0] == own:
                    continue
                self.images.updateValue((image,), (own,))
                news = max(news, ms)
        if news:
            due, last, version = self.page.get() if self.page.exists() else (0, 0, 0)
            if due:
                self.handle.deleteTimer(due)
            # A page that has been told, or whose crops come late, waits for the watermark to move on.
            due = max(due, news + self.quiet_ms, timerValues.getCurrentWatermarkInMs() + 1)
            self.handle.registerTimer(due)
            self.page.update((due, max(last, news), version))
        return iter(())  # pages are told by their timers

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, last, version = self.page.get()
        self.page.update((0, last, version + 1))
        names = sorted(k[0] for k in self.images.keys())
        yield pd.DataFrame({"file": [key[0]], "page": [key[1]], "version": [version + 1], "images": ["\n".join(names)], "last": [pd.Timestamp(last, unit="ms")]})


def arrivals(spark: SparkSession, folder: str, per_trigger: int = 1000) -> DataFrame:
    """Names of crops as they arrive below a folder (file, page, image, length, changed, at); no file is opened.

    ``at`` is the time of arrival, not the file's own, so that an old file that comes late is no late event.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    rows = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(folder).drop("content")
    crops = files.crop_images(files.parts(rows, folder)).where("kind = 'crops' and page is not null")
    return crops.select(*PAGE, F.col("name").alias("image"), "length", F.col("modificationTime").alias("changed"), F.current_timestamp().alias("at"))


def complete(crops: DataFrame, quiet_seconds: int, delay: str = "10 seconds") -> DataFrame:
    """Pages of a stream (file, page, image, length, changed, at) that have been quiet for ``quiet_seconds`` of event time.

    ``delay`` is how far behind the latest crop others may be; Spark drops what is later still.
    """
    crops.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    watched = crops.withWatermark("at", delay)
    return watched.groupBy(*PAGE).transformWithStateInPandas(Quiet(quiet_seconds * 1000), COMPLETE, "Append", "EventTime")
