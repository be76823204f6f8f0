"""Landing pages as they come: first-wins and the stop rule, held over micro-batches by keyed state.

Pages (search, page, payload, at) arrive in any number of batches; the pages of a search in their order,
and searches one after the other, as they are read. What is landed then is what one batch run over all pages lands
(``operators.scrape.land``). Two keyed operators follow one another. The first has a state for each search: the keys
that it has seen and how its last page went, so it flags what is new to the search and ends
it. The second has a state for each key: whether a record with it was written. Inside a batch, rows are taken in the order of their
place, so what is first doesn't hang on how a batch is cut or dealt out.

Both forget: a search whose last page, and a key whose first record, is older than ``horizon`` behind the
watermark is dropped from the state by an event-time timer; a record that repeats it later counts as
new, as it does for a run that starts then. State is in RocksDB, not in a worker's memory; a task holds the
pages that a batch has of one search.

A batch that runs again replaces its folder of records.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from .. import fixed
from ..functions.keys import record_key
from ..sources import pages as page_source
from ..sources.fetch import records_in
from ..tables import on_workers

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Forgetful(StatefulProcessor):
    """Drops a key's state once ``horizon`` has gone by after ``since``."""

    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def _forget_after(self, at_ms: int) -> None:
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
        self.handle.registerTimer(at_ms + self.horizon_ms)

    def close(self) -> None:
        pass


class _Searches(_Forgetful):
    """Pages of a search with ``fresh``: for each place of a record whether it is new to the search."""

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "key string", "is boolean")
        self.last = handle.getValueState("last", "stale int, stopped boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stale, stopped = self.last.get() if self.last.exists() else (0, False)
        newest = None
        for row in sorted(rows, key=lambda r: r["page"]):
            newest = row["at"] if newest is None else max(newest, row["at"])
            if stopped:
                continue
            found, own, fresh = records_in(json.loads(row["payload"])), set(), {}
            for place, k in found:
                fresh[place] = k is None or k not in own and not self.seen.containsKey((k,))
                if k is not None and fresh[place]:
                    own.add(k)
                    self.seen.updateValue((k,), (True,))
            stale = 0 if any(fresh.values()) else stale + 1
            stopped = not found or stale == fixed.EMPTY_PAGES_TO_STOP
            yield Row(search=key[0], page=row["page"], payload=row["payload"], at=row["at"], fresh=[fresh.get(i, False) for i in range(max(fresh, default=-1) + 1)])
        self.last.update((stale, stopped))
        self._forget_after(int(newest.timestamp() * 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        self.last.clear()
        return iter(())


class _Keys(_Forgetful):
    """Records of a key with ``written``: whether it is the first of the run."""

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "is boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        there = self.first.exists()
        for row in sorted(rows, key=lambda r: (r["search"], r["page"], r["pos"])):
            yield Row(search=row["search"], page=row["page"], pos=row["pos"], key=row["key"], record=row["record"], is_new=row["is_new"], written=row["is_new"] and (row["key"] is None or not there))
            there = there or row["key"] is not None
            if not self.first.exists():
                self.first.update((True,))
                self._forget_after(int(row["at"].timestamp() * 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.first.clear()
        return iter(())


def land(pages: DataFrame, horizon_ms: int, delay: str = "0 seconds") -> DataFrame:
    """Streaming records (search, page, pos, key, record, is_new, written) of streaming ``pages`` (search, page, payload, at); record is JSON text."""
    on_workers(pages.sparkSession)
    marked = pages.select(F.col("search").cast("int"), F.col("page").cast("bigint"), "payload", "at").withWatermark("at", delay)
    kept = marked.groupBy("search").transformWithState(_Searches(horizon_ms), "search int, page bigint, payload string, at timestamp, fresh array<boolean>", "append", "EventTime", eventTimeColumnName="at")
    found = page_source.records(kept).withColumn("key", record_key(F.col("record")))
    rows = found.select(
        "search", "page", "pos", "key", F.to_json("record").alias("record"), "at", F.coalesce(F.get("fresh", F.col("pos")), F.lit(False)).alias("is_new"),
        # Rows without a key have no state to share: each is a key of its own.
        F.coalesce(F.concat(F.lit("k"), F.col("key")), F.concat_ws(" ", F.lit("place"), "search", "page", "pos")).alias("of"),
    )
    return rows.groupBy("of").transformWithState(_Keys(horizon_ms), "search int, page bigint, pos int, key string, record string, is_new boolean, written boolean", "append", "EventTime")


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, while a query starts; the session's own comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def read_pages(spark: SparkSession, folder: str, files_a_batch: int | None = None) -> DataFrame:
    """Pages from JSON lines of (search, page, payload, at) that land in ``folder``."""
    reader = spark.readStream.schema("search int, page bigint, payload string, at timestamp")
    return (reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader).json(folder)


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, horizon_ms: int = 86_400_000, delay: str = "1 hour", files_a_batch: int | None = None) -> StreamingQuery:
    """Land the pages of ``folder``; each batch's records go to ``out``/epoch=n."""

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    with _rocks(spark):
        landed = land(read_pages(spark, folder, files_a_batch), horizon_ms, delay)
        return landed.writeStream.foreachBatch(put).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
