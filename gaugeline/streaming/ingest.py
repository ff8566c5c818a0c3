"""Messages -> three zones, as Structured Streaming queries or one batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugeline.functions.rules import RuleSet
from gaugeline.operators.decode import curated_readings, near_arrival, readings_of, rejected
from gaugeline.operators.envelope import raw_envelope
from gaugeline.operators.windows import WATERMARK, WINDOW, window_averages, without_repeats
from gaugeline.schemas import CURATED_ZONE
from gaugeline.sinks.zones import (
    write_consumption,
    write_curated,
    write_offsets,
    write_raw,
    write_rejected,
)
from gaugeline.sources.lake import read_zone

WINDOW_FUTURE_LIMIT = "1 day"

BatchSink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class IngestJob:
    """Where a job reads its rules, writes its zones and keeps its progress.

    ``checkpoints`` and ``lake`` must be folders that all executors share.
    ``trigger_interval`` None drains what is available and stops. ``label`` goes
    before the query names, so that several jobs can share a session.
    ``plain_layout`` continues a lake without write directories, where a batch
    repeated after a crash is stored twice.

    ``max_future_skew`` refuses readings dated that much after their arrival. Without
    it they are curated, but those beyond ``window_future_limit`` still don't reach
    the windows, where one of them would make every later row late.
    ``windows_without_repeats`` counts a message that is read again within the watermark
    once in its window, at the price of a second state.
    """

    lake: str
    checkpoints: str
    rules: RuleSet = RuleSet()
    window: str = WINDOW
    watermark: str = WATERMARK
    max_future_skew: str | None = None
    window_future_limit: str = WINDOW_FUTURE_LIMIT
    trigger_interval: str | None = "10 seconds"
    label: str = ""
    plain_layout: bool = False
    windows_without_repeats: bool = False

    def start(self, messages: DataFrame, *, shared_batches: bool = False) -> list[StreamingQuery]:
        """Start the writers of all zones.

        By default each zone is a query with progress of its own, and a failure
        of one leaves the others running. ``shared_batches`` writes raw, curated
        and rejected from one query that reads the source once for all.
        """
        raw = raw_envelope(messages)
        if shared_batches:
            stateless = [self._start(raw, "append", "raw-and-curated-zone-writer", self._both)]
        else:
            stateless = [
                self._start(raw, "append", "raw-zone-writer", self._raw),
                self._start(self._curated(raw), "append", "curated-zone-writer", self._curate),
                self._start(self._rejected(raw), "append", "rejected-zone-writer", self._reject),
            ]
        return [*stateless, self.start_windows(messages)]

    def start_windows(self, messages: DataFrame, *, output_mode: str = "update") -> StreamingQuery:
        """Start the writer of window averages.

        ``update`` emits a window each time rows are added to it; ``append``
        emits it once, after the watermark has passed its end.
        """
        readings = readings_of(
            raw_envelope(messages), self.rules, max_future_skew=self.max_future_skew
        )
        if self.windows_without_repeats:
            # Far-future rows must not reach this watermark either.
            regular = near_arrival(readings, self.window_future_limit)
            once = without_repeats(regular, watermark=self.watermark)
            averages = window_averages(once, window=self.window, watermark=None)
        else:
            averages = self._averages(readings)
        return self._start(averages, output_mode, "consumption-zone-writer", self._consume)

    def run_batch(
        self, messages: DataFrame, *, write_id: str, ingestion_time: Column | None = None
    ) -> None:
        """The same zones from a bounded set of messages, such as a backfill.

        The windows are made from the curated files just written, so the messages
        are decoded once for both. Running again with the same ``write_id`` replaces
        the first result, also where it held other rows or another ingestion time.
        """
        raw = raw_envelope(messages, ingestion_time=ingestion_time)
        this = {"write_id": write_id, "rerun": True}
        write_raw(raw, self.lake, hours=ingestion_time is not None, **this)
        write_offsets(raw, self.lake, **this)
        write_curated(self._curated(raw), self.lake, **this)
        write_rejected(self._rejected(raw), self.lake, **this)
        written = read_zone(messages.sparkSession, self.lake, CURATED_ZONE, write_id=write_id)
        write_consumption(self._averages(written), self.lake, batch_id=0, **this)

    def _averages(self, readings: DataFrame) -> DataFrame:
        regular = near_arrival(readings, self.window_future_limit)
        return window_averages(regular, window=self.window, watermark=self.watermark)

    def _rejected(self, raw: DataFrame) -> DataFrame:
        return rejected(raw, self.rules, max_future_skew=self.max_future_skew)

    def _curated(self, raw: DataFrame) -> DataFrame:
        return curated_readings(raw, self.rules, max_future_skew=self.max_future_skew)

    def _start(
        self, rows: DataFrame, output_mode: str, name: str, sink: BatchSink
    ) -> StreamingQuery:
        writer = (
            rows.writeStream.foreachBatch(sink)
            .queryName(f"{self.label}{name}")
            .outputMode(output_mode)
            .option("checkpointLocation", f"{self.checkpoints.rstrip('/')}/{name}")
        )
        if self.trigger_interval is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=self.trigger_interval).start()

    def _write_id(self, batch: DataFrame, batch_id: int) -> str | None:
        return None if self.plain_layout else write_id_of(batch, batch_id)

    # A stateless batch can be looked at twice: finding one row costs little, and
    # keeping the whole batch would cost more than reading it again.

    def _raw(self, batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_id = self._write_id(batch, batch_id)
            write_raw(batch, self.lake, write_id=write_id)
            write_offsets(batch, self.lake, write_id=write_id)

    def _curate(self, batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_curated(batch, self.lake, write_id=self._write_id(batch, batch_id))

    def _reject(self, batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_rejected(batch, self.lake, write_id=self._write_id(batch, batch_id))

    # A batch used for two writes, or one that carries window state, is evaluated
    # once: a second run of a stateful plan would update its state twice.

    def _both(self, batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if not kept.isEmpty():
                write_id = self._write_id(batch, batch_id)
                write_raw(kept, self.lake, write_id=write_id)
                write_offsets(kept, self.lake, write_id=write_id)
                write_curated(self._curated(kept), self.lake, write_id=write_id)
                write_rejected(self._rejected(kept), self.lake, write_id=write_id)
        finally:
            kept.unpersist()

    def _consume(self, batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if not kept.isEmpty():
                write_consumption(
                    kept, self.lake, write_id=self._write_id(batch, batch_id), batch_id=batch_id
                )
        finally:
            kept.unpersist()


def write_id_of(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch, the same when it is repeated after a crash.

    The query id lives in the checkpoint: a restart keeps it, and a stream that
    starts over from a new checkpoint can never replace files of the old one.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def drain(queries: Sequence[StreamingQuery]) -> None:
    """Wait until every query has finished, then report all that failed."""
    failures = []
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as failure:
            failures.append(failure)
    if failures:
        raise ExceptionGroup("streaming queries failed", failures)


def supervise(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Run until any query ends or fails, then stop the others."""
    try:
        while all(query.isActive for query in queries):
            spark.streams.resetTerminated()
            spark.streams.awaitAnyTermination(timeout=10)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    drain(queries)
