"""Windows over an event stream that lose no row: late ones go to a side output, and the end of a replay closes what is open.

Spark's own windowed aggregate drops rows behind the watermark without a trace and never emits windows that are open when the
input ends. Here every batch splits its rows by the watermark of the batches before it. Rows of closed windows are written
aside, the others are added to partial results per (window, group, actor), which stay in one written table per batch; windows that
the batch's own watermark closes are emitted. The ledger has rows, late rows and the watermark of every batch.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallyforge.streaming import ledger

FACTS = "rows bigint, late bigint, untimed bigint, newest timestamp, watermark timestamp"


@dataclass(frozen=True)
class LateAwareWindows:
    """Tumbling windows of ``width`` seconds below ``root``; a window closes ``delay`` seconds after its end.

    Folders: ``windows`` (window_start, window_end, group, activity_count, avg_value, unique_actors), ``late`` (rows as they came, with
    their window_end), ``state`` and ``ledger``. Rows without a time belong to no window and go to ``late``. Distinct actors are exact;
    rows without an actor count as events only.
    """

    root: str
    width: int = 600
    delay: int = 1800
    time: str = "event_time"
    group: str = "ai_tool_used"
    value: str = "session_duration"
    actor: str = "student_id"

    @property
    def facts(self) -> str:
        return f"{self.root}/ledger"

    def _watermark(self, spark: SparkSession, batch: int) -> dt.datetime | None:
        """The watermark after all batches before this one."""
        rows = ledger.entries(spark, self.facts, FACTS).filter(F.col("batch") < batch)
        return rows.agg(F.max("watermark")).first()[0]

    def _open(self, spark: SparkSession, batch: int) -> DataFrame | None:
        """Partial results that the batch before left open."""
        last = ledger.last_batch(spark, self.facts, FACTS, batch)
        state = None if last is None else ledger.read_batch(spark, f"{self.root}/state", last)
        return None if state is None else state.filter(self._not_closed(self._watermark(spark, batch)))

    @staticmethod
    def _not_closed(watermark: dt.datetime | None) -> F.Column:
        return F.lit(True) if watermark is None else F.col("window_end") > F.lit(watermark)

    def _partial(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_end", self.group, self.actor).agg(
            F.count(F.lit(1)).alias("events"), F.count(self.value).alias("values"), F.sum(F.col(self.value).cast("double")).alias("total")
        )

    def _summary(self, state: DataFrame) -> DataFrame:
        width = F.make_dt_interval(secs=F.lit(self.width))
        summary = state.groupBy("window_end", self.group).agg(
            F.sum("events").alias("activity_count"),
            F.try_divide(F.sum("total"), F.sum("values")).alias("avg_value"),
            F.count(self.actor).alias("unique_actors"),
        )
        return summary.select((F.col("window_end") - width).alias("window_start"), "*")

    def step(self, batch: DataFrame, number: int) -> None:
        """One batch; running it again replaces what it wrote."""
        spark = batch.sparkSession
        before = self._watermark(spark, number)
        timed = batch.withColumn("window_end", F.window(self.time, f"{self.width} seconds").getField("end"))
        rows = self._with_untimed(batch, timed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            on_time = F.coalesce(F.col("window_end").isNotNull() & self._not_closed(before), F.lit(False))
            seen = rows.agg(F.count(F.lit(1)), F.count_if(~on_time), F.count_if(F.col(self.time).isNull()), F.max(self.time)).first()
            newest = None if seen[3] is None else seen[3] - dt.timedelta(seconds=self.delay)
            after = max((w for w in (before, newest) if w is not None), default=None)
            ledger.replace_batch(rows.filter(~on_time), f"{self.root}/late", number)
            state, known = self._partial(rows.filter(on_time)), self._open(spark, number)
            if known is not None:
                state = state.unionByName(known).groupBy("window_end", self.group, self.actor).agg(*[F.sum(c).alias(c) for c in ("events", "values", "total")])
            ledger.replace_batch(state, f"{self.root}/state", number)
            state = ledger.read_batch(spark, f"{self.root}/state", number)
            ledger.replace_batch(self._summary(state.filter(~self._not_closed(after))), f"{self.root}/windows", number)
            facts = {"rows": seen[0], "late": seen[1], "untimed": seen[2], "newest": seen[3], "watermark": after}
            ledger.enter(spark, self.facts, number, facts, FACTS)
        finally:
            rows.unpersist()

    def _with_untimed(self, batch: DataFrame, timed: DataFrame) -> DataFrame:
        """``F.window`` leaves out rows without a time; they are kept, without a window."""
        untimed = batch.filter(F.col(self.time).isNull()).withColumn("window_end", F.lit(None).cast("timestamp"))
        return timed.unionByName(untimed)

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take what has arrived and stop."""
        return stream.writeStream.foreachBatch(self.step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def close(self, spark: SparkSession) -> None:
        """The end of a replay: windows still open are emitted, as batch -1. Nothing may be streamed into this root afterwards."""
        left = self._open(spark, 2**62)
        if left is not None:
            ledger.replace_batch(self._summary(left), f"{self.root}/windows", -1)

    def windows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/windows").drop("batch")

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/late")

    def batches(self, spark: SparkSession) -> DataFrame:
        return ledger.entries(spark, self.facts, FACTS)
