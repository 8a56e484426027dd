"""Vehicle operators over streams: the batch operator, over carried and new records.

What an operator needs of the past is small: the last 99 records of each vehicle for the count
window, the last one for pairs. They lie in a carry table. A micro-batch puts the carried records
before the new ones, runs the operator of the batch library over both and reports on the new
ones only, so stream and batch share every line, a busy vehicle is cut into days and blocks as
in batch, and no Python runs per vehicle or record.

Late records are put right by a reorder buffer. With ``delay`` seconds, records wait in a pending
table until the newest event time read is that far ahead of them, and are released in order of
time; ``flush`` releases what is left. What arrives after its place was passed goes to the
table ``late``, whole, and is counted in ``done``. A record whose time cannot be read takes the
newest time read before it and is never late.

All tables of a micro-batch lie under its number and follow from those of the one before:
running a batch again writes the same files again. Tables older than the last batch are
removed. Files under the folder: ``out``, ``late``, ``state``, each ``batch=<number>``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltfleet.operators import realtime
from voltfleet.operators.ordering import in_time, sort_keys, with_day, with_sort_keys
from voltfleet.schema import with_date
from voltfleet.settings import DEFAULTS, Settings
from voltfleet.sources.workspace import children, remove

#: Flush is a batch of its own, behind all numbered ones.
LAST_BATCH = 2**40
_ORDER = ("place", "day", "date")


@dataclass
class Carried:
    """A batch operator of (rows, fresh) to run over a stream, and how far back it looks."""

    folder: str
    operator: Callable[[DataFrame, str], DataFrame]
    reach: int
    delay: int = 0
    #: Where results go besides the table ``out``: a function of (rows, batch number).
    emit: Callable[[DataFrame, int], None] | None = None

    def _state(self, batch_id: int, table: str) -> str:
        return f"{self.folder}/state/batch={batch_id}/{table}"

    def _before(self, spark: SparkSession, batch_id: int) -> int | None:
        """Number of the last batch that was finished before this one."""
        names = children(spark, f"{self.folder}/state")
        known = [int(n.split("=")[1]) for n in names if n.startswith("batch=")]
        known = [k for k in known if k < batch_id and "_SUCCESS" in children(spark, self._state(k, "done"))]
        return max(known, default=None)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._run(batch, batch_id, release_all=False)

    def flush(self, spark: SparkSession) -> None:
        """Release all records that still wait; the stream must have ended."""
        before = self._before(spark, LAST_BATCH)
        if before is not None:
            waiting = spark.read.parquet(self._state(before, "pending"))
            self._run(waiting.drop(*_ORDER).limit(0), LAST_BATCH, release_all=True)

    def _run(self, batch: DataFrame, batch_id: int, release_all: bool) -> None:
        spark, before = batch.sparkSession, self._before(batch.sparkSession, batch_id)
        # A micro-batch has a session of its own, without the re-planning its joins gain from.
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        arrived = self._arrived(batch, batch_id)
        carry, waiting, newest_time = arrived.limit(0), arrived.limit(0), None
        if before is not None:
            carry = spark.read.parquet(self._state(before, "carry"))
            waiting = spark.read.parquet(self._state(before, "pending"))
            newest_time = spark.read.parquet(self._state(before, "done")).first()["newest_time"]
        passed = carry.groupBy("vehicle_id").agg(F.max("place").alias("_passed"))
        arrived = arrived.join(passed, "vehicle_id", "left")
        # An unread time stands behind all that was released, and behind what it came with.
        place = F.coalesce("timestamp", F.greatest("place", "_passed"))
        arrived = with_day(arrived.withColumn("place", place)).drop("_passed")
        times = [newest_time, arrived.agg(F.max("timestamp")).first()[0]]
        newest_time = max((t for t in times if t is not None), default=None)
        both = waiting.unionByName(arrived)
        if release_all or newest_time is None:
            ready, pending = both, both.limit(0)
        else:
            horizon = F.lit(str(newest_time)).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(float(self.delay)))
            is_ready = F.coalesce(F.col("place") <= horizon, F.lit(True))
            ready, pending = both.filter(is_ready), both.filter(~is_ready)
        ready = ready.join(passed, "vehicle_id", "left")
        is_late = F.coalesce(F.col("place") < F.col("_passed"), F.lit(False))
        late = ready.filter(is_late).drop("_passed")
        in_order = ready.filter(~is_late).drop("_passed")
        rows = carry.withColumn("fresh", F.lit(False)).unionByName(in_order.withColumn("fresh", F.lit(True)))
        self._write(pending, self._state(batch_id, "pending"))
        self._write(late.drop("place", "day"), f"{self.folder}/late/batch={batch_id}")
        self._write(self._kept(rows), self._state(batch_id, "carry"))
        result = self.operator(rows, "fresh")
        out = f"{self.folder}/out/batch={batch_id}"
        self._write(result, out)
        if self.emit is not None:
            self.emit(spark.read.schema(result.schema).parquet(out), batch_id)
        self._finish(spark, batch_id, before, newest_time)

    def _write(self, df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").parquet(path)

    def _arrived(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch as a table: wall-clock times, a ``seq`` of arrival where there is none, places."""
        row = F.monotonically_increasing_id()
        # Batch, task and row, so that later arrivals have larger numbers.
        number = F.lit(batch_id % 2**22) * F.lit(2**40) + F.shiftright(row, 33) * F.lit(2**28) + row.bitwiseAND(2**33 - 1)
        known = batch.filter("vehicle_id IS NOT NULL").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
        own = F.col("seq") if "seq" in batch.columns else F.lit(None).cast("bigint")
        path = self._state(batch_id, "arrived")
        self._write(with_date(known.withColumn("seq", F.coalesce(own, number))), path)
        arrived = in_time(batch.sparkSession.read.parquet(path))
        return arrived if "place" in arrived.columns else with_day(arrived.withColumn("place", F.col("timestamp")))

    def _kept(self, rows: DataFrame) -> DataFrame:
        """The last ``reach`` records of each vehicle, cut on the map side already."""
        sorted_ = with_sort_keys(rows)
        newest = Window.partitionBy("vehicle_id").orderBy(*[F.desc(c) for c in sort_keys(sorted_)])
        ranked = sorted_.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= self.reach)
        return ranked.drop("_rank", "unread", "fresh")

    def _finish(self, spark: SparkSession, batch_id: int, before: int | None, newest_time) -> None:
        """Mark the batch as done, with its counts, and remove what no run can need again."""
        count = lambda path: spark.read.parquet(path).count()
        done = spark.createDataFrame(
            [(newest_time, count(f"{self.folder}/late/batch={batch_id}"), count(self._state(batch_id, "pending")))],
            "newest_time timestamp_ntz, late_records long, pending_records long",
        )
        self._write(done, self._state(batch_id, "done"))
        for name in children(spark, f"{self.folder}/state"):
            if before is not None and int(name.split("=")[1]) < before:
                remove(spark, f"{self.folder}/state/{name}")

    def results(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/out").drop("batch")

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/late").drop("batch")


def window_metrics(folder: str, cfg: Settings = DEFAULTS, delay: int = 0, emit=None) -> Carried:
    """Per record, from each vehicle's second one on: metrics of its last 100 records."""
    operator = lambda rows, fresh: realtime.window_metrics(rows, cfg, fresh=fresh)
    return Carried(folder, operator, cfg.window_records - 1, delay, emit)


def pairwise_metrics(folder: str, cfg: Settings = DEFAULTS, delay: int = 0, emit=None) -> Carried:
    """Per record: power, and rates against the vehicle's previous record."""
    operator = lambda rows, fresh: realtime.pairwise_metrics(rows, cfg, fresh=fresh)
    return Carried(folder, operator, 1, delay, emit)
