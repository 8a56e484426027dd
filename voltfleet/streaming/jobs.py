"""Running streams: message in, metrics, message out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltfleet.settings import DEFAULTS, Settings
from voltfleet.sources.messages import decode, encode, read_topic, send_batch
from voltfleet.sources.workspace import remove
from voltfleet.streaming.carried import Carried, window_metrics


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, append it to a Parquet folder and stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """As above for results that change: each micro-batch writes its own folder.

    A batch that is run again after a failure replaces its folder. ``latest_updates``
    reads the result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_updates(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """Of each key the row of the last batch that wrote it."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in (*key, "batch")]
    newest = f"max_by(struct({', '.join(columns)}), batch) AS newest"
    return rows.groupBy(*key).agg(F.expr(newest)).select(*key, "newest.*")


def run_carried(stream: DataFrame, job: Carried, checkpoint: str) -> None:
    """Process what is there with a vehicle operator and stop; the next run goes on from its tables."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(job)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_letters(lines: DataFrame, path: str, checkpoint: str) -> None:
    """Split messages into records and dead letters, two tables of one micro-batch, and stop.

    Both tables of a batch lie under its number, so a batch that is run again replaces them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        whole = f"{path}/lines/batch={batch_id}"
        batch.write.mode("overwrite").parquet(whole)
        parsed = decode(batch.sparkSession.read.parquet(whole), keep_malformed=True)
        good = "malformed IS NULL AND vehicle_id IS NOT NULL"
        parsed.filter(good).drop("malformed", "line").write.mode("overwrite").parquet(f"{path}/records/batch={batch_id}")
        dead = parsed.filter(f"NOT ({good})").select("line", "malformed")
        dead.write.mode("overwrite").parquet(f"{path}/dead/batch={batch_id}")
        remove(batch.sparkSession, whole)

    query = (
        lines.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def start_realtime(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    fmt: str = "kafka",
    cfg: Settings = DEFAULTS,
    per_trigger: int | None = None,
    available_now: bool = False,
    delay: int = 0,
    **options: str,
):
    """Telemetry topic in, window metrics topic out; returns the running query.

    ``available_now`` takes what is there and stops, in place of a running time. ``delay``:
    how many seconds records wait for late ones. The operator's tables lie beside the checkpoint.
    A folder as a sink gets one subfolder a micro-batch, which a second run of it replaces.
    """

    def emit(rows: DataFrame, batch_id: int) -> None:
        if fmt == "kafka":
            send_batch(rows, sink, fmt, **options)
        else:
            encode(rows).select("value").write.mode("overwrite").format(fmt).save(f"{sink}/batch={batch_id}")

    messages = read_topic(spark, source, fmt, cfg, per_trigger, **options)
    job = window_metrics(f"{checkpoint}/tables", cfg, delay, emit)
    writer = (
        decode(messages, kind="timestamp_ntz")
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(job)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{cfg.checkpoint_seconds} seconds").start()
