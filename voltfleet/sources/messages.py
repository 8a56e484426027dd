"""Records as JSON messages, and topics as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltfleet.schema import RAW_SCHEMA_WITH_SEQ
from voltfleet.settings import DEFAULTS, Settings


def encode(df: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Rows as messages: ``key`` and the whole row as JSON in ``value``."""
    # As text, a stamp has a fraction only where it needs one.
    times = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    fields = [F.col(c).cast("string").alias(c) if c in times else F.col(f"`{c}`") for c in df.columns]
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def text_times(schema: T.StructType) -> T.StructType:
    """The schema of rows as messages: times are text there."""
    kinds = (T.TimestampType, T.TimestampNTZType)
    text = lambda f: T.StructField(f.name, T.StringType()) if isinstance(f.dataType, kinds) else f
    return T.StructType([text(f) for f in schema.fields])


def envelope(messages: DataFrame, topic: str, sent_at_ms: int) -> DataFrame:
    """The message with its topic and send time, as a queue stores it."""
    return messages.select(
        F.lit(topic).alias("topic"),
        "key",
        "value",
        F.lit(sent_at_ms).cast("bigint").alias("timestamp"),
    )


def decode(
    messages: DataFrame,
    schema: T.StructType = RAW_SCHEMA_WITH_SEQ,
    keep_malformed: bool = False,
    time: str = "timestamp",
    kind: str = "timestamp",
) -> DataFrame:
    """Messages back to rows; their ``time`` becomes a TIMESTAMP for watermarks, or of another ``kind``.

    Messages may lack fields of the schema, such as ``seq``, which are null then. What is no
    valid record is dropped, or kept as it came in ``line`` with the reason's text in ``malformed``.
    """
    fields = T.StructType([*schema.fields, T.StructField("malformed", T.StringType())])
    parsed = F.from_json(
        F.col("value").cast("string"), fields, {"columnNameOfCorruptRecord": "malformed"}
    )
    line = F.col("value").cast("string").alias("line")
    rows = messages.select(parsed.alias("r"), line).select("r.*", "line")
    rows = rows.withColumn(time, F.col(time).try_cast(kind))
    if keep_malformed:
        return rows
    return rows.filter("malformed IS NULL AND vehicle_id IS NOT NULL").drop("malformed", "line")


def read_topic(
    spark: SparkSession,
    topic_or_path: str,
    fmt: str = "kafka",
    cfg: Settings = DEFAULTS,
    per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """A stream with a text column ``value``.

    ``fmt="kafka"`` needs the Kafka package on the cluster; ``fmt="text"`` watches a
    folder of JSON lines. ``per_trigger`` bounds one micro-batch: records of a topic,
    files of a folder, ``files_per_trigger`` by default.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = (
            reader.option("subscribe", topic_or_path)
            .option("maxOffsetsPerTrigger", per_trigger or cfg.records_per_trigger)
            .option("startingOffsets", cfg.starting_offsets)
            .option("groupIdPrefix", cfg.consumer_group)
        )
        return reader.load().selectExpr("CAST(value AS STRING) AS value")
    reader = reader.option("maxFilesPerTrigger", per_trigger or cfg.files_per_trigger)
    return reader.load(topic_or_path)


def write_topic(
    rows: DataFrame,
    topic_or_path: str,
    checkpoint: str,
    fmt: str = "kafka",
    key: str = "vehicle_id",
    cfg: Settings = DEFAULTS,
    available_now: bool = False,
    **options: str,
):
    """Start writing a stream of rows as messages; text files hold the value only."""
    messages = encode(rows, key)
    if fmt != "kafka":
        messages = messages.select("value")
    writer = (
        messages.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("topic" if fmt == "kafka" else "path", topic_or_path)
        .options(**options)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{cfg.checkpoint_seconds} seconds").start()


def send_batch(rows: DataFrame, topic_or_path: str, fmt: str = "kafka", **options: str) -> None:
    """Write a table of rows to a topic in one go."""
    messages = encode(rows)
    if fmt == "kafka":
        messages.write.format(fmt).option("topic", topic_or_path).options(**options).save()
    else:
        messages.select("value").write.mode("append").format(fmt).save(topic_or_path)
