"""Telemetry records derived from the ``events`` table of the test data.

A fixed projection: it gives every operator nulls, copies, out-of-range values,
charging starts and charge jumps to work on, at any scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltfleet.schema import with_date

# The projection that stands for a fleet's raw records.
TELEMETRY = """
SELECT event_id AS seq,
  TIMESTAMP_NTZ '2024-01-01 00:00:00'
    + make_dt_interval(CAST(event_id % 4 AS INT), 0, 0, 5 * (event_id DIV 10)) AS `timestamp`,
  concat('EV_', lpad(CAST(user_id % 10 + 1 AS STRING), 3, '0')) AS vehicle_id,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_type = 'signup' THEN 0e0 ELSE value * 2e0 END AS speed,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(180 + (event_id * 37) % 300 AS DOUBLE) END AS battery_voltage,
  CAST((event_id * 53) % 440 - 220 AS DOUBLE) AS battery_current,
  CAST((event_id * 29) % 90 - 25 AS DOUBLE) AS battery_temperature,
  CAST((event_id * 31) % 180 - 25 AS DOUBLE) AS motor_temperature,
  CAST((event_id * 97) % 16000 AS DOUBLE) AS motor_rpm,
  CASE WHEN event_id % 59 = 0 THEN NULL ELSE CAST((event_id * 17) % 101 AS DOUBLE) END AS soc,
  CAST((event_id * 13) % 105 AS DOUBLE) AS throttle,
  CAST((event_id * 7) % 11 AS DOUBLE) / 10e0 AS brake,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS charging_status,
  value / 2e0 AS energy_consumption,
  CAST(15 + (event_id * 19) % 20 AS DOUBLE) AS cabin_temperature,
  29e0 + CAST(event_id % 400 AS DOUBLE) / 100e0 AS latitude,
  102e0 + CAST((event_id * 3) % 400 AS DOUBLE) / 100e0 AS longitude
FROM {events}
"""


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records as they would arrive: copies, nulls and outliers included."""
    return spark.sql(TELEMETRY, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of a finer instrument: values with as many decimals as a double holds."""
    scaled = {"speed": "speed / 7e0", "battery_voltage": "battery_voltage * 3e0 / 7e0 + 2e2", "battery_current": "battery_current / 7e4"}
    return telemetry(spark, sf_dir).withColumns({c: F.expr(e) for c, e in scaled.items()})


def written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records whose times are text: with fractions, in ISO form, or unreadable."""
    rows = telemetry(spark, sf_dir)
    at = "CAST(`timestamp` + make_dt_interval(0, 0, 0, CAST(seq % 7 AS DECIMAL(18, 6)) / 10) AS STRING)"
    form = f"CASE WHEN seq % 97 = 0 THEN 'n/a' WHEN seq % 3 = 1 THEN replace({at}, ' ', 'T') ELSE {at} END"
    return rows.selectExpr(*[f"{form} AS `timestamp`" if c == "timestamp" else c for c in rows.columns])


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_date(telemetry(spark, sf_dir))


def with_broken(messages: DataFrame) -> DataFrame:
    """Messages, some of them cut off or no JSON at all; ``seq`` tells which record each was."""
    seq = "CAST(get_json_object(value, '$.seq') AS BIGINT)"
    broken = """CASE WHEN seq % 89 = 0 THEN concat('{"seq":', seq, ',"speed') WHEN seq % 97 = 0 THEN concat('no record ', seq)
        ELSE value END"""
    return messages.selectExpr("key", "value", f"{seq} AS seq").selectExpr("key", f"{broken} AS value", "seq")
