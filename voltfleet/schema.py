"""The telemetry record: sixteen fields plus ``seq``, the ingest order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names and types of a telemetry record, in order.
SIGNALS = [
    "speed",
    "battery_voltage",
    "battery_current",
    "battery_temperature",
    "motor_temperature",
    "motor_rpm",
    "soc",
    "throttle",
    "brake",
    "charging_status",
    "energy_consumption",
    "cabin_temperature",
    "latitude",
    "longitude",
]
FIELDS = ["timestamp", "vehicle_id", *SIGNALS]
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _signal_type(name: str) -> T.DataType:
    return T.IntegerType() if name == "charging_status" else T.DoubleType()


# As it arrives in files and messages: the time stamp is still text.
RAW_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType()), T.StructField("vehicle_id", T.StringType())]
    + [T.StructField(name, _signal_type(name)) for name in SIGNALS]
)
RAW_SCHEMA_WITH_SEQ = T.StructType([T.StructField("seq", T.LongType()), *RAW_SCHEMA.fields])


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ("seq",)) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def integer_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}


def parse_time(column: str = "timestamp") -> str:
    """Text to TIMESTAMP_NTZ: ``TIME_FORMAT`` and ISO forms, with or without a fraction.

    What does not parse becomes null; such records stay, and are no copies of each other.
    """
    return f"try_cast({column} AS TIMESTAMP_NTZ)"


def normalise(df: DataFrame) -> DataFrame:
    """One place for ingest rules: parsed time, ``date``, NaN as null."""
    out = []
    for f in df.schema.fields:
        if f.name == "timestamp" and isinstance(f.dataType, T.StringType):
            out.append(f"{parse_time()} AS timestamp")
        elif f.name == "timestamp":
            out.append("CAST(timestamp AS TIMESTAMP_NTZ) AS timestamp")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(f"nullif({f.name}, CAST('NaN' AS {f.dataType.simpleString()})) AS {f.name}")
        else:
            out.append(f"`{f.name}`")
    return with_date(df.selectExpr(*out))


def with_date(df: DataFrame) -> DataFrame:
    """Add ``date`` from the time stamp unless the table has one."""
    return df if "date" in df.columns else df.withColumn("date", F.to_date("timestamp"))
