"""Files in and out: raw records, warehouse layers, metric tables, reports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltfleet.operators.metrics import METRIC_COLUMNS
from voltfleet.schema import RAW_SCHEMA, RAW_SCHEMA_WITH_SEQ, normalise


def read_csv(spark: SparkSession, path: str | list[str], with_seq: bool = False) -> DataFrame:
    """Raw records from CSV with a header. Values that do not fit the schema are null.

    A file without ``seq`` gets the place of each row in the input instead: file,
    split and row within the read. It orders rows as the files do, on any cluster.
    """
    schema = RAW_SCHEMA_WITH_SEQ if with_seq else RAW_SCHEMA
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .csv(path)
    )
    if with_seq:
        return normalise(rows)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return normalise(rows.select(place.alias("seq"), *RAW_SCHEMA.names))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Records from Parquet; ``seq`` falls back to file and row number."""
    rows = spark.read.parquet(path)
    if "seq" not in rows.columns:
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("start"),
            F.lit(0).cast("bigint").alias("row"),
        )
        rows = rows.select(place.alias("seq"), *rows.columns)
    return normalise(rows)


def read_records(spark: SparkSession, path: str, fmt: str = "csv", with_seq: bool = False):
    return read_csv(spark, path, with_seq) if fmt == "csv" else read_parquet(spark, path)


def newest_path(spark: SparkSession, folder: str, pattern: str = "*.csv", by: str = "time") -> str | None:
    """The file changed last (``by="time"``) or last by name; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime")
    )
    order = [F.desc("modificationTime"), F.desc("path")] if by == "time" else [F.desc("path")]
    found = files.orderBy(*order).limit(1).collect()
    return found[0]["path"] if found else None


def read_newest(spark: SparkSession, folder: str, with_seq: bool = False) -> DataFrame | None:
    """Records of the newest delivery of a landing folder, or None if there is none.

    A delivery is a CSV file in the folder, or a folder below it with all its parts.
    """
    path = newest_path(spark, folder)
    if path is None:
        return None
    parent = path.rsplit("/", 1)[0]
    return read_csv(spark, path if _bare(parent) == _bare(folder) else parent, with_seq)


def _bare(path: str) -> str:
    """A path without its scheme, where that has no host, and without a last slash."""
    return re.sub(r"^[a-z][a-z0-9+.-]*:/+", "/", path).rstrip("/")


def _flat(df: DataFrame) -> DataFrame:
    """CSV has no nested values and writes time stamps as text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            out.append(F.col(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    _flat(df).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, by_date: bool = True) -> None:
    """Overwrite a layer; with ``by_date`` only the days present in ``df`` are replaced.

    ``rebalance`` lets AQE choose the number of files per day: neither many small
    files nor one task for a heavy day.
    """
    if by_date and "date" in df.columns:
        (
            df.hint("rebalance", F.col("date"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(path)
        )
    else:
        df.write.mode("overwrite").parquet(path)


def write_layer(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt == "parquet":
        write_parquet(df, path)
    elif fmt == "csv":
        write_csv(df, path)
    else:
        raise ValueError(f"unknown layer format: {fmt}")


def write_metrics(summary: DataFrame, path: str) -> None:
    """All metric tables in one write, one folder per metric."""
    (
        summary.hint("rebalance", F.col("metric_name"))
        .write.mode("overwrite")
        .partitionBy("metric_name")
        .parquet(path)
    )


def read_metric(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One metric's table; only its folder is read."""
    rows = spark.read.parquet(path).filter(F.col("metric_name") == name)
    return rows.select("vehicle_id", "date", *METRIC_COLUMNS[name])


def read_metrics(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: read_metric(spark, path, name) for name in METRIC_COLUMNS}


def write_report(report: DataFrame, path: str) -> None:
    """One nested row as JSON; fields without a value are left out."""
    report.write.mode("overwrite").json(path)


def latest_report(spark: SparkSession, folder: str, schema: T.StructType | None = None):
    """The report written last, going by the names of the report folders."""
    path = newest_path(spark, folder, pattern="*.json", by="name")
    if path is None:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)
