"""Rows of one vehicle in time order, without one task per vehicle.

A window over ``vehicle_id`` alone puts the whole history of a vehicle in one
task. Here the history is cut into (vehicle, date) chunks: a chunk holds what one
vehicle sends in a day (864,000 rows at ten records a second), however much of the
fleet's data that vehicle holds. What a chunk needs from earlier ones travels in a
table of one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from voltfleet.sources.workspace import materialise

CHUNK = ("vehicle_id", "date")
#: Ingest numbers that are looked through together for the time before an unread one.
PLACE_ROWS = 1_000_000


def in_time(df: DataFrame) -> DataFrame:
    """Give records whose time cannot be read a place: the newest time read before them.

    "Before" is the ingest order ``seq`` of the same vehicle. Such a record stands behind those
    read at that time, and before the first one if nothing was read yet. Where all times
    are read, which costs a look at ``date``, the table is returned as it is; else it is written, and
    ``place`` and ``day`` are added to order by. Only stretches of ``seq`` with such a record
    are looked through, ``PLACE_ROWS`` numbers of one vehicle at a time.
    """
    if "place" in df.columns or df.filter("date IS NULL AND vehicle_id IS NOT NULL").isEmpty():
        return df
    df = materialise(df, "untimed").withColumn("_stretch", F.expr(f"seq div {PLACE_ROWS}"))
    key = ["vehicle_id", "_stretch"]
    touched = df.filter("timestamp IS NULL AND vehicle_id IS NOT NULL").select(*key).distinct()
    vehicles = touched.select("vehicle_id").distinct()
    upto = Window.partitionBy("vehicle_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    newest = df.join(vehicles, "vehicle_id", "left_semi").groupBy(*key).agg(F.max("timestamp").alias("_own"))
    before = newest.select(*key, F.max("_own").over(upto).alias("_before"))
    so_far = Window.partitionBy(*key).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = df.join(touched, key, "left_semi").withColumn("_own", F.max("timestamp").over(so_far))
    near = near.join(before, key).withColumn("place", F.coalesce("timestamp", F.greatest("_own", "_before")))
    near = near.drop("_own", "_before")
    rest = df.join(touched, key, "left_anti").withColumn("place", F.col("timestamp"))
    placed = rest.unionByName(near).drop("_stretch")
    return with_day(placed)


def with_day(df: DataFrame) -> DataFrame:
    """The day of ``place``; records before anything was read come before all days."""
    return df.withColumn("day", F.coalesce(F.to_date("place"), F.lit("0001-01-01").cast("date")))


def chunk_of(df: DataFrame) -> list[str]:
    return ["vehicle_id", "day"] if "place" in df.columns else list(CHUNK)


def sort_keys(df: DataFrame) -> list[str]:
    """What orders the records of one vehicle."""
    return ["place", "unread", "seq"] if "place" in df.columns else ["timestamp", "seq"]


def with_sort_keys(df: DataFrame) -> DataFrame:
    return df.withColumn("unread", F.col("timestamp").isNull()) if "place" in df.columns else df


def in_chunk(df: DataFrame) -> WindowSpec:
    return Window.partitionBy(*chunk_of(df)).orderBy(*sort_keys(df))


def across_chunks(df: DataFrame) -> WindowSpec:
    """Over a table with one row per chunk: a vehicle's days in order."""
    return Window.partitionBy("vehicle_id").orderBy(chunk_of(df)[1])


def order_key(unique: bool, df: DataFrame | None = None) -> str:
    """What orders one vehicle's records, for ``max_by`` and ``min_by``.

    Where the time alone tells them apart (``unique``: deduplicated records) the key
    is one number, and Spark aggregates by hash; with ``seq`` as a tie-break, or with places
    (``in_time``), it is a struct, for which it has to sort.
    """
    if df is not None and "place" in df.columns:
        return f"struct({', '.join(sort_keys(df))})"
    if unique:
        return "coalesce(timestamp, TIMESTAMP_NTZ '0001-01-01 00:00:00')"
    return "struct(timestamp, seq)"


def with_previous(
    df: DataFrame, columns: Sequence[str], name: str = "prev", unique: bool = False
) -> DataFrame:
    """Add a struct of ``columns`` taken from the vehicle's previous record, or null."""
    names = df.columns
    df = with_sort_keys(in_time(df))
    order, chunk = order_key(unique, df), chunk_of(df)
    last_rows = (
        df.groupBy(*chunk)
        .agg(*[F.expr(f"max_by({c}, {order}) AS {c}") for c in columns])
        .select(*chunk, F.struct(*columns).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(across_chunks(df)))
        .select(*chunk, "_carry")
    )
    joined = df.join(last_rows, chunk, "left")
    first = F.row_number().over(in_chunk(df)) == 1
    previous = F.lag(F.struct(*columns)).over(in_chunk(df))
    return joined.select(*names, F.when(first, F.col("_carry")).otherwise(previous).alias(name))


TABLE_CHUNK_ROWS = 1_000_000


def fill_along_time(
    df: DataFrame,
    forward: Sequence[str],
    backward: Sequence[str],
    scope: str = "vehicle",
    unique: bool = False,
    edges: DataFrame | None = None,
) -> DataFrame:
    """Replace nulls by the nearest earlier (later) value; leading (trailing) ones stay.

    ``scope="vehicle"`` follows each vehicle's time. ``scope="table"`` follows the
    ingest order of the whole table, across vehicles; it needs a whole-number ``seq``,
    and cuts the table into ranges of it. ``unique``: see ``order_key``. All columns
    share one window pass. ``edges``: what the chunks' neighbours hand over (``carried_over``),
    where ``df`` holds only part of the days.
    """
    if not forward and not backward:
        return df
    columns = df.columns
    if scope == "vehicle":
        df = with_sort_keys(in_time(df))
        chunk, order, days = chunk_of(df), order_key(unique, df), across_chunks(df)
        rows = Window.partitionBy(*chunk)
        up = sort_keys(df)
        down = [F.desc(c) for c in up]
    elif scope == "table":
        chunk, order = ["_range"], "seq"
        df = df.withColumn("_range", F.floor(F.col("seq") / TABLE_CHUNK_ROWS))
        # One row per million records: small enough for a single ordered pass.
        days, rows = Window.orderBy("_range"), Window.partitionBy("_range")
        up, down = ["seq"], [F.desc("seq")]
    else:
        raise ValueError(f"unknown fill scope: {scope}")

    if edges is None:
        own = df.groupBy(*chunk).agg(*edge_values(forward, backward, order))
        edges = carried_over(own, chunk, days, forward, backward)
    # Backwards as a running frame over the reversed order: a frame that starts at
    # the current row would be scanned anew for every row.
    so_far = (Window.unboundedPreceding, Window.currentRow)
    up_to, down_to = rows.orderBy(*up).rowsBetween(*so_far), rows.orderBy(*down).rowsBetween(*so_far)
    joined = df.join(edges, chunk, "left")
    filled = {
        **{c: F.coalesce(F.last(c, True).over(up_to), F.col(f"_before_{c}")) for c in forward},
        **{c: F.coalesce(F.last(c, True).over(down_to), F.col(f"_after_{c}")) for c in backward},
    }
    return joined.withColumns(filled).select(*columns)


def edge_values(forward: Sequence[str], backward: Sequence[str], order: str) -> list[Column]:
    """Aggregates of a chunk: its last known values and, for backward columns, its first ones."""

    def known(c: str) -> str:
        return f"CASE WHEN {c} IS NOT NULL THEN {order} END"

    return [
        *[F.expr(f"max_by({c}, {known(c)}) AS _last_{c}") for c in forward],
        *[F.expr(f"min_by({c}, {known(c)}) AS _next_{c}") for c in backward],
    ]


def carried_over(
    own: DataFrame, chunk: Sequence[str], days: WindowSpec, forward: Sequence[str], backward: Sequence[str]
) -> DataFrame:
    """Per chunk, the nearest known values before and after it; ``own`` holds ``edge_values``."""
    before = days.rowsBetween(Window.unboundedPreceding, -1)
    after = days.rowsBetween(1, Window.unboundedFollowing)
    return own.select(
        *chunk,
        *[F.last(f"_last_{c}", True).over(before).alias(f"_before_{c}") for c in forward],
        *[F.first(f"_next_{c}", True).over(after).alias(f"_after_{c}") for c in backward],
    )


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Add the 0-based rank of each record in its vehicle's whole history.

    Every record needs a vehicle.
    """
    names = df.columns
    df = with_sort_keys(in_time(df))
    chunk = chunk_of(df)
    before = across_chunks(df).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*chunk)
        .agg(F.count("*").alias("_n"))
        .select(*chunk, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # Rows without a date match no offset; they sort first within their vehicle.
    start = F.coalesce(F.col("_offset"), F.lit(0))
    position = (start + F.row_number().over(in_chunk(df)) - 1).alias(name)
    return df.join(offsets, chunk, "left").select(*names, position)


def in_blocks(df: DataFrame, reach: int, block_rows: int, position: str = "position") -> DataFrame:
    """Cut each vehicle's records into blocks that row frames can run in alone.

    A block holds ``block_rows`` consecutive records, plus a copy of the ``reach``
    records before them (``_own`` is false there): frames that look back at most
    ``reach`` rows are complete for every own record, and no block is larger. With
    blocks shorter than the reach a record is copied to several.
    """
    block = F.floor(F.col(position) / block_rows)
    homes = F.sequence(block, F.floor((F.col(position) + reach) / block_rows))
    return (
        df.withColumn("_block", F.explode(homes)).withColumn("_own", F.col("_block") == block)
    )

