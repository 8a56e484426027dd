"""Real-time metrics over stored records: count window, pairs, event-time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltfleet.functions.clock import MICROS, seconds_between, with_micros
from voltfleet.functions.derive import GROSS_WATTS, SIGNED_WATTS, acceleration
from voltfleet.functions.exact import limb_sums, limbs, minus, total
from voltfleet.functions.numbers import half_up, named, row
from voltfleet.operators.ordering import (
    in_blocks,
    in_time,
    order_key,
    sort_keys,
    with_position,
    with_previous,
    with_sort_keys,
)
from voltfleet.schema import with_date
from voltfleet.settings import DEFAULTS, Settings

# What a window metric needs of a record.
_RECORD = (
    "at",
    "timestamp",
    "seq",
    "speed",
    "soc",
    "battery_voltage",
    "battery_current",
    "battery_temperature",
    "motor_temperature",
)
_STATE = ("battery_temperature", "motor_temperature", "battery_voltage", "battery_current")
_ROW = f"struct({', '.join(_RECORD)})"
_EDGE = ("at", "soc", *_STATE)


def window_columns(cfg: Settings, several: str = "true") -> dict[str, str]:
    """The output of one window, from a row that holds

    ``first`` and ``last`` (its edge records), ``records``, ``speed_sum`` and
    ``gross_sum`` as limbs, ``speed_count``, ``speed_max``, ``speed_min``.
    ``gross_sum`` covers every record but the first one. Rates are null unless
    ``several`` holds.
    """
    duration = f"coalesce(nullif({seconds_between('last.at', 'first.at')}, 0D), 1D)"

    def per_second(c: str, factor: str = "1D") -> str:
        value = half_up(f"(last.{c} - first.{c}) / {duration} * {factor}", 4)
        return f"CASE WHEN {several} THEN {value} END"

    kwh = f"{total('gross_sum')} / 1000D * {cfg.window_record_seconds}D / 3600D"
    mean = f"try_divide({total('speed_sum')}, CAST(speed_count AS DOUBLE))"
    return {
        "window_duration": duration,
        "record_count": "CAST(records AS BIGINT)",
        "instantaneous_power": half_up("last.battery_voltage * last.battery_current / 1000D", 2),
        "battery_temp_rate": per_second("battery_temperature"),
        "motor_temp_rate": per_second("motor_temperature"),
        "avg_speed": half_up(mean, 2),
        "max_speed": half_up("speed_max", 2),
        "min_speed": half_up("speed_min", 2),
        "soc_rate": per_second("soc", "3600D"),
        "latest_soc": "last.soc",
        "energy_consumed": half_up(kwh, 4),
        **{c: f"last.{c}" for c in _STATE},
    }


def window_metrics(df: DataFrame, cfg: Settings = DEFAULTS, fresh: str | None = None) -> DataFrame:
    """Per record, from each vehicle's second one on: metrics of its last 100 records.

    With ``fresh``, a boolean column, only records that have it true are reported on.

    Histories are cut into bounded blocks (``in_blocks``). A record costs the same
    however long the window is: sums are differences of running sums, and with stretches
    as long as the window, its max is the larger one of the max so far in the stretch of
    its last record and the max from its first record on to the end of that stretch.
    """
    n = cfg.window_records
    known = with_micros(with_date(df)).filter("vehicle_id IS NOT NULL")
    known = known.withColumn("fresh", F.col(fresh) if fresh else F.lit(True))
    order = [c for c in ("place", "day") if c in df.columns]
    placed = with_position(known.select("vehicle_id", "date", "fresh", *order, *_RECORD)).drop(*order)
    blocks = in_blocks(placed, reach=n - 1, block_rows=cfg.block_rows)
    so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    stretch = "PARTITION BY vehicle_id, _block, stretch ORDER BY position"
    rest, begun = f"OVER ({stretch} DESC {so_far})", f"OVER ({stretch} {so_far})"
    blocks = blocks.selectExpr("*", f"floor(position / {n}) AS stretch")
    # One shuffle by block serves the windows over stretches, too.
    blocks = blocks.repartition("vehicle_id", "_block")
    blocks = blocks.selectExpr("*", f"max(speed) {rest} AS rest_max", f"min(speed) {rest} AS rest_min")
    # ``stretch`` only repeats what ``position`` says, so that one sort serves both.
    w = "PARTITION BY vehicle_id, _block ORDER BY stretch, position"
    upto = f"OVER ({w} {so_far})"
    # The very first record of a vehicle opens no interval and carries no energy.
    gross = f"CASE WHEN position > 0 THEN {GROSS_WATTS} END"
    running = {
        "last": _ROW,
        "first": f"coalesce(lag({_ROW}, {n - 1}) OVER ({w}), first_value({_ROW}) {upto})",
        "speeds": limb_sums("speed", upto),
        "speed_n": f"count(speed) {upto}",
        "grosses": limb_sums(gross, upto),
        "begun_max": f"max(speed) {begun}",
        "begun_min": f"min(speed) {begun}",
        "speed_max": f"lag(rest_max, {n - 1}) OVER ({w})",
        "speed_min": f"lag(rest_min, {n - 1}) OVER ({w})",
    }
    sums = {
        "speed_max": "greatest(begun_max, speed_max)",
        "speed_min": "least(begun_min, speed_min)",
        "records": f"least(position + 1, {n}L)",
        "speed_sum": minus("speeds", "speeds_before"),
        "speed_count": f"speed_n - coalesce(lag(speed_n, {n}) OVER ({w}), 0L)",
        "gross_sum": minus("grosses", "grosses_before"),
    }
    before = {"speeds_before": f"lag(speeds, {n}) OVER ({w})", "grosses_before": f"lag(grosses, {n - 1}) OVER ({w})"}
    frames = blocks.selectExpr("vehicle_id", "position", "stretch", "_block", "_own AND fresh AS _own", *named(running))
    frames = frames.selectExpr("*", *named(before))
    kept = ["vehicle_id", "position", "_own", "first", "last"]
    frames = frames.selectExpr(*kept, *named(sums)).filter("_own AND position > 0")
    return frames.selectExpr(
        "last.timestamp AS window_end_time",
        "vehicle_id",
        "last.seq AS seq",
        *named(window_columns(cfg)),
    )


# What one window needs besides its edge records.
_SUMS = {
    "records": "count(*)",
    "speed_sum": limb_sums("speed"),
    "speed_count": "count(speed)",
    "speed_max": "max(speed)",
    "speed_min": "min(speed)",
    "gross_all": limb_sums(GROSS_WATTS),
}
_FIRST_GROSS = f"{limbs('first.battery_voltage * abs(first.battery_current)')} AS first_gross"
_GROSS_SUM = f"{minus('gross_all', 'first_gross')} AS gross_sum"


def latest_metrics(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """The newest window of each vehicle, from its last 100 records alone.

    The cut to 100 records per vehicle happens before the shuffle already.
    """
    df = with_sort_keys(in_time(with_date(df)))
    newest = Window.partitionBy("vehicle_id").orderBy(*[F.desc(c) for c in sort_keys(df)])
    tail = (
        with_micros(df)
        .filter("vehicle_id IS NOT NULL")
        .select("vehicle_id", *dict.fromkeys([*_RECORD, *sort_keys(df)]))
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= cfg.window_records)
    )
    edges = {"last": f"min_by({_ROW}, _rank)", "first": f"max_by({_ROW}, _rank)"}
    per_vehicle = tail.groupBy("vehicle_id").agg(*[F.expr(e) for e in named({**edges, **_SUMS})])
    return (
        per_vehicle.filter("records > 1")
        .selectExpr("*", _FIRST_GROSS)
        .selectExpr("*", _GROSS_SUM)
        .selectExpr(
            "last.timestamp AS window_end_time", "vehicle_id", *named(window_columns(cfg))
        )
    )


PAIR_FIELDS = ("at", "battery_temperature", "motor_temperature", "soc")


def pairwise_columns(cfg: Settings = DEFAULTS) -> dict[str, str]:
    """Metrics of a record against its predecessor ``prev``; rates are null without one."""
    elapsed = f"coalesce({seconds_between('at', 'prev.at')}, {cfg.interval_seconds}D)"

    def per_second(c: str, factor: str = "1D") -> str:
        change = half_up(f"try_divide({c} - prev.{c}, {elapsed}) * {factor}", 4)
        return f"CASE WHEN prev IS NOT NULL AND {elapsed} > 0 THEN {change} END"

    return {
        "timestamp": "timestamp",
        "vehicle_id": "vehicle_id",
        "seq": "seq",
        "instantaneous_power_kw": half_up(f"{SIGNED_WATTS} / 1000D", 2),
        "soc": "soc",
        "battery_temp": "battery_temperature",
        "motor_temp": "motor_temperature",
        "speed": "speed",
        "battery_temp_rate": per_second("battery_temperature"),
        "motor_temp_rate": per_second("motor_temperature"),
        "soc_rate_per_hour": per_second("soc", "3600D"),
    }


def pairwise_metrics(
    df: DataFrame, cfg: Settings = DEFAULTS, unique: bool = False, fresh: str | None = None
) -> DataFrame:
    """Per record: power, and rates against the vehicle's previous record.

    ``unique`` tells that the records are deduplicated, here and below. ``fresh``: as above.
    """
    order = [c for c in ("place", "day", fresh) if c in df.columns]
    df = with_micros(with_date(df)).select("vehicle_id", "date", *order, *_RECORD)
    paired = with_previous(df, PAIR_FIELDS, unique=unique)
    return (paired.filter(fresh) if fresh else paired).selectExpr(*named(pairwise_columns(cfg)))


def speed_acceleration(df: DataFrame, unique: bool = False) -> DataFrame:
    """Add the change of speed since the vehicle's previous record, in km/h per second."""
    change = acceleration("speed", "prev.speed", "at", "prev.at")
    known = with_previous(with_micros(with_date(df)), ["at", "speed"], unique=unique)
    return known.withColumn("speed_acceleration", F.expr(change)).drop("prev", "at")


def _window_sums(unique: bool) -> list:
    """Edge records and sums of a group of records."""
    order = order_key(unique)
    if unique:  # one number per field, so that Spark can aggregate by hash
        edges = {f"_{k}_{c}": f"{k}_by({c}, {order})" for c in _EDGE for k in ("min", "max")}
    else:
        edge = f"struct({', '.join(_EDGE)})"
        edges = {"first": f"min_by({edge}, {order})", "last": f"max_by({edge}, {order})"}
    return [F.expr(e) for e in named({**edges, **_SUMS})]


def _window_output(grouped: DataFrame, start: str, end: str, cfg: Settings) -> DataFrame:
    if "first" not in grouped.columns:
        first, last = (row({c: f"_{k}_{c}" for c in _EDGE}) for k in ("min", "max"))
        grouped = grouped.selectExpr("*", f"{first} AS first", f"{last} AS last")
    return (
        grouped.selectExpr("*", _FIRST_GROSS)
        .selectExpr("*", _GROSS_SUM)
        .selectExpr(
            f"{start} AS window_start",
            f"{end} AS window_end_time",
            "vehicle_id",
            *named(window_columns(cfg, several="records > 1")),
        )
    )


def sliding_windows(
    df: DataFrame, cfg: Settings = DEFAULTS, size: int | None = None, unique: bool = False
) -> DataFrame:
    """Metrics per vehicle and event-time window; works on streams with a watermark.

    A window with a single record reports it with rates of null.
    """
    size = cfg.window_size_seconds if size is None else size
    slide = cfg.window_slide_seconds
    df = with_micros(df)
    if unique and not df.isStreaming:
        return _tiled_windows(df, cfg, size, slide)
    window = F.window("timestamp", f"{size} seconds", f"{slide} seconds")
    grouped = df.groupBy(window.alias("w"), "vehicle_id").agg(*_window_sums(unique))
    start, end = (f"CAST(w.{k} AS TIMESTAMP_NTZ)" for k in ("start", "end"))
    return _window_output(grouped, start, end, cfg)


def _tiled_windows(df: DataFrame, cfg: Settings, size: int, slide: int) -> DataFrame:
    """The windows of stored, deduplicated records.

    A record belongs to size / slide windows, and hardly any two records of a vehicle
    share all of theirs: shuffled per window, every record would travel that often.
    Here records travel once, to the stretch of time (tile) their windows start in,
    or twice if those lie on both sides of a border. A tile holds ten minutes of one
    vehicle's records.
    """
    tile, zero = cfg.tile_seconds * MICROS, "TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {})"
    size, slide, seconds = size * MICROS, slide * MICROS, size
    moved = df.filter("at IS NOT NULL").select("vehicle_id", *_RECORD)
    # Window starts are multiples of the slide in (at - size, at].
    last_start = f"(at - at % {slide}L)"
    first_start = f"((at - {size}L) - (at - {size}L) % {slide}L + {slide}L)"
    moved = moved.selectExpr("*", f"{first_start} AS lo", f"{last_start} AS hi")
    moved = moved.filter("lo <= hi").selectExpr(
        "*", f"explode(sequence(lo div {tile}L, hi div {tile}L)) AS tile"
    )
    local = moved.repartition("vehicle_id", "tile").selectExpr(
        *["vehicle_id", "tile", *_RECORD],
        f"explode(sequence(lo, hi, {slide}L)) AS start",
    )
    grouped = (
        local.filter(f"start div {tile}L = tile")
        .groupBy("vehicle_id", "tile", "start")
        .agg(*_window_sums(unique=True))
    )
    begin = f"start div {MICROS}L"
    return _window_output(grouped, zero.format(begin), zero.format(f"{begin} + {seconds}"), cfg)
