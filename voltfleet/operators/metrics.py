"""The eight daily metrics of each vehicle.

One window pass over (vehicle, date) chunks finds the changes between records of
a day, one aggregate gives all sums of the day. The change from a day's last
record to the next day's first one is added on the daily rows: the event belongs
to the later day. Nothing is ever grouped by vehicle before it is one row per day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltfleet.functions.clock import with_micros
from voltfleet.functions.derive import GROSS_WATTS, SIGNED_WATTS, acceleration
from voltfleet.functions.exact import exact_avg, exact_stddev, exact_sum, halves
from voltfleet.functions.numbers import half_up, named, percent, row, rows, text
from voltfleet.operators.ordering import CHUNK
from voltfleet.schema import with_date
from voltfleet.settings import DEFAULTS, Settings

KEYS = list(CHUNK)

# Metric -> its columns, in output order.
METRIC_COLUMNS: dict[str, list[str]] = {
    "daily_energy_consumption": [
        "total_energy_kwh",
        "total_distance_km",
        "daily_energy_consumption",
    ],
    "rapid_acceleration_count": ["rapid_acceleration_count"],
    "high_temp_duration": ["high_temp_duration_hours"],
    "daily_mileage": ["total_mileage_km", "driving_time_hours"],
    "charging_frequency": ["charging_frequency"],
    "average_speed": ["average_speed", "max_speed", "min_speed", "speed_std"],
    "brake_energy_recovery_rate": [
        "total_recovered_energy",
        "total_consumed_energy",
        "brake_energy_recovery_rate",
    ],
    "battery_health_index": ["battery_health_index", "high_temp_duration_hours", "soc_cycles"],
}

_CHANGING = ("at", "speed", "charging_status", "soc")
EVE = tuple(f"eve_{c}" for c in _CHANGING)


def _events(now: str, before: str, cfg: Settings) -> dict[str, str]:
    """What happened between two consecutive records, given their column prefixes."""
    rate = acceleration(f"{now}speed", f"{before}speed", f"{now}at", f"{before}at")
    return {
        "rapid": f"{rate} > {cfg.rapid_acceleration!r}D",
        "charging_start": f"{now}charging_status - {before}charging_status = 1",
        "soc_cycle": f"abs({now}soc - {before}soc) > {cfg.soc_cycle_step!r}D",
    }


def daily_sums(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per vehicle and day: exact sums, and the day's first and last record."""
    df = with_date(df).filter("vehicle_id IS NOT NULL AND date IS NOT NULL")
    chunk = "(PARTITION BY vehicle_id, date ORDER BY timestamp, seq)"
    recovering = "battery_current < 0"
    if not cfg.recovery_includes_charging:
        recovering += " AND charging_status = 0"
    watts = {
        "gross": GROSS_WATTS,
        "recovered": f"CASE WHEN {recovering} THEN abs({SIGNED_WATTS}) END",
        "consumed": f"CASE WHEN battery_current > 0 THEN {SIGNED_WATTS} END",
    }
    lagged = with_micros(df).selectExpr(
        *["vehicle_id", "date", "battery_temperature", *named({**watts, **halves("speed", "speed")})],
        *_CHANGING,
        *named({f"prev_{c}": f"lag({c}) OVER {chunk}" for c in _CHANGING}),
        f"row_number() OVER {chunk} = 1 AS is_first",
        f"lead(1) OVER {chunk} IS NULL AS is_last",
    )
    columns = {
        **{c: exact_sum(c) for c in watts},
        "distance": exact_sum("speed"),
        "driven": exact_sum("CASE WHEN speed > 0 THEN speed END"),
        "driving_records": "count_if(speed > 0)",
        "hot_records": f"count_if(battery_temperature > {cfg.high_temperature!r}D)",
        "average_speed": half_up(exact_avg("speed"), 2),
        "max_speed": half_up("max(speed)", 2),
        "min_speed": half_up("min(speed)", 2),
        "speed_std": half_up(exact_stddev("speed", "speed"), 2),
        **{name: f"count_if({flag})" for name, flag in _events("", "prev_", cfg).items()},
        **{f"first_{c}": f"max(CASE WHEN is_first THEN {c} END)" for c in _CHANGING},
        **{f"last_{c}": f"max(CASE WHEN is_last THEN {c} END)" for c in _CHANGING},
    }
    return lagged.groupBy(*KEYS).agg(*[F.expr(e) for e in named(columns)])


def daily_metrics(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """All metrics of each vehicle and day in one wide row.

    Expects cleaned records. Those without a vehicle or a day belong to no group.
    """
    return metrics_of(with_eve(daily_sums(df, cfg)), cfg)


def with_eve(sums: DataFrame) -> DataFrame:
    """Add to each day's sums the last record of the vehicle's day before."""
    days = "(PARTITION BY vehicle_id ORDER BY date)"
    return sums.selectExpr("*", *named({e: f"lag(last_{c}) OVER {days}" for e, c in zip(EVE, _CHANGING, strict=True)}))


def metrics_of(sums: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """The metrics of each day from its own sums and the eve's last record."""
    overnight = _events("first_", "eve_", cfg)

    hours = f"{cfg.interval_hours!r}D"
    kwh = lambda c: f"({c} / 1000D * {hours})"
    km = lambda c: f"({c} * {hours})"
    total = lambda e: f"({e} + CAST(coalesce({overnight[e]}, false) AS BIGINT))"
    hot_hours, cycles = f"(hot_records * {hours})", total("soc_cycle")
    columns = {
        "total_energy_kwh": kwh("gross"),
        "total_distance_km": km("distance"),
        "daily_energy_consumption": percent(kwh("gross"), km("distance")),
        "rapid_acceleration_count": total("rapid"),
        "high_temp_duration_hours": hot_hours,
        "total_mileage_km": km("driven"),
        "driving_time_hours": f"driving_records * {hours}",
        "charging_frequency": total("charging_start"),
        **{c: c for c in METRIC_COLUMNS["average_speed"]},
        "total_recovered_energy": kwh("recovered"),
        "total_consumed_energy": kwh("consumed"),
        "brake_energy_recovery_rate": half_up(percent(kwh("recovered"), kwh("consumed")), 2),
        "battery_health_index": health_index(hot_hours, cycles, cfg),
        "soc_cycles": cycles,
    }
    return sums.selectExpr(*KEYS, *named(columns))


def health_index(hot_hours: str, cycles: str, cfg: Settings = DEFAULTS) -> str:
    score = (
        f"100D - {hot_hours} * {cfg.health_per_hot_hour!r}D - {cycles} * {cfg.health_per_cycle!r}D"
    )
    return half_up(f"least(greatest({score}, 0D), 100D)", 2)


def metric(wide: DataFrame, name: str) -> DataFrame:
    """One metric's table out of the wide rows; unused sums are pruned from the plan."""
    return wide.select(*KEYS, *METRIC_COLUMNS[name])


def metric_tables(wide: DataFrame) -> dict[str, DataFrame]:
    return {name: metric(wide, name) for name in METRIC_COLUMNS}


def battery_health_by_join(
    hot_hours: DataFrame, cycles: DataFrame, cfg: Settings = DEFAULTS
) -> DataFrame:
    """Battery health from its two parts as separate tables; a missing part counts 0."""
    joined = hot_hours.join(cycles, KEYS, "left").fillna(0, ["soc_cycles"])
    index = health_index("high_temp_duration_hours", "soc_cycles", cfg)
    return joined.selectExpr(
        *KEYS, f"{index} AS battery_health_index", "high_temp_duration_hours", "soc_cycles"
    )


def union_by_name(tables: dict[str, DataFrame], update_time: str | None = None) -> DataFrame:
    """Stack tables by column name; what a table lacks is null there."""
    tagged = [t.withColumn("metric_name", F.lit(name)) for name, t in tables.items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return out if update_time is None else out.withColumn("update_time", F.lit(update_time))


def summary_rows(wide: DataFrame, update_time: str) -> DataFrame:
    """The union of the eight metric tables, made from the wide rows in one pass."""
    kinds = dict(wide.dtypes)
    columns = list(dict.fromkeys(c for own in METRIC_COLUMNS.values() for c in own))
    tables = [
        row(
            {
                "metric_name": text(name),
                **{c: c if c in own else f"CAST(NULL AS {kinds[c]})" for c in columns},
            }
        )
        for name, own in METRIC_COLUMNS.items()
    ]
    return wide.selectExpr(*KEYS, rows(tables)).withColumn("update_time", F.lit(update_time))
