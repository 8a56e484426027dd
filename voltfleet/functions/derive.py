"""Row-wise columns: states, power, energy, distance. Batch and stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltfleet.functions.clock import seconds_between
from voltfleet.settings import DEFAULTS, Settings

# Limits and names of the states. What compares to null takes ELSE.
STATUS = {
    "driving_status": """CASE WHEN speed = 0 THEN 'idle' WHEN speed < 60 THEN 'normal'
        WHEN speed < 100 THEN 'fast' ELSE 'highway' END""",
    "energy_category": """CASE WHEN energy_consumption < 10 THEN 'A_excellent'
        WHEN energy_consumption < 15 THEN 'B_good'
        WHEN energy_consumption < 20 THEN 'C_average' ELSE 'D_poor' END""",
    "temp_status": """CASE WHEN battery_temperature < 10 THEN 'cold'
        WHEN battery_temperature < 30 THEN 'normal'
        WHEN battery_temperature < 45 THEN 'warm' ELSE 'hot' END""",
    "battery_status": """CASE WHEN soc < 20 THEN 'low_power' WHEN soc > 80 THEN 'high_power'
        WHEN battery_temperature > 45 THEN 'high_temp_warning' ELSE 'normal' END""",
}

SIGNED_WATTS = "battery_voltage * battery_current"  # negative while charging
GROSS_WATTS = "battery_voltage * abs(battery_current)"


def _with(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(value) for name, value in columns.items()})


def add_status(df: DataFrame) -> DataFrame:
    """The four state columns of the detail layer."""
    return _with(df, STATUS)


def acceleration(speed: str, prev_speed: str, at: str, prev_at: str) -> str:
    """km/h per second, times in microseconds; the millisecond keeps equal ones from dividing by 0."""
    return f"(({speed} - {prev_speed}) / ({seconds_between(at, prev_at)} + 0.001D))"


def add_power(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Power, energy and distance credited to each record."""
    hours = f"{cfg.interval_hours!r}D"
    kw, gross_kw = f"({SIGNED_WATTS} / 1000D)", f"({GROSS_WATTS} / 1000D)"
    return _with(
        df,
        {
            "power_kw": kw,
            "gross_power_kw": gross_kw,
            "energy_kwh": f"{gross_kw} * {hours}",
            "distance_km": f"speed * {hours}",
            "driven_km": f"CASE WHEN speed > 0 THEN speed * {hours} ELSE 0D END",
            "recovered_kwh": f"CASE WHEN battery_current < 0 THEN abs({kw}) * {hours} ELSE 0D END",
            "consumed_kwh": f"CASE WHEN battery_current > 0 THEN {kw} * {hours} ELSE 0D END",
        },
    )


def add_flags(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return _with(
        df,
        {
            "is_high_temp": f"battery_temperature > {cfg.high_temperature!r}D",
            "is_driving": "speed > 0",
        },
    )
