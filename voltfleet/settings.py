"""Parameters of the library, in one frozen record that is passed around.

The literals below are fixed values: results depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Valid physical range of each signal, both ends included.
PHYSICAL_RANGES: dict[str, tuple[float, float]] = {
    "speed": (0.0, 200.0),
    "battery_voltage": (200.0, 450.0),
    "battery_current": (-200.0, 200.0),
    "battery_temperature": (-20.0, 60.0),
    "motor_temperature": (-20.0, 150.0),
    "motor_rpm": (0.0, 15000.0),
    "soc": (0.0, 100.0),
    "throttle": (0.0, 100.0),
    "brake": (0.0, 1.0),
    "energy_consumption": (0.0, 50.0),
    "cabin_temperature": (-10.0, 50.0),
    "latitude": (18.0, 54.0),
    "longitude": (73.0, 135.0),
}

# Metric name -> unit.
METRIC_UNITS: dict[str, str] = {
    "daily_energy_consumption": "kWh/100km",
    "rapid_acceleration_count": "次",
    "high_temp_duration": "小时",
    "daily_mileage": "km",
    "charging_frequency": "次",
    "average_speed": "km/h",
    "brake_energy_recovery_rate": "%",
    "battery_health_index": "%",
}

# Null filling per column; every other column takes "default".
FILL_STRATEGY: dict[str, str] = {"speed": "ffill", "soc": "ffill", "default": "median"}


@dataclass(frozen=True)
class Settings:
    interval_seconds: int = 5
    dedup_key: tuple[str, ...] = ("vehicle_id", "timestamp")
    ranges: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(PHYSICAL_RANGES))
    fill_strategy: dict[str, str] = field(default_factory=lambda: dict(FILL_STRATEGY))
    completeness_threshold: float = 99.0
    duplicate_threshold: float = 5.0
    iqr_factor: float = 1.5

    rapid_acceleration: float = 5.0  # km/h per second, strictly above
    high_temperature: float = 45.0  # degrees Celsius, strictly above
    soc_cycle_step: float = 20.0  # percent, strictly above
    recovery_includes_charging: bool = True  # count plug-in charging as recovered, too
    health_per_hot_hour: float = 0.1
    health_per_cycle: float = 0.01

    window_records: int = 100  # count window of the real-time metrics
    window_record_seconds: int = 5  # time credited to each record in it
    window_size_seconds: int = 5  # event-time window
    window_slide_seconds: int = 1
    checkpoint_seconds: int = 30

    telemetry_topic: str = "vehicle_can_data"
    metrics_topic: str = "realtime_metrics"
    consumer_group: str = "realtime-metrics"
    starting_offsets: str = "latest"
    records_per_trigger: int = 10_000_000  # bound of one micro-batch read from a topic
    files_per_trigger: int = 10_000  # the same for a folder

    # Scale knobs; none of them changes a result.
    block_rows: int = 8192  # rows of one vehicle handled together by row frames
    tile_seconds: int = 600  # time of one vehicle handled together by event-time windows

    @property
    def interval_hours(self) -> float:
        return self.interval_seconds / 3600


DEFAULTS = Settings()
