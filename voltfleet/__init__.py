"""Vehicle telemetry warehouse and real-time metrics on Spark DataFrames."""

from voltfleet.settings import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
