from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from voltfleet.schema import FIELDS, RAW_SCHEMA_WITH_SEQ, normalise  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# A quiet record; tests change what they are about.
CALM = {
    "speed": 50.0, "battery_voltage": 300.0, "battery_current": 10.0,
    "battery_temperature": 25.0, "motor_temperature": 40.0, "motor_rpm": 3000.0, "soc": 50.0,
    "throttle": 20.0, "brake": 0.0, "charging_status": 0, "energy_consumption": 15.0,
    "cabin_temperature": 22.0, "latitude": 30.0, "longitude": 104.0,
}
START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def records(spark):
    """Rows from dicts; ``at`` is seconds after the start of 2024 or a text, 5 s apart by default."""

    def make(*rows: dict):
        out = []
        for i, given in enumerate(rows):
            given = dict(given)
            at = given.pop("at", 5 * i)
            if isinstance(at, (int, float)):
                at = (START + timedelta(seconds=at)).strftime("%Y-%m-%d %H:%M:%S")
            full = {"seq": i, "timestamp": at, "vehicle_id": "EV_001", **CALM, **given}
            out.append([full[c] for c in ("seq", *FIELDS)])
        return normalise(spark.createDataFrame(out, RAW_SCHEMA_WITH_SEQ))

    return make
