"""No record is lost on the way in, whatever its time looks like."""

from __future__ import annotations

import pytest

from voltfleet.operators import dedup
from voltfleet.plans import cleaning
from voltfleet.schema import normalise
from voltfleet.sources import files, messages

TIMES = {
    "fraction": "2024-01-01 00:00:{:02d}.{:d}00",
    "iso": "2024-01-01T00:00:{:02d}.{:d}",
    "unreadable": "n/a",
}


@pytest.mark.parametrize("form", TIMES)
def test_fifty_records_at_ten_a_second(records, form):
    rows = records(*[{"at": TIMES[form].format(i // 10, i % 10)} for i in range(50)])
    assert dedup.deduplicate(rows).count() == 50
    assert dedup.duplicate_counts(rows).first()["duplicate_count"] == 0
    assert cleaning.clean(rows).count() == 50


def test_typed_times_keep_their_fraction(spark):
    rows = spark.sql(
        "SELECT id AS seq, 'EV' AS vehicle_id, TIMESTAMP_NTZ '2024-01-01 00:00:00'"
        " + make_dt_interval(0, 0, 0, id * 0.1) AS timestamp FROM range(50)"
    )
    assert dedup.deduplicate(normalise(rows)).count() == 50


def test_fractions_survive_messages(records):
    rows = records({"at": "2024-01-01 00:00:00.25"}, {"at": 5})
    back = normalise(messages.decode(messages.encode(rows.drop("date"))))
    assert [r[0] for r in back.orderBy("seq").selectExpr("CAST(timestamp AS STRING)").collect()] == [
        "2024-01-01 00:00:00.25",
        "2024-01-01 00:00:05",
    ]


def test_newest_delivery_is_whole(spark, records, tmp_path):
    rows = records(*[{} for _ in range(40)]).drop("date")
    files.write_csv(rows.limit(3), f"{tmp_path}/early")
    files.write_csv(rows.repartition(4), f"{tmp_path}/late")
    assert files.read_newest(spark, str(tmp_path), with_seq=True).count() == 40
