"""Sums of doubles against fractions: exact, rounded once, the same in any order."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from voltfleet.functions.exact import exact_avg, exact_stddev, exact_sum, halves, limb_sums, limbs, minus, total
from voltfleet.operators import metrics

KINDS = [
    lambda: random.uniform(-1, 1) * 10 ** random.randint(-12, 12),
    lambda: random.uniform(0, 200),
    lambda: random.choice([None, 0.1, -0.1, 1e16, -1e16]),
    lambda: random.uniform(-1, 1) * 2.0 ** random.randint(-43, 60),
    lambda: 4294967295.0 - random.random(),
]


def values() -> list[tuple]:
    random.seed(5)
    return [(g, KINDS[g % 5]()) for g in range(40) for _ in range(random.choice([1, 2, 40, 300]))]


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("parts", [1, 9])
def test_sums_are_the_nearest_double_of_the_true_sum(spark, wide, parts):
    data = values()
    df = spark.createDataFrame(data, "g int, x double").repartition(parts)
    df = df.selectExpr("*", *[f"{e} AS {c}" for c, e in halves("x", "x").items()])
    found = df.groupBy("g").agg(
        F.expr(exact_sum("x", wide)).alias("s"),
        F.expr(exact_avg("x", wide)).alias("a"),
        F.expr(exact_stddev("x", "x", wide)).alias("d"),
    )
    for r in found.collect():
        own = [Fraction(x) for g, x in data if g == r["g"] and x is not None]
        true = sum(own)
        assert r["s"] == float(true)
        assert r["a"] == (float(true) / len(own) if own else None)
        if len(own) < 2:
            assert r["d"] is None
        elif max(map(abs, own)) < 2**32:
            spread = (len(own) * sum(x * x for x in own) - true * true) / (len(own) * (len(own) - 1))
            assert math.isclose(r["d"], math.sqrt(spread), rel_tol=1e-9, abs_tol=1e-12)


def test_running_sums_can_be_subtracted(spark):
    data = [(i, (-1) ** i * 0.1 * 10 ** (i % 17)) for i in range(400)]
    w = "OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    df = spark.createDataFrame(data, "i int, x double").selectExpr("i", f"{limb_sums('x', w)} AS s")
    df = df.selectExpr("i", "s", "lag(s, 10) OVER (ORDER BY i) AS old").selectExpr("i", f"{total(minus('s', 'old'))} AS last")
    for r in df.collect():
        assert r["last"] == float(sum(Fraction(x) for i, x in data if r["i"] - 10 < i <= r["i"]))


@pytest.mark.parametrize("bad", [2.0**64, -1e300, float("inf")])
def test_values_out_of_reach_make_the_sum_null(spark, bad):
    df = spark.createDataFrame([(1.0,), (bad,), (None,)], "x double")
    assert df.selectExpr(exact_sum("x"), exact_sum("x", wide=True), exact_avg("x")).first()[:] == (None, None, None)
    assert df.selectExpr(f"{total(limbs('x'))} AS t").collect()[0]["t"] == 1.0


def test_no_rows_and_only_nulls(spark):
    for df in (spark.createDataFrame([], "x double"), spark.createDataFrame([(None,)], "x double")):
        assert df.selectExpr(exact_sum("x"), exact_avg("x")).first()[:] == (0.0, None)


def test_small_values_are_not_cut(records):
    calm = {"speed": 0.0004, "battery_voltage": 300.0, "battery_current": 0.0000014}
    day = metrics.daily_metrics(records(*[{**calm, "at": 5 * i} for i in range(6)])).first()
    hours = 5 / 3600
    assert math.isclose(day["total_distance_km"], 6 * 0.0004 * hours)
    assert math.isclose(day["total_energy_kwh"], 6 * 300 * 0.0000014 / 1000 * hours)
