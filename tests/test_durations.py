"""Literal inputs and outputs, and properties of the printed units."""

import random
import re

from conftest import one_col
from curata.functions.durations import age_hours, duration_text, elapsed_text

DURATIONS = {
    0.0: "0s", 0.5: "0.500s", 1.5: "1.500s", 5.0: "5s", 0.0004: "0s", 60.0: "1m", 61.0: "1m 1s", 60.25: "1m 0.250s",
    125.0: "2m 5s", 3600.0: "1h 0m 0s", 3661.5: "1h 1m 1.500s", 86400.0: "1d 0h 0m 0s", 90061.25: "1d 1h 1m 1.250s",
    604800.0: "1w 0d 0h 0m 0s", 1209661.0: "2w 0d 0h 1m 1s",
}
ELAPSED = {0: "0s", 5: "5s", 59: "59s", 60: "1m 0s", 125: "2m 5s", 3600: "1h 0m 0s", 3661: "1h 1m 1s",
           86399: "23h 59m 59s", 86400: "1d 0h 0m 0s", 90061: "1d 1h 1m 1s", 10_000_000: "115d 17h 46m 40s"}
UNIT = {"w": 604800, "d": 86400, "h": 3600, "m": 60, "s": 1}


def total(text):
    return sum(float(n) * UNIT[u] for n, u in re.findall(r"([\d.]+)([wdhms])", text))


def test_duration_literals(spark):
    assert one_col(spark, list(DURATIONS), duration_text, "double") == list(DURATIONS.values())


def test_duration_units_add_up(spark):
    rnd = random.Random(3)
    xs = [round(rnd.uniform(0, 3e6), rnd.randint(0, 3)) for _ in range(2000)]
    for x, text in zip(xs, one_col(spark, xs, duration_text, "double")):
        assert abs(total(text) - x) < 0.0011, (x, text)
        parts = [u for _, u in re.findall(r"([\d.]+)([wdhms])", text)]
        assert parts == sorted(parts, key=lambda u: -UNIT[u])


def test_elapsed(spark):
    assert one_col(spark, list(ELAPSED), elapsed_text, "long") == list(ELAPSED.values())
    xs = list(range(0, 1_000_000, 7919))
    assert [total(t) for t in one_col(spark, xs, elapsed_text, "long")] == xs


def test_age_hours(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("2024-01-30 00:00:01",), ("2024-01-30 00:00:00",), ("2024-01-31 01:00:00",)], "t string")
    got = [r[0] for r in df.select(age_hours(F.to_timestamp("t"), "2024-01-31 00:00:00")).collect()]
    assert got == [23, 24, -1]  # whole hours, towards zero
