"""Hand-derived speeds for ``highway = primary``; the table stands in FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from paceway.functions import speed

# maxspeed, chain, km/h text, mph text, km/h without splitting
ROWS = [
    (None, 35, 65, 40, 65),
    ("", 65, 65, 40, 65),
    ("50", 65, 50, 50, 50),
    ("30 mph", 48.28032, 48.27, 30, 48.27),
    ("50 km/h", 50, 50, 50, 50),
    ("de:urban", 50, 50, 40, 50),
    ("none", 65, 65, 40, 65),
    ("50;70", 65, 70, 70, 65),
    ("10 knots", 65, 18.52, 8.68976, 18.52),
    ("130", 65, 130, 130, 130),
    ("-5", 65, 65, 40, 65),
    ("abc", 65, 65, 40, 65),
    ("60kph", 65, 60, 60 / 1.609344, 60),
    ("45mph", 72.42048, 72.405, 45, 72.405),
    ("80 kmh", 65, 80, 80, 80),
    ("gb:nsl_single", 96.54, 96.54, 40, 96.54),
    ("living_street", 6, 6, 40, 6),
    (" 30 MPH ", 65, 48.27, 30, 48.27),
    ("it:motorway", 130, 130, 40, 130),
    ("0", 65, 65, 40, 65),
    ("25|35", 65, 35, 35, 65),
    ("signals", 65, 65, 40, 65),
    ("12.5", 65, 12.5, 12.5, 12.5),
    ("nan", 65, 65, 40, 65),
    ("5d", 65, 65, 40, 65),
    ("20 kn", 37.04, 65, 40, 65),
    ("10 m/s", 36, 65, 40, 65),
    ("1e2", 65, 100, 100, 100),
    (".5 km/h", 0.5, 0.5, 0.5, 0.5),
    ("30 mph;40 mph", 65, 64.36, 40, 65),
]


def test_table(spark):
    df = spark.createDataFrame([(i, r[0], "primary") for i, r in enumerate(ROWS)], "i int, m string, h string")
    got = df.select(
        "i",
        speed.speed_chain("h", "m").alias("chain"),
        speed.speed_notebook("h", "m").alias("kmh"),
        speed.speed_notebook("h", "m", "mph").alias("mph"),
        speed.speed_notebook("h", "m", literal_split=True).alias("whole"),
    ).collect()
    for r in got:
        want = ROWS[r["i"]]
        assert tuple(r)[1:] == pytest.approx(want[1:]), want[0]


def test_missing_tags(spark):
    rows = [("motorway", None), ("path", "x"), (None, "50 km/h"), ("raceway", "50")]
    df = spark.createDataFrame(rows, "h string, m string").select(
        F.array(
            speed.speed_chain("h", "m"), speed.class_speed("h"), speed.class_speed("h", "mph")
        ).alias("v"),
        speed.speed_source("h", "m").alias("s"),
    )
    assert [tuple(r["v"]) + (r["s"],) for r in df.collect()] == [
        (35.0, 100.0, 65.0, "missing_tag"),
        (35.0, 35.0, 20.0, "road"),
        (35.0, 35.0, 20.0, "missing_tag"),
        (35.0, 35.0, 20.0, "road"),
    ]


def test_tables_are_complete():
    assert len(speed.CLASS_KMH) == len(speed.CLASS_MPH) == 17
    assert len(speed.COUNTRY_KMH) == 65
    assert len(speed.NO_INFORMATION) == 10
