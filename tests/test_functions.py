"""Boundaries of every classification and score expression (hand-made rows)."""

from pyspark.sql import functions as F

from epicentre.functions import (
    capped_risk_score,
    day_name,
    day_of_week_sunday0,
    depth_category,
    epoch_ms_to_ntz,
    magnitude_category,
    max_magnitude_points,
    region_from_place,
    risk_category,
    tsunami_warning,
)


def _map(spark, values, fn, typ):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_magnitude_category(spark):
    mags = [-1.0, 1.99, 2.0, 3.99, 4.0, 5.0, 6.0, 7.0, 7.99, 8.0, 9.5, None]
    assert _map(spark, mags, magnitude_category, "double") == [
        "micro", "micro", "minor", "minor", "light", "moderate", "strong", "major", "major",
        "great", "great", "unknown",
    ]


def test_depth_category(spark):
    assert _map(spark, [0.0, 69.9, 70.0, 299.9, 300.0, None], depth_category, "double") == [
        "shallow", "shallow", "intermediate", "intermediate", "deep", "unknown",
    ]


def test_region_from_place(spark):
    places = [
        None,
        "Alaska",
        "10 km N of  Anchorage, Alaska ",
        "north of Gulf of Aden",
        "5 km S OF Town",
        "  padded  ",
    ]
    assert _map(spark, places, region_from_place, "string") == [
        None,
        "Alaska",
        "Anchorage, Alaska",  # first ' of ', trimmed
        "Gulf of Aden",  # only the first ' of ' splits
        "5 km S OF Town",  # case-sensitive
        "  padded  ",  # no ' of ': untouched, untrimmed
    ]


def test_tsunami_warning(spark):
    assert _map(spark, [1, 0, 2, None], tsunami_warning, "int") == [True, False, False, False]


def test_day_name_and_dow(spark):
    assert _map(spark, list(range(7)) + [None], day_name, "int") == [
        "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", None,
    ]
    # 2024-01-07 was a Sunday; the millisecond part survives the conversion
    ms = 1704585600123
    row = spark.createDataFrame([(ms,)], "ms long").select(
        epoch_ms_to_ntz("ms").alias("t"), day_of_week_sunday0(epoch_ms_to_ntz("ms")).alias("d")
    ).first()
    assert row.d == 0 and row.t.microsecond == 123000 and str(row.t).startswith("2024-01-07 00:00:00")


def test_epoch_conversion_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        t = spark.createDataFrame([(0,)], "ms long").select(epoch_ms_to_ntz("ms").alias("t")).first().t
        assert str(t) == "1970-01-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_points_and_risk(spark):
    assert _map(spark, [3.9, 4.0, 5.0, 6.0, None], max_magnitude_points, "double") == [1, 5, 10, 20, 1]
    assert _map(spark, [9.99, 10.0, 25.0, 50.0, None], risk_category, "double") == [
        "minimal", "low", "moderate", "high", "minimal",
    ]
    assert _map(spark, [99.5, 100.0, 250.0, None], capped_risk_score, "double") == [99.5, 100.0, 100.0, None]
