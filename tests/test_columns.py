"""Column expressions on the edge rows of FIXTURES.md §3."""

from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.functions.sql_functions import register_sql_functions


def col_values(spark, values, fn, ddl="x string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_duration_seconds(spark):
    vals = ["PT1H30M15S", "PT45S", "PT10M", "PT2H5S", "P0D", "", None, "P1DT2H", "P1M", "PT1M", "P2DT3M4S"]
    assert col_values(spark, vals, C.duration_seconds) == [5415, 45, 600, 7205, 0, 0, 0, 93600, 0, 60, 172984]
    # unparseable numbers and totals beyond int give null, never an ANSI error
    bad = ["PT1.5S", "PTxS", "P99999D", "P99999999999999999999D", "P106751991167300D"]
    assert col_values(spark, bad, C.duration_seconds) == [0] * 5


def test_engagement_rate(spark):
    df = spark.createDataFrame([(3, 0, 0), (None, 5, 10), (1, 1, 3), (1, 1, None)], "l bigint, c bigint, v bigint")
    got = [r[0] for r in df.select(C.engagement_rate("l", "c", "v")).collect()]
    assert got[0] == 300.0 and got[1] == 50.0 and got[3] == 200.0
    assert abs(got[2] - 66.66666666666666) < 1e-12


def test_category_name(spark):
    assert col_values(spark, ["10", "3", None, "23", "34"], C.category_name) == [
        "Music", "Unknown", "Unknown", "Comedy", "Comedy"]


def test_duration_buckets(spark):
    secs = [0, 59, 60, 300, 600, 1200, None]
    left = col_values(spark, secs, C.duration_bucket, "x int")
    right = col_values(spark, secs, C.duration_bucket_right, "x int")
    assert left == ["< 1 min", "< 1 min", "1-5 mins", "5-10 mins", "10-20 mins", "> 20 mins", "> 20 mins"]
    assert right == [None, "< 1 min", "< 1 min", "1-5 mins", "5-10 mins", "10-20 mins", None]
    assert col_values(spark, [1201], C.duration_bucket_right, "x int") == ["> 20 mins"]


def test_calendar_keys(spark):
    df = spark.createDataFrame([("2024-01-01 13:05:00",)], "s string").select(F.to_timestamp("s").alias("ts"))
    r = df.select(C.day_short(F.to_date("ts")), C.day_long("ts"), C.hour_of_day("ts"), C.year_month("ts")).first()
    assert tuple(r) == ("Mon", "Monday", 13, "2024-01")


def test_ordinals(spark):
    assert col_values(spark, ["Mon", "Sun", "xx", None], C.weekday_order_short) == [1, 7, 0, None]
    assert col_values(spark, ["< 1 min", "> 20 mins"], C.bucket_order) == [1, 5]


def test_timestamps(spark):
    vals = ["2022-01-01T12:00:00Z", "2022-01-01", "2022-01-01T12:00:00.123Z", "junk", None]
    strict = col_values(spark, vals, C.api_timestamp)
    lenient = col_values(spark, vals, C.lenient_timestamp)
    assert strict[0] is not None and strict[1:] == [None, None, None, None]
    assert [x is None for x in lenient] == [False, False, False, True, True]
    assert lenient[2] == strict[0]


def test_short_title_and_numbers(spark):
    long = "x" * 45
    assert col_values(spark, [long, "short", None], C.short_title) == ["x" * 40 + "...", "short", "Unknown"]
    nums = col_values(spark, [None, 999, 1234, 2_600_000, 3_000_000_000], C.human_number, "x bigint")
    assert nums == ["0", "999", "1.2K", "2.6M", "3.0B"]
    tidy = col_values(spark, [12.0, 3.46, 999.94, 1500.0], lambda c: C.human_number(c, tidy=True), "x double")
    assert tidy == ["12", "3.5", "999.9", "1.5K"]
    # ties round like Python's '%.1f' (exact binary value, half-even)
    ties = [1250, 1350, 1150, 2550, 5_123_456_789_000]
    assert col_values(spark, ties, C.human_number, "x bigint") == [
        f"{v / 1000:.1f}K" if v < 1e6 else f"{v / 1e9:.1f}B" for v in ties]


def test_casts_are_lenient(spark):
    assert col_values(spark, ["12", "x12", None], C.to_long) == [12, None, None]


def test_sql_functions_match_columns(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame(
        [("PT1H30M15S", "23", 3, 0, 0), (None, None, None, 5, 10), ("P1DT2H", "99", 1, 1, None),
         ("P2DT3M4S", "1", 0, 0, 5), ("P1M", "34", 1, 2, 3), ("PT9S", "x", None, None, 0),
         ("P99999D", "2", 1, 1, 1), ("PT1.5S", "3", 1, 1, 1)],
        "d string, cat string, l bigint, c bigint, v bigint")
    df.createOrReplaceTempView("fx")
    got = spark.sql("select format_duration(d), get_category_name(cat), calculate_engagement(l, c, v) from fx").collect()
    exp = df.select(C.duration_seconds("d"), C.category_name("cat"), C.engagement_rate("l", "c", "v")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in exp]
    plan = spark.sql("select format_duration(d) from fx")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_duration_seconds_property(spark):
    """Random well-formed durations (any unit may be absent) parse to d*86400+h*3600+m*60+s."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    unit = st.one_of(st.none(), st.integers(min_value=0, max_value=5000))
    cases = []

    @settings(max_examples=400, database=None, derandomize=True)
    @given(unit, unit, unit, unit)
    def collect(d, h, m, s):
        text = "P" + (f"{d}D" if d is not None else "")
        if any(v is not None for v in (h, m, s)):
            text += "T" + "".join(f"{v}{u}" for v, u in ((h, "H"), (m, "M"), (s, "S")) if v is not None)
        cases.append((text, (d or 0) * 86400 + (h or 0) * 3600 + (m or 0) * 60 + (s or 0)))

    collect()
    df = spark.createDataFrame(cases, "x string, expected long")
    bad = df.filter(C.duration_seconds("x").cast("long") != F.col("expected")).collect()
    assert not bad, bad[:5]
