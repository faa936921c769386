"""ts_iso against Python's datetime.fromisoformat (wall clock), and the instant with the offset applied."""

from datetime import datetime, timedelta, timezone

from hypothesis import given, settings
from hypothesis import strategies as st

from salespark.functions import time as TS

DATES = ["2026-07-09", "20260709", "2026-W28-4", "2026W284", "2026-W28", "2026W28", "2020-W53-7", "2021-W53-1", "2026-W00-1",
         "2026-02-30", "20260230", "0000-01-01", "0000-W01-1", "9999-12-31", "2026-W54-1", "2026-W28-8"]
TIMES = ["", "T10:30:00", "T103000", "x1030", " 10:30:00", " 103000", "T10", "T10:30", "T1030", "T10:30:00.5", "T10:30:00,123456789",
         "T103000.25", "T24:00:00", "T10:60", "T1", "T10:3", "\n10:30:00", "T10:30:00Z", "T103000Z", "T10:30:00+05:30", "T10:30-0330",
         "T10+14", "T10:30:00.1+00:00:30", "T10:30:00+24:00"]
ODD = ["", " ", "garbage", "corrupted-timestamp", "2026", "2026-07", "2026-7-9", " 2026-07-09", "2026-07-09T", "Z", "2026-07-09Z"]


def python_iso(s):
    try:
        return datetime.fromisoformat(s)
    except ValueError:
        return None


def spark_iso(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    wall = df.select("i", "s", TS.ts_iso("s").alias("t"))
    return [(r.t, r.u) for r in wall.select("i", "t", TS.instant("t", "s").alias("u")).orderBy("i").collect()]


def agree(spark, texts):
    for s, (wall, utc) in zip(texts, spark_iso(spark, texts)):
        want = python_iso(s)
        assert wall == (None if want is None else want.replace(tzinfo=None)), s
        if want is not None and want.year not in (1, 9999):
            offset = want.utcoffset() or timedelta(0)
            assert utc == want.replace(tzinfo=None) - timedelta(seconds=int(offset.total_seconds())), s


def test_every_date_with_every_time(spark):
    agree(spark, [d + t for d in DATES for t in TIMES] + ODD)


def test_null_has_no_time(spark):
    assert spark_iso(spark, [None])[0][0] is None


days = st.dates().map(lambda d: [d.isoformat(), d.strftime("%Y%m%d").zfill(8), "{}-W{:02d}-{}".format(str(d.isocalendar()[0]).zfill(4), *d.isocalendar()[1:])])
clocks = st.builds(lambda t, ext, frac, off: (t.strftime("%H:%M:%S") if ext else t.strftime("%H%M%S")) + frac + off,
                   st.times(), st.booleans(), st.sampled_from(["", ".5", ",123456", ".000001"]),
                   st.sampled_from(["", "Z", "+05:30", "-0300", "+00"]))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(days, st.integers(0, 2), st.sampled_from("T x-:"), clocks), min_size=20, max_size=20))
def test_generated(spark, parts):
    agree(spark, [d[k] + sep + c for d, k, sep, c in parts])


def test_sql_pattern(spark):
    df = spark.createDataFrame([("2026-07-09 10:30:00",), ("2026-07-09T10:30:00",), ("x",)], "s string")
    got = [r.t for r in df.select(TS.ts_pattern("s").alias("t")).collect()]
    assert got == [datetime(2026, 7, 9, 10, 30), None, None]


def test_minute_bucket_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2026-03-08 02:30:45' AS t")
        assert df.select(TS.minute_bucket("t").alias("m")).first().m == datetime(2026, 3, 8, 2, 30)
        back = df.select(TS.instant_to_ntz(TS.ntz_to_instant("t")).alias("b")).first().b
        assert back == datetime(2026, 3, 8, 2, 30, 45)
        assert spark_iso(spark, ["2026-03-08T04:30:00+02:00"])[0][1] == datetime(2026, 3, 8, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_instant_is_in_utc():
    assert datetime(2026, 7, 9, 10, 30, tzinfo=timezone(timedelta(hours=5, minutes=30))).astimezone(timezone.utc).hour == 5
