import datetime as dt

from conftest import plan_text
from pyspark.sql import functions as F

from siftkit.functions.channels import local_date_at_least, local_datetime, utc_wall_clock


def _instants(spark):
    texts = ["2024-11-03T05:30:00Z", "2024-11-03T06:30:00.123456Z", "2024-03-10T07:30:00Z", None]
    return spark.createDataFrame([(t,) for t in texts], "s string").select(F.to_timestamp("s").alias("datetime"))


def test_instants_keep_apart_in_a_zone_with_clock_changes(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = _instants(spark)
        utc = utc_wall_clock(F.col("datetime"), df.schema["datetime"].dataType)
        got = [r[0] for r in df.select(utc.cast("string")).collect()]
        assert got == ["2024-11-03 05:30:00", "2024-11-03 06:30:00.123456", "2024-03-10 07:30:00", None]
        local = [r[0] for r in df.select(local_datetime(utc, "America/New_York").cast("string")).collect()]
        assert local == ["2024-11-03 01:30:00", "2024-11-03 01:30:00.123456", "2024-03-10 03:30:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bound_reaches_the_scan_for_instants(spark, tmp_path):
    path = str(tmp_path / "t")
    _instants(spark).write.parquet(path)
    df = spark.read.parquet(path)
    cut = df.filter(local_date_at_least(F.col("datetime"), df.schema["datetime"].dataType, dt.date(2024, 11, 3), "+07:00"))
    pushed = [x for x in plan_text(cut).splitlines() if "PushedFilters" in x]
    assert any("GreaterThanOrEqual(datetime" in x for x in pushed)
    assert cut.count() == 2
    late = df.filter(local_date_at_least(F.col("datetime"), df.schema["datetime"].dataType, dt.date(2024, 11, 4), "Asia/Tokyo"))
    assert late.count() == 0
