"""Column functions on literal rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clickloom.functions import (
    if_,
    is_available,
    is_distinct,
    line_value,
    local_date,
    local_datetime,
    micros_to_seconds,
    param,
    param_num,
    parse_day,
    plain_double,
    shard_day,
    shard_name,
    single_valued,
    utc_date,
)
from clickloom.functions.clock import before_day_after, ntz_to_micros
from clickloom.schemas import SHARD


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def params_frame(spark, *lists):
    schema = SHARD["event_params"].dataType
    return spark.createDataFrame([(x,) for x in lists], f"p {schema.simpleString()}")


def entry(key, s=None, i=None, f=None, d=None):
    return (key, (s, i, f, d))


def test_param_lookup(spark):
    df = params_frame(
        spark, [entry("a", s="x"), entry("b", i=3)], [], None, [entry("b", f=1.5)], [entry("b", d=2.5)], [entry("b")]
    )
    got = df.select(param(F.col("p"), "a", "string_value"), param_num(F.col("p"), "b")).collect()
    assert [tuple(r) for r in got] == [("x", 3.0), (None, None), (None, None), (None, 1.5), (None, 2.5), (None, None)]


def test_param_num_prefers_int_then_float(spark):
    df = params_frame(spark, [entry("b", i=1, f=2.0, d=3.0)], [entry("b", f=2.0, d=3.0)])
    assert [r[0] for r in df.select(param_num(F.col("p"), "b")).collect()] == [1.0, 2.0]


def test_repeated_key_raises_only_when_wanted(spark):
    df = params_frame(spark, [entry("a", s="x"), entry("a", s="y"), entry("b", i=3)])
    assert df.select(single_valued(F.col("p"), ["b"], param_num(F.col("p"), "b")).alias("v")).first()["v"] == 3.0
    with pytest.raises(Exception, match="more than one value for one of the parameters a, b"):
        df.select(single_valued(F.col("p"), ["a", "b"], param_num(F.col("p"), "b"))).collect()


def test_days_and_shards(spark):
    assert shard_day("2024-01-05") == "20240105"
    assert shard_name("2024-01-05") == "events_20240105"
    assert one(spark, parse_day(F.lit("20240229"))) == date(2024, 2, 29)
    with pytest.raises(ValueError):
        shard_day("20240105x")
    with pytest.raises(Exception, match="2024013x|parse"):
        spark.createDataFrame([("2024013x",)], "s string").select(parse_day(F.col("s"))).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 2024-07-01 16:30 UTC is already July 2nd in Seoul.
        micros = 1_719_851_400_000_000
        df = spark.createDataFrame([(micros,)], "m bigint")
        instant = F.timestamp_micros("m")
        wall = F.expr("TIMESTAMP_NTZ'2024-07-01 16:30:00'")
        row = df.select(
            local_datetime(F.col("m")), local_date(instant), utc_date(instant), ntz_to_micros(wall)
        ).first()
        assert tuple(row) == (datetime(2024, 7, 2, 1, 30), date(2024, 7, 2), date(2024, 7, 1), micros)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_coarse_limit_never_cuts_a_wanted_row(spark):
    start = 1_705_190_400_000_000  # 2024-01-14 00:00 UTC
    df = spark.range(96).select((F.col("id") * 3_600_000_000 + start).alias("m")).withColumn("t", F.timestamp_micros("m"))
    exact = local_date(F.col("t")) <= F.lit(date(2024, 1, 15))
    assert df.where(exact & ~before_day_after(F.col("t"), "Asia/Seoul", "2024-01-15")).isEmpty()


def test_division_goes_towards_zero(spark):
    df = spark.createDataFrame([(1_999_999,), (-1_999_999,), (0,)], "m bigint")
    assert [r[0] for r in df.select(micros_to_seconds(F.col("m"))).collect()] == [1, -1, 0]


def test_null_rules(spark):
    assert one(spark, if_(F.lit(None).cast("boolean"), 1, 2)) == 2
    null = F.lit(None).cast("int")
    assert one(spark, is_distinct(null, null)) is False
    assert one(spark, is_distinct(null, F.lit(1))) is True
    day = F.lit(date(2024, 1, 1))
    assert one(spark, is_available(F.lit(1), day)) == "true"
    assert one(spark, is_available(F.lit(0), day)) == "false"
    assert one(spark, is_available(null, day)) == "false"
    assert one(spark, is_available(F.lit(1), F.lit(None).cast("date"))) == "false"


def test_line_value_divides_exactly(spark):
    assert one(spark, line_value(F.lit(2500), F.lit(3))) == 7.5


@pytest.mark.parametrize(
    "value, text",
    [
        (12_500_000.0, "12500000.0"),
        (12_345_678.9, "12345678.9"),
        (1.0, "1.0"),
        (-98_765_432.125, "-98765432.125"),
        (0.00025, "0.00025"),
        (0.5, "0.5"),
        (9_007_199_254_740_993.0, "9007199254740992.0"),
        (1e20, "1.0E20"),
    ],
)
def test_plain_double(spark, value, text):
    got = spark.createDataFrame([(value,)], "v double").select(plain_double(F.col("v")).alias("t")).first()["t"]
    assert got == text
    assert float(got) == value
