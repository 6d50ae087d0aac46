import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillhouse.functions import dates, text
from rillhouse.operators.windows import union_flagged, windowed_agg


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_dates(spark):
    assert one(spark, dates.date_text(F.lit("2024-02-29 23:59:59"))) == "2024-02-29"
    assert one(spark, dates.date_text(F.lit("soon"))) is None
    assert one(spark, dates.millis_date_text(F.lit(1704067199999))) == "2023-12-31"
    assert one(spark, dates.millis_to_seconds_ts(F.lit(1704067199999))) == dt.datetime(2023, 12, 31, 23, 59, 59)
    assert one(spark, dates.add_days_text(F.lit("2024-03-01"), -1)) == "2024-02-29"
    assert one(spark, dates.seconds_between(F.lit("2024-01-01 00-00-00"), F.lit("2024-01-01 00-01-05"))) == 65
    assert one(spark, dates.days_between(F.lit("2024-01-01"), F.lit("2023-12-25"))) == -7
    assert one(spark, dates.number(F.lit("3.7"))) == 3.7
    assert one(spark, dates.number(F.lit("x"), "bigint")) is None


def test_tokenize(spark):
    df = spark.createDataFrame([("Apple iPhone-15, Été!",), ("...",), (None,), ("",)], "t string")
    assert [r.keyword for r in text.explode_words(df, "t").collect()] == ["apple", "iphone", "15", "été"]


def test_longest_match_segmenter(spark):
    split = text.segment_with(text.longest_match(["苹果", "苹果手机", "手机壳"]))
    df = spark.createDataFrame([("苹果手机 Pro15壳",), (None,), ("！",)], "t string")
    assert [r.keyword for r in text.explode_words(df, "t", split=split).collect()] == ["苹果手机", "pro15", "壳"]


def test_split_keywords_in_sql(spark):
    ask = lambda: [r.x for r in spark.sql(
        "SELECT splitKeywords(t) AS x FROM VALUES ('Red Pen!'), ('...'), (NULL) AS v(t)").collect()]
    text.register_split_keywords(spark)
    assert ask() == ["red,pen", "", None]
    text.register_split_keywords(spark, text.longest_match(["red pen"]))
    assert ask() == ["red,pen", "", None]


def test_observed_metrics_come_with_the_write(spark):
    from rillhouse.live.run import observed
    df, watch = observed(spark.range(10), F.count("*").alias("n"), F.max("id").alias("top"))
    df.write.format("noop").mode("overwrite").save()
    assert watch.get == {"n": 10, "top": 9}


def test_window_date_from_end_and_bad_choice(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 55), 2)], "ts timestamp, n int")
    agg = [F.sum("n").alias("n")]
    start = windowed_agg(df, "ts", "10 seconds", agg).first()
    end = windowed_agg(df, "ts", "10 seconds", agg, date_from="end").first()
    assert (start.startTime, start.endTime) == ("2024-01-01 23:59:50", "2024-01-02 00:00:00")
    assert (start.date, end.date) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    with pytest.raises(ValueError):
        windowed_agg(df, "ts", "10 seconds", agg, date_from="middle")


def test_union_flagged_fills_missing_flags_with_zero(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(1).withColumn("y", F.lit(2))
    assert sorted((r.x, r.y) for r in union_flagged(a, b).collect()) == [(0, 2), (1, 0)]
