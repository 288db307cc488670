"""Literal cases of FIXTURES.md §3 for the column functions."""

from pyspark.sql import functions as F

from tidewater.functions import (
    age_years, all_tokens_match, date_part_of, hour_part_of, log_date, log_hour, mask_phone,
    minute_key, remainder_percent, truncated_percent,
)
from tidewater.operators import ingest


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_phone_mask(spark):
    assert one(spark, mask_phone(F.lit("13812345678"))) == "1381*******"
    assert one(spark, mask_phone(F.lit("138"))) == "138*******"
    assert one(spark, mask_phone(F.lit(None).cast("string"))) is None


def test_date_split(spark):
    assert one(spark, date_part_of(F.lit("2020-05-22 00:52:43"))) == "2020-05-22"
    assert one(spark, hour_part_of(F.lit("2020-05-22 00:52:43"))) == "00"


def test_epoch_split_utc(spark):
    assert one(spark, log_date(F.lit(1590080000000))) == "2020-05-21"
    assert one(spark, log_hour(F.lit(1590080000000))) == "16"
    assert one(spark, minute_key(F.lit(1590080000000))) == "16:53"


def test_age_365_day_years(spark):
    assert one(spark, age_years(F.lit("2000-06-01").cast("date"), F.lit("2024-01-01").cast("date"))) == 23
    # born after the as-of date: truncation toward zero, like long division
    assert one(spark, age_years(F.lit("2002-01-01").cast("date"), F.lit("2001-08-01").cast("date"))) == 0


def test_truncating_percent_and_remainder(spark):
    row = spark.range(1).select(
        truncated_percent(F.lit(1), F.lit(3)).alias("a"),
    ).select("a", remainder_percent("a", "a").alias("r")).first()
    assert row["a"] == 33.3
    assert row["r"] == 100 - 33.3 - 33.3 == 33.400000000000006


def test_quoted_number_decodes_with_string_schema(spark):
    df = spark.createDataFrame([('{"id":"1","total_amount":"12.5"}',)], "value string")
    out = ingest.decode_orders(df).first()
    assert out["total_amount"] == 12.5
    typed = df.select(F.from_json("value", "id string, total_amount double").alias("r")).first()["r"]
    assert typed["total_amount"] is None  # a DOUBLE schema loses the quoted number


def test_keyword_all_tokens(spark):
    df = spark.createDataFrame([("red ring",), ("red bolt",), ("Ring, RED!",)], "sku_name string")
    got = sorted(r[0] for r in df.where(all_tokens_match("sku_name", "red ring")).collect())
    assert got == ["Ring, RED!", "red ring"]
    assert df.where(all_tokens_match("sku_name", "")).count() == 0
    assert df.where(all_tokens_match("sku_name", " ,, ")).count() == 0
