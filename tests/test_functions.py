"""Column tests on small literal frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ordersmith.functions import (
    canonical_status,
    clean,
    clean_upper,
    invalid_country,
    invalid_currency,
    map_fulfillment_channel,
    map_status,
    round_money,
    safe_ratio,
    source_file_date,
)


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_clean_strips_unicode_whitespace(spark):
    got = col_values(spark, ["\tA-1\n", " x　", "  ", "", None, " a b "], clean)
    assert got == ["A-1", "x", None, None, None, "a b"]


def test_clean_upper(spark):
    assert col_values(spark, [" eur\n", "Usd", " "], clean_upper) == ["EUR", "USD", None]


def test_map_status(spark):
    raw = ["canceled", "Cancelled", "complete", "COMPLETED", " pending ", "refunded", "Returned", "shipped",
           "unshipped", "partially_refunded", "", None]
    got = col_values(spark, raw, lambda c: map_status(clean(c)))
    assert got == ["CANCELLED", "CANCELLED", "COMPLETED", "COMPLETED", "PENDING", "REFUNDED", "RETURNED",
                   "SHIPPED", "UNSHIPPED", "PARTIALLY_REFUNDED", None, None]


def test_canonical_status_keeps_blank(spark):
    got = col_values(spark, ["CANCELED", "complete", " x ", "", None], canonical_status)
    assert got == ["CANCELLED", "COMPLETED", "X", "", None]


def test_channel(spark):
    got = col_values(spark, ["afn", "MFN", "fbx", " ", None], lambda c: map_fulfillment_channel(clean(c)))
    assert got == ["AMAZON", "MERCHANT", "FBX", None, None]


def test_source_file_date(spark):
    got = col_values(spark, ["r/2025-06-02.tsv", "a2025-06-02b2025-07-01", "undated", "2025-13-45", "", None],
                     source_file_date)
    assert got == [dt.date(2025, 6, 2), dt.date(2025, 6, 2), None, None, None, None]


def test_format_checks(spark):
    got = col_values(spark, ["EUR", "EU1", "EURO", None, "EU\n"], invalid_currency)
    assert got == [False, True, True, False, True]
    assert col_values(spark, ["DE", "DEU", None], invalid_country) == [False, True, False]


def test_round_money_half_away_from_zero(spark):
    got = col_values(spark, [2.675, -2.345, 0.0, None], lambda c: round_money(c.cast("decimal(38,9)")), "double")
    assert got == [Decimal("2.680000000"), Decimal("-2.350000000"), Decimal("0E-9"), None]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 3)], "a bigint, b bigint")
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None]
