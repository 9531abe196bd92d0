from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starbazaar.functions import presentation as show
from starbazaar.functions import scalars


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("later, days", [
    ("2017-01-01 12:00:00", None), ("2017-01-02 23:59:59", 0), ("2017-01-03 00:00:00", 1),
    ("2017-01-02 00:00:00", 0), (None, None), ("2018-01-02 00:00:00", 365),
])
def test_whole_days(spark, later, days):
    assert one(spark, scalars.whole_days(ntz(later), ntz("2017-01-02 00:00:00"))) == days


def test_whole_days_ignores_the_session_zone(spark):
    """A day with a clock change still has 24 hours between zone-free timestamps."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        days = one(spark, scalars.whole_days(ntz("2017-03-27 00:00:00"), ntz("2017-03-25 00:00:00")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert days == 2


@pytest.mark.parametrize("text, padded", [("123", "00123"), ("12345", "12345"), ("123456", "123456"), (None, None)])
def test_zero_pad_never_truncates(spark, text, padded):
    assert one(spark, scalars.zero_pad(F.lit(text).cast("string"))) == padded


def test_date_key(spark):
    assert one(spark, scalars.date_key(ntz("2017-03-09 10:00:00"))) == 20170309
    assert one(spark, scalars.date_key(ntz(None))) == -1


@pytest.mark.parametrize("day, weekday", [(date(2021, 1, 3), 7), (date(2021, 1, 4), 1), (date(2021, 1, 2), 6)])
def test_iso_weekday(spark, day, weekday):
    assert one(spark, scalars.iso_weekday(F.lit(day))) == weekday


def test_is_late_has_three_values(spark):
    def late(days, delivered):
        return one(spark, scalars.is_late(
            F.lit(days).cast("int"), ntz(delivered), ntz("2017-02-01 00:00:00")))
    assert late(3, "2017-02-01 14:00:00") is True
    assert late(3, "2017-02-01 00:00:00") is False
    assert late(None, "2017-02-01 14:00:00") is None


@pytest.mark.parametrize("dearer, average", [(4_999_600, "1.00"), (5_000_000, "1.01")])
def test_exact_avg_rounds_once(spark, dearer, average):
    """Means 1.0049996 and 1.005; rounding the first at six digits on the way would give 1.01."""
    price = F.when(F.col("id") < dearer, F.lit("1.01")).otherwise(F.lit("1.00")).cast("decimal(10,2)")
    rows = spark.range(10_000_000).select(price.alias("price"))
    assert rows.agg(scalars.exact_avg(F.col("price"), 2).alias("a")).first()["a"] == Decimal(average)


def test_percentages_of_nothing_are_null(spark):
    assert one(spark, scalars.percent_rows(F.lit(0), F.lit(0), 1)) is None
    assert one(spark, scalars.percent(F.lit(Decimal("1.00")), F.lit(Decimal("0.00")), 1)) is None
    assert one(spark, scalars.percent_rows(F.lit(1), F.lit(3), 2)) == Decimal("33.33")


@pytest.mark.parametrize("value, text", [
    (Decimal("1234567.891"), "R$ 1.234.567,89"), (Decimal("0.5"), "R$ 0,50"), (None, "R$ —")])
def test_money_text(spark, value, text):
    assert one(spark, show.money_text(F.lit(value).cast("decimal(12,3)"))) == text


@pytest.mark.parametrize("value, text", [(1234.9, "1.234"), (0.0, "0"), (None, "—")])
def test_count_text(spark, value, text):
    assert one(spark, show.count_text(F.lit(value).cast("double"))) == text


@pytest.mark.parametrize("value, text", [(4.04, "4.04 / 5"), (None, "—"), (0.0, "—")])
def test_score_text(spark, value, text):
    assert one(spark, show.score_text(F.lit(value).cast("decimal(4,2)"))) == text


@pytest.mark.parametrize("code, label", [
    ("credit_card", "Tarjeta crédito"), ("unknown", "Desconocido"), ("gift_card", "Gift Card")])
def test_payment_label(spark, code, label):
    assert one(spark, show.payment_label(F.lit(code))) == label


def test_labels_and_period(spark):
    assert one(spark, show.month_label(F.lit(date(2017, 2, 1)))) == "Feb 2017"
    assert one(spark, show.day_label(F.lit(date(2017, 2, 1)))) == "01 Feb 2017"
    assert one(spark, show.period_days(F.lit(date(2017, 1, 1)), F.lit(date(2017, 1, 31)))) == 31


def test_status_and_severity(spark):
    assert one(spark, scalars.status_label(F.lit(0))) == "✓ ok"
    assert one(spark, scalars.status_label(F.lit(2))) == "✗ ALERTA"
    ranks = [one(spark, scalars.severity_rank(F.lit(s))) for s in ("alta", "media", "baja", "?")]
    assert ranks == [0, 1, 2, None]


def test_timestamps_keep_their_clock_time(spark):
    assert one(spark, ntz("2017-03-26 02:30:00")) == datetime(2017, 3, 26, 2, 30)
