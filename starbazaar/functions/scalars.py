"""Column expressions shared by the plans. All stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_DATE_KEY = -1
EXCLUDED_STATUSES = ("canceled", "unavailable")


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer, -1 for an unknown day."""
    number = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.coalesce(number, F.lit(UNKNOWN_DATE_KEY)).cast("int")


def month_number(day: Column) -> Column:
    """YYYYMM as an integer."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def whole_days(later: Column, earlier: Column) -> Column:
    """Completed 24-hour periods between two zone-free timestamps; NULL when they are in the wrong order."""
    return F.when(later >= earlier, F.extract(F.lit("DAY"), later - earlier)).cast("int")


def zero_pad(text: Column, width: int = 5) -> Column:
    """Pad with zeros on the left. Longer values keep all their characters, unlike ``lpad``."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + 1


def is_late(delivery_days: Column, delivered: Column, promised: Column) -> Column:
    """True, false, or NULL when there is no usable delivery."""
    return F.when(delivery_days.isNotNull(), F.coalesce(delivered > promised, F.lit(False)))


def revenue() -> Column:
    """What a buyer pays for one item."""
    return F.col("price") + F.col("freight_value")


def counted_sale() -> Column:
    return ~F.col("order_status").isin(*EXCLUDED_STATUSES)


def exact_avg(value: Column, scale: int) -> Column:
    """Average rounded half up. The cast makes Spark keep 12 digits, so its own rounding does not show."""
    return F.round(F.avg(value.cast("decimal(28,8)")), scale)


def percent(part: Column, whole: Column, scale: int) -> Column:
    """100 * part / whole for money, NULL for an empty whole. The casts leave 14 digits before rounding."""
    ratio = F.try_divide((part.cast("decimal(22,2)") * 100).cast("decimal(24,2)"), whole.cast("decimal(22,2)"))
    return F.round(ratio, scale)


def percent_rows(part: Column, whole: Column, scale: int) -> Column:
    """As ``percent`` for row counts."""
    return F.round(F.try_divide((part * 100).cast("decimal(20,0)"), whole.cast("decimal(20,0)")), scale)


def category_name() -> Column:
    return F.coalesce("category_name_en", "category_name_pt", F.lit("uncategorized"))


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "alta", 0).when(severity == "media", 1).when(severity == "baja", 2)


def status_label(count: Column) -> Column:
    return F.when(count == 0, "✓ ok").otherwise("✗ ALERTA")
