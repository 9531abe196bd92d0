"""Text forms of report values: money, counts, month labels, payment labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"

# Labels shown for the payment codes.
PAYMENT_LABELS = {
    "credit_card": "Tarjeta crédito",
    "boleto": "Boleto",
    "voucher": "Voucher",
    "debit_card": "Tarjeta débito",
    "unknown": "Desconocido",
}


def _swap_separators(text: Column) -> Column:
    return F.translate(text, ",.", ".,")


def money_text(value: Column) -> Column:
    """``R$ 1.234,56``."""
    number = _swap_separators(F.format_number(value, 2))
    return F.coalesce(F.concat(F.lit("R$ "), number), F.lit(f"R$ {DASH}"))


def count_text(value: Column) -> Column:
    """``1.234``, fraction cut off."""
    return F.coalesce(_swap_separators(F.format_number(value.cast("bigint"), 0)), F.lit(DASH))


def score_text(value: Column) -> Column:
    """``4.04 / 5``; a missing or zero score shows a dash."""
    return F.when(F.coalesce(value, F.lit(0)) == 0, DASH).otherwise(F.concat(F.format_number(value, 2), F.lit(" / 5")))


def month_label(day: Column) -> Column:
    return F.date_format(day, "MMM yyyy")


def day_label(day: Column) -> Column:
    return F.date_format(day, "dd MMM yyyy")


def payment_label(code: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in PAYMENT_LABELS.items() for x in pair))
    return F.coalesce(F.try_element_at(known, code), F.initcap(F.replace(code, F.lit("_"), F.lit(" "))))


def period_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1
