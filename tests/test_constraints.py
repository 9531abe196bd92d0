"""Rows beyond the first of each key."""

import collections

import pytest

from starbazaar.operators.constraints import _repeats, _unique_report
from starbazaar.sources.schemas import STAR

LAST = (1 << 63) - 1


@pytest.mark.parametrize("kind", ["bigint", "int", "smallint", "string"])
def test_repeats_of_keys_of_any_kind(spark, kind):
    wide = [LAST, LAST, LAST - 1, -LAST - 1, -LAST - 1] if kind == "bigint" else []
    keys = [0, 0, 0, 63, 63, 64, -1, -1, -64, -65, 127, 128, 9_999, None, None, *range(200, 500), *range(450, 520), *wide]
    df = spark.createDataFrame([(None if k is None else str(k),) for k in keys], "k string").selectExpr(f"cast(k AS {kind}) AS k").repartition(3)
    expected = sum(n - 1 for k, n in collections.Counter(keys).items() if k is not None)
    assert _repeats(df, "k").first().violations == expected


def test_no_rows_have_no_repeats(spark):
    for kind in ("bigint", "string"):
        assert _repeats(spark.createDataFrame([], f"k {kind}"), "k").first().violations == 0


def test_generated_keys_move_a_row_for_64_keys(spark):
    """Keys of one block are one row before the shuffle."""
    keys = spark.range(0, 6_400, 1, 2).toDF("customer_key")
    text = _unique_report(keys, STAR["dim_customer"], "customer_key", "primary_key")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in text and "hashpartitioning(customer_key" not in text, text
