import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starbazaar.operators.dedupe import dominant_payment, duplicated_rows, first_per_key, latest_review
from starbazaar.operators.numbering import group_medians, tile, with_position, with_surrogate_key


@pytest.mark.parametrize("rows", [0, 1, 2, 5, 7, 59])
def test_tile_equals_the_window_function(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") % 3).alias("tie"))
    order = {"tie": F.col("tie"), "id": F.col("id")}
    ours = df.select("id", *(tile(df, k, order).alias(f"t{k}") for k in (1, 3, 4)))
    window = Window.orderBy("tie", "id")
    theirs = df.select("id", *(F.ntile(k).over(window).alias(f"t{k}") for k in (1, 3, 4)))
    assert ours.exceptAll(theirs).count() == 0 and ours.count() == rows


def test_positions_are_dense_although_a_third_of_the_rows_tie(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("value"), "id")
    placed = with_position(df, ["value", "id"])
    window = Window.orderBy("value", "id")
    expected = df.withColumn("position", F.row_number().over(window).cast("bigint") - 1)
    assert placed.exceptAll(expected).count() == 0


def test_a_hot_value_spreads_over_partitions(spark):
    """With a unique last column, even one value shared by all rows is not sorted by a single task."""
    from starbazaar.operators.numbering import _sorted_layout
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout = _sorted_layout(spark.range(20_000).select(F.lit(1).alias("value"), "id"), ["value", "id"], "hot")
        sizes = [r["count"] for r in layout.groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 10_000


def test_surrogate_keys_follow_the_natural_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "natural string, v int")
    keyed = with_surrogate_key(df, "natural", "key").orderBy("key").collect()
    assert [(r["key"], r["natural"]) for r in keyed] == [(1, "a"), (2, "b"), (3, "c")]


def test_group_medians(spark):
    rows = [("even", v, 1.0) for v in (1.0, 2.0, 3.0, 10.0)] + [("odd", v, v) for v in (5.0, None, 1.0, 9.0)]
    rows += [("none", None, 4.0), ("nothing", None, None)]
    medians = group_medians(spark.createDataFrame(rows, "k string, v double, w double"), "k", ["v", "w"]).collect()
    assert {r["k"]: (r["v"], r["w"]) for r in medians} == {"even": (2.5, 1.0), "odd": (5.0, 5.0), "none": (None, 4.0)}


def test_group_medians_with_a_hot_group(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.when(F.col("id") % 4 == 0, 3.0).otherwise((F.hash("id") % 1000).cast("double")).alias("v"))
    expected = df.groupBy("k").agg(F.median("v").alias("v"))
    assert group_medians(df, "k", ["v"]).exceptAll(expected).count() == 0


def test_first_per_key_ignores_row_order(spark):
    rows = [("a", "y", 1), ("a", "x", 2), (None, "z", 3), (None, "q", 4)]
    for data in (rows, rows[::-1]):
        kept = first_per_key(spark.createDataFrame(data, "k string, s string, n int"), "k").collect()
        assert {(r["k"], r["s"], r["n"]) for r in kept} == {("a", "x", 2), (None, "q", 4)}


def test_fullest_row_wins(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 9)], "k string, s string, n int")
    assert first_per_key(df, "k").first()["n"] == 1
    assert first_per_key(df, "k", fullest=True).first()["n"] == 9


def test_dominant_payment(raw):
    best = dominant_payment(raw["payments"]).collect()
    assert [(r["payment_value"], r["payment_type"], r["payment_installments"]) for r in best] == [
        (30, "credit_card", 3)]


def test_latest_review(raw):
    assert [r["review_score"] for r in latest_review(raw["reviews"]).collect()] == [5]


def test_duplicated_rows_counts_null_keys_as_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert sorted(str(r["k"]) for r in duplicated_rows(df, "k").collect()) == ["None", "None", "a", "a"]
