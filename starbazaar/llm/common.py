"""What several operators share: reading tables, intermediate tables, walking Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbazaar.session import work_table

#: White space that separates words, as a Java and RE2 character class.
WORD = r"[^\x20\x09-\x0D]+"
#: Of the bit map of ``likely`` (4 MB), and of one row of it.
_BITS, _BUCKET = 1 << 25, 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; survives lost executors."""
    return work_table(df, label)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most_bytes`` at most in each, one row at least."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        begin, held = 0, 0
        for i in range(batch.num_rows):
            held += len(values[i].as_buffer() or b"") if values[i].is_valid else 0
            if held >= most_bytes:
                yield batch.slice(begin, i + 1 - begin)
                begin, held = i + 1, 0
        if begin < batch.num_rows:
            yield batch.slice(begin)


def own_column(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def likely(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``df`` with one more column, the last: whether ``key`` (a 64-bit hash) may be among ``keys``, which has such hashes in its only column.

    Never false for one that is. One bit for a hash goes to every task, ``_BITS`` at most, so that a join that finds few of the rows need not shuffle all.
    """
    (name,), (bucket, bitmap, found) = keys.columns, (own_column(df, c) for c in ("bit_bucket", "bit_map", "likely"))
    place = lambda h: F.pmod(h, F.lit(_BITS))
    maps = keys.select(place(F.col(name)).alias("at")).groupBy(F.expr(f"at div {_BUCKET}").alias(bucket)).agg(
        F.bitmap_construct_agg(F.col("at") % _BUCKET).alias(bitmap))
    at = place(key) % _BUCKET
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (at % 8).cast("int")) == 1
    return df.withColumn(bucket, F.floor(place(key) / _BUCKET)).join(F.broadcast(maps), bucket, "left").select(
        *(F.col(f"`{c}`") for c in df.columns), F.coalesce(bit, F.lit(False)).alias(found))


def digest(*columns: str) -> Column:
    """A key of 128 bits for the values of some columns; null is a value of its own."""
    # Hash functions pass over nulls.
    parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(lane), *parts)), 16, "0") for lane in ("a", "b")))
