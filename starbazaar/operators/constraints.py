"""Constraint checks of the star schema. Spark enforces none of them, so they are counted.

Row-level rules (required, domain, check) are counted in one pass per table. A write counts them as it goes, so that nothing is
built a second time for rules that are broken. Uniqueness and references combine per key before any shuffle,
so a key that holds a third of the fact shrinks to one row per task first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbazaar.sources.schemas import SMALL, STAR, Table

REPORT_COLUMNS = ["table", "constraint", "column", "violations"]


def row_rules(table: Table) -> dict[tuple[str, str], Column]:
    """(constraint, column) -> expression that is true for a violating row."""
    rules: dict[tuple[str, str], Column] = {}
    for c in table.columns:
        value = F.col(c.name)
        if c.required:
            rules["not_null", c.name] = value.isNull()
        if c.max_length is not None:
            rules["max_length", c.name] = F.length(value) > c.max_length
        if c.type == SMALL:
            rules["range", c.name] = ~value.between(-32768, 32767)
        if isinstance(c.type, T.DecimalType):
            limit = 10 ** (c.type.precision - c.type.scale)
            rules["range", c.name] = F.abs(F.round(value, c.type.scale)) >= limit
    for name, (column, holds) in table.checks.items():
        rules[name, column] = ~holds(F.col(column))
    return rules


def row_counts(table: Table) -> list[Column]:
    """One violation count per rule, as aggregates."""
    return [F.count_if(rule).alias(f"{constraint}:{column}")
            for (constraint, column), rule in row_rules(table).items()]


def broken_rules(table: Table, without: str | None = None) -> Column:
    """The rules a row breaks as bits of one number, 0 for a sound row. Rules of the column ``without``, which is yet to come, are not broken."""
    bits = (F.when(rule, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            for i, ((_, column), rule) in enumerate(row_rules(table).items()) if column != without)
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def broken_counts(table: Table, broken: str) -> list[Column]:
    """One violation count per rule, as aggregates over the bits of ``broken_rules``."""
    return [F.count_if(F.col(broken).bitwiseAND(F.lit(1 << i).cast("bigint")) != 0).alias(f"{constraint}:{column}")
            for i, (constraint, column) in enumerate(row_rules(table))]


def _row_report(df: DataFrame, table: Table) -> DataFrame:
    counts = df.agg(*row_counts(table))
    lines = F.explode(F.array(*(
        F.struct(F.lit(constraint).alias("constraint"), F.lit(column).alias("column"),
                 F.col(f"`{constraint}:{column}`").alias("violations"))
        for constraint, column in row_rules(table)
    )))
    return counts.select(lines.alias("line")).select(F.lit(table.name).alias("table"), "line.*")


def _repeats(df: DataFrame, column: str) -> DataFrame:
    """One row: ``violations``, the rows beyond the first of each key; NULL keys are left out.

    Whole numbers are counted in blocks of 64 keys, one bit a key: numbers that lie close together, as generated keys do, are a row
    for each block and task before the shuffle, and others move no more rows than there are keys.
    """
    present = df.where(F.col(column).isNotNull())
    if isinstance(df.schema[column].dataType, T.IntegralType):
        key = F.col(column).cast("bigint")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
        beyond = present.groupBy(F.shiftright(key, 6).alias("block")).agg(
            (F.count("*") - F.bit_count(F.bit_or(bit))).alias("n"))
    else:
        beyond = present.groupBy(column).agg(F.count("*").alias("n")).where("n > 1").select((F.col("n") - 1).alias("n"))
    return beyond.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def _unique_report(df: DataFrame, table: Table, column: str, constraint: str) -> DataFrame:
    """Rows beyond the first of each key. NULL keys are left to the not-null rule, as in SQL."""
    return _repeats(df, column).select(
        F.lit(table.name).alias("table"), F.lit(constraint).alias("constraint"), F.lit(column).alias("column"),
        "violations",
    )


def reference_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row: ``rows`` of the child and how many of them are ``orphans``, without a parent of that key.

    NULL equals NULL here. Both sides go through one grouping by key instead of a join: each is combined per
    task and shuffled once, a key with very many rows arrives as one row per task, and nothing is sorted.
    """
    keys = child.select(F.col(column).alias("_key"), F.lit(False).alias("_parent")).unionByName(
        parent.select(F.col(parent_column).alias("_key"), F.lit(True).alias("_parent")))
    per_key = keys.groupBy("_key").agg(
        F.count_if(~F.col("_parent")).alias("n"), F.bool_or("_parent").alias("_known"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~F.col("_known"), F.col("n"))), F.lit(0)).alias("orphans"))


def _reference_report(child: DataFrame, parent: DataFrame, table: Table, column: str, target: Table) -> DataFrame:
    present = child.where(F.col(column).isNotNull())
    return reference_count(present, column, parent, target.primary_key).select(
        F.lit(table.name).alias("table"), F.lit("foreign_key").alias("constraint"),
        F.lit(column).alias("column"), F.col("orphans").alias("violations"))


def key_report(star: dict[str, DataFrame], *, own_keys: bool = False) -> DataFrame:
    """Uniqueness and references for the tables present.

    ``own_keys=True`` is for a star whose surrogate keys this package assigned and looked up itself. Those
    numbers are unique and their references hold by construction; proving it again would shuffle the fact
    once per key. The natural keys are checked always.
    """
    parts = []
    for name, df in star.items():
        if name not in STAR:  # derived from the fact
            continue
        table = STAR[name]
        if not own_keys:
            parts.append(_unique_report(df, table, table.primary_key, "primary_key"))
            parts += [
                _reference_report(df, star[target], table, column, STAR[target])
                for column, target in table.foreign_keys.items() if target in star
            ]
        parts += [_unique_report(df, table, column, "unique") for column in table.unique]
    return reduce(DataFrame.unionByName, parts)


def validate(star: dict[str, DataFrame]) -> DataFrame:
    """All rules of all tables: table, constraint, column, violations."""
    row_parts = [_row_report(df, STAR[name]) for name, df in star.items() if name in STAR]
    return reduce(DataFrame.unionByName, [*row_parts, key_report(star)]).select(REPORT_COLUMNS)
