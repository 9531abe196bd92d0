"""The nine raw tables as CSV files, landed once as typed Parquet.

Nothing is lost in silence: every column of a file is kept, columns go by each file's own header, a quoted line break is part of its
field in all tables, and whatever can't be used is counted: rows of the wrong width, a quote that its file never closes, bytes that are not UTF-8,
and filled values that their column's type can't hold. The load refuses such files, or reports what it found, as asked.

Every file is read by many tasks, unless it is compressed: then it is read by one. A first look at the lines, split like any text, tells files whose lines are records from those with
quoted line breaks or wrong bytes; the former go to Spark's reader in byte ranges, the records of the latter are found by ``csv_records``.
"""

from __future__ import annotations

import csv
import io
import logging
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbazaar.session import work_path, work_scope
from starbazaar.sources.csv_records import records, survey
from starbazaar.sources.schemas import RAW
from starbazaar.sources.warehouse import metric

log = logging.getLogger(__name__)

# File names of the published dataset, whatever prefix they carry.
FILES = {
    "orders": "*_orders_dataset.csv",
    "customers": "*_customers_dataset.csv",
    "order_items": "*_order_items_dataset.csv",
    "payments": "*_order_payments_dataset.csv",
    "reviews": "*_order_reviews_dataset.csv",
    "products": "*_products_dataset.csv",
    "sellers": "*_sellers_dataset.csv",
    "geolocation": "*_geolocation_dataset.csv",
    "category_xlat": "product_category_name_translation.csv",
}

# Texts that pandas reads as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

CORRUPT, OPEN, BYTES, PROBLEMS = "_corrupt_record", "_open_record", "_wrong_bytes", "_problems"
WRONG_WIDTH, OPEN_QUOTE, NOT_UTF8, UNREADABLE = "wrong_width", "open_quote", "not_utf8", "unreadable"
_LONGEST_HEADER = 1 << 20
_FORMAT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
_PROBLEM = "array<struct<column:string,problem:string,value:string>>"


class CsvProblems(RuntimeError):
    """Files hold rows or values that can't be used. ``found`` has (table, column, problem, count, sample)."""

    def __init__(self, found: list[tuple]):
        super().__init__("; ".join(f"{t}.{c or '*'}: {p} x{n}, such as {s!r}" for t, c, p, n, s in found))
        self.found = found


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _matches(spark: SparkSession, pattern: str) -> list:
    fs, place = _file_system(spark, pattern)
    return sorted(fs.globStatus(place) or [], key=lambda s: s.getPath().toString())


def _part_files(spark: SparkSession, status) -> list[str]:
    if status.isFile():
        return [status.getPath().toString()]
    fs, place = _file_system(spark, status.getPath().toString())
    parts = [s.getPath() for s in fs.listStatus(place) if s.isFile()]
    return sorted(p.toString() for p in parts if not p.getName().startswith(("_", ".")))


def _header(spark: SparkSession, path: str) -> tuple[tuple[str, ...], str] | None:
    """A file's column names and line separator, None for an empty file. Names may hold quoted line breaks."""
    fs, place = _file_system(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(place)
    stream = fs.open(place) if codec is None else codec.createInputStream(fs.open(place))
    try:
        begin = bytes(stream.readNBytes(_LONGEST_HEADER)).decode("utf-8-sig", "surrogateescape")
    finally:
        stream.close()
    if not begin:
        return None
    rows = csv.reader(io.StringIO(begin, newline=""))
    names = tuple(c.strip() for c in next(rows))
    end = list(io.StringIO(begin, newline=""))[rows.line_num - 1]
    if len(begin) >= _LONGEST_HEADER // 4 and not end.endswith(("\n", "\r")):
        raise ValueError(f"{path}: the header does not end")
    if any("\udc80" <= c <= "\udcff" for n in names for c in n):
        raise ValueError(f"{path}: the header is not UTF-8")
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"{path} names a column twice: {', '.join(names)}")
    return names, "\r" if end.endswith("\r") else "\n"


def _from_records(spark: SparkSession, files: list[str], header: tuple[str, ...], separator: str) -> DataFrame:
    """Text columns of files with quoted line breaks or wrong bytes."""
    found = records(spark, files, separator).where((F.col("number") > 1) & F.col("value").rlike(r"\S"))
    # A Windows line end leaves its carriage return before the separator.
    value = F.regexp_replace("value", "\r$", "") if separator == "\n" else F.col("value")
    names = ", ".join(f"`{c.replace('`', '``')}` string" for c in (*header, CORRUPT))
    shown = F.make_valid_utf8(F.col("value"))
    return found.select(F.from_csv(value, names, _FORMAT).alias("fields"), "open", "value").select(
        "fields.*", F.when(F.col("open"), shown).alias(OPEN), F.when(~F.is_valid_utf8("value"), shown).alias(BYTES))


def _texts(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All files under ``path`` as text columns by name, and the record where its width is wrong, its file ends in it or its bytes are no UTF-8.

    Files of one header are read together, so there are as many scans as there are different headers.
    """
    by_header: dict[tuple[tuple[str, ...], str], list[str]] = {}
    for status in _matches(spark, path):
        for part in _part_files(spark, status):
            header = _header(spark, part)
            if header:
                by_header.setdefault(header, []).append(part)
    if not by_header:
        raise FileNotFoundError(f"{name}: nothing to read at {path}")
    parts = []
    for (header, separator), files in by_header.items():
        absent = [f.name for f in RAW[name] if f.name not in header]
        if absent:
            raise ValueError(f"{name}: {files[0]} has no column {', '.join(absent)}")
        plain = survey(spark, files, separator)
        simple = [f for f in files if plain.get(_file_system(spark, f)[1].toUri().getPath())]
        others = [f for f in files if f not in simple]
        if simple:
            schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, CORRUPT)])
            # A reader that skips columns does not notice rows of the wrong width.
            rows = spark.read.schema(schema).option("columnPruning", False).csv(simple, header=True, encoding="UTF-8", **_FORMAT)
            parts.append(rows.withColumns({c: F.lit(None).cast("string") for c in (OPEN, BYTES)}))
        if others:
            parts.append(_from_records(spark, others, header, separator))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _filled(column: str) -> Column:
    text = F.col(f"`{column}`")
    return F.when(~F.trim(text).isin(*MISSING), text)


def _typed(column: str, kind: T.DataType) -> Column:
    value = _filled(column)
    if isinstance(kind, T.IntegerType):
        # A column with gaps may spell its integers with a fraction of zero.
        number = value.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    return value.try_cast("timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else kind)


def read_with_problems(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Every row of a raw table: its own columns typed, any others as text, and the problems it has."""
    texts = _texts(spark, path, name)
    own, marks = RAW[name], {OPEN: OPEN_QUOTE, CORRUPT: WRONG_WIDTH, BYTES: NOT_UTF8}
    others = [c for c in texts.columns if c not in own.names and c not in marks]

    def problem(column: Column, kind: str, value: Column) -> Column:
        return F.struct(column.cast("string").alias("column"), F.lit(kind).alias("problem"), value.alias("value"))

    # Fields of a record that is cut off or has the wrong width say nothing.
    cut = F.col(OPEN).isNotNull()
    # Spark refuses to read the column of wrong records alone, so the condition looks at another one, too.
    wide = ~cut & F.col(CORRUPT).isNotNull() & F.coalesce(CORRUPT, own.names[0]).isNotNull()
    conditions = {OPEN: cut, CORRUPT: wide, BYTES: F.col(BYTES).isNotNull()}
    broken = [F.when(conditions[c], problem(F.lit(None), kind, F.col(c))) for c, kind in marks.items()]
    unread = [F.when(~cut & ~wide & _filled(f.name).isNotNull() & _typed(f.name, f.dataType).isNull(),
                     problem(F.lit(f.name), UNREADABLE, F.col(f"`{f.name}`")))
              for f in own if not isinstance(f.dataType, T.StringType)]
    found = F.filter(F.array(*broken, *unread), lambda p: p.isNotNull()).cast(_PROBLEM)
    # Spark interprets what stands inside of a filter, generated code tells whether a row needs it.
    any_found = reduce(lambda a, b: a | b, (p.isNotNull() for p in (*broken, *unread)))
    found = F.when(any_found, found).otherwise(F.array().cast(_PROBLEM))
    return texts.select(
        *(_typed(f.name, f.dataType).alias(f.name) for f in own), *(_filled(c).alias(c) for c in others), found.alias(PROBLEMS))


def usable(rows: DataFrame) -> DataFrame:
    """The whole rows of the right width; a value that can't be read is NULL."""
    return rows.where(~F.exists(PROBLEMS, lambda p: p.problem.isin(WRONG_WIDTH, OPEN_QUOTE))).drop(PROBLEMS)


def read_csv_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One raw table, what can be used of it, without landing it."""
    return usable(read_with_problems(spark, path, name))


def problems(landed: dict[str, DataFrame]) -> DataFrame:
    """table, column, problem, n and the smallest value of it as a sample, over tables with their problems."""
    # Before a plain explode Spark looks for empty lists, a condition that parses a record again for every field it names.
    parts = [df.select(F.lit(name).alias("table"), F.explode_outer(PROBLEMS).alias("p")).where("p IS NOT NULL").select("table", "p.*")
             for name, df in landed.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("table", "column", "problem").agg(
        F.count("*").alias("n"), F.min(F.left("value", F.lit(80))).alias("sample"))


def data_set_prefix(spark: SparkSession, base: str, prefix: str | None = None) -> str:
    """The one prefix of the files in a folder; files of several data sets need a choice."""
    suffix = FILES["orders"][1:]
    found = sorted({s.getPath().getName().removesuffix(suffix) for s in _matches(spark, f"{base}/*{suffix}")})
    if prefix is not None:
        return prefix
    if len(found) != 1:
        raise ValueError(f"{base} holds {'no data set' if not found else 'several data sets, choose a prefix: ' + ', '.join(found)}")
    return found[0]


def land_raw_data(spark: SparkSession, base: str, folder: str, prefix: str | None = None, metrics: list[dict] | None = None) -> dict[str, DataFrame]:
    """Write each file's table as Parquet under ``folder``; the tables with their problems. ``metrics`` gets a line for each table."""
    chosen = data_set_prefix(spark, base, prefix)

    def land(name: str) -> DataFrame:
        begin = time.perf_counter()
        with work_scope(spark):
            rows, seen = read_with_problems(spark, f"{base}/{FILES[name].replace('*', chosen)}", name), Observation(f"{name}-{uuid.uuid4().hex}")
            rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.size(PROBLEMS)).alias("problems")).write.parquet(f"{folder}/{name}")
        line = metric("extract", name, seen.get["rows"], len(rows.columns) - 1, seen.get["problems"] or 0, time.perf_counter() - begin)
        log.info("%(table)-14s rows=%(rows)d columns=%(columns)d problems=%(problems)d", line)
        if metrics is not None:
            metrics.append(line)
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    with ThreadPoolExecutor(len(FILES)) as pool:
        # A wrapper each: threads of one wrapper would share their scope.
        pending = {name: pool.submit(inheritable_thread_target(spark)(land), name) for name in FILES}
        return {name: result.result() for name, result in pending.items()}


def load_raw_data(spark: SparkSession, data_path: str | None = None, *, prefix: str | None = None,
                  on_problem: str = "refuse", metrics: list[dict] | None = None) -> dict[str, DataFrame]:
    """All nine tables, landed in the shared folder; inside of a ``work_scope`` they are gone when it ends. The folder is the argument, else
    ``RAW_DATA_PATH``, else ``data/raw``.

    ``on_problem`` is ``refuse`` (raise ``CsvProblems``) or ``report`` (log them and go on with what can be used). ``metrics`` gets a line
    for each table, as ``warehouse.load_metrics`` shows them once they are published.
    """
    if on_problem not in ("refuse", "report"):
        raise ValueError(f"on_problem: {on_problem}")
    base = (data_path or os.getenv("RAW_DATA_PATH", "data/raw")).rstrip("/")
    landed = land_raw_data(spark, base, work_path(spark, f"raw-{uuid.uuid4().hex}"), prefix, metrics)
    # A line for each column and kind of problem.
    found = [tuple(r) for r in problems(landed).orderBy("table", "column", "problem").collect()]
    if found and on_problem == "refuse":
        raise CsvProblems(found)
    for line in found:
        log.warning("%s.%s: %s x%d, such as %r", *line)
    return {name: usable(df) for name, df in landed.items()}


def write_csv_tables(tables: dict[str, DataFrame], base: str, prefix: str = "market", compression: str | None = None,
                     max_records_per_file: int = 0) -> None:
    """Write raw tables under the names ``load_raw_data`` looks for (each a folder of part files).

    A compressed file is read by one task, so ``compression`` wants files that are not too long.
    """
    for name, df in tables.items():
        writer = df.write.option("maxRecordsPerFile", max_records_per_file).option("zlib.compress.level", "BEST_SPEED")
        writer.csv(f"{base}/{FILES[name].replace('*', prefix)}", header=True, quote='"', escape='"', compression=compression)
