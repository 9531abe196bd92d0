"""The records of CSV files, read in byte ranges.

Only the text before a byte range tells whether the range begins inside a quoted field. A line, however, does one of a few things whatever comes
before it: it takes "outside" to one state and "inside" to another. These maps compose, so the lines of every stretch of a range are combined on their
own for both possible beginnings, the stretches of a file are lined up (one small row each), and then every line knows its state and the number
of the record it belongs to. A stretch has ``1 << STRETCH`` lines at most, so that the lines of one range are sorted by many tasks. Lines that are a record of their own stay where they are; only the lines of longer records are brought
together. A quote inside an unquoted field, or after the closing quote, is text.

A record that the end of its file leaves open is not put together: its first line stands for it.
"""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starbazaar.session import work_table

# A field that is followed by another one; a closed quoted field. Possessive, so that Java takes them in a loop.
_FIELD = r'\G(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?,'
_CLOSED = r'^"[^"]*+(?:""[^"]*+)*+"'
STRETCH = 16


def _quoted(line: Column) -> Column:
    return F.contains(line, F.lit('"'))


def leaves_open(line: Column) -> Column:
    """Whether a line that begins outside of quotes ends inside a quoted field."""
    last = F.regexp_replace(line, F.lit(_FIELD), F.lit(""))
    return F.when(_quoted(line), last.startswith('"') & ~last.rlike(_CLOSED)).otherwise(F.lit(False))


def stays_open(line: Column) -> Column:
    """Whether a line that begins inside a quoted field ends inside one: it is like a line with a quote before it."""
    return F.when(_quoted(line), leaves_open(F.concat(F.lit('"'), line))).otherwise(F.lit(True))


def lines(spark: SparkSession, files: list[str], separator: str = "\n") -> DataFrame:
    """file, block (the begin of the byte range that was read), at (ascending within the range) and value of every line."""
    return spark.read.text(files, lineSep=separator).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def survey(spark: SparkSession, files: list[str], separator: str = "\n") -> dict[str, bool]:
    """By path whether every line of a file is a record without a carriage return, but for its last character, and all its bytes are UTF-8.
    A row a file comes to the driver."""
    value = F.col("value")
    found = lines(spark, files, separator).groupBy("file").agg(
        (F.count_if(leaves_open(value) | ~F.is_valid_utf8(value) | (F.contains(value, F.lit("\r")) & value.rlike(r"\r(?s:.)"))) == 0).alias("plain"))
    return {unquote(urlsplit(r["file"]).path): r["plain"] for r in found.collect()}


def _with_states(df: DataFrame, outside: str, inside: str, rows) -> DataFrame:
    """Columns after0 and after1: the state (0 or 1) after each row, by the state before the first row.

    The given columns tell what a row makes of either state. A row that makes the same of both settles it; after that, or from the first
    row on, rows that swap the two count by their number modulo 2.
    """
    a, b = F.col(outside), F.col(inside)
    df = df.withColumn("_swaps", (F.sum(F.when((a == 1) & (b == 0), 1).otherwise(0)).over(rows) % 2).cast("int"))
    settled = F.when(a == b, a.bitwiseXOR(F.col("_swaps")))
    df = df.withColumn("_settled", F.last(settled, ignorenulls=True).over(rows))
    return df.withColumns({
        f"after{s}": F.coalesce("_settled", F.lit(s)).bitwiseXOR(F.col("_swaps")) for s in (0, 1)}).drop("_swaps", "_settled")


def records(spark: SparkSession, files: list[str], separator: str = "\n") -> DataFrame:
    """file, number (from 1), open (whether the file ends in it) and value of every record; an open one has its first line only."""
    line = F.col("value")
    given = lines(spark, files, separator).withColumns({"opens": leaves_open(line).cast("int"), "stays": stays_open(line).cast("int")})
    given = given.withColumn("stretch", F.shiftright("at", STRETCH))
    stretch = ["file", "block", "stretch"]
    in_stretch = Window.partitionBy(*stretch).orderBy("at")
    upto = in_stretch.rowsBetween(Window.unboundedPreceding, 0)
    ran = _with_states(given, "opens", "stays", upto)
    ran = ran.withColumns({f"before{s}": F.lag(f"after{s}", 1, s).over(in_stretch) for s in (0, 1)})
    ran = ran.withColumns({f"n{s}": F.count_if(F.col(f"before{s}") == 0).over(upto) for s in (0, 1)})
    ran = ran.withColumn("ends", F.lead("at").over(in_stretch).isNull())
    ran = work_table(ran.drop("opens", "stays"), "csv-lines")

    # One row for each stretch: what it makes of either state, and how many records begin in it.
    ranges = ran.where("ends").select(*stretch, F.col("after0").alias("opens"), F.col("after1").alias("stays"), "n0", "n1")
    in_file = Window.partitionBy("file").orderBy("block", "stretch")
    before, whole = in_file.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("file")
    ranges = _with_states(ranges, "opens", "stays", before).withColumn("start", F.lag("after0", 1, 0).over(in_file))
    ranges = ranges.withColumn("began", F.when(F.col("start") == 1, F.col("n1")).otherwise(F.col("n0")))
    ranges = work_table(ranges.select(
        *(F.col(c).alias(f"_{c}") for c in stretch), "start", (F.sum("began").over(before) - F.col("began")).alias("earlier"),
        F.sum("began").over(whole).alias("all"), F.max_by("after0", F.struct("block", "stretch")).over(whole).alias("end")), "csv-ranges")

    def by_start(column: str) -> Column:
        return F.when(F.col("start") == 1, F.col(f"{column}1")).otherwise(F.col(f"{column}0"))

    placed = ran.join(ranges, [F.col(c) == F.col(f"_{c}") for c in stretch]).select(
        "file", "block", "at", "value", (by_start("before") == 0).alias("first"), (by_start("after") == 0).alias("last"),
        (F.col("earlier") + by_start("n")).alias("number"), "all", "end")
    unclosed = (F.col("end") == 1) & (F.col("number") == F.col("all"))
    alone = F.col("first") & (F.col("last") | unclosed)
    joined = placed.where(~alone & ~unclosed).groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("lines")).select(
        "file", "number", F.lit(False).alias("open"), F.array_join("lines.value", separator).alias("value"))
    return placed.where(alone).select("file", "number", unclosed.alias("open"), "value").unionByName(joined)
