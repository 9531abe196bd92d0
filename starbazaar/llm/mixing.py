"""Mixing sources to target weights by hash-threshold histograms.

Sizes are summed by source and hash bucket. A source's target is a number of whole passes over it plus a rest;
the rest is met by the documents whose hash lies under a threshold, found bucket by bucket: the histogram shows
the bucket in which the budget runs out, and only that bucket is looked at with finer buckets, until the hash is
used up. Rows are then filtered by comparing their hash with their source's threshold, so nothing is sorted, and a
smaller budget always takes a subset of what a larger one takes.

A document's hash is one of its id and text, or of all its columns, and of its number among equal rows; so rows without an id, or sharing one,
are documents of their own, and of many equal rows as many are taken as the target asks for.

Defined results: null and empty texts have size 0 and take 0 words; null is a source of its own, the last; repeated rows are told apart by
their number, so that each counts on its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starbazaar.llm.common import WORD, digest, own_column, table, written
from starbazaar.operators.numbering import with_position

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
#: Bits of the hash per level, and the number of levels: 60 bits in all.
LEVEL_BITS, LEVELS = 12, 5
_HASH_BITS = LEVEL_BITS * LEVELS
#: Equal rows that are numbered, or copies of a row that are made, in one piece.
PIECE = 1 << 16


def words(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """``sizes`` (source, source_size) with each source's target; the shares of all words by weight, at most ``most`` times
    its size, what is left over shared again by weight among the others.

    A round fixes the sources that are above their most and shares the rest again; a few sums come to the driver.
    """
    known = sizes.where("source IS NOT NULL")
    rank = with_position(known, ["source"], "rank", "sources").unionByName(
        sizes.where("source IS NULL").withColumn("rank", F.lit(known.count()).cast("bigint")))
    order = F.array(*(F.lit(w) for w in weights))
    ranked = written(rank.withColumns({
        "weight": F.get(order, (F.col("rank") % len(weights)).cast("int")).cast("bigint"),
        "most": F.lit(most) * F.col("source_size"),
    }), "weights")
    left, share, full = None, None, F.lit(False)
    while True:
        sums = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(full, F.col("most"))).alias("fixed"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        now = ((sums["total"] or 0) - (sums["fixed"] or 0), sums["weight"] or 0)
        if now == (left, share):
            break
        left, share = now
        # Whole numbers up to here, so that the comparison is exact.
        full = (F.col("weight").cast("decimal(38,0)") * F.lit(left).cast("decimal(38,0)")
                >= F.col("most").cast("decimal(38,0)") * F.lit(share).cast("decimal(38,0)")) | full
        if not share:
            break
    shared = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(share or 1))
    return ranked.select("source", "source_size", F.when(full, F.col("most").cast("double")).otherwise(shared).alias("target"))


def thresholds(rows: DataFrame, aims: DataFrame) -> DataFrame:
    """For every source of ``aims`` (source, source_size, target): passes, and the hash under which a document is taken once more.

    ``rows`` (source, size, hash) is aggregated once for the histogram; each finer level reads only the boundary bucket.
    """
    state = aims.select(
        "source", "source_size",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint").alias("passes"),
        "target").withColumn("passes", F.least(F.col("passes"), F.lit(MOST_PASSES))).select(
        "source", "passes", (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("bigint").alias("below"))
    state = written(state, "budgets")
    for level in range(LEVELS):
        shift = _HASH_BITS - LEVEL_BITS * (level + 1)
        bucket = F.shiftright(F.col("hash"), shift)
        inside = rows if level == 0 else rows.join(
            state.select(F.col("source").alias("of"), F.col("below").alias("begin")),
            F.col("source").eqNullSafe(F.col("of")) & (F.shiftright(F.col("hash"), shift + LEVEL_BITS)
                                                      == F.shiftright(F.col("begin"), shift + LEVEL_BITS))).drop("of", "begin")
        histogram = inside.groupBy(F.col("source").alias("of"), bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        # A source has at most 2 ** LEVEL_BITS buckets at a level.
        so_far = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        lined = histogram.withColumn("so_far", F.sum("words").over(so_far)).join(
            state.select("source", "rest"), F.col("of").eqNullSafe(F.col("source")))
        fits = F.col("so_far") <= F.col("rest")
        # Empty buckets may lie between the last that fits and the boundary, which is the first that does not.
        taken = lined.groupBy("of").agg(
            F.max(F.when(fits, F.col("bucket"))).alias("last"), F.max(F.when(fits, F.col("so_far"))).alias("taken"),
            F.min(F.when(~fits, F.col("bucket"))).alias("boundary"))
        step = F.lit(1 << shift).cast("bigint")
        state = written(
            state.join(taken, F.col("source").eqNullSafe(F.col("of")), "left").select(
                "source", "passes", (F.col("rest") - F.coalesce("taken", F.lit(0))).alias("rest"),
                F.coalesce(F.col("boundary") * step, (F.col("last") + 1) * step, F.col("below")).alias("below")), "budgets")
    # The document at the boundary is taken too when that comes nearer to the target.
    at = rows.join(state.select(F.col("source").alias("of"), "below", "rest"),
                   F.col("source").eqNullSafe(F.col("of")) & (F.col("hash") >= F.col("below")) & (F.col("size") > 0))
    first = at.groupBy("of").agg(F.min("hash").alias("first"))
    tied = rows.join(first, F.col("source").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("first"))).groupBy("of").agg(
        F.sum("size").alias("more"), F.max("hash").alias("hash"))
    return state.join(tied, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "passes",
        F.when((F.col("more") < 2 * F.col("rest")), F.col("hash") + 1).otherwise(F.col("below")).alias("below"))


def _times(df: DataFrame, n: str, number: str) -> DataFrame:
    """``df``, a written table, with every row ``n`` times and a number from 0 to n - 1; a large n is split over tasks."""
    begin = own_column(df, "piece")
    pieces = df.where(F.col(n) > 0).withColumn(begin, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1, F.lit(PIECE).cast("bigint"))))
    large = pieces.where(F.col(n) > PIECE).repartition(F.xxhash64(begin, n))
    end = F.least(F.col(n), F.col(begin) + PIECE) - 1
    return pieces.where(F.col(n) <= PIECE).unionByName(large).withColumn(number, F.explode(F.sequence(begin, end))).drop(begin)


def _numbered(docs: DataFrame, key: Column) -> DataFrame:
    """doc_id, source, size, key and hash of every row; rows that agree in all of them are counted first and then numbered."""
    groups = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"), key.alias("key")).groupBy(
        "doc_id", "source", "size", "key").agg(F.count("*").alias("n"))
    return _times(written(groups, "equal-rows"), "n", "number").select(
        "doc_id", "source", "size", "key",
        F.shiftrightunsigned(F.xxhash64(F.lit("mix"), "key", "number"), 64 - _HASH_BITS).alias("hash"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES, key: Column | None = None) -> DataFrame:
    """doc_id, key, source, size, source_size, target, copies and taken of every row of ``docs`` (doc_id, text, source)."""
    rows = written(_numbered(docs, digest("doc_id", "text") if key is None else key), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = written(targets(sizes, weights, most), "targets")
    limits = thresholds(rows, aims)
    decided = written(aims.join(
        limits.select(F.col("source").alias("of"), "passes", "below"), F.col("source").eqNullSafe(F.col("of")))
        .drop("of").withColumnRenamed("source", "of"), "limits")
    once_more = (F.col("passes") < most) & (F.col("hash") < F.col("below"))
    return rows.join(decided, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "copies", F.col("passes") + once_more.cast("bigint")).select(
        "doc_id", "key", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows of no words stay away. Other columns are kept as they are."""
    key, copies, rows, number = (own_column(docs, f"mixed_{c}") for c in ("key", "copies", "rows", "number"))
    keyed = docs.withColumn(key, digest(*docs.columns))
    plan = written(mix(keyed, key=F.col(key), **options).where("size > 0").groupBy(F.col("key").alias(key)).agg(
        F.sum("copies").alias(copies), F.count("*").alias(rows)).where(F.col(copies) > 0), "mixed")
    # A row on its own is taken a few times at most.
    taken = keyed.join(plan.where(F.col(rows) == 1), key).withColumn(number, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies))))
    equal = plan.where(F.col(rows) > 1)
    if equal.isEmpty():
        return taken.select(docs.columns)
    # Rows of one key are equal in every column, so one stands for all.
    one = written(keyed.join(equal.select(key), key, "left_semi").dropDuplicates([key]).join(equal, key), "equal-documents")
    return taken.unionByName(_times(one, copies, number)).select(docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
