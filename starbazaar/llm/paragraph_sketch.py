"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests; DataFrame functions only.

A paragraph (a line) is cut into pieces of ``WORDS`` words, a piece's digest is its XXH64, and a text is the set of its digests. Every
digest is added to three cells, one in each third of the sketch: the XOR of the digests, and the sum of their tags, which count and check. Two texts'
sketches subtract cell by cell, equal digests vanish, and peeling recovers what differs: a cell that holds a single digest gives it away, and
taking it out of its other cells lays open the next one.

The fingerprint is a sketch of fixed size with the number of digests and a hash of the whole text. If the difference is too large for it, larger
sketches are made: the digests are dealt into blocks by their value, as many as their number asks for, each block has a sketch, and a block that
does not peel is tried again with twice the cells. The work is in proportion to the text; blocks are dealt in two steps for that.

Likeness is the share of common digests among all of both texts, from the recovered difference.

Defined results: null is the empty text; two texts without words have likeness 1; the order is by doc_id, largest first, rows without doc_id last,
rows that share a doc_id by a hash of their text; a single row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starbazaar.llm.common import table

WORDS, LONG = 16, 40
#: Cells in a third of the fingerprint; of a block's sketch, one attempt after another; digests dealt into a block.
THIRD, ATTEMPTS, LOAD = 8, (5, 10, 20), 6
#: A tag counts in the bits from here on. A sketch has 63 cells at most, so that a digest's cells fit a mask.
_COUNT = 32
_ONE = 1 << _COUNT
_PIECE = rf"(?:[^\x20\x09-\x0D]{{1,{LONG}}}+[\x20\x09]*+){{1,{WORDS}}}+"
#: The least id, and the bits over which rows without one spread above it.
_LAST, _SPREAD = -(1 << 63), 40
#: Ranges of documents for each shuffle partition, and the bounds among them that are quantiles; as with any range partitioning
#: these are on the driver. Between two such bounds ranges are equally wide.
RANGES, BOUNDS = 4, 4096
_STEP = 64


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digests(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), lambda p: F.xxhash64(p)))


def _tag(digest: Column) -> Column:
    """What a digest adds to a cell's tag: one in the upper bits for the count, its check in the lower ones."""
    return F.lit(_ONE) + F.hash(digest, F.lit(-1)).bitwiseAND(F.lit(0x7FFFFFFF))


def _cells(digest: Column, size: int) -> Column:
    """The digest's cells as a bit mask, one in each third."""
    def bit(j: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.hash(digest, F.lit(j)), F.lit(size)) + j * size)
    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2))


def _added(signed: Column, size: int) -> Column:
    """The cells of digests with a sign, (d, tag, cells): the XOR of the digests and the sum of the tags in each."""
    def cell(all_: Column, none: Column, more: Callable[[Column, Column], Column]) -> Column:
        return F.transform(F.lit(list(range(3 * size))), lambda i: F.aggregate(
            all_, none, lambda s, x: F.when(F.getbit(x.cells, i) == 1, more(s, x)).otherwise(s)))

    zero = F.lit(0).cast("bigint")
    return _let(signed, lambda all_: F.struct(
        cell(all_, zero, lambda s, x: s.bitwiseXOR(x.d)).alias("keys"), cell(all_, zero, lambda s, x: s + x.tag).alias("tags")))


def _signed(own: Column, sign: int, size: int) -> Column:
    return F.transform(own, lambda d: F.struct(d.alias("d"), (sign * _tag(d)).alias("tag"), _cells(d, size).alias("cells")))


def sketch(own: Column, size: int) -> Column:
    """The ``3 * size`` cells of an array of digests, as two arrays."""
    return _added(_signed(own, 1, size), size)


def subtracted(a: Column, b: Column) -> Column:
    return F.struct(F.zip_with(a.keys, b.keys, lambda x, y: x.bitwiseXOR(y)).alias("keys"),
                    F.zip_with(a.tags, b.tags, lambda x, y: x - y).alias("tags"))


def peeled(cells: Column, size: int) -> Column:
    """ok, and the digests of the left and the right side, of a subtracted sketch."""
    places = F.lit(list(range(3 * size)))
    nothing = F.array().cast("array<bigint>")

    def state(keys: Column, tags: Column, left: Column, right: Column, more: Column) -> Column:
        return F.struct(keys.alias("keys"), tags.alias("tags"), left.alias("left"), right.alias("right"), more.alias("more"))

    def pure(s: Column, i: Column) -> Column:
        tag, key = F.abs(F.get(s.tags, i)), F.get(s.keys, i)
        return (F.shiftright(tag, _COUNT) == 1) & (tag == _tag(key)) & (F.getbit(_cells(key, size), i) == 1)

    def taken(s: Column, at: Column) -> Column:
        found = F.struct(F.get(s.keys, at).alias("key"), F.get(s.tags, at).alias("tag"), _cells(F.get(s.keys, at), size).alias("cells"))
        return _let(found, lambda x: state(
            F.transform(s.keys, lambda k, i: F.when(F.getbit(x.cells, i) == 1, k.bitwiseXOR(x.key)).otherwise(k)),
            F.transform(s.tags, lambda t, i: F.when(F.getbit(x.cells, i) == 1, t - x.tag).otherwise(t)),
            F.when(x.tag > 0, F.concat(s.left, F.array(x.key))).otherwise(s.left),
            F.when(x.tag < 0, F.concat(s.right, F.array(x.key))).otherwise(s.right), F.lit(True)))

    def step(s: Column, _: Column) -> Column:
        return F.when(~s.more, s).otherwise(_let(F.get(F.filter(places, lambda i: pure(s, i)), F.lit(0)), lambda at: F.when(
            at.isNull(), state(s.keys, s.tags, s.left, s.right, F.lit(False))).otherwise(taken(s, at))))

    end = F.aggregate(places, state(cells.keys, cells.tags, nothing, nothing, F.lit(True)), step)
    return _let(end, lambda s: F.struct(
        (F.forall(s.keys, lambda k: k == 0) & F.forall(s.tags, lambda t: t == 0)).alias("ok"), s.left.alias("left"), s.right.alias("right")))


def _block(a: Column, b: Column, attempts: tuple[int, ...]) -> Column:
    """The difference of two small arrays of digests by sketches of growing size; one side is added, the other taken away."""
    if not attempts:  # more digests in one block than chance brings there
        return F.struct(F.array_except(a, b).alias("left"), F.array_except(b, a).alias("right"))
    size = attempts[0]
    cells = _added(F.concat(_signed(a, 1, size), _signed(b, -1, size)), size)
    return _let(_let(cells, lambda c: peeled(c, size)), lambda r: F.when(
        r.ok, F.struct(r.left.alias("left"), r.right.alias("right"))).otherwise(_block(a, b, attempts[1:])))


def _larger(a: Column, b: Column) -> Column:
    """The difference of two arrays of digests, block by block."""
    blocks = F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / LOAD)).cast("bigint")
    first = F.ceil(F.sqrt(blocks.cast("double"))).cast("bigint")

    def pair(x: Column, y: Column) -> Column:
        return F.struct(x.alias("a"), y.alias("b"))

    def inner(part: Column, coarse: Column, fine: Column) -> Column:
        return F.transform(F.sequence(F.lit(0).cast("bigint"), fine - 1), lambda j: pair(*(
            F.filter(x, lambda d: F.pmod(F.shiftright(d, 20), fine) == j) for x in (part.a, part.b))))

    def outer(coarse: Column, fine: Column) -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(0).cast("bigint"), coarse - 1), lambda i: _let(
            pair(*(F.filter(x, lambda d: F.pmod(d, coarse) == i) for x in (a, b))), lambda part: inner(part, coarse, fine))))

    dealt = _let(F.struct(first.alias("coarse"), F.ceil(blocks / first).cast("bigint").alias("fine")), lambda n: outer(n.coarse, n.fine))
    found = F.transform(dealt, lambda p: _block(p.a, p.b, ATTEMPTS))
    return _let(found, lambda all_: F.struct(
        F.flatten(F.transform(all_, lambda r: r.left)).alias("left"), F.flatten(F.transform(all_, lambda r: r.right)).alias("right")))


def difference(a: Column, a_cells: Column, b: Column, b_cells: Column) -> Column:
    """left and right: the digests that only one of two texts has, from their fingerprints' cells or else from larger sketches."""
    return _let(_let(subtracted(a_cells, b_cells), lambda c: peeled(c, THIRD)), lambda r: F.when(
        r.ok, F.struct(r.left.alias("left"), r.right.alias("right"))).otherwise(_larger(a, b)))


def likeness(a: Column, b: Column, found: Column) -> Column:
    apart = F.size(found.left) + F.size(found.right)
    common = (F.size(a) + F.size(b) - apart) / 2
    return F.when(common + apart > 0, common / (common + apart)).otherwise(1.0)


def fingerprint(text: Column, own: Column, cells: Column) -> Column:
    parts = F.zip_with(cells.keys, cells.tags, lambda k, t: F.concat_ws(":", F.hex(k), F.hex(t)))
    return F.lower(F.concat_ws(";", F.hex(F.size(own)), F.hex(F.xxhash64(text)), F.array_join(parts, ",")))


def _with_order(docs: DataFrame) -> DataFrame:
    """doc_id, text, and id and tie, by which the documents go, largest first. Rows without doc_id spread over numbers below all others, in the
    order of their tie, so that no range gets them all."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select("doc_id", text.alias("text")).withColumn("tie", F.bitwise_not(F.xxhash64("text")))
    spread = F.lit(_LAST + (1 << (_SPREAD - 1))) + F.shiftright("tie", 64 - _SPREAD)
    given = F.greatest(F.col("doc_id").cast("bigint"), F.lit(_LAST + (1 << _SPREAD)))
    return own.select("doc_id", "text", F.when(F.col("doc_id").isNull(), spread).otherwise(given).alias("id"), "tie")


def with_next(docs: DataFrame, ranges: int | None = None, bounds: int = BOUNDS) -> DataFrame:
    """doc_id, text and the next document's text, by descending doc_id, the first after the last.

    Ranges of ids are brought together, and the first document of each goes to the range above as well, so each text moves once.
    """
    own = _with_order(docs)
    n = ranges or RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coarse = min(n, bounds)
    cuts = [i / coarse for i in range(1, coarse)] or [0.5]
    seen = own.agg(F.percentile_approx("id", cuts, 10_000).alias("cut"), F.min("id").alias("least"), F.max("id").alias("most")).first()
    placed = own.withColumn("range", _range(F.col("id"), sorted(set(seen["cut"] or [])), seen["least"] or 0, seen["most"] or 0, -(-n // coarse)))
    # By the id alone, so that no text is read for it; of rows that share it, all are lent and the line below puts them in order.
    tops = placed.groupBy("range").agg(F.max("id").alias("top"))
    # One row per range; the top range's first document follows the lowest range's last.
    order = Window.orderBy("range")
    above = F.coalesce(F.lead("range").over(order), F.first("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    lent = tops.select(F.col("range").alias("of"), "top", above.alias("to"))
    moved = placed.join(F.broadcast(lent), (F.col("range") == F.col("of")) & (F.col("id") == F.col("top")), "left")
    copies = moved.select("doc_id", "text", "id", "tie", F.explode(F.when(F.col("to").isNull(), F.array(
        F.struct("range", F.lit(False).alias("lent")))).otherwise(F.array(
            F.struct("range", F.lit(False).alias("lent")), F.struct(F.col("to").alias("range"), F.lit(True).alias("lent"))))).alias("at"))
    line = Window.partitionBy("at.range").orderBy("at.lent", F.desc("id"), F.desc_nulls_last("doc_id"), F.desc("tie"))
    return copies.withColumn("next", F.lead("text").over(line)).where("NOT at.lent").select("doc_id", "text", "next")


def _range(value: Column, bounds: list[int], least: int, most: int, parts: int) -> Column:
    """The number of a value's range, which grows with the value: how many bounds lie below it, by a coarse and a fine look, and
    which of the equal parts between its two bounds it is in."""
    if not bounds:
        return F.lit(0).cast("bigint")
    every, coarse = F.lit(bounds), F.lit(bounds[_STEP - 1::_STEP] or [bounds[-1]])
    steps = F.size(F.filter(coarse, lambda b: b < value))
    below = _let(steps, lambda k: k * _STEP + F.size(F.filter(F.slice(every, k * _STEP + 1, F.lit(_STEP)), lambda b: b < value)))
    ends = F.lit([float(least), *map(float, bounds), float(most)])

    def part(i: Column) -> Column:
        low, high = F.get(ends, i), F.get(ends, i + 1)
        share = F.when(high > low, (value.cast("double") - low) / (high - low)).otherwise(0.0)
        return F.least(F.lit(parts - 1), F.greatest(F.lit(0), F.floor(share * parts)))

    return _let(below, lambda i: i.cast("bigint") * parts + (part(i) if parts > 1 else F.lit(0)))


def compared(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited text's, and the likeness to the edited text and the next document."""
    texts = with_next(docs).withColumn("n_chars", F.length("text"))
    k = F.floor(F.col("n_chars") / 3).cast("int")
    edited = texts.withColumn("edited", F.concat(F.left("text", F.col("n_chars") - k), F.left("next", k)))
    sets = edited.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "text", "edited",
        digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"), digests(F.col("next")).alias("other"))
    cells = sets.withColumns({f"{c}_cells": sketch(F.col(c), THIRD) for c in ("own", "changed", "other")})
    found = cells.withColumns({
        f"to_{c}": difference(F.col("own"), F.col("own_cells"), F.col(c), F.col(f"{c}_cells")) for c in ("changed", "other")})
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("own"), F.col("own_cells")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("changed"), F.col("changed_cells")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), F.col("to_changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other"), F.col("to_other")).alias("near_next"))


def op9_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))
