"""Personal data by candidates and gradient boosting; DataFrame functions and Spark ML only.

Six high-recall patterns propose spans that may overlap: the four plain ones without their checks, phone numbers without a plus, and
addresses that spell out the at sign. Every candidate gets features of its format and its surroundings, taken from a form in which spelled
addresses look like plain ones and phone numbers have no plus; which pattern proposed it, and whether it passes the plain check, are no features. Boosted trees learn
from one half of all candidates (by hash): positive are the candidates inside a plain span of their kind, negative those with evidence against them (inside
a span of another kind, an octet too large, too few or too many digits, a date, a word such as "version" or "page" before them). All others say
nothing of their sort and are not learned from. Candidates of equal features are one row with their number as its weight. A threshold calibrated on
all of the other half then selects among all candidates, scored by the trees as
plain column expressions. The plain spans always stay; a selected candidate joins them if it meets no plain span and no better selected one. So spelled
addresses, phone numbers without a plus and numbers written like a card's that fail the card's check digit are added where they look like the plain ones.

Positions come from the pieces between matches: their lengths are summed along the text over rows, so a text with many matches
costs in proportion. Patterns never look at a place twice: they begin only where a run begins and don't go back.

Defined results: null is the empty text and has no spans; repeated rows get equal results, row by row; with no candidates of
one sort, positive or negative, nothing is added; positions count code points; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starbazaar.llm.common import table, written

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, SEED = 10, 4, 42
#: Rows of different features that a task of the training takes.
TASK_ROWS = 100_000
#: Rows that Spark ML looks at for the cuts of a feature, or the square of the number of bins, if that is more.
LOOKED_AT, LEAST_BINS = 10_000, 32
PRECISION, BINS = 0.99, 200
CONTEXT = 24
_BEFORE = "(?<![A-Za-z0-9._%+-])"
#: Generators: name, kind, what a text must contain, pattern. The first four are the plain ones, made to run in linear time.
GENERATORS = (
    ("email", "email", "@", rf"(?:\G|{_BEFORE})[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", "ip", "[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    ("card", "card", "[0-9]", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("bare", "phone", "[0-9]", r"(?<![0-9+.])(?:\([0-9]{2,4}\)[\x20-]?)?[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9])"),
    ("spelled", "email", r"(?i)[\[(]\x20?at\x20?[\])]",
     rf"(?i){_BEFORE}[A-Za-z0-9._%+-]++\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[A-Za-z0-9-]++)++"),
)
#: Words before a span that speak for or against a kind.
HINTS = {
    "says_phone": r"(?i)\b(?:tel|phone|call|fax|mobile)\b", "says_card": r"(?i)\b(?:card|visa|credit|iban)\b",
    "says_mail": r"(?i)\b(?:mail|email|contact)\b", "says_number": r"(?i)\b(?:version|license|no|page|id|v)\b",
}
_DATE = r"^(?:(?:19|20)[0-9]{2}[-.\x20][01]?[0-9][-.\x20][0-3]?[0-9]|[0-3]?[0-9][-.\x20][0-3]?[0-9][-.\x20](?:19|20)[0-9]{2})$"
#: Numbers of digits beyond which a candidate is surely something else.
PHONE_DIGITS, CARD_DIGITS = (7, 15), (13, 19)


def _found(pattern: str) -> Column:
    """Matches with the length of the piece before each and what stands around it."""
    pieces = F.split("text", pattern)
    matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    return F.transform(matches, lambda m, i: F.struct(
        m.alias("match"), F.length(F.get(pieces, i)).alias("gap"), F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("left"),
        F.left(F.get(pieces, i + 1), F.lit(CONTEXT)).alias("right")))


def _looked_at(docs: DataFrame) -> DataFrame:
    """One row per document with its matches by generator; the only pass over the texts."""
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shape = "array<struct<match:string,gap:int,left:string,right:string>>"
    return written(own.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        *(F.when(F.col("text").rlike(must), _found(pattern)).cast(shape).alias(name) for name, _, must, pattern in GENERATORS)), "pii-matches")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def value(i: Column) -> Column:
        d = F.ascii(F.element_at(F.split(F.reverse(digits), ""), i)) - 48
        twice = F.when(d >= 5, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _passes(digits: Column, n: Column) -> Column:
    """Whether a match of a plain generator passes its check."""
    octets = F.forall(F.split("match", r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (
        F.regexp_replace(p, "^0+", "").try_cast("int").isNull() | (F.regexp_replace(p, "^0+", "").try_cast("int") <= 255)))
    return (
        F.when(F.col("generator") == 0, True)
        .when(F.col("generator") == 1, octets)
        .when(F.col("generator") == 2, F.when(n.between(13, 19), luhn(digits)).otherwise(False))
        .when(F.col("generator") == 3, n.between(9, 15))
        .otherwise(False))


def candidates(matches: DataFrame) -> DataFrame:
    """Every match as a row: row, generator, start, end, match, left, right, and plain, whether it is a span of the plain rules."""
    parts = [matches.where(F.size(name) > 0).select("row", F.lit(i).alias("generator"), F.posexplode(name).alias("i", "m")).select(
        "row", "generator", "i", "m.*") for i, (name, *_) in enumerate(GENERATORS)]
    rows = reduce(DataFrame.unionByName, parts)
    so_far = Window.partitionBy("row", "generator").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    n = F.length("match")
    ended = rows.withColumn("end", F.sum(F.col("gap") + n).over(so_far))
    digits = _digits(F.col("match"))
    return ended.select("row", "generator", (F.col("end") - n).alias("start"), "end", "match", "left", "right",
                        _passes(digits, F.length(digits)).alias("plain"))


def _class(c: Column) -> Column:
    return (F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^\p{L}$"), 2).when(c.rlike("^[0-9]$"), 3).otherwise(4)).cast("double")


def _canonical() -> Column:
    """The match with its at sign and dots spelled plainly, and without a plus."""
    plain = F.regexp_replace("match", r"(?i)\x20?[\[(]\x20?at\x20?[\])]\x20?", "@")
    plain = F.regexp_replace(plain, r"(?i)\x20?[\[(]\x20?dot\x20?[\])]\x20?", ".")
    return F.when(F.col("kind") == KINDS.index("email"), plain).otherwise(F.regexp_replace("match", r"^\+", ""))


def features() -> dict[str, Column]:
    """By name, over the columns kind, match, left and right."""
    match, left = _canonical(), F.col("left")
    digits = _digits(match)
    groups = F.filter(F.split(match, "[^0-9]+"), lambda g: g != "")

    def count(pattern: str) -> Column:
        return (F.length(match) - F.length(F.regexp_replace(match, pattern, ""))).cast("double")

    found = {
        "kind": F.col("kind").cast("double"), "digits": F.length(digits).cast("double"), "chars": F.length(match).cast("double"),
        "groups": F.size(groups).cast("double"), "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double"),
        "brackets": count(r"[()]"), "dots": count(r"\."), "hyphens": count("-"), "spaces": count(" "),
        "over": F.exists(groups, lambda g: F.coalesce(g.try_cast("int") > 255, F.lit(True))).cast("double"),
        "date": match.rlike(_DATE).cast("double"),
        "before": _class(F.right(left, F.lit(1))), "after": _class(F.left(F.col("right"), F.lit(1))),
    }
    return found | {name: left.rlike(pattern).cast("double") for name, pattern in HINTS.items()}


def _spoken_against() -> Column:
    """Whether the features hold evidence that a candidate is not what its kind says."""
    digits = F.col("x_digits")

    def of(kind: str) -> Column:
        return F.col("kind") == KINDS.index(kind)

    named = (F.col("x_says_number") == 1) & (F.col("x_says_phone") + F.col("x_says_card") + F.col("x_says_mail") == 0)
    return named | (of("ip") & ~F.col("plain")) | (of("phone") & (~digits.between(*PHONE_DIGITS) | (F.col("x_date") == 1))) | (
        of("card") & ~digits.between(*CARD_DIGITS))


def _tree(lines: list[str], names: list[str]) -> Column:
    """A tree in Spark ML's text form as a column expression."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return F.lit(float(line.split(":")[1]))
    feature, cut = re.fullmatch(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line).groups()
    yes = _tree(lines, names)
    lines.pop(0)  # Else
    return F.when(F.col(names[int(feature)]) <= float(cut), yes).otherwise(_tree(lines, names))


def learn(rated: DataFrame, names: list[str]) -> tuple[Column, float] | None:
    """The score as an expression over the feature columns, and the threshold; None if there is one sort only.

    ``rated`` holds a row for each combination of features, ``label`` and ``half``, and its ``weight``, the number of candidates.
    """
    sorts = {(r["label"], r["half"]): r["n"] for r in rated.groupBy("label", "half").agg(F.count("*").alias("n")).collect()}
    if not all(sorts.get((label, 0)) for label in (0, 1)):
        return None
    rows = sorts[0, 0] + sorts[1, 0]
    # So many bins that cuts are taken from all rows.
    bins = LEAST_BINS if rows <= LOOKED_AT else max(LEAST_BINS, math.isqrt(rows) + 1)
    trainer = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, maxBins=bins, seed=SEED, stepSize=0.3)
    # In order, so that sums come out the same in a rerun.
    ordered = rated.where("half = 0").repartitionByRange(1 + rows // TASK_ROWS, *names, "label").sortWithinPartitions(*names, "label")
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(ordered)
    model = trainer.fit(vectors.select("features", "label", F.col("weight").cast("double").alias("weight")))
    sums = [float(w) * _tree([line for line in tree.toDebugString.split("\n")[1:] if line.strip()], names)
            for w, tree in zip(model.treeWeights, model.trees)]
    score = 1 / (1 + F.exp(-2 * reduce(Column.__add__, sums)))
    counted = rated.where("half = 1").withColumn("score", score).groupBy(F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")).collect()
    return score, _calibrated({r["bin"]: (r["good"], r["n"]) for r in counted})


def _calibrated(bins: dict[int, tuple[int, int]]) -> float:
    """The lowest score from which on the share of good candidates is at least ``PRECISION``."""
    good = seen = 0
    cut = 1.01
    for b in sorted(bins, reverse=True):
        good, seen = good + bins[b][0], seen + bins[b][1]
        if good >= PRECISION * seen:
            cut = b / BINS
    return cut


def spans(matches: DataFrame) -> DataFrame:
    """row, kind (its place in ``KINDS``), start, end and plain of every span."""
    kind = F.get(F.array(*(F.lit(KINDS.index(k)) for _, k, _, _ in GENERATORS)), F.col("generator"))
    given = {f"x_{n}": c for n, c in features().items()}
    names = list(given)
    found = candidates(matches).withColumn("kind", kind).select(
        "row", F.col("generator").alias("by"), "kind", "start", "end", "plain", *(c.alias(n) for n, c in given.items()))
    # Where plain spans that began up to here end, and where the next one begins: no pairs of spans are made. A candidate
    # inside a plain span of its kind is a good one, whatever proposed it.
    place = Window.partitionBy("row").orderBy("start")
    until, later = place.rangeBetween(Window.unboundedPreceding, 0), place.rangeBetween(0, Window.unboundedFollowing)
    of_kind = Window.partitionBy("row", "kind").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    ends = F.when(F.col("plain"), F.col("end"))
    placed = found.withColumns({
        "meets": F.coalesce((F.max(ends).over(until) > F.col("start")) | (
            F.min(F.when(F.col("plain"), F.col("start"))).over(later) < F.col("end")), F.lit(False)),
        "inside": F.coalesce(F.max(ends).over(of_kind) >= F.col("end"), F.lit(False))})
    label = F.when(F.col("inside"), 1).when(F.col("meets") | _spoken_against(), 0)
    # The only table of candidates; plain spans and what is learned from are read from it.
    known = written(placed.withColumn("label", label).drop("inside"), "pii-known")
    plain = known.where("plain").select("row", "kind", "start", "end")
    half = F.pmod(F.xxhash64(F.lit("pii"), "row", "by", "start"), F.lit(2)).cast("int").alias("half")
    learned = written(known.where("label IS NOT NULL").groupBy("label", half, *names).agg(F.count("*").alias("weight")), "pii-learned")
    model = learn(learned, names)
    plain = plain.withColumn("plain", F.lit(True))
    if model is None:
        return plain
    score, cut = model
    own = known.where("NOT plain AND NOT meets").withColumn("score", score).where(F.col("score") >= cut).select(
        "row", "kind", "by", "start", "end", "score")
    # Of selected spans that hang together the best stays; ties go to the earlier, then the longer, then the first generator.
    before = Window.partitionBy("row").orderBy("start", "end", "by").rowsBetween(Window.unboundedPreceding, -1)
    starts = own.withColumn("apart", (F.col("start") >= F.coalesce(F.max("end").over(before), F.lit(0))).cast("int"))
    run = starts.withColumn("run", F.sum("apart").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    best = run.groupBy("row", "run").agg(F.max_by(
        F.struct("kind", "start", "end"), F.struct("score", -F.col("start"), "end", -F.col("by"))).alias("best"))
    return plain.unionByName(best.select("row", "best.*", F.lit(False).alias("plain")))


def _joined(only_plain: bool) -> Column:
    own = F.filter("spans", lambda s: s.plain) if only_plain else F.col("spans")
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")


def found_in(docs: DataFrame) -> DataFrame:
    """doc_id and the spans (kind, start, end, plain; sorted) of every row of ``docs`` (doc_id, text)."""
    matches = _looked_at(docs)
    by_row = spans(matches).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "plain"))).alias("spans"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,plain:boolean>>")
    return matches.select("row", "doc_id").join(by_row, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def redacted(docs: DataFrame, found: DataFrame, mask: str = "[PRIVATE]") -> DataFrame:
    """doc_id and text of ``docs`` with the spans of ``found`` masked; doc_id must be unique in both."""
    places = F.transform("spans", lambda s: F.struct(s.start.alias("start"), s.end.alias("end")))
    ordered = F.array_sort(F.concat(places, F.array(F.struct(F.length("text").cast("bigint").alias("start"), F.length("text").cast("bigint").alias("end")))))
    ends = F.transform(ordered, lambda s: s.end)
    piece = F.transform(ordered, lambda s, i: F.substring(
        F.col("text"), F.when(i == 0, 1).otherwise(F.get(ends, i - 1) + 1).cast("int"),
        F.greatest(F.lit(0), s.start - F.when(i == 0, 0).otherwise(F.get(ends, i - 1))).cast("int")))
    return docs.join(found, "doc_id").select("doc_id", F.array_join(piece, mask).alias("text"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.plain & (s.kind == KINDS.index(kind)))).cast("bigint").alias(f"n_{kind}")

    return found_in(table(spark, sf_dir, "documents")).select(
        "doc_id", *map(count, KINDS), F.sha2(_joined(True).cast("binary"), 256).alias("base_sha256"), _joined(False).alias("spans"))
