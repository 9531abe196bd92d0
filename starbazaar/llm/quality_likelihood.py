"""Quality rules: plain counts of a text, and the log-likelihood ratio of its hashed n-grams.

Tokens (runs of letters and digits, runs of other signs) and pairs of neighbours are hashed into ``BUCKETS``. One multinomial counts
them over every document, the other over a trusted target: every document of one half of the rows labelled as good. A text's score is the
sum of the log ratios of its n-grams, divided by their number plus a constant, so that very short texts stay near zero. Every text at or above
one threshold is kept: the cut that separates labelled rows best (every labelled document outside of the target), but never above the lowest two
hundredth of the good ones. All texts are scored once; the cut comes from their scores, laid out in order over all tasks.

Defined results: null has no words and no n-grams; empty texts score zero; rows without a usable label are not learned from; labels of one doc_id
that disagree count by their mean, and of different texts of one doc_id the smallest is judged; without labelled rows every score is zero and nothing is rejected for it; repeated rows get equal results;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbazaar.llm.common import slices, table, written
from starbazaar.operators.numbering import with_sums_below

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SMOOTHING, SHRINK, GOOD_LOST = 0.5, 20, 0.005
LEAST_WORDS, MOST_REPEATED = 50, 50
REMEMBERED = 300_000
#: Bits of the map that spares the shuffle most texts outside of the target.
PLACES = 1 << 24

_TOKENS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\x00-\x200-9A-Za-z\x80-\xff]+").findall
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = (text or "").encode("utf-8", "replace")
    flat = np.frombuffer(raw, np.uint8)
    words = raw.split()  # of bytes: exactly the white space \\x09-\\x0D and \\x20
    chars = int(((flat & 0xC0) != 0x80).sum() - _SPACE[flat].sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(words), chars, int(_SYMBOL[flat].sum()), len(lines) - len(set(lines)), _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words in windows of three that occur more than once."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    own = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    size = len(ids)
    pair = own[:-1] * size + own[1:]
    if size > 1 << 20:  # three ids no longer fit one number
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * size + own[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


class Hasher:
    """The buckets of a text's n-grams; remembers the hashes of tokens."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = _TOKENS((text or "").encode("utf-8", "replace"))
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = xxhash.xxh64_intdigest(t)
        h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (np.concatenate([h, pairs]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _histograms(docs: DataFrame) -> DataFrame:
    """bucket, n over all documents: one row of each task for each bucket it met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text"):
            total += np.bincount(
                np.concatenate([np.empty(0, np.int64), *map(hasher, batch.column(0).to_pylist())]), minlength=BUCKETS)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _multinomial(docs: DataFrame) -> np.ndarray:
    """Counts by bucket; as many numbers as there are buckets come to the driver."""
    found = np.zeros(BUCKETS)
    for r in _histograms(docs).collect():
        found[r["bucket"]] = r["n"]
    return found


def _own(labels: DataFrame) -> DataFrame:
    """id, quality and half, which keeps the good rows of the target apart from the judged ones, of every labelled id."""
    return labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.round(F.avg("quality")).cast("int").alias("quality")).withColumn("half", F.xxhash64(F.lit("half"), "id") % 2 == 0)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text of every document of the target; it grows with the input and is never cut.

    A bit map of hashed ids, of ``PLACES`` bits whatever the input, is broadcast first, so that few other texts are shuffled; the join decides.
    """
    ids = written(_own(labels).where("quality = 1 AND half").select("id"), "quality-target")
    place = F.xxhash64(F.lit("place"), "id").bitwiseAND(F.lit(PLACES - 1))
    bits = ids.withColumn("place", place).groupBy(F.shiftright("place", 6).alias("block")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))").alias("bits"))
    likely = _texts(docs).withColumn("place", place).withColumn("block", F.shiftright("place", 6)).join(F.broadcast(bits), "block").where(
        "shiftright(bits, cast(place & 63 AS int)) & 1 = 1").select("id", "text")
    return likely.join(ids, "id").select("text")


def _failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def learn(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The log ratio of every bucket, and the threshold."""
    ratios = log_ratios(docs, labels)
    return ratios, _cut(_scored(docs, ratios), docs, labels, ratios)


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The log ratio of every bucket; zeros without a target."""
    target = _multinomial(trusted(docs, labels))
    if not target.sum():
        return np.zeros(BUCKETS)
    raw = _multinomial(docs)

    def logs(n: np.ndarray) -> np.ndarray:
        return np.log((n + SMOOTHING) / (n.sum() + SMOOTHING * BUCKETS))

    return logs(target) - logs(raw)


def _scored(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    return written(rated(docs, ratios).withColumn("base_failed", _failed()), "quality-scores")


def _cut(scored: DataFrame, docs: DataFrame, labels: DataFrame, ratios: np.ndarray) -> float:
    return threshold(judged_scores(scored, docs, labels, ratios)) if ratios.any() else -math.inf


def judged_scores(scored: DataFrame, docs: DataFrame, labels: DataFrame, ratios: np.ndarray) -> DataFrame:
    """score and quality of every labelled document outside of the target that the plain rules pass; what they reject says nothing about the cut."""
    marks = _own(labels).where("quality = 0 OR NOT half").select("id", "quality")
    rates = F.struct("score", "base_failed")
    by_id = written(scored.withColumnRenamed("doc_id", "id").join(marks, "id").groupBy("id", "quality").agg(
        F.min(rates).alias("rate"), F.max(rates).alias("other")), "quality-judged")
    # Rows of one id whose texts differ are told apart by the texts; usually there are none, which a written table shows the planner.
    unlike = written(by_id.where("rate <> other").select("id", "quality"), "quality-unlike")
    texts = _texts(docs).join(unlike, "id").groupBy("id", "quality").agg(F.min("text").alias("text"))
    again = rated(texts.withColumn("doc_id", F.col("quality")), ratios).where(~_failed()).select("score", F.col("doc_id").cast("int").alias("quality"))
    return by_id.where("rate = other AND NOT rate.base_failed").select("rate.score", "quality").unionByName(again)


def threshold(scores: DataFrame) -> float:
    """The cut with the best sum of both rates, lowest of equals, bounded by the good rows that may be lost.

    ``scores`` (score, quality) may have any number of rows: equal scores combine, and what lies below each is summed over a sorted layout.
    """
    by_score = written(scores.groupBy("score").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")), "quality-cuts")
    sums = by_score.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not sums["good"] or not sums["bad"]:
        return -math.inf
    placed = with_sums_below(by_score, ["score"], ["good", "bad"], "quality-cuts")
    # Both rates times both numbers: whole numbers, so that equal cuts are equal.
    rate = (F.lit(sums["good"]) - F.col("good_below")).cast("decimal(19,0)") * F.lit(sums["bad"]).cast("decimal(18,0)") + (
        F.col("bad_below").cast("decimal(19,0)") * F.lit(sums["good"]).cast("decimal(18,0)"))
    lost = int(GOOD_LOST * sums["good"])
    found = placed.agg(
        F.max_by("score", F.struct(rate.alias("rate"), (-F.col("score")).alias("score"))).alias("best"),
        F.min(F.when(F.col("good_below") + F.col("good") > lost, F.col("score"))).alias("bound")).first()
    below = by_score.where(F.col("score") < F.lit(found["best"])).agg(F.max("score")).first()[0]
    middle = found["best"] if below is None else (found["best"] + below) / 2
    return float(min(middle, found["bound"]))


def rated(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, the counts and the score of every row of ``docs`` (doc_id, text)."""
    given = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, own = Hasher(), given.value
        for batch in slices(batches, "text"):
            texts = batch.column(1).to_pylist()
            buckets = list(map(hasher, texts))
            columns = list(zip(*map(counts, texts))) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns),
                 pa.array([float(own[b].sum() / (len(b) + SHRINK)) for b in buckets], pa.float64())],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
             "n_repeat_words bigint, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, score and the verdict ``kept`` of every document."""
    ratios = log_ratios(docs, labels)
    scored = _scored(docs, ratios)
    cut = _cut(scored, docs, labels, ratios)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(cut)))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
