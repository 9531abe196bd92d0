"""Language identification by nearest centroids.

A text is the TF-IDF vector of its hashed character n-grams (one to three characters of lower-case words, word ends included), of length one.
Document frequencies are counted over every row that may be learned from. Each language has up to ``CENTROIDS`` centroids, found by spherical
k-means over a bounded sample of its different texts (about ``SAMPLE`` of a language, all if there are fewer). A text gets the language of
the centroid with the greatest cosine. It is marked as rejected where that cosine lies below what nearly all texts of the centroid's own cluster
reach: such a text is likely in none of the learned languages.

The model has ``CENTROIDS`` vectors of ``BUCKETS`` numbers a language and goes to every task; the number of languages is counted first, and
more than ``MOST_LANGUAGES`` are refused with an error.

Defined results: null, empty and letterless texts are ``und`` with score 0 and are not learned from; rows without a language are not learned from;
a text that shares no n-gram with any centroid gets the language with the most learned texts (ties: the first by code point), score 0, and is
rejected; of equally near languages that one wins, too; repeated rows get equal results and count once among the sampled texts; without anything
to learn from every text is ``und``; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbazaar.llm.common import slices, table, written

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
SAMPLE, CENTROIDS, ROUNDS = 600, 3, 10
#: Clusters with a smaller share of their language's texts are dropped: they are strays, such as texts with a wrong language.
LEAST_SHARE = 0.05
MOST_LANGUAGES = 256
#: Share of a cluster's texts that lie beyond its cut.
BEYOND = 0.01
UNKNOWN = "und"
#: Characters of a text that are looked at at once.
PIECE = 1 << 20

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_classes: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """By code point: 2 for letters, 1 for marks, which words go on over, else 0."""
    if not _classes:
        found = np.zeros(0x110000, np.uint8)
        for i in range(0x110000):
            kind = unicodedata.category(chr(i))[0]
            if kind in "LM":
                found[i] = 2 if kind == "L" else 1
        _classes.append(found)
    return _classes[0]


def counts(text: str | None) -> np.ndarray | None:
    """How often each bucket's n-grams occur; None for a text without a letter."""
    text = (text or "").lower()
    kinds, total, letters = _kinds(), np.zeros(BUCKETS, np.int64), False
    before = np.full(2, 32, np.uint64)
    for at in range(0, len(text) + 1, PIECE):
        piece = text[at:at + PIECE] + (" " if at + PIECE > len(text) else "")
        codes = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)
        kind = kinds[codes]
        letters = letters or bool((kind == 2).any())
        c = np.concatenate([before, np.where(kind > 0, codes, 32)])
        before = c[-2:].copy()
        c0, c1, c2 = c[:-2], c[1:-1], c[2:]
        one = c2 * _FACTORS[0]
        two = (one + c1) * _FACTORS[1]
        three = (two + c0) * _FACTORS[2]
        inner, last = c1 != 32, c2 != 32
        for h, counted in ((one, last), (two, inner | last), (three, inner)):
            total += np.bincount((h[counted] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=BUCKETS)
    return total if letters else None


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The places and values of a text's TF-IDF vector of length one."""
    n = counts(text)
    if n is None:
        return None
    at = np.flatnonzero(n)
    values = ((1 + np.log(n[at])) * idf[at]).astype(np.float32)
    return at, values / np.linalg.norm(values)


class Model(NamedTuple):
    languages: list[str]   # by falling number of learned texts
    of: np.ndarray         # the language of each centroid, by its place
    centroids: np.ndarray  # a row for each bucket, a column for each centroid
    cuts: np.ndarray
    idf: np.ndarray


def _document_frequencies(texts: DataFrame) -> np.ndarray:
    """By bucket the texts that hold it; last the number of texts with a letter. So many numbers come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in slices(batches, "text"):
            for text in batch.column(0).to_pylist():
                n = counts(text)
                if n is not None:
                    total[:-1] += n > 0
                    total[-1] += 1
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    found = np.zeros(BUCKETS + 1)
    for r in texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[r["bucket"]] = r["n"]
    return found


def _sample(learnable: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """lang, key and text of about ``SAMPLE`` different texts of each language, and each language's number of different texts."""
    keyed = learnable.select("lang", F.xxhash64("text").alias("key"), "text")
    keys = written(keyed.select("lang", "key").distinct(), "language-keys")
    sizes = {r["lang"]: r["n"] for r in keys.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    if not sizes:
        return keyed.limit(0), sizes
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, SAMPLE / n))))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("language"), "key"), 11) / F.lit(float(1 << 53))
    # About SAMPLE * MOST_LANGUAGES rows of two short values at most.
    chosen = written(keys.where(draw < F.element_at(share, F.col("lang"))), "language-sample")
    return keyed.join(F.broadcast(chosen), ["lang", "key"], "left_semi").groupBy("lang", "key").agg(F.min("text").alias("text")), sizes


def clusters(vectors: np.ndarray, most: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length one, the largest clusters first, and the nearest of them to each vector, by spherical k-means. It begins with the
    vector nearest to the mean, then takes the vector farthest from those it has, twice as many as wanted; strays fall to clusters of their own."""
    begin = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    near = vectors @ vectors[begin[0]]
    while len(begin) < min(2 * most, len(vectors)):
        begin.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[begin[-1]])
    centroids, member = vectors[begin], np.full(len(vectors), -1)
    for _ in range(rounds):
        now = np.argmax(vectors @ centroids.T, axis=1)
        if (now == member).all():
            break
        member = now
        sums = np.stack([vectors[member == k].sum(axis=0) for k in range(len(centroids))])
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centroids)
    sizes = np.bincount(member, minlength=len(centroids))
    kept = np.argsort(-sizes, kind="stable")[:most]
    kept = kept[sizes[kept] >= min(LEAST_SHARE * len(vectors), sizes.max())]
    return centroids[kept], np.argmax(vectors @ centroids[kept].T, axis=1)


def learn(docs: DataFrame) -> Model:
    """The model from the rows of ``docs`` (text, lang) that have both."""
    learnable = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sample, sizes = _sample(learnable)
    if not sizes:
        return Model([], np.zeros(0, np.int64), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), np.ones(BUCKETS))
    frequency = _document_frequencies(learnable)
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [vector(t, idf) for t in batch.column(2).to_pylist()]
            kept = pa.array([v is not None for v in found])
            places, values = zip(*(v for v in found if v is not None)) if any(v is not None for v in found) else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(kept), batch.column(1).filter(kept), pa.array([p.astype(np.uint16).tobytes() for p in places], pa.binary()),
                 pa.array([v.tobytes() for v in values], pa.binary())], ["lang", "key", "places", "values"])

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        dense = np.zeros((len(rows), BUCKETS), np.float32)
        for i, (p, v) in enumerate(zip(rows["places"], rows["values"])):
            dense[i, np.frombuffer(p, np.uint16)] = np.frombuffer(v, np.float32)
        centroids, member = clusters(dense)
        own = (dense * centroids[member]).sum(axis=1)
        used = np.unique(member)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [centroids[k].astype(np.float32).tobytes() for k in used],
                             "cut": [float(np.quantile(own[member == k], BEYOND)) for k in used]})

    # About SAMPLE rows a language, of at most BUCKETS places each, whatever the texts.
    found = sample.select("lang", "key", "text").mapInArrow(vectors, "lang string, key bigint, places binary, values binary").groupBy(
        "lang").applyInPandas(cluster, "lang string, centroid binary, cut double").collect()
    languages = sorted({r["lang"] for r in found}, key=lambda lang: (-sizes[lang], lang))
    rank = {lang: i for i, lang in enumerate(languages)}
    found.sort(key=lambda r: (rank[r["lang"]], r["centroid"]))
    return Model(languages, np.array([rank[r["lang"]] for r in found]),
                 np.ascontiguousarray(np.stack([np.frombuffer(r["centroid"], np.float32) for r in found], axis=1)),
                 np.array([r["cut"] for r in found]), idf)


def nearest(text: str | None, model: Model) -> tuple[str, float, bool]:
    """Language, cosine and whether the text is rejected."""
    found = vector(text, model.idf)
    if found is None or not model.languages:
        return UNKNOWN, 0.0, True
    near = found[1] @ model.centroids[found[0]]
    best = int(np.argmax(near))
    return model.languages[model.of[best]], float(min(1, max(0, near[best]))), bool(near[best] <= 0 or near[best] < model.cuts[best])


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (the cosine) and rejected of every row of ``docs`` (doc_id, text)."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = given.value
        for batch in slices(batches, "text"):
            columns = list(zip(*(nearest(t, own) for t in batch.column(1).to_pylist()))) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.bool_())))],
                ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: those whose CRC-32 has the remainder 2. Rows without an id are not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    return identified(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
