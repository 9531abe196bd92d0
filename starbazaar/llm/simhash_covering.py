"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint is the bitwise majority of the XXH64 values of its word shingles. Two distinct
fingerprints are linked when they differ in at most ``radius`` bits, and components of links are the groups.

Candidates come from a covering family of bit masks: every bit position gets a vector of ``radius + 1`` bits, and
mask ``v`` keeps the positions whose vector has an odd product with ``v``. Up to ``radius`` differing positions
span less than the whole space, so some non-zero ``v`` is orthogonal to all of them: that mask keeps none of the
differing bits and the pair meets in its table. No pair within the radius is missed.

Equal fingerprints are one vertex, so exact copies never meet as pairs. Within a table's bucket the vertices are
linked by a forest, not by all pairs. A bucket with more than ``bucket`` vertices is not brought into one task:
its vertices are joined through the values within half the radius of each, which is linear in their number and
also exact (two values within the radius have such a value in common).

Defined results: a null or empty text, or one without words, has fingerprint zero, linked like any other; fewer
words than a shingle form one shingle; repeated rows keep one output row each; a null doc_id never becomes a
component's id unless the whole component has none; an empty table gives an empty result. ``one_of_each`` keeps one row of each component
whatever its ids: rows without an id, or sharing one, are documents of their own if their fingerprints are not linked. It is the row with the
smallest id, one without an id only if there is no other, of equal ids the one with the smallest digest of all its columns.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbazaar.llm.common import digest, own_column, slices, table, written

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET = 4096
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of a text."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[shingle - 1:].tolist() if len(words) >= shingle else [len(joined)]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(ends), _CHUNK):
        part = [digest(joined[a:b], seed) for a, b in zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK])]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(ends)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, key: str | None = None) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a bigint) and key of every row; the key is a text column of ``docs``, if named, else null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = [fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64)), batch.column(2)], ["doc_id", "fp", "key"])

    own = F.lit(None) if key is None else F.col(key)
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"), own.cast("string").alias("key")).mapInArrow(
        run, "doc_id bigint, fp bigint, key string")


def masks(radius: int = RADIUS, bits: int = BITS, seed: int = 7) -> list[int]:
    """The ``2 ** (radius + 1) - 1`` masks of the covering family, as signed 64-bit values."""
    width = radius + 1
    # Vectors in turn rather than at random: each is used about equally often, so all masks keep about half the bits.
    vectors = [1 + i % ((1 << width) - 1) for i in np.random.default_rng(seed).permutation(bits).tolist()]
    found = []
    for v in range(1, 1 << width):
        mask = sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() % 2)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (smaller root, member) that join the values as all links within the radius do."""
    n = len(values)
    root = np.arange(n)
    step = max(1, (1 << 20) // n)
    for at in range(0, n, step):
        near = np.bitwise_count(values[at:at + step, None] ^ values[None, :]) <= radius
        for i, row in enumerate(near, at):
            touched = np.unique(root[row])
            if len(touched) > 1:
                root[np.isin(root, touched)] = touched[0]
    return [(int(values[r]), int(values[i])) for i, r in enumerate(root.tolist()) if r != i]


def _bucket_links(radius: int):
    """Rows (table, key, fp) sorted by table and key to links; a bucket may run over several batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((0, 3), np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], 1)
                rest = np.concatenate([rest, rows])
            if not len(rest):
                continue
            cuts = np.flatnonzero((rest[1:, :2] != rest[:-1, :2]).any(axis=1)) + 1
            if batch is not None and not len(cuts):
                continue
            whole = len(rest) if batch is None else cuts[-1]
            links: set[tuple[int, int]] = set()
            for a, b in itertools.pairwise([0, *cuts[cuts < whole].tolist(), int(whole)]):
                links.update(_forest(np.sort(rest[a:b, 2]), radius))
            rest = rest[whole:]
            if links:
                pairs = np.array(sorted(links), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return run


def _through_middles(values: DataFrame, radius: int, bits: int) -> DataFrame:
    """Links among ``values`` (column fp) through the values within half the radius; needs an even radius or one bit more."""
    half = (radius + 1) // 2
    flips = [0]
    for k in range(1, half + 1):
        for chosen in itertools.combinations(range(bits), k):
            mask = sum(1 << i for i in chosen)
            flips.append(mask - (1 << 64) if mask >> 63 else mask)
    near = values.select("fp", F.explode(F.transform(
        F.lit(np.array(flips, np.int64)), lambda flip: flip.bitwiseXOR(F.col("fp")))).alias("middle"))
    lists = near.groupBy("middle").agg(F.sort_array(F.collect_set("fp")).alias("met")).where(F.size("met") > 1)
    # At most as many values meet in a middle as there are flips. For an odd radius they may be one bit too far apart.
    if radius % 2 == 0:
        return lists.select(F.col("met")[0].alias("a"), F.explode(F.slice("met", 2, len(flips))).alias("b"))
    pairs = lists.select("met", F.explode("met").alias("a")).select("a", F.explode("met").alias("b"))
    return pairs.where((F.col("a") < F.col("b")) & (_differing("a", "b") <= radius)).distinct()


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between the distinct values of column fp, enough of them to join every pair within the radius."""
    tables = F.array(*(
        F.struct(F.lit(i).cast("int").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(masks(radius))))
    keyed = distinct.select("fp", F.explode(tables).alias("at")).select("at.t", "at.key", "fp")
    buckets = written(
        keyed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1"), "simhash-buckets")
    found = buckets.where("n = 2").where(_differing("a", "b") <= radius).select("a", "b")
    several = keyed.join(buckets.where(F.col("n").between(3, bucket)).select("t", "key"), ["t", "key"])
    inside = several.select("t", "key", "fp").repartition("t", "key").sortWithinPartitions("t", "key")
    found = found.unionByName(inside.mapInArrow(_bucket_links(radius), "a bigint, b bigint"))
    large = buckets.where(F.col("n") > bucket).select("t", "key")
    if not large.isEmpty():
        members = keyed.join(large, ["t", "key"], "left_semi").select("fp").distinct()
        found = found.unionByName(_through_middles(members, radius, BITS))
    return written(found.distinct(), "simhash-links")


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every end of an edge; label is the smallest value in its component.

    Labels take the smallest label among neighbours, then that label's own label, until none changes: the distance
    to the smallest value about halves in a round. Each round is written to the shared folder.
    """
    both = written(
        edges.select(F.col("a").alias("v"), F.col("b").alias("w"))
        .unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("w"))), "edges")
    labels = written(both.groupBy("v").agg(F.min("w").alias("w")).select(
        "v", F.least("v", "w").alias("label")), "labels")
    while True:
        heard = (
            both.join(labels.select(F.col("v").alias("w"), F.col("label").alias("heard")), "w")
            .groupBy("v").agg(F.min("heard").alias("heard"))
        )
        told = written(labels.join(heard, "v").select(
            "v", F.col("label").alias("old"), F.least("label", "heard").alias("label")), "labels-told")
        root = told.select(F.col("v").alias("label"), F.col("label").alias("root"))
        after = written(told.join(root, "label").select(
            "v", "old", F.least("label", "root").alias("label")), "labels")
        labels = after.select("v", "label")
        if after.where("old <> label").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                    bucket: int = BUCKET) -> DataFrame:
    """doc_id, fp (bigint) and component_id of every row of ``docs`` (doc_id, text)."""
    prints = written(with_fingerprints(docs, shingle, seed), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = components(links(distinct, radius, bucket))
    grouped = distinct.join(labels.withColumnRenamed("v", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label"))
    ids = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    # Written, so that the last join shuffles plain tables and a fingerprint of many rows can be split.
    of_print = written(grouped.join(ids, "label").select("fp", "component_id"), "components")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """One row of each component of ``docs``; other columns are kept as they are."""
    key, rows = own_column(docs, "kept_key"), own_column(docs, "kept_rows")
    keyed = docs.withColumn(key, digest(*docs.columns))
    prints = written(with_fingerprints(keyed, shingle, seed, key), "fingerprints")
    labels = components(links(written(prints.select("fp").distinct(), "distinct"), radius, bucket))
    # Written, so that the join shuffles plain tables and a fingerprint of many rows can be split.
    labelled = written(prints.join(written(labels, "labels"), F.col("fp") == F.col("v"), "left").select(
        F.coalesce("label", "fp").alias("label"), "doc_id", "key"), "labelled")
    chosen = labelled.groupBy("label", "doc_id", "key").agg(F.count("*").alias("n")).groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key", "n")).alias("first"))
    kept = written(chosen.select(F.col("first.key").alias(key), F.col("first.n").alias(rows)), "kept")
    once = keyed.join(kept.where(F.col(rows) == 1), key, "left_semi")
    repeated = kept.where(F.col(rows) > 1)
    if not repeated.isEmpty():
        # Rows of one key are equal in every column.
        once = once.unionByName(keyed.join(repeated, key, "left_semi").dropDuplicates([key]))
    return once.select(docs.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
