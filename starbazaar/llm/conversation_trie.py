"""The prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence with the list of its ends. Sequences that are proper prefixes of others are
dropped by an anti-join: what stays are the leaves. The weighted sequences are then cut into their prefixes, and every figure of a node
is a sum over the sequences through it, so no subtree is ever walked and no pair of nodes of one path is formed:

* Each sequence owns the nodes whose smallest member is its own smallest member; along its path these are the last ones.
* The words of a subtree, each node counted as often as it has members, are the members' words less those before the node.
* The words of a subtree, each node counted once, are what its sequences own, but for the node's own smallest member, of which all
  from the node on counts.

A prefix is known by its depth and the exclusive or of the hashes of (depth, turn) in it, 128 bits. A turn's place is found in a global
order and its prefix hash in blocks, so neither a conversation of very many turns nor a turn that most conversations share comes into one
task. End lists are kept in blocks of at most ``BLOCK`` ids; a digest over a whole list reads them one after another.

Defined results: rows without conv_id belong to no conversation; a null turn comes first; rows of one turn go by role, then by the SHA-256 of
their text, and repeated rows are turns of their own; a null role or text is empty; a rebuilt conversation without turns ends at the root;
other columns are ignored; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starbazaar.llm.common import WORD, table, written
from starbazaar.operators.numbering import with_position

BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS
#: Conversations of one family share their first turns; at most so many less one.
FAMILY, MOST_SHARED = 20, 4


def _hash(lane: int, *parts: str) -> Column:
    return F.xxhash64(F.lit(lane), *parts)


def turns_of(rows: DataFrame) -> DataFrame:
    """c, place (from 0), said (a digest of role and text) and words of every turn of ``rows`` (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = written(rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("c"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        F.unhex(F.sha2(text, 256)).alias("said"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
        .withColumn("tail", F.monotonically_increasing_id()), "said")
    lined = with_position(said, ["c", "turn", "role", "said", "tail"], "at", "turns")
    first = written(lined.groupBy("c").agg(F.min("at").alias("first")), "first-turns")
    return lined.join(first, "c").select(
        "c", (F.col("at") - F.col("first")).alias("place"), "words",
        F.sha2(F.concat(F.col("said"), F.encode("role", "utf-8")), 256).alias("said"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (c, length) with the first turns of their family's first conversation in place of their own,
    and their turns (c, depth from 1, said, words)."""
    sizes = turns.groupBy("c").agg(F.count("*").alias("n")).select(
        "c", "n", (F.col("c") - F.col("c") % FAMILY).alias("base"),
        (F.crc32(F.col("c").cast("string")) % MOST_SHARED).alias("shared"))
    sizes = written(sizes, "conversation-sizes")
    bases = sizes.select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    convs = written(sizes.join(bases, "base", "left").select(
        "c", "base", "shared", F.least("shared", F.coalesce("base_n", F.lit(0))).alias("borrowed"), "n")
        .withColumn("length", F.col("borrowed") + F.greatest(F.col("n") - F.col("shared"), F.lit(0))), "conversations")
    own = turns.join(convs.select("c", "shared", "borrowed"), "c").where("place >= shared").select(
        "c", (F.col("place") - F.col("shared") + F.col("borrowed") + 1).alias("depth"), "said", "words")
    # A family has a bounded number of members, so a first turn is lent to few.
    lent = turns.where((F.col("c") % FAMILY == 0) & (F.col("place") < MOST_SHARED - 1)).withColumnRenamed("c", "base").join(
        convs.where("borrowed > 0").select("c", "base", "borrowed"), "base").where("place < borrowed").select(
        "c", (F.col("place") + 1).alias("depth"), "said", "words")
    return convs.select("c", "length"), own.unionByName(lent)


def collapsed(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations with the key (length, x, y) of their sequence, and the distinct sequences: key, rep (the smallest
    conversation), n (how many) and total (words)."""
    keys = turns.groupBy("c").agg(
        F.bit_xor(_hash(1, "depth", "said")).alias("x"), F.bit_xor(_hash(2, "depth", "said")).alias("y"), F.sum("words").alias("total"))
    known = written(convs.join(keys, "c", "left").select(
        "c", "length", *(F.coalesce(k, F.lit(0)).alias(k) for k in ("x", "y", "total"))), "keyed-conversations")
    sequences = known.groupBy("length", "x", "y").agg(
        F.min("c").alias("rep"), F.count("*").alias("n"), F.min("total").alias("total"))
    return known, written(sequences, "sequences")


def prefixes(sequences: DataFrame, turns: DataFrame) -> DataFrame:
    """Every prefix of every distinct sequence: rep, length, its key (depth, x, y), the key of the prefix before (px, py), the words
    of its last turn and of all before it."""
    cut = written(turns.join(sequences.select(F.col("rep").alias("c"), "length"), "c").select(
        F.col("c").alias("rep"), "length", "depth", _hash(1, "depth", "said").alias("zx"), _hash(2, "depth", "said").alias("zy"), "words",
        F.shiftright("depth", BLOCK_BITS).alias("block")), "sequence-turns")
    # Running values within a block of places, then those of the blocks before; only long sequences have any.
    before = Window.partitionBy("rep").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut.where(F.col("length") >= BLOCK).groupBy("rep", "block").agg(
        F.bit_xor("zx").alias("bx"), F.bit_xor("zy").alias("by"), F.sum("words").alias("bw"))
    carried = blocks.select("rep", "block", *(f(c).over(before).alias(c) for f, c in ((F.bit_xor, "bx"), (F.bit_xor, "by"), (F.sum, "bw"))))
    inside = Window.partitionBy("rep", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = cut.withColumns({"x": F.bit_xor("zx").over(inside), "y": F.bit_xor("zy").over(inside), "upto": F.sum("words").over(inside)})
    run = run.join(carried, ["rep", "block"], "left")
    zero = F.lit(0).cast("bigint")
    x, y = (F.col(c).bitwiseXOR(F.coalesce(b, zero)) for c, b in (("x", "bx"), ("y", "by")))
    rows = run.select(
        "rep", "length", "depth", x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("zx")).alias("px"), y.bitwiseXOR(F.col("zy")).alias("py"),
        "words", (F.col("upto") + F.coalesce("bw", zero) - F.col("words")).alias("before"))
    roots = sequences.select("rep", "length", *(zero.alias(c) for c in ("depth", "x", "y", "px", "py", "words", "before")))
    return written(rows.unionByName(roots), "prefixes")


def ends(known: DataFrame) -> DataFrame:
    """The end list of every sequence: its key, block and ids, at most ``BLOCK`` ascending conversations of one range of ids a row."""
    return known.withColumn("block", F.shiftright("c", BLOCK_BITS)).groupBy("length", "x", "y", "block").agg(
        F.sort_array(F.collect_list("c")).alias("ids"))


def end_digests(lists: DataFrame) -> DataFrame:
    """The SHA-256 of every end list as comma-joined numbers; blocks of a list are read in order, one at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            finished = []
            for *now, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        finished.append((*key, digest.hexdigest()))
                    key, digest = now, hashlib.sha256()
                digest.update(text.encode())
            yield rows(finished)
        if key is not None:
            yield rows([(*key, digest.hexdigest())])

    def rows(finished: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*finished)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (*[pa.int64()] * 3, pa.string()))], ["length", "x", "y", "ends_sha256"])

    placed = lists.select(
        "length", "x", "y", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text")).repartition(
        "length", "x", "y").sortWithinPartitions("length", "x", "y", "block")
    return placed.select("length", "x", "y", "text").mapInArrow(run, "length bigint, x bigint, y bigint, ends_sha256 string")


def trie(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes over the rebuilt conversations of ``rows`` (conv_id, turn, role, text), with their key (depth, x, y); and the end lists."""
    convs, turns = rebuilt(written(turns_of(rows), "placed-turns"))
    turns = written(turns, "rebuilt-turns")
    known, sequences = collapsed(convs, turns)
    paths = prefixes(sequences, turns)

    # Leaves: the sequences that no other goes on from.
    inner = paths.where("depth < length").select(F.col("depth").alias("length"), "x", "y").distinct()
    leaves = sequences.join(inner, ["length", "x", "y"], "left_anti").select("rep", F.lit(1).alias("leaf"))
    owned = paths.groupBy("depth", "x", "y").agg(F.min("rep").alias("rep"), F.min("words").alias("words")).groupBy("rep").agg(
        F.sum("words").alias("owned"))
    weighted = written(
        sequences.join(leaves, "rep", "left").join(owned, "rep", "left").select(
            "rep", "n", "total", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("owned", F.lit(0)).alias("owned")), "weighted-sequences")

    first = F.min(F.struct("rep", "total", "owned"))
    nodes = written(paths.join(weighted, "rep").groupBy("depth", "x", "y", "px", "py").agg(
        first.alias("first"), F.sum("n").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.min("before").alias("before"),
        F.sum(F.col("n") * F.col("total")).alias("all_words"), F.sum("owned").alias("all_owned")).select(
        F.col("first.rep").alias("conv_id"), "depth", "x", "y", "px", "py", "n_convs", "n_leaves",
        (F.col("all_words") - F.col("n_convs") * F.col("before") - F.col("all_owned") + F.col("first.owned")
         - F.col("first.total") + F.col("before")).alias("saved_tokens")), "nodes")

    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count("*").alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(below, ["depth", "x", "y"], "left").select(
        "conv_id", "depth", "x", "y", "px", "py", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        F.col("n_leaves").cast("bigint").alias("n_leaves"), "saved_tokens")
    return written(found, "counted-nodes").join(above, ["depth", "px", "py"], "left").drop("px", "py"), ends(known)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, lists = trie(table(spark, sf_dir, "conversations"))
    digests = end_digests(lists).withColumnRenamed("length", "depth")
    return nodes.join(digests, ["depth", "x", "y"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


#: The CRC-32 of a number's digits, bit by bit.
_CRC = """
xor(list_reduce(list_concat([4294967295], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda crc, b:
    list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""

ORACLE_SQL = f"""
WITH turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS place,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT c, c - c % 20 AS base, {_CRC} % 4 AS shared FROM turns),
lent AS (SELECT convs.c, convs.shared, t.place, t.role, t.text FROM convs JOIN turns t ON t.c = convs.base WHERE t.place < convs.shared),
parts AS (
    SELECT c, 0 AS part, place, role, text FROM lent
    UNION ALL
    SELECT c, 1, place, role, text FROM turns JOIN convs USING (c) WHERE place >= shared),
placed AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, place) AS depth, sha256(to_json([role, text])) AS said,
        len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM parts),
paths AS (
    SELECT c, depth, words, string_agg(said, '') OVER (PARTITION BY c ORDER BY depth) AS path FROM placed
    UNION ALL
    SELECT c, 0, 0, '' FROM convs),
lengths AS (SELECT c, max(depth) AS length FROM paths GROUP BY c),
keyed AS (SELECT c, depth, words, sha256(path) AS node, CASE WHEN depth > 0 THEN sha256(left(path, length(path) - 64)) END AS parent FROM paths),
nodes AS (SELECT node, depth, parent, min(c) AS conv_id, count(*) AS n_convs, min(words) AS words FROM keyed GROUP BY node, depth, parent),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * words AS saved FROM nodes LEFT JOIN kids USING (node)),
-- Every node with each node above it, by way of the node's smallest member.
above AS (
    SELECT up.node AS top, n.n_children, n.saved FROM counted n JOIN keyed up ON up.c = n.conv_id AND up.depth <= n.depth),
sums AS (
    SELECT top AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY top),
ended AS (
    SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM keyed JOIN lengths USING (c) WHERE depth = length GROUP BY node)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
    s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted n JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN ended e ON e.node = n.node
"""
