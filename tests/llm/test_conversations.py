"""The prefix trie of conversations against brute force and SQL."""

import collections
import hashlib
import random
import re
import zlib

import pytest

import __spark_entry__ as entry
from compare import difference, duck
from conftest import SMALL_DIR
from starbazaar.llm import conversation_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, C string, depth int"


def brute(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = collections.defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    found = []
    for node, inside in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ended = ",".join(str(c) for c in sorted(inside) if built[c] == node)
        found.append((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(children), len(leaves), saved,
                      hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(found, key=repr)


def nodes(spark, rows):
    docs = spark.createDataFrame([(*r, "extra", 9) for r in rows], SCHEMA)
    found, lists = conversation_trie.trie(docs)
    digests = {(r.length, r.x, r.y): r.ends_sha256 for r in conversation_trie.end_digests(lists).collect()}
    none = hashlib.sha256(b"").hexdigest()
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                    digests.get((r.depth, r.x, r.y), none)) for r in found.collect()), key=repr)


def drawn(seed):
    draw, rows = random.Random(seed), []
    for c in draw.sample(range(200), 70):
        for turn in range(draw.choice([1, 2, 3, 5])):
            rows.append((c, turn, draw.choice(["user", "assistant", None]), draw.choice(["a", "b c", "", None, "d e f"])))
    # Ties, repeated rows, null turns and rows of no conversation.
    rows += [(40, 1, "user", "tie"), (40, 1, "user", "tie"), (40, 1, "system", "tie"), (40, None, None, None), (40, None, "user", "z"),
             (None, 1, "user", "nobody"), (None, None, None, None), (10 ** 12 + 7, 0, "user", "far away")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_against_brute_force(spark, seed):
    rows = drawn(seed)
    assert nodes(spark, rows) == brute(rows)


def test_long_conversations_and_end_lists_run_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK_BITS", 2)
    monkeypatch.setattr(conversation_trie, "BLOCK", 4)
    rows = [(c, t, "user", "same words") for c in range(60) for t in range(13)]
    rows += [(60, t, "user", "same words") for t in range(40)] + drawn(3)
    assert nodes(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert nodes(spark, []) == []


def test_very_long_turns(spark):
    rows = [(c, t, "user", "wort " * 50_000 + "x" * 100_000 + str(t)) for c in (1, 2, 21) for t in range(2)]
    assert nodes(spark, rows) == brute(rows)


def test_query_against_brute_force_and_sql(spark):
    query = entry.queries()["op11_conversations"]
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in query(spark, SMALL_DIR).collect()), key=repr) == brute(given)
    assert difference(query(spark, SMALL_DIR), duck(SMALL_DIR), conversation_trie.ORACLE_SQL) is None
