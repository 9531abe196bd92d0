"""Rows without a doc_id, or sharing one, are documents of their own in the near-duplicate choice and in the mix."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from starbazaar.llm import mixing, simhash_covering
from starbazaar.llm.common import digest
from test_text_operators import shared

SCHEMA = "doc_id bigint, text string, lang string, source string, KEPT_KEY string"


def prose(draw, n=60):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def components(texts):
    prints = [simhash_covering.fingerprint(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            root[top(i)] = top(j)
    return [top(i) for i in range(len(texts))]


def test_far_apart_rows_all_stay(spark):
    draw = random.Random(1)
    given = [(i, prose(draw), "en", "s", "k") for i in (None, None, None, None, None, 7, 7, 8)]
    kept = simhash_covering.one_of_each(spark.createDataFrame(given, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "source", "KEPT_KEY"]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(given, key=repr)


def test_one_row_of_each_component(spark):
    draw = random.Random(2)
    texts = [prose(draw) for _ in range(12)] + [None, ""]
    given = []
    for n, text in enumerate(texts):
        for _ in range(draw.choice([1, 1, 2, 5])):
            # Copies with and without ids, equal in some columns or in all; and near copies.
            near = text and (text if draw.random() < 0.7 else text + " " + prose(draw, 1))
            given.append((draw.choice([None, 3, 3, n]), near, draw.choice(["en", None]), draw.choice([None, "en"]), "k"))
    given += [given[0]] * 4
    kept = simhash_covering.one_of_each(spark.createDataFrame(given, SCHEMA)).collect()
    of = components([g[1] for g in given])
    by_row = {g: c for g, c in zip(given, of)}
    found = [by_row[tuple(r)] for r in kept]
    assert sorted(found) == sorted(set(of))
    for r in kept:
        ids = [g[0] for g, c in zip(given, of) if c == by_row[tuple(r)]]
        assert r.doc_id == min((i for i in ids if i is not None), default=None)


def mixed_rows(draw):
    given = [(None if i % 2 else i // 4, "w " * (1 + i % 7) + str(i), "en", "abc"[i % 3], "k") for i in range(900)]
    given += [(5, "one of many equal rows", "en", "b", "k")] * 700 + [(None, "again and again", "en", None, "k")] * 300
    draw.shuffle(given)
    return given


def taken_near_targets(taken, given):
    sizes, largest = collections.Counter(), collections.Counter()
    for _, text, _, source, _ in given:
        sizes[source] += len(text.split())
        largest[source] = max(largest[source], len(text.split()))
    targets = shared(sizes)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6, (s, taken[s], targets[s])


@pytest.mark.parametrize("piece", [mixing.PIECE, 64])
def test_a_mix_of_rows_without_ids_comes_near_its_targets(spark, monkeypatch, piece):
    monkeypatch.setattr(mixing, "PIECE", piece)
    given = mixed_rows(random.Random(3))
    docs = spark.createDataFrame(given, SCHEMA)
    found = mixing.mix(docs).collect()
    assert len(found) == len(given)
    assert collections.Counter((r.doc_id, r.source, r.size) for r in found) == collections.Counter((g[0], g[3], len(g[1].split())) for g in given)
    taken = collections.Counter()
    for r in found:
        taken[r.source] += r.taken
    taken_near_targets(taken, given)
    again = mixing.repeated(docs).collect()
    taken = collections.Counter()
    for r in again:
        taken[r.source] += len(r.text.split())
    taken_near_targets(taken, given)
    times = collections.Counter(map(tuple, again))
    counts = collections.Counter(given)
    assert set(times) <= set(counts) and all(n <= 3 * counts[g] for g, n in times.items())


def test_digests_tell_nulls_apart(spark):
    rows = [(None, "a"), ("a", None), (None, None), ("", ""), ("", None), ("a", "a")]
    found = spark.createDataFrame(rows, "x string, y string").select(digest("x", "y").alias("d")).distinct()
    assert found.count() == len(rows) and found.where(F.length("d") != 32).count() == 0
