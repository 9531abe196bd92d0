"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from conftest import SMALL_DIR
from starbazaar.llm import periodic_runs


def brute(words):
    """Every run by looking at every period."""
    n, found = len(words), {}
    ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
    own = np.array([ids[w] for w in words])
    for q in range(1, n // 2 + 1):
        unequal = np.flatnonzero(own[q:] != own[:-q])
        for a, b in zip([-1, *unequal.tolist()], [*unequal.tolist(), n - q]):
            start, end = a + 1, b + q
            if end - start >= max(12, 2 * q):
                found.setdefault((start, end), q)
    runs = sorted((s, e - s, q) for (s, e), q in found.items())
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in dropped)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def drawn(draw, n, letters):
    """Words with planted repeats."""
    out = []
    while len(out) < n:
        root = [draw.choice(letters) for _ in range(draw.choice([1, 1, 2, 3, 5, 6, 7, 8, 13, 31, 32, 64, 70]))]
        out += (root * draw.randint(1, 9))[:draw.randint(1, 400)]
    return out[:n]


def test_transform_against_the_definition():
    draw = np.random.default_rng(3)
    for bits in (2, 5, 6, 9, 11):
        n = 1 << bits
        rows = draw.integers(0, periodic_runs.PRIME, (3, n)).astype(float)
        spectrum = periodic_runs.Transform(bits)(rows)
        assert np.array_equal(periodic_runs.Transform(bits, True)(spectrum) % periodic_runs.PRIME, rows)
        root = pow(periodic_runs.ROOT, (periodic_runs.PRIME - 1) >> bits, periodic_runs.PRIME)
        for k in (0, 1, n - 1, n // 2 + 1):
            assert spectrum[1, k] % periodic_runs.PRIME == sum(int(x) * pow(root, i * k, periodic_runs.PRIME) for i, x in enumerate(rows[1])) % periodic_runs.PRIME


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed):
    draw = random.Random(seed)
    texts = [drawn(draw, draw.choice([0, 1, 11, 12, 13, 25, 60, 200, 900]), letters) for letters in ("ab", "abc", "abcdefghij") for _ in range(25)]
    texts += [["be"] * n for n in (11, 12, 13, 500, 501)] + [["a"] * 40 + ["b"] + ["a"] * 40] * 2 + [["be"] * 20] * 3
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 800:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts.append(list(fibonacci[-1]))
    for words, (runs, kept) in zip(texts, periodic_runs.of_texts([" ".join(t) for t in texts])):
        assert (runs, kept.decode()) == brute(words)


def test_long_blocks_are_found_by_their_first_words(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PATTERN", 8)
    monkeypatch.setattr(periodic_runs, "ELEMENTS", 64)
    draw = random.Random(9)
    texts = [drawn(draw, 700, letters) for letters in ("ab", "abcdefghijkl", "abc")] + [["x"] * 90]
    for words, (runs, kept) in zip(texts, periodic_runs.of_texts([" ".join(t) for t in texts])):
        assert (runs, kept.decode()) == brute(words)


def test_a_chance_hash_is_noticed(monkeypatch):
    """A stretch that hashes call equal and words do not is tried again with other hashes."""
    words = drawn(random.Random(5), 300, "abcdefghij")
    plain, seen = periodic_runs._candidates, []

    def misled(group):
        seen.append(group)
        rows = plain(group)
        return np.concatenate([rows, [[0, 300, 149]]]) if len(seen) == 1 else rows

    monkeypatch.setattr(periodic_runs, "_candidates", misled)
    (runs, kept), = periodic_runs.of_texts([" ".join(words)])
    assert (runs, kept.decode()) == brute(words) and len(seen) == 2


def test_awkward_rows(spark):
    text = "wort " * 20_000 + "x" * 30_000
    given = [(1, None), (2, ""), (3, " \t\n \r\n"), (4, text), (5, "a b " * 7), (5, "a b " * 7), (None, "a b " * 12), (None, None)]
    docs = spark.createDataFrame([(*r, "extra", 1) for r in given], "doc_id bigint, text string, RUNS string, start int")
    found = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.with_runs(docs).collect()), key=repr)
    expected = []
    for i, t in given:
        if i == 4:
            expected.append((4, [(0, 20_000, 1)], "wort " + "x" * 30_000))
        else:
            expected.append((i, *brute(words_of(t))))
    assert found == sorted(expected, key=repr)
    assert periodic_runs.with_runs(docs.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL_DIR}/documents.parquet").select("doc_id", "text").collect()}
    found = entry.queries()["op13_runs"](spark, SMALL_DIR).collect()
    assert len(found) == len(texts) and found[0].__fields__ == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rewritten = 0
    for r in found:
        words, h = words_of(texts[r.doc_id]), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, rewritten = g % n, rewritten + 1
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs, kept = brute(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert tuple(r) == (
            r.doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(kept))
    assert rewritten
