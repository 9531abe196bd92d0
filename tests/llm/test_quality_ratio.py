"""The likelihood ratio, its threshold and the verdict against plain counting."""

import collections
import math
import random
import re

import numpy as np
import pytest
import xxhash

from starbazaar.llm import quality_likelihood as quality


def buckets(text):
    tokens = [t.encode() for t in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^\x00-\x20\x80-\U0010ffff0-9A-Za-z]+", text or "")]
    hashes = [xxhash.xxh64_intdigest(t) for t in tokens]
    wide = hashes + [((a * 0x9E3779B97F4A7C15 + b) * 0xC2B2AE3D27D4EB4F) % (1 << 64) for a, b in zip(hashes, hashes[1:])]
    return [h >> (64 - quality.BUCKET_BITS) for h in wide]


def corpus(seed):
    draw = random.Random(seed)
    good, bad = ("alpha beta gamma delta epsilon zeta".split(), "buy now cheap !! click $$ free".split())
    docs, labels = [], []
    for i in range(160):
        is_good = i % 2 == 0
        docs.append((i, " ".join(draw.choice((good if is_good else bad) + ["the", "of"]) + draw.choice(["", "s", "x"]) for _ in range(draw.randint(55, 90)))))
        if i % 3:
            labels.append((i, int(is_good)))
    docs += [(200, None), (201, ""), (202, "é ünï çode"), (None, "no id here"), (3, docs[3][1])]
    labels += [(1, 0), (900, 1), (None, 1), (5, None)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_ratios_scores_threshold_and_verdict(spark, seed):
    docs, labels = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    halves = {r.id: (r.quality, r.half) for r in quality._own(marks).collect()}
    target, raw = collections.Counter(), collections.Counter()
    for i, text in docs:
        raw.update(buckets(text))
        if halves.get(i) == (1, True):
            target.update(buckets(text))

    def log(counts, b):
        return math.log((counts[b] + quality.SMOOTHING) / (sum(counts.values()) + quality.SMOOTHING * quality.BUCKETS))

    def score(text):
        found = buckets(text)
        return sum(log(target, b) - log(raw, b) for b in found) / (len(found) + quality.SHRINK)

    ratios, cut = quality.learn(frame, marks)
    met = sorted(raw)
    assert np.allclose([ratios[b] for b in met], [log(target, b) - log(raw, b) for b in met])

    judged = {}
    for i, text in docs:
        if i in halves and halves[i] != (1, True) and not quality.counts(text)[0] < 50:
            n, _, _, _, repeated = quality.counts(text)
            if 100 * repeated <= 50 * n:
                judged[i] = (score(text), halves[i][0])
    good = sorted(s for s, q in judged.values() if q)
    bad = sorted(s for s, q in judged.values() if not q)
    cuts = sorted(set(good + bad))
    rates = [sum(g >= c for g in good) / len(good) + sum(b < c for b in bad) / len(bad) for c in cuts]
    best = max(range(len(cuts)), key=lambda k: (round(rates[k], 12), -k))
    expected = min((cuts[best] + cuts[best - 1]) / 2 if best else cuts[best], good[int(quality.GOOD_LOST * len(good))])
    assert cut == pytest.approx(expected)

    found = quality.judged(frame, marks).collect()
    assert len(found) == len(docs)
    texts = collections.defaultdict(set)
    for i, text in docs:
        texts[i].add(text)
    for r in found:
        text, = texts[r.doc_id]
        assert r.score == pytest.approx(score(text), abs=1e-9)
        n, _, _, _, repeated = quality.counts(text)
        failed = n < 50 or 100 * repeated > 50 * n
        assert r.base_failed == failed
        if abs(score(text) - cut) > 1e-9:
            assert r.kept == (not failed and score(text) >= cut)


def cut_of(judged):
    """The threshold by plain counting over all judged (score, quality)."""
    good, bad = (sorted(s for s, q in judged if q == k) for k in (1, 0))
    cuts = sorted({s for s, _ in judged})
    rates = [sum(g >= c for g in good) * len(bad) + sum(b < c for b in bad) * len(good) for c in cuts]
    best = max(range(len(cuts)), key=lambda k: (rates[k], -k))
    return min((cuts[best] + cuts[best - 1]) / 2 if best else cuts[best], good[int(quality.GOOD_LOST * len(good))])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_cut_comes_from_every_judged_row(spark, seed):
    draw = random.Random(seed)
    judged = [(draw.choice([draw.gauss(q, 1), round(draw.gauss(q, 1), 1)]), q) for q in (0, 1) for _ in range(400)]
    assert quality.threshold(spark.createDataFrame(judged, "score double, quality int")) == cut_of(judged)


def test_no_labelled_document_is_left_out(spark):
    draw = random.Random(5)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    docs = [(i, " ".join(draw.choice(words if i % 2 else words[3:] + ["spam"]) for _ in range(52)) + f" {'x' * (i % 7)}") for i in range(9_000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    marks = spark.createDataFrame([(i, int(i % 20 == 1)) for i, _ in docs], "doc_id bigint, quality int")
    ratios, cut = quality.learn(frame, marks)
    halves = {r.id: (r.quality, r.half) for r in quality._own(marks).collect()}
    scored = {r.doc_id: r for r in quality.rated(frame, ratios).withColumn("failed", quality._failed()).collect()}
    judged = [(scored[i].score, q) for i, (q, half) in halves.items() if not (q and half) and not scored[i].failed]
    assert sum(not q for _, q in judged) > 4_000
    rows = quality.judged_scores(quality._scored(frame, ratios), frame, marks, ratios).collect()
    assert sorted((r.score, r.quality) for r in rows) == sorted(judged)
    assert cut == quality.threshold(spark.createDataFrame(judged, "score double, quality int"))


def test_of_unlike_texts_of_one_id_the_smallest_is_judged(spark):
    docs, labels = corpus(1)
    docs += [(3, docs[4][1]), (1, docs[1][1])]
    frame, marks = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")
    ratios = quality.log_ratios(frame, marks)
    rows = quality.judged_scores(quality._scored(frame, ratios), frame, marks, ratios).collect()
    halves = {r.id: (r.quality, r.half) for r in quality._own(marks).collect()}
    smallest = {}
    for i, text in docs:
        if halves.get(i, (1, True)) != (1, True) and text is not None:
            smallest[i] = min(smallest.get(i, text), text)
    scored = quality.rated(spark.createDataFrame(list(smallest.items()), "doc_id bigint, text string"), ratios).where(~quality._failed()).collect()
    assert sorted((r.score, r.quality) for r in rows) == sorted((r.score, halves[r.doc_id][0]) for r in scored)
