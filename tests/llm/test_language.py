"""Language identification: features by brute force, clustering, what is learned from, held-out accuracy, awkward rows."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL_DIR
from starbazaar.llm import language_centroids as lang

MIDDLE_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, LANG_PRED string, score double"


def grams(text):
    """The n-grams of a text, as tuples of code points, the last first."""
    line = "  " + "".join(c if lang._kinds()[ord(c)] else " " for c in text.lower()) + " "
    found = collections.Counter()
    for i in range(2, len(line)):
        a, b, c = line[i - 2], line[i - 1], line[i]
        found[(c,)] += c != " "
        found[(c, b)] += (b, c) != (" ", " ")
        found[(c, b, a)] += b != " "
    return found


def bucket(gram):
    h = 0
    for c, factor in zip(gram, lang._FACTORS):
        h = (h + ord(c)) * int(factor) % (1 << 64)
    return h >> (64 - lang.BUCKET_BITS)


@pytest.mark.parametrize("piece", [1, 3, 7, lang.PIECE])
def test_counts_against_brute_force(monkeypatch, piece):
    monkeypatch.setattr(lang, "PIECE", piece)
    for text in ("The quick  fox, 12 times.", "Œuvre ÉTÉ\n", "x", " a ", "日本語 テキスト", "नमस्ते", "1 a2b 3", "straße İstanbul"):
        expected = np.zeros(lang.BUCKETS, np.int64)
        for gram, n in grams(text).items():
            expected[bucket(gram)] += n
        assert np.array_equal(lang.counts(text), expected), text
    assert lang.counts(None) is lang.counts("") is lang.counts(" 12 .,\n") is None


def test_vectors_have_length_one():
    idf = np.linspace(1, 2, lang.BUCKETS)
    at, values = lang.vector("two words", idf)
    n = lang.counts("two words")
    plain = (1 + np.log(n[at])) * idf[at]
    assert np.allclose(values, plain / np.sqrt((plain ** 2).sum()), atol=1e-6) and (n[at] > 0).all() and (n > 0).sum() == len(at)


def test_clusters_are_the_nearest_means_and_strays_are_dropped():
    draw = np.random.default_rng(1)
    groups = [np.eye(40)[k] + draw.normal(0, 0.02, (60, 40)) for k in range(3)] + [np.eye(40)[9] + draw.normal(0, 0.02, (2, 40))]
    vectors = np.concatenate(groups)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centroids, member = lang.clusters(vectors)
    assert len(centroids) == 3 and sorted(np.argmax(centroids, axis=1)) == [0, 1, 2]
    for k in range(3):
        own = vectors[k * 60:k * 60 + 60]
        assert len(set(member[k * 60:k * 60 + 60])) == 1
        mean = own.sum(axis=0) / np.linalg.norm(own.sum(axis=0))
        assert np.allclose(centroids[member[k * 60]], mean, atol=0.05)
    assert np.allclose(np.linalg.norm(centroids, axis=1), 1)
    alone, _ = lang.clusters(vectors[:1])
    assert np.allclose(alone, vectors[:1])


def test_nothing_is_learned_from_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    kept = ~lang.held_out(F.col("doc_id"))
    turned = docs.withColumn("lang", F.when(kept, F.col("lang")).otherwise("xx")).withColumn(
        "text", F.when(kept, F.col("text")).otherwise("entirely other words"))
    a, b = lang.learn(docs.where(kept)), lang.learn(turned.where(kept))
    assert a.languages == b.languages and np.array_equal(a.centroids, b.centroids) and np.array_equal(a.idf, b.idf)


def test_document_frequencies_cover_every_row(spark):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet").select("text")
    expected = np.zeros(lang.BUCKETS + 1)
    for r in docs.collect():
        n = lang.counts(r.text)
        if n is not None:
            expected[:-1] += n > 0
            expected[-1] += 1
    assert np.array_equal(lang._document_frequencies(docs), expected)


def test_query_is_right_on_held_out_rows(spark):
    given = {r.doc_id: r for r in spark.read.parquet(f"{MIDDLE_DIR}/documents.parquet").collect()}
    found = entry.queries()["op12_language"](spark, MIDDLE_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(given)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in found} <= {"en", "de", "fr", "es", "und"}
    for held in (False, True):
        own = [r.lang_pred == given[r.doc_id].lang for r in found if r.held_out == held and any(c.isalpha() for c in given[r.doc_id].text or "")]
        assert len(own) > 200 and sum(own) >= 0.98 * len(own)


def test_awkward_rows(spark):
    long = "palabra " * 40_000 + "x" * 30_000
    rows = [(1, "the cat and the dog", "en"), (1, "the cat and the dog", "en"), (2, "el gato y la casa " * 3, "es"), (3, long, "es"), (4, None, "en"),
            (5, "", "en"), (6, "12 345 .", "en"), (None, "the house and the tree", "en"), (8, "the end of it", None), (9, "Ελληνικά", None),
            (10, "x", "Zz")]
    docs = spark.createDataFrame([(*r, "kept", 0.5) for r in rows], SCHEMA)
    model = lang.learn(docs)
    assert model.languages == ["en", "es", "Zz"]  # by different texts, then by name
    found = lang.identified(docs, model).collect()
    assert len(found) == len(rows) and [r.doc_id for r in found].count(1) == 2
    by = {r.doc_id: r for r in found}
    assert [by[i].lang_pred for i in (1, 2, 3, 4, 5, 6, None, 8, 9, 10)] == ["en", "es", "es", "und", "und", "und", "en", "en", "en", "Zz"]
    assert by[9].score == 0 and by[9].rejected and by[4].score == 0 and not by[2].rejected
    nobody = lang.learn(docs.where("lang = 'none'"))
    assert {r.lang_pred for r in lang.identified(docs, nobody).collect()} == {"und"}
    assert lang.identified(docs.limit(0), model).collect() == []


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(lang, "MOST_LANGUAGES", 2)
    docs = spark.createDataFrame([(f"text {c}", c) for c in "abc"], "text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        lang.learn(docs)
