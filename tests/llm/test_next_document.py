"""The order of the documents, and who is whose next."""

import random

import pytest
import xxhash

from starbazaar.llm import paragraph_sketch


def signed_hash(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


@pytest.mark.parametrize("ranges", [None, 1, 16])
def test_next_documents_of_rows_without_ids(spark, ranges):
    draw = random.Random(6)
    given = [(draw.choice([None, None, draw.randint(-50, 50), 7]), f"text {i}" if i % 9 else None) for i in range(300)]
    given += [(-(1 << 63), "least"), ((1 << 63) - 1, "most"), (-(1 << 63) + 5, "nearly least")]
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    line = sorted(given, key=lambda g: (g[0] is None, -(g[0] or 0), -~signed_hash(g[1])))
    found = paragraph_sketch.with_next(docs, ranges).collect()
    expected = sorted((i, t or "", n or "") for (i, t), (_, n) in zip([(i, t) for i, t in line], line[1:] + line[:1]) if i is not None)
    assert sorted(tuple(r) for r in found if r.doc_id is not None) == expected
    assert sorted((r.text, r.next) for r in found if r.doc_id is None) == sorted(
        (t or "", n or "") for (i, t), (_, n) in zip(line, line[1:] + line[:1]) if i is None)


def test_rows_without_ids_spread_over_ranges(spark):
    docs = spark.createDataFrame([(None if i % 3 else i, f"text {i}") for i in range(300)], "doc_id bigint, text string")
    ids = [r.id for r in paragraph_sketch._with_order(docs).where("doc_id IS NULL").select("id").collect()]
    assert len(set(ids)) == 200 and max(ids) < -(1 << 63) + (1 << 40)
