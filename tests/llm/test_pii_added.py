"""What the boosted trees add to the plain spans."""

import random

import pytest

from starbazaar.llm import pii_boosting


def texts(draw):
    """Texts with plain spans, spelled addresses, phones without a plus, and what only looks like them."""
    names = ["jane", "joe.doe", "m_smith", "ana-li", "k.w"]

    def words(n):
        return " ".join(draw.choice(["some", "other", "plain", "words", "here", "and", "there"]) for _ in range(n))

    def phone():
        return f"({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}"

    def address(at, dot):
        return f"{draw.choice(names)}{at}mail{draw.randint(1, 9)}{dot}example{dot}com"

    plain = [lambda: address("@", "."), lambda: f"+1 {phone()}", lambda: ".".join(str(draw.randint(11, 255)) for _ in range(4))]
    added = {"spelled": (lambda: address(" [at] ", "."), 200), "dots": (lambda: address(" (at) ", " (dot) "), 40), "bare": (phone, 120)}
    alike = [lambda: f"version {draw.randint(10, 99)}.{draw.randint(10, 99)}.{draw.randint(10, 99)}", lambda: f"page {draw.randint(100, 999)}-{draw.randint(1000, 9999)}",
             lambda: f"{draw.randint(1990, 2024)}-{draw.randint(10, 12)}-{draw.randint(10, 28)}", lambda: f"{draw.randint(10, 99)} {draw.randint(10, 99)}"]
    found = []
    for kind, make, n in [("plain", draw.choice(plain), 1) for _ in range(450)] + [(k, m, n) for k, (m, n) in added.items()] + [("alike", None, 160)]:
        for i in range(n):
            what = draw.choice(alike)() if kind == "alike" else make()
            left = words(draw.randint(1, 5))
            found.append((kind, f"{left} {what} {words(draw.randint(1, 4))}", len(left) + 1, len(left) + 1 + len(what)))
    draw.shuffle(found)
    return found


def test_trees_add_what_looks_like_plain_spans(spark):
    given = texts(random.Random(4))
    docs = spark.createDataFrame([(i, t) for i, (_, t, _, _) in enumerate(given)], "doc_id bigint, text string")
    seen = {"spelled": 0, "dots": 0, "bare": 0}
    for r in pii_boosting.found_in(docs).collect():
        kind, text, start, end = given[r.doc_id]
        if kind == "plain":
            assert [(s.start, s.end) for s in r.spans if s.plain] == [(start, end)] and len(r.spans) == 1, text
        elif kind == "alike":
            assert r.spans == [], text
        else:
            assert not any(s.plain for s in r.spans)
            seen[kind] += [(pii_boosting.KINDS[s.kind], s.start, s.end) for s in r.spans] == [("phone" if kind == "bare" else "email", start, end)]
    assert seen["spelled"] >= 190 and seen["dots"] >= 36 and seen["bare"] >= 110, seen


def test_without_evidence_against_anything_nothing_is_added(spark):
    docs = spark.createDataFrame([(i, f"write to jane{'x' * i}@example.com or joe [at] example.com") for i in range(40)], "doc_id bigint, text string")
    assert all([s.plain for s in r.spans] == [True] for r in pii_boosting.found_in(docs).collect())


def test_every_labelled_candidate_is_learned_from(spark, monkeypatch):
    given, own = [], pii_boosting.learn
    monkeypatch.setattr(pii_boosting, "learn", lambda rated, names: given.append(rated) or own(rated, names))
    text = " ".join([f"jane{'x' * i}@example.com" for i in range(20)] + ["in version 1.2.3.999 of"] * 5)
    pii_boosting.found_in(spark.createDataFrame([(i, text) for i in range(1_000)], "doc_id bigint, text string")).collect()
    seen = {r.label: r.n for r in given[0].selectExpr("label", "weight").groupBy("label").sum("weight").toDF("label", "n").collect()}
    assert seen[1] == 20_000 and seen[0] >= 5_000
    assert given[0].count() < 1_000  # equal candidates are one row


@pytest.mark.parametrize("match, kind, expected", [
    ("joe [at] example (dot) com", 0, "joe@example.com"), ("+1 (200) 555", 3, "1 (200) 555"), ("4111 1111", 2, "4111 1111")])
def test_spelled_forms_look_like_plain_ones(spark, match, kind, expected):
    row = spark.createDataFrame([(match, kind)], "match string, kind int").select(pii_boosting._canonical().alias("c")).first()
    assert row.c == expected


def test_candidates_are_written_once(spark, monkeypatch):
    labels, own = [], pii_boosting.written
    monkeypatch.setattr(pii_boosting, "written", lambda df, label: labels.append(label) or own(df, label))
    docs = spark.createDataFrame([(1, "write to jane@example.com in version 1.2.3.999"), (2, None)], "doc_id bigint, text string")
    assert {r.doc_id: len(r.spans) for r in pii_boosting.found_in(docs).collect()} == {1: 1, 2: 0}
    assert sorted(labels) == ["pii-known", "pii-learned", "pii-matches"]
