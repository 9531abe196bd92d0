"""Line templates against a plain walk through every leaf."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from starbazaar.llm import common, line_templates

SLACK = 5


def form(line):
    return tuple("<*>" if re.search("[0-9@]", w) else w for w in re.findall(r"[^\x20\x09-\x0D]+", line))


def brute(docs):
    """The positions that go, by document."""
    seen = collections.defaultdict(dict)
    for doc, text in sorted(docs):
        for pos, line in enumerate(text.split("\n")):
            if len(form(line)) >= 4:
                seen[form(line)].setdefault(doc, pos)
    leaves = collections.defaultdict(list)
    for f, places in seen.items():
        leaves[len(f), f[:3]].append((-len(places), min(places), places[min(places)], f))
    template = {}
    for forms in leaves.values():
        leads = []
        for *_, f in sorted(forms):
            met = [lead for lead in leads if SLACK * sum(a != b for a, b in zip(lead, f)) <= len(f)]
            template[f] = met[0] if met else f
            if not met:
                leads.append(f)
    docs_of = collections.defaultdict(set)
    for f, t in template.items():
        docs_of[t] |= set(seen[f])
    return {doc: [line for line in text.split("\n") if not (
        form(line) in template and len(docs_of[template[form(line)]]) > 1 and min(docs_of[template[form(line)]]) != doc)]
            for doc, text in docs}


def check(spark, docs):
    found = {r.doc_id: r.text.split("\n") for r in line_templates.without_recurring(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    expected = {doc: lines or [""] for doc, lines in brute(docs).items()}
    assert found == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_all_templates_of_a_leaf_against_a_plain_walk(spark, seed):
    draw, docs = random.Random(seed), []
    families = [[draw.choice("abc") + draw.choice("xy") for _ in range(n)] for n in (5, 6, 9, 10, 12, 17, 25, 60) for _ in range(4)]
    for doc in range(60):
        lines = []
        for _ in range(6):
            words = list(draw.choice(families))
            words[:3] = ["one", "and", "same"]
            for _ in range(draw.choice([0, 1, 1, 2, 3, len(words) // 5 + 1])):
                words[draw.randrange(3, len(words))] = draw.choice(["p", "q", "r", "s7", f"u{doc}", f"own{'abcdefghij'[doc % 10]}"])
            lines.append(" ".join(words))
        docs.append((doc, "\n".join(lines)))
    check(spark, docs)


def test_two_families_in_one_leaf(spark):
    docs = [(i, f"the same opening words then alpha beta gamma delta {'abcd'[i]}") for i in range(4)]
    docs += [(i, f"the same opening words but quite another sentence ends {'xyz'[i - 4]}") for i in range(4, 7)]
    found = {r.doc_id: r.n_dropped for r in line_templates.without_recurring(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert found == {0: 0, 1: 1, 2: 1, 3: 1, 4: 0, 5: 1, 6: 1}
    check(spark, docs)


def test_a_long_line_is_compared_word_by_word(spark):
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)]
    other = list(words)
    for i in (5, 37, 81):
        other[i] = "other"
    far = list(words)
    for i in range(3, 24):
        far[i] = "far"
    docs = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(far))]
    found = {r.doc_id: r.n_dropped for r in line_templates.without_recurring(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert found == {1: 0, 2: 1, 3: 0}


def test_many_unlike_forms_of_one_leaf(spark):
    docs = [(i, f"this is the {a} {b} {c}") for i, (a, b, c) in enumerate(
        (a, b, c) for a in ("red", "green") for b in "abcdef" for c in "uvwxyz")]
    check(spark, docs)


def test_a_round_writes_three_tables(spark, monkeypatch):
    labels, own = [], line_templates.written
    monkeypatch.setattr(line_templates, "written", lambda df, label: labels.append(label) or own(df, label))
    check(spark, [(i, f"the same opening words then alpha beta gamma delta {'abcd'[i]}") for i in range(4)])
    seen = collections.Counter(labels)
    rounds = seen["line-links"]
    assert rounds and {k: n for k, n in seen.items() if n != 1} == {k: n for k, n in {
        "line-links": rounds, "line-buckets": rounds + 1, "line-words": rounds}.items() if n != 1}
    assert not {"line-leads", "line-undecided"} & set(labels)


def unlike(n):
    """Lines that agree in one run of words and in nothing else."""
    return [(i, " ".join(["the", "same", "opening", "common", "run", "here", *(f"w{'abcdefghijklmnopqrstuvwxyz'[i]}{c}" for c in "abcdef")])) for i in range(n)]


def test_unlike_forms_with_a_common_place_need_one_round(spark, monkeypatch):
    labels, own = [], line_templates.written
    monkeypatch.setattr(line_templates, "written", lambda df, label: labels.append(label) or own(df, label))
    check(spark, unlike(9) + [(20 + i, f"{line} more".replace("wax", "way")) for i, line in unlike(9)] + [(40, unlike(9)[8][1].replace("wif", "other"))])
    assert labels.count("line-links") == 1


@pytest.mark.parametrize("walk", [0, 1 << 11])
def test_large_leaves_go_on_in_rounds(spark, monkeypatch, walk):
    monkeypatch.setattr(line_templates, "WALK", walk)
    draw, docs = random.Random(walk), []
    for doc in range(40):
        words = ["one", "and", ("same", "other")[doc % 3 == 0], *draw.choice([list("abcdefg"), list("abcxyzw"), list("pqrsefg")])]
        for _ in range(draw.choice([0, 1, 2, 3])):
            words[draw.randrange(3, 10)] = draw.choice("abcdefgpqrs")
        docs.append((doc, " ".join(words)))
    check(spark, docs)


def test_texts_that_lose_nothing_are_not_shuffled(spark):
    docs = [(i, f"line {'abcdefghij'[i]} of its own stands here") for i in range(10)] + [(20, "these very words come twice"), (21, "these very words come twice"), (22, None), (None, "")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {r.doc_id: (r.text, r.n_dropped) for r in line_templates.without_recurring(table).collect()}
    assert found == {i: (t, 0) for i, t in docs} | {21: ("", 1)}
    keys = table.where("doc_id = 21").selectExpr("xxhash64(doc_id) AS h")
    assert [r.doc_id for r in common.likely(table, F.xxhash64("doc_id"), keys).where("likely").collect()] == [21]


def test_likely_holds_every_key(spark):
    rows = spark.range(100_000).withColumn("h", F.xxhash64("id"))
    found = common.likely(rows, F.col("h"), rows.where("id % 7 = 0").select("h")).groupBy((F.col("id") % 7 == 0).alias("key")).agg(
        F.count("*").alias("n"), F.sum(F.col("likely").cast("int")).alias("likely"))
    found = {r.key: (r.n, r.likely) for r in found.collect()}
    assert found[True] == (14286, 14286) and found[False][1] < 200
