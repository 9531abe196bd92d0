"""The text operators against brute force, and on awkward rows."""

import base64
import collections
import hashlib
import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import difference, duck
from conftest import SMALL_DIR
from starbazaar.llm import (
    line_templates, link_trust, mixing, paragraph_sketch, pii_boosting, quality_likelihood, sentencepiece_bpe, simhash_covering,
    toxicity_grammar, warc_index)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, N_LINES string, label int"
LONG = "wort " * 20_000 + "x" * 30_000
PROSE = "The quick brown fox jumps over the lazy dog near the river bank today"


def awkward_rows():
    texts = [(1, None), (2, ""), (3, " \t\n \r\n"), (4, LONG), (5, PROSE), (5, PROSE), (6, PROSE), (None, PROSE), (None, None), (7, "one"),
             (8, "a\u2581b  \u2581 \ud7ff\U0001F600 \x00 ."), (9, PROSE + "\n" + PROSE)]
    return [(i, t, "en", None if n % 3 == 0 else f"s{n % 2}", None, 0.5, "kept", 7) for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, None if i == 9 else i % 2, i % 2) for i in range(1, 10)] + [(None, 1, 1), (5, 0, 0)],
                                 "doc_id bigint, quality int, toxic int")


def rows(spark, name):
    return entry.queries()[name](spark, SMALL_DIR).collect()


# 1: SentencePiece

def tokenizer():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return path, sentencepiece.SentencePieceProcessor(model_file=path)


def expected_tokens(model, text):
    import numpy as np

    ids = model.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_tokens(spark, documents):
    _, model = tokenizer()
    for r in rows(spark, "op1_sentencepiece"):
        assert tuple(r)[1:] == expected_tokens(model, documents[r.doc_id].text)


def test_tokens_of_awkward_texts(awkward, empty):
    path, model = tokenizer()
    found = sentencepiece_bpe.digests(awkward, path).collect()
    assert sorted(map(repr, (tuple(r) for r in found))) == sorted(
        repr((r[0], *expected_tokens(model, r[1]))) for r in awkward_rows())
    assert sentencepiece_bpe.digests(empty, path).collect() == []


def test_merge_rounds_equal_the_library():
    path, model = tokenizer()
    voc = sentencepiece_bpe.Vocabulary.load(path)
    encoder, draw = sentencepiece_bpe.Encoder(voc), random.Random(5)
    texts = ["".join(draw.choice("aabehinorst  \u2581é\u2581벨😀\n.,1") for _ in range(draw.randint(0, 50))) for _ in range(500)]
    texts += [" " * 333 + "x", "\u2581", "aaaa" * 200, "<s></s><0x41>", "the the"]
    import numpy as np

    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_bos=True, add_eos=True), text
    for _ in range(300):
        ids = [draw.choice([draw.randrange(3, 259), draw.randrange(32_000)]) for _ in range(draw.randint(0, 9))]
        assert sentencepiece_bpe.decode([np.array(ids, "<u4").tobytes()], voc) == [model.decode(ids)]


# 2: toxicity

def test_grammar_prefers_aimed_clauses():
    lexicon = toxicity_grammar.Lexicon({w: (k, 3.0) for k, t in toxicity_grammar.WORDS.items() for w in t.split()}, {})
    matcher = toxicity_grammar.Matcher(lexicon)

    def best(text):
        return max(matcher.clauses(text)[0], default=0.0)

    assert best("you are an idiot") > best("an idiot is a word") > best("he said idiot") > best("they are not idiot") > 0
    assert best("I will kill you") > 0 and best("you kill time") == 0
    assert best("") == best(None) == best("all is well") == 0
    assert matcher.score("you idiot. you moron.") > 0.7 > matcher.score("a fine day")


def test_toxicity_never_learns_from_held_out_rows(spark):
    found = rows(spark, "op2_toxicity")
    assert len(found) == spark.read.parquet(f"{SMALL_DIR}/documents.parquet").count()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
               for r in found)
    docs, own = spark.read.parquet(f"{SMALL_DIR}/documents.parquet"), spark.read.parquet(f"{SMALL_DIR}/labels.parquet")
    turned = own.withColumn("toxic", F.when(toxicity_grammar.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity_grammar.fit(docs, turned) == toxicity_grammar.fit(docs, own)


def test_toxicity_of_awkward_rows(awkward, empty, labels):
    lexicon = toxicity_grammar.fit(awkward, labels)
    kept = toxicity_grammar.without_toxic(awkward, lexicon)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert toxicity_grammar.without_toxic(empty, toxicity_grammar.fit(empty, labels.limit(0))).collect() == []


# 3: line dedup

def test_lines_against_sql(spark):
    assert difference(entry.queries()["op3_lines"](spark, SMALL_DIR), duck(SMALL_DIR), line_templates.ORACLE_SQL) is None


def test_lines_of_awkward_rows(spark, awkward, empty):
    found = line_templates.without_recurring(awkward)
    assert found.columns == [*awkward.columns, "n_lines_", "n_dropped"]
    by_id = collections.defaultdict(list)
    for r in found.collect():
        by_id[r.doc_id].append((r.text, r[-1], r.score, r.label))
    assert by_id[5] == [(PROSE, 0, 0.5, 7)] * 2      # the smallest id keeps its lines
    assert by_id[6] == [("", 1, 0.5, 7)] and by_id[9] == [("", 2, 0.5, 7)]
    assert sorted(map(str, (x[0] for x in by_id[None]))) == ["", "None"]
    assert by_id[7][0][0] == "one" and by_id[4][0][0] == LONG and by_id[1][0][0] is None and by_id[2][0][0] == ""
    assert line_templates.without_recurring(empty).collect() == []


def test_variable_fields_share_a_template(spark):
    docs = spark.createDataFrame(
        [(i, f"request {i} took {i * 7} ms on host{i}\nown words of document {'abcdefgh'[i]}{'x' * i} only here then") for i in range(1, 5)],
        "doc_id bigint, text string")
    found = {r.doc_id: r for r in line_templates.without_recurring(docs).collect()}
    assert [found[i].n_dropped >= 1 for i in range(1, 5)] == [False, True, True, True]
    assert "took" in found[1].text and "took" not in found[3].text


# 4: URL rules and links

def test_links_against_sql(spark):
    assert difference(entry.queries()["op4_links"](spark, SMALL_DIR), duck(SMALL_DIR), link_trust.ORACLE_SQL) is None


def test_distrust_flows_against_links(spark):
    pages = spark.createDataFrame([
        (1, "http://bad.net/x", None), (2, "http://farm.com/a", '<a href="http://bad.net/x">x</a><a HREF=//bad.net/z>'),
        (3, "HTTP://Good.org/fr/1?q#f", "<a href='https://friend.com/'>"), (4, "http://friend.com/", ""), (5, None, None), (6, "no scheme", "x"),
        (7, "http://a.example.net/en/1", ""), (7, "http://a.example.net/en/1", ""), (8, "x://Ex.Example.COM/de/#", ""), (9, "x://notexample.com/de/", ""),
        (10, "http://bad.net", ""), (11, "http://bad.net/y", ""), (12, "http://bad.net/z", ""),
    ], "page_id bigint, url string, html string").withColumn("rule", F.lit("clash"))
    found = sorted((tuple(r) for r in link_trust.judged(pages).collect()), key=lambda r: r[0])
    assert [(r[0], r[3], r[4]) for r in found] == [
        (1, "net/", "block"), (2, None, "block"), (3, "org/fr/", "allow"), (4, None, "allow"), (5, None, "allow"), (6, None, "allow"),
        (7, "example.net/en/", "allow"), (7, "example.net/en/", "allow"), (8, "example.com/de/", "block"), (9, None, "allow"), (10, None, "block"),
        (11, "net/", "block"), (12, "net/", "block")]
    assert found[2][1:3] == ("Good.org".lower(), "/fr/1") and found[4][1:3] == ("", "") == found[5][1:3]
    assert link_trust.judged(pages.limit(0)).collect() == []


def test_distrust_reaches_far_hosts(spark):
    """Against a plain loop over a chain of hosts, each linking to the one before."""
    pages = spark.createDataFrame([(0, "http://bad.net/", "")] + [
        (i, f"http://h{i}.com/", f'<a href="http://{f"h{i - 1}.com" if i > 1 else "bad.net"}/">') for i in range(1, 31)], "page_id bigint, url string, html string")
    found = {r.page_id: r.verdict for r in link_trust.judged(pages).collect()}
    seeds = {i: (float(i == 0) / 31, float(i > 0) / 31) for i in range(31)}
    now = dict(seeds)
    for _ in range(link_trust.ROUNDS):
        now = {i: (0.15 * seeds[i][0] + 0.85 * now.get(i - 1, (0, 0))[0], 0.15 * seeds[i][1] + 0.85 * now.get(i + 1, (0, 0))[1]) for i in range(31)}
    assert found == {i: "block" if i == 0 or now[i][0] >= 0.5 * sum(now[i]) else "allow" for i in range(31)}
    masses = link_trust.propagated(
        spark.createDataFrame([("h0", 0.0, 1.0, 0.0)], "host string, trust double, distrust double, neutral double"),
        spark.createDataFrame([(f"h{i}", f"h{i - 1}", 1.0, 1.0) for i in range(1, 41)], "a string, b string, out double, back double"))
    reached = {r.host: r.distrust for r in masses.collect()}
    assert reached["h30"] == pytest.approx(0.15 * 0.85 ** 30) and reached["h40"] > 0


# 5: personal data

def passes_luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == "phone" or passes_luhn(digits)):
                found.append((kind, *m.span()))
    return found


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_personal_data(spark, documents):
    for r in rows(spark, "op5_pii"):
        plain = plain_spans(documents[r.doc_id].text or "")
        counts = collections.Counter(k for k, _, _ in plain)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in pii_boosting.KINDS)
        assert r.base_sha256 == hashlib.sha256(joined(plain).encode()).hexdigest()
        assert set(filter(None, joined(plain).split(","))) <= set(r.spans.split(","))


def test_personal_data_in_awkward_texts(spark, awkward, empty):
    texts = ["a@b.c@d.e", "a.b@c..d x@y.z.", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (988) 555-2485) +12",
             "😀 a@b.cd 1.2.3.4", "5" * 5000, "+1 " + "(" * 5000, "@" * 300, "a" * 20_000 + "@b.c", "1 2 3 4 5 6 7 8 9 0 1 2 3", "a_b@c.d_e@f.g", "bob (at) mail [dot] org", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pii_boosting.found_in(docs).collect():
        plain = [(pii_boosting.KINDS[s.kind], s.start, s.end) for s in r.spans if s.plain]
        assert plain == plain_spans(texts[r.doc_id] or ""), texts[r.doc_id][:80]
    assert pii_boosting.found_in(awkward).count() == awkward.count()
    assert pii_boosting.found_in(empty).collect() == []
    masked = pii_boosting.redacted(docs, pii_boosting.found_in(docs)).collect()
    assert {r.doc_id: r.text for r in masked}[5] == "😀 [PRIVATE] [PRIVATE]"


# 6: WARC

def test_warc(spark):
    pages = {r.page_id: r.html or "" for r in spark.read.parquet(f"{SMALL_DIR}/pages.parquet").collect()}
    last = {h: max(i for i, x in pages.items() if x == h) for h in set(pages.values())}
    found = rows(spark, "op6_warc")
    assert len(found) == len(pages)
    for r in found:
        raw, kept = pages[r.page_id].encode(), last[pages[r.page_id]]
        assert tuple(r)[1:] == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if kept == r.page_id else "revisit",
                                None if kept == r.page_id else kept)


def test_warc_index_finds_ranges(spark, tmp_path):
    data = [(i, f"http://h{i % 7}.example.com/p/{i % 40}?q=a b", None if i % 5 == 0 else f"<p>ü {i % 11}\r\n\r\n</p>") for i in range(200)]
    data += [(200, None, "x"), (201, "http://[bad", "y"), (202, "http://é.org/\r\nX: 1", "z"), (199, data[199][1], data[199][2]), (None, "http://n.org/", "x")]
    pages = spark.createDataFrame(data, "page_id bigint, url string, html string").withColumn("key", F.lit(1)).repartition(3)
    folder = f"file://{tmp_path}/warc"
    blocks = warc_index.indexed(warc_index.archived(pages, folder), folder, block=16)
    found = warc_index.read_all(blocks).collect()
    assert sorted(map(str, (r.page_id for r in found))) == sorted(str(d[0]) for d in data)
    by_id = {r.page_id: r for r in found}
    assert by_id[199].record_type == "response" and by_id[0].record_type == "revisit" and by_id[0].refers_to == 195 and by_id[195].payload == b""
    assert by_id[None].refers_to == 200
    asked = spark.createDataFrame([(data[8][1],), ("http://none.org/",)], "url string")
    assert sorted(r.page_id for r in warc_index.look_up(asked, blocks).collect()) == [
        d[0] for d in data[:200] if warc_index.surt(d[1]) == warc_index.surt(data[8][1])]
    none = warc_index.indexed(warc_index.archived(pages.limit(0), folder), folder)
    assert warc_index.read_all(none).collect() == []


# 7: SimHash

def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    label = {v: v for v in prints}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sorted(prints), 2):
            if (a ^ b).bit_count() <= radius and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def test_masks_cover_every_pair():
    masks, draw = [m % (1 << 64) for m in simhash_covering.masks()], random.Random(1)
    for _ in range(3000):
        flips = sum(1 << b for b in draw.sample(range(64), draw.randint(1, 4)))
        assert any(not flips & m for m in masks)
    assert len(masks) == 31 and all(24 <= m.bit_count() <= 40 for m in masks)


def test_simhash(spark, documents):
    prints = {i: brute_fingerprint(r.text) for i, r in documents.items()}
    label = brute_components(set(prints.values()))
    first = {}
    for i, p in prints.items():
        first[label[p]] = min(i, first.get(label[p], i))
    found = rows(spark, "op7_simhash")
    assert len(found) == len(prints)
    assert all((int(r.fingerprint, 16), r.component_id) == (prints[r.doc_id], first[label[prints[r.doc_id]]]) for r in found)


@pytest.mark.parametrize("bucket", [2, 4096])
def test_links_join_what_is_near(spark, bucket):
    """A chain and a dense ball; with the small bucket, large ones are joined through middles."""
    draw, values = random.Random(2), set()
    for _ in range(3):
        v = draw.getrandbits(64)
        for _ in range(12):
            values.add(v)
            v ^= sum(1 << b for b in draw.sample(range(64), draw.randint(1, 5)))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash_covering.links(spark.createDataFrame(signed, "fp bigint"), bucket=bucket)
    found = collections.defaultdict(set)
    for r in simhash_covering.components(edges).collect():
        found[r.label].add(r.v % (1 << 64))
    label, groups = brute_components(values), collections.defaultdict(set)
    for v, k in label.items():
        groups[k].add(v)
    assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_one_of_each_awkward_row(awkward, empty):
    kept = simhash_covering.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 7, 8, 9]
    assert simhash_covering.one_of_each(empty).collect() == []


# 8: quality

def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, documents):
    found = rows(spark, "op8_quality")
    assert len(found) == len(documents)
    for r in found:
        own = plain_counts(documents[r.doc_id].text)
        failed = own[0] < 50 or 100 * own[4] > 50 * own[0]
        assert tuple(r)[1:7] == (*own, failed) and not (failed and r.kept)


def test_quality_counts_of_awkward_texts(awkward, empty, labels):
    for _, text, *_ in awkward_rows():
        assert quality_likelihood.counts(text) == plain_counts(text)
    assert quality_likelihood.judged(awkward, labels).count() == awkward.count()
    assert quality_likelihood.judged(empty, labels).collect() == []


def test_every_good_row_of_the_half_is_in_the_target(spark):
    labels = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    # "late" is what good rows beyond the first 20,000 of the half say, in the order of the draw.
    half = labels.where(F.xxhash64(F.lit("half"), "doc_id") % 2 == 0).orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id")
    early = half.limit(20_000).select("doc_id").withColumn("text", F.lit("early"))
    late = half.select("doc_id").exceptAll(early.select("doc_id")).withColumn("text", F.lit("late"))
    rest = labels.where(F.xxhash64(F.lit("half"), "doc_id") % 2 != 0).select("doc_id", F.lit("rest").alias("text"))
    ratios, _ = quality_likelihood.learn(early.unionByName(late).unionByName(rest), labels)
    signs = {word: ratios[quality_likelihood.Hasher()(word)[0]] for word in ("early", "late", "rest")}
    # Half of all rows are the target, so what only they say is twice as frequent there.
    assert signs["early"] == pytest.approx(signs["late"], abs=0.01) and signs["late"] > 0 > signs["rest"]


def test_likelihood_separates_signs_from_prose(spark):
    draw = random.Random(3)
    words = ["stone", "river", "cloud", "grass", "light", "house", "water", "green"]
    docs = [(i, " ".join(draw.choice(words) + ("%%%" if i % 2 else "") for _ in range(80))) for i in range(200)]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(150)], "doc_id bigint, quality int, toxic int")
    found = quality_likelihood.judged(spark.createDataFrame(docs, "doc_id bigint, text string"), labels).collect()
    assert all(r.kept == (r.doc_id % 2 == 0) for r in found if not r.base_failed)


# 9: fingerprints

def pieces(text):
    found = set()
    for line in re.split("[\n\x0b\x0c\r]", text):
        words = re.findall(r"[^\x20\x09-\x0D]{1,40}[\x20\x09]*", line)
        n = paragraph_sketch.WORDS
        found |= {"".join(words[i:i + n]) for i in range(0, len(words), n)}
    return found


def jaccard(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected_prints(texts):
    """By descending id: (n_chars, edited_sha256, near_edited, near_next)."""
    order = sorted(texts, reverse=True)
    found = {}
    for i, after in zip(order, order[1:] + order[:1]):
        text, other = texts[i] or "", texts[after] or ""
        k = len(text) // 3
        edited = text[:len(text) - k] + other[:k]
        found[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(text, edited), jaccard(text, other))
    return found


def test_fingerprints(spark, documents):
    expected = expected_prints({i: r.text for i, r in documents.items()})
    found = rows(spark, "op9_sketch")
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in found} == expected
    assert len({r.fingerprint for r in found}) == len({r.text or "" for r in documents.values()})


def test_pairs_cross_ranges(spark):
    texts = {i * 37 - 500: f"text {i} " * (i % 9) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    for ranges, bounds in ((1, 10), (7, 10), (150, 200), (150, 9)):
        found = paragraph_sketch.with_next(docs, ranges, bounds).collect()
        assert {r.doc_id: r.next for r in found} == {i: texts[after[i]] for i in texts} and len(found) == len(texts)


def test_fingerprints_of_awkward_rows(spark, awkward, empty):
    found = paragraph_sketch.compared(awkward.drop("text").withColumn("text", F.col("label").cast("string")).unionByName(awkward)).collect()
    assert len(found) == 2 * awkward.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert paragraph_sketch.compared(empty).collect() == []
    one = paragraph_sketch.compared(spark.createDataFrame([(1, PROSE)], "doc_id bigint, text string")).first()
    assert one.near_next == 1.0


# 10: mixing

def shared(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * left >= most * sizes[s] * total}
        if not more:
            return {s: float(most * sizes[s]) if s in full else weight[s] * left / total for s in names}
        full |= more


def check_mix(found, docs):
    sizes, largest, taken = collections.Counter(), collections.Counter(), collections.Counter()
    for (i, text, source), r in zip(docs, found):
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) and r.taken <= 3 * r.size and (r.taken == 0 or r.taken % r.size == 0)
        sizes[source] += r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    targets = shared(sizes)
    for (i, text, source), r in zip(docs, found):
        assert r.source_size == sizes[source] and r.target == pytest.approx(targets[source])
    return {s: abs(taken[s] - targets[s]) - largest[s] for s in sizes}


def test_mix(spark, documents):
    found = sorted(rows(spark, "op10_mixing"), key=lambda r: r.doc_id)
    apart = check_mix(found, [(i, documents[i].text, documents[i].source) for i in sorted(documents)])
    assert max(apart.values()) <= 0
    assert found == sorted(rows(spark, "op10_mixing"), key=lambda r: r.doc_id)


def test_mix_stops_at_three_times_a_source(spark):
    docs = [(i, "w " * (1 + i % 5), "a" if i < 4 else "b" if i < 100 else "c" if i < 300 else None) for i in range(400)]
    found = sorted(mixing.mix(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect(), key=lambda r: r.doc_id)
    assert max(check_mix(found, docs).values()) <= 0
    assert all(r.copies == 3 for r in found[:4])


def test_mix_refines_the_bucket_where_the_budget_ends(spark):
    wide = 1 << 48  # a bucket of the first level
    near = [("near", 10, 3)] + [("near", 10, 5 * wide + k * 1000) for k in range(10)]
    far = [("far", 10, 7 * wide + k * 1000) for k in range(10)]
    rows = spark.createDataFrame(near + far, "source string, size bigint, hash bigint")
    aims = spark.createDataFrame([("near", 110, 64.0), ("far", 100, 46.0)], "source string, source_size bigint, target double")
    below = {r.source: r.below for r in mixing.thresholds(rows, aims).collect()}
    taken = {s: sum(size for of, size, h in near + far if of == s and h < below[s]) for s in below}
    assert taken == {"near": 60, "far": 50}


def test_mixing_awkward_rows(awkward, empty):
    mixed = mixing.mix(awkward)
    assert mixed.count() == awkward.count()
    again = mixing.repeated(awkward)
    assert again.columns == awkward.columns and again.where("text IS NULL OR trim(text) = ''").count() == 0
    assert mixing.repeated(empty).collect() == [] and mixing.mix(empty).collect() == []


# pipeline

def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        given = docs
        stage(spark, docs, SMALL_DIR).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        counts.append(docs.count())
        if n < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if name == "toxicity":
            lexicon = toxicity_grammar.fit(given, spark.read.parquet(f"{SMALL_DIR}/labels.parquet"))
            matcher = toxicity_grammar.Matcher(lexicon)
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in given.collect() if matcher.score(r.text) < 0.7}
        if name == "near duplicates":
            prints = [brute_fingerprint(r.text) for r in docs.collect()]
            assert all((a ^ b).bit_count() > 4 for a, b in itertools.combinations(prints, 2))
    assert len(corpus_pipeline.STAGES) == 5 and counts[0] >= counts[1] == counts[2] > counts[3] and counts[4] == counts[5]


def test_pipeline_of_awkward_rows(spark, awkward, empty, labels, tmp_path):
    folder = f"{tmp_path}/sf"
    labels.write.parquet(f"{folder}/labels.parquet")
    for k, table in enumerate((awkward, empty)):
        docs = table
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}-{n}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{n}")
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
