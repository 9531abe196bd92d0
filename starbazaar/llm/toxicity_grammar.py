"""Toxicity by a weighted finite-state pattern grammar.

Words become classes by a lexicon (whole words and stems with weights): insult, threat, modal, target, negation,
report, other. Small weighted transducers rewrite the classes of a clause from left to right: negation turns an insult within
its reach into a negated one, reported speech turns what follows into reported matter, a threat needs a modal before it, and a target
near a match makes it weigh more. They are composed once into one machine; a clause's score is the weight of its path, so
an isolated word weighs less than one that is aimed at somebody, and a denied or quoted one less still.

The lexicon's general words are fixed; the others, and all weights, are learned from labelled rows: at most ``SAMPLE`` rows of each
label, chosen by a hash of their id among the rows that are not held out. Near copies in the sample (equal
minimum hashes) count once. A logistic curve over the matched clauses gives the score.

Defined results: null and empty texts match nothing and get the curve's lowest score; a row without a usable label is never learned
from; if a doc_id has several labels, their mean counts; without labels the fixed words and a fixed curve decide; repeated rows get
equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbazaar.llm.common import own_column, slices, table, written

SAMPLE = {1: 4000, 0: 8000}
THRESHOLD = 0.7
#: A learned term needs so many different documents, and log odds of at least this; stems need more words and odds.
SUPPORT, ODDS, STEM_WORDS, STEM_ODDS = 5, 3.0, 3, 3.5
STEMS = range(4, 8)
MOST_TERMS = 4000
REMEMBERED = 300_000

INSULT, THREAT, MODAL, TARGET, NEGATION, REPORT, OTHER = "INSULT", "THREAT", "MODAL", "TARGET", "NEGATION", "REPORT", "OTHER"
NEGATED, REPORTED, AIMED = "NEGATED", "REPORTED", "AIMED"

#: Fixed words of the classes, in four languages.
WORDS = {
    INSULT: "idiot idiots moron morons stupid scum trash loser losers worthless pathetic disgusting clown imbecile "
            "dumb filth vermin coward idiota imbécil estúpido basura dummkopf abschaum versager trottel crétin ordure "
            "minable abruti",
    THREAT: "kill hurt destroy beat stab shoot strangle burn töten umbringen verletzen tuer frapper matar golpear",
    MODAL: "will shall going gonna must should werde werden vais va voy vamos",
    TARGET: "you your yours you're yourself u he she they him her them this that du dich dir euch sie tu vous toi te "
            "usted ustedes ti",
    NEGATION: "not never no isn't aren't nobody nicht kein keine nie pas jamais nunca",
    REPORT: "said says say called calls quoted quote reported reports wrote claimed sagte nannte dit dijo llamó",
}
_EDGE = "".join(map(chr, [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])) + "«»“”„‘’…–—¡¿"
_ENDS = re.compile(r"[.!?;:]|[…]")


class Transducer:
    """A deterministic weighted transducer over classes. ``arcs`` maps (state, class) to (state, class out, weight);
    a class without an arc passes as it is and moves along ``otherwise`` (state to state, default: stays)."""

    def __init__(self, arcs: dict, otherwise: dict | None = None, start=0) -> None:
        self.arcs, self.otherwise, self.start = arcs, otherwise or {}, start

    def step(self, state, symbol: str):
        if (state, symbol) in self.arcs:
            return self.arcs[state, symbol]
        return self.otherwise.get(state, state), symbol, 0.0

    def compose(self, after: Transducer) -> Transducer:
        """One machine that feeds its output to ``after``; only reachable states are built."""
        start, arcs = (self.start, after.start), {}
        waiting, symbols = [start], [*WORDS, OTHER]
        seen = {start}
        while waiting:
            a, b = state = waiting.pop()
            for symbol in symbols:
                a2, middle, w1 = self.step(a, symbol)
                b2, out, w2 = after.step(b, middle)
                arcs[state, symbol] = ((a2, b2), out, w1 + w2)
                if (a2, b2) not in seen:
                    seen.add((a2, b2))
                    waiting.append((a2, b2))
        return Transducer(arcs, start=start)


def negation(reach: int = 3) -> Transducer:
    """Within ``reach`` words after a negation, an insult or threat comes out negated."""
    arcs, otherwise = {}, {}
    for left in range(reach + 1):
        arcs[left, NEGATION] = (reach, NEGATION, 0.0)
        otherwise[left] = max(0, left - 1)
        if left:
            arcs[left, INSULT] = (left - 1, NEGATED, 0.0)
            arcs[left, THREAT] = (left - 1, NEGATED, 0.0)
    return Transducer(arcs, otherwise)


def reported() -> Transducer:
    """After a verb of reporting, an insult or threat of the clause comes out as reported."""
    return Transducer({(0, REPORT): (1, REPORT, 0.0), (1, INSULT): (1, REPORTED, 0.0), (1, THREAT): (1, REPORTED, 0.0)})


def threat(reach: int = 3) -> Transducer:
    """A threatening verb counts within ``reach`` words after a modal; elsewhere it is an ordinary word."""
    arcs, otherwise = {}, {}
    for left in range(reach + 1):
        arcs[left, MODAL] = (reach, MODAL, 0.0)
        arcs[left, THREAT] = (0, AIMED, 0.5) if left else (0, OTHER, 0.0)
        otherwise[left] = max(0, left - 1)
    return Transducer(arcs, otherwise)


def weighing(reach: int = 4) -> Transducer:
    """What a match weighs, next to its own weight: more after a target or another match, little when denied or reported."""
    arcs, otherwise = {}, {}
    for left in range(reach + 1):
        near = 0.5 if left else 0.0
        arcs[left, TARGET] = (reach, TARGET, 0.0)
        arcs[left, INSULT] = (reach, AIMED, 1.0 + near)
        arcs[left, AIMED] = (reach, AIMED, 1.0 + near)
        arcs[left, NEGATED] = (left, NEGATED, 0.2)
        arcs[left, REPORTED] = (left, REPORTED, 0.4)
        otherwise[left] = max(0, left - 1)
    return Transducer(arcs, otherwise)


GRAMMAR = negation().compose(reported()).compose(threat()).compose(weighing())


@dataclass
class Lexicon:
    """Class and weight of words and stems; ``curve`` holds the logistic curve."""

    words: dict[str, tuple[str, float]]
    stems: dict[str, float]
    curve: tuple[float, ...] = (-4.0, 2.0, 2.0, 0.5)

    def look_up(self, word: str) -> tuple[str, float, bool] | None:
        """Class, weight and whether a clause ends here; None for an ordinary word inside a clause."""
        core = word.strip(_EDGE)
        ends = bool(_ENDS.search(word[len(word.rstrip(_EDGE)):]))
        kind = self.words.get(core)
        if kind is None:
            weight = next((self.stems[core[:k]] for k in STEMS if core[:k] in self.stems), None)
            kind = (INSULT, weight) if weight is not None else None
        if kind is None:
            return (OTHER, 0.0, True) if ends else None
        return (*kind, ends)


class Matcher:
    """Scores texts of a task; remembers words."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.known = lexicon, {}

    def clauses(self, text: str | None) -> tuple[list[float], int]:
        """The score of every matched clause, and the number of words."""
        known, look_up = self.known, self.lexicon.look_up
        scores, n = [], 0
        for line in (text or "").lower().split("\n"):
            words = line.split()
            n += len(words)
            for w in set(words).difference(known):
                known[w] = look_up(w)
            found = [(i, k) for i, k in enumerate(map(known.__getitem__, words)) if k]
            if any(k[0] in (INSULT, THREAT) for _, k in found):
                scores.extend(self._run(found))
        if len(known) > REMEMBERED:
            known.clear()
        return scores, n

    def _run(self, found: list[tuple[int, tuple[str, float, bool]]]) -> Iterator[float]:
        state, total, last = GRAMMAR.start, 0.0, -1
        for at, (kind, weight, ends) in found:
            for _ in range(min(at - last - 1, 8)):  # ordinary words; all reaches are shorter than that
                state = GRAMMAR.step(state, OTHER)[0]
            state, out, more = GRAMMAR.step(state, kind)
            last = at
            if more:
                total += more * (weight if kind in (INSULT, THREAT) else 1.0)
            if ends:
                if total:
                    yield total
                state, total = GRAMMAR.start, 0.0
        if total:
            yield total

    def features(self, text: str | None) -> list[float]:
        scores, n = self.clauses(text)
        if not scores:
            return [1.0, 0.0, 0.0, 0.0]
        return [1.0, math.log1p(max(scores)), math.log1p(sum(scores)), math.log1p(1000 * len(scores) / (n + 50))]

    def score(self, text: str | None) -> float:
        z = sum(a * b for a, b in zip(self.lexicon.curve, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, most: dict[int, int] | None = None) -> DataFrame:
    """text and toxic of at most ``most`` rows of each label, held-out rows never among them."""
    own = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("bigint").alias("id")).agg(F.round(F.avg("toxic")).cast("int").alias("toxic"))
    order = F.xxhash64(F.lit("toxicity"), "id")
    chosen = None
    for label, n in (most or SAMPLE).items():
        part = own.where(F.col("toxic") == label).orderBy(order, "id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    # As many rows as SAMPLE allows, whatever the size of the tables. Written, so that the texts are read for it once.
    found = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")
    return written(found, "toxicity-sample")


def _terms(text: str) -> set[str]:
    return {w.strip(_EDGE) for w in text.lower().split()} - {""}


def _signature(terms: set[str]) -> str:
    """Equal for near copies, as a rule."""
    return "-".join(f"{min((xxhash.xxh32_intdigest(t, seed) for t in terms), default=0):x}" for seed in (1, 2))


def learn(sample: DataFrame) -> Lexicon:
    """Terms and their weights from the sample, then the curve."""
    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [sorted(_terms(t or "")) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets, pa.list_(pa.string())), batch.column(1),
                 pa.array([_signature(set(s)) for s in sets])], ["terms", "toxic", "signature"])

    once = sample.mapInArrow(seen, "terms array<string>, toxic int, signature string").groupBy("signature", "toxic").agg(
        F.min("terms").alias("terms"))
    sizes = {r["toxic"]: r["n"] for r in once.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    positive, negative = sizes.get(1, 0), sizes.get(0, 0)

    def odds(t: Column, c: Column) -> Column:
        return F.log((t + 0.5) / (positive + 1)) - F.log((c + 0.5) / (negative + 1))

    words = once.select("toxic", F.explode("terms").alias("term"), F.lit(1).alias("words"))
    counted = words.groupBy("term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    learned = counted.where(f"t >= {SUPPORT} AND length(term) > 2").withColumn("odds", odds(F.col("t"), F.col("c"))).where(
        f"odds >= {ODDS}").orderBy(F.desc("odds"), F.desc("t"), "term").limit(MOST_TERMS)
    own = {r["term"]: r["odds"] for r in learned.select("term", "odds").collect()}

    long = once.select("toxic", "terms", F.explode(F.lit(list(STEMS))).alias("k"))
    stems = long.select("toxic", "k", F.explode(F.array_distinct(F.transform(
        F.filter("terms", lambda w: F.length(w) > F.col("k")), lambda w: F.left(w, F.col("k"))))).alias("stem")).groupBy("stem").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    wide = stems.where(f"t >= {SUPPORT}").withColumn("odds", odds(F.col("t"), F.col("c"))).where(f"odds >= {STEM_ODDS}")
    stem_words = words.where("toxic = 1").select("term").distinct()
    variety = wide.join(
        stem_words.select("term", F.explode(F.lit(list(STEMS))).alias("k")).where("length(term) > k").select(
            F.left("term", F.col("k")).alias("stem")), "stem").groupBy("stem", "t", "odds").agg(F.count("*").alias("forms")).where(
        f"forms >= {STEM_WORDS}").orderBy(F.desc("odds"), F.desc("t"), "stem").limit(MOST_TERMS)
    found = {r["stem"]: r["odds"] for r in variety.collect()}
    shortest = {s: w for s, w in found.items() if not any(s[:k] in found for k in range(STEMS.start, len(s)))}

    fixed = {w: (kind, ODDS) for kind, text in WORDS.items() for w in text.split()}
    known = {w: (kind, own.get(w, weight)) for w, (kind, weight) in fixed.items()}
    lexicon = Lexicon({**{w: (INSULT, weight) for w, weight in own.items()}, **known}, shortest)
    return _fitted(lexicon, sample)


def _fitted(lexicon: Lexicon, sample: DataFrame) -> Lexicon:
    """The curve by ridge logistic regression over the sample's features: a few numbers for each sampled row."""
    given = sample.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(given.value)
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([matcher.features(t)[1:] for t in batch.column(0).to_pylist()], pa.list_(pa.float64())),
                 batch.column(1)], ["x", "y"])

    rows = Counter((tuple(r["x"]), r["y"]) for r in sample.mapInArrow(run, "x array<double>, y int").collect())
    if len({y for _, y in rows}) < 2:
        return lexicon
    x = np.array([[1.0, *k[0]] for k in rows])
    y, n = np.array([k[1] for k in rows], float), np.array(list(rows.values()), float)
    b = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [0.1] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (n * (y - p)) - ridge @ b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    # A text that matches nothing is never called toxic, whatever the labels' share.
    b[0] = min(b[0], 0.0)
    lexicon.curve = tuple(b.tolist())
    return lexicon


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with one more column, the score; its name is the last of the result."""
    given = docs.sparkSession.sparkContext.broadcast(lexicon)
    text, score = own_column(docs, "scored_text"), own_column(docs, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(given.value)
        for batch in slices(batches, text):
            scores = pa.array([matcher.score(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], [*batch.schema.names[:-1], score])

    plain = docs.withColumn(text, F.col("text").cast("string"))
    return plain.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())]))


def fit(docs: DataFrame, labels: DataFrame) -> Lexicon:
    return learn(labelled_sample(docs, labels))


def without_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored below the threshold."""
    rated = scored(docs, lexicon)
    score = rated.columns[-1]
    return rated.where(F.col(score) < threshold).drop(score)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs.withColumn("held_out", held_out(F.col("doc_id"))), lexicon).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
