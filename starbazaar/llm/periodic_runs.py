"""Periodic runs of words by block convolution.

A run is a stretch of words that repeats with its smallest period q, of at least ``LEAST`` words and two periods, that no neighbouring word
extends. At the scale of blocks of B words, a run with a period of 2B to 4B - 1 words holds a whole aligned block whose copy lies that
many words behind it (the smallest scale looks at periods from 1). The sum of squared differences between the block and every place of the
windows behind it is a convolution; it is taken exactly, over the integers modulo a prime, by a number-theoretic transform of all blocks of a
scale at once, and is zero wherever the block recurs. Each such distance is a seed: it is extended to both sides as far as words one distance
apart are equal, by binary search over prefix hashes. A stretch long enough is a run; of several periods of one stretch the smallest counts,
because the others are its multiples. What hashes say is compared word by word in the end, so chance cannot change a result.

Texts are worked on in groups of some MB, laid one after another; a longer text is a group of its own. Blocks longer than ``PATTERN`` are looked
for by their first words, which finds all of them and perhaps more; extending tells.

Defined results: a null or empty text, or one of white space only, has no words and no run; a text of fewer than ``LEAST`` words has no run;
repeated rows get equal results; a null doc_id is kept; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbazaar.llm.common import WORD, slices, table

LEAST = 12
#: A prime with roots of unity of every order up to 2 ** 20. Sums of 32 products of its residues, also of twice their size, fit a double.
PRIME, ROOT = 7_340_033, 3
#: Words of a block that are looked for, and elements of one transform at a time.
PATTERN, ELEMENTS = 1 << 18, 1 << 18
_DIRECT = 5
_HASH_PRIME = (1 << 31) - 1

Runs = list[tuple[int, int, int]]


def _mod(x: np.ndarray) -> np.ndarray:
    """Numbers of the same residues from -PRIME to 2 * PRIME, in place; whole numbers held as doubles."""
    x -= np.floor(x * (1.0 / PRIME)) * PRIME
    return x


def _powers(base: int, n: int, prime: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo ``prime``."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    return out[:n]


class Transform:
    """The number-theoretic transform of rows of 2 ** bits residues, and its inverse. Short rows are multiplied by the matrix of roots,
    which a double holds exactly; long ones are split into two shorter dimensions with twiddle factors between."""

    def __init__(self, bits: int, inverse: bool = False) -> None:
        self.bits = bits
        root = pow(ROOT, (PRIME - 1) >> bits, PRIME)
        root = pow(root, PRIME - 2, PRIME) if inverse else root
        self.scale = float(pow(1 << bits, PRIME - 2, PRIME)) if inverse else None
        self.matrices: dict[int, np.ndarray] = {}
        self.twiddles: dict[int, np.ndarray] = {}
        todo = [bits]
        while todo:
            b = todo.pop()
            powers = _powers(pow(root, 1 << (bits - b), PRIME), 1 << b, PRIME).astype(np.float64)
            if b <= _DIRECT:
                at = np.arange(1 << b)
                self.matrices[b] = powers[np.outer(at, at) % (1 << b)]
            else:
                low = b // 2
                a, c = np.arange(1 << (b - low)), np.arange(1 << low)
                self.twiddles[b] = powers[np.outer(c, a)]
                todo += [low, b - low]

    def _run(self, x: np.ndarray, b: int) -> np.ndarray:
        if b <= _DIRECT:
            return _mod(x @ self.matrices[b])
        low = b // 2
        high = b - low
        # Place i * 2 ** low + j: first over i for every j, then over j for every frequency of the first.
        y = self._run(np.ascontiguousarray(x.reshape(-1, 1 << high, 1 << low).transpose(0, 2, 1)).reshape(-1, 1 << high), high)
        y = _mod(y.reshape(-1, 1 << low, 1 << high) * self.twiddles[b])
        y = self._run(np.ascontiguousarray(y.transpose(0, 2, 1)).reshape(-1, 1 << low), low)
        return np.ascontiguousarray(y.reshape(-1, 1 << high, 1 << low).transpose(0, 2, 1)).reshape(-1, 1 << b)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        out = self._run(rows, self.bits)
        return out if self.scale is None else _mod(out * self.scale)


_transforms: dict[tuple[int, bool], Transform] = {}


def _transform(bits: int, inverse: bool = False) -> Transform:
    key = (bits, inverse)
    if key not in _transforms:
        _transforms[key] = Transform(bits, inverse)
    return _transforms[key]


class Group:
    """The words of several texts, one text after another, as numbers: equal words, and only those, have equal numbers."""

    def __init__(self, texts: list[str | None], seed: int = 1) -> None:
        self.words = [(t or "").encode("utf-8", "replace").split() for t in texts]  # of bytes: exactly \\x09-\\x0D and \\x20
        sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        known = {w: i for i, w in enumerate(dict.fromkeys(itertools.chain.from_iterable(self.words)))}
        self.ids = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(self.words)), np.int64, int(sizes.sum()))
        self.of = np.repeat(np.arange(len(texts)), sizes)
        draw = np.random.default_rng(seed)
        self.residues = draw.integers(0, PRIME, len(known) + 1)[self.ids].astype(np.float64)
        prime = np.uint64(_HASH_PRIME)
        powers = _powers(int(draw.integers(1 << 20, 1 << 30)), len(self.ids) + 1, _HASH_PRIME)
        values = draw.integers(1, _HASH_PRIME, len(known) + 1).astype(np.uint64)[self.ids]
        self.powers, self.sums = powers, np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:-1] % prime) % prime])

    def same(self, a: np.ndarray, d: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from a equal those d behind, by their hashes."""
        prime = np.uint64(_HASH_PRIME)
        first = (self.sums[a + n] + prime - self.sums[a]) % prime
        second = (self.sums[a + d + n] + prime - self.sums[a + d]) % prime
        return first * self.powers[d] % prime == second

    def longest(self, at: np.ndarray, d: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """Words from ``at`` on (step 1) or before it (step -1) that equal those d behind, ``most`` at most."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = self.same(at if step > 0 else at - middle, d, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low


def _recurrences(group: Group, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chains (first block, last block, distance) of neighbouring blocks of ``scale`` words that recur at one distance."""
    lengths = group.ends - group.starts
    least = 1 if scale == 2 else 2 * scale  # the smallest period of this scale
    blocks = np.arange(len(group.ids) // scale)
    if not len(blocks):
        return
    text = group.of[blocks * scale]
    room = group.ends[text] - blocks * scale
    blocks = blocks[(lengths[text] >= max(LEAST, 2 * least)) & (room >= scale + least)]
    if not len(blocks):
        return
    size = min(scale, PATTERN)
    bits = size.bit_length()  # rows of twice the pattern
    forward, back = _transform(bits), _transform(bits, True)
    most = 4 * scale + 2 * size
    residues = np.concatenate([group.residues, np.zeros(most)])
    squares = _mod(residues * residues).astype(np.int64)
    summed = np.concatenate([[0], np.cumsum(squares)])
    offsets = np.arange(0 if scale == 2 else 2 * scale, 4 * scale, size)
    places, inside = np.arange(size), np.arange(2 * size)
    per = max(1, ELEMENTS // (2 * size))
    carried: dict[int, tuple[int, np.ndarray]] = {}  # by offset: the last block, and where its row was zero
    for at in range(0, len(blocks), per):
        now = blocks[at:at + per]
        begin = now * scale
        rows = np.zeros((len(now), 2 * size))
        # Reversed, so that the product of transforms is the correlation.
        rows[:, (-places) % (2 * size)] = residues[begin[:, None] + places]
        spectrum = forward(rows)
        own = summed[begin + size] - summed[begin]
        # Windows begin at multiples of the scale, so that one block's window is often another's, too; long blocks have many windows each.
        wanted = np.unique((begin[:, None] + offsets).ravel()) if size == scale else np.empty(0, np.int64)
        held = forward(residues[wanted[:, None] + inside]) if len(wanted) else None
        for offset in offsets.tolist():
            start = begin + offset
            window = forward(residues[start[:, None] + inside]) if held is None else held[np.searchsorted(wanted, start)]
            cross = back(_mod(spectrum * window))[:, :size].astype(np.int64)
            behind = start[:, None] + places
            zero = (own[:, None] + summed[behind + size] - summed[behind] - 2 * cross) % PRIME == 0
            if offset == 0:
                zero[:, 0] = False
            yield from _chains(now, zero, offset, carried)
    for offset, (block, open_at) in carried.items():
        d = np.flatnonzero(open_at >= 0)
        if len(d):
            yield open_at[d], np.full(len(d), block), d + offset


def _chains(now: np.ndarray, zero: np.ndarray, offset: int, carried: dict[int, tuple[int, np.ndarray]]
            ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chains that end inside these rows; ``carried`` keeps the first block of those that may go on."""
    last, opened = carried.get(offset, (-2, np.full(zero.shape[1], -1)))
    follows = np.concatenate([[now[0] == last + 1], now[1:] == now[:-1] + 1])
    hit, place = np.nonzero(zero)
    before = np.vstack([(opened >= 0)[None], zero[:-1]])
    after = np.vstack([zero[1:] & follows[1:, None], np.zeros((1, zero.shape[1]), bool)])
    begins = ~(before[hit, place] & follows[hit])
    ends = ~after[hit, place]
    # What was open and does not go on has ended.
    shut = np.flatnonzero((opened >= 0) & ~(zero[0] & follows[0]))
    if len(shut):
        yield opened[shut], np.full(len(shut), last), shut + offset
    order = np.lexsort((hit, place))
    hit, place, begins, ends = hit[order], place[order], begins[order], ends[order]
    first = np.where(begins, now[hit], -1)
    goes_on = ~begins & (hit == 0)
    first[goes_on] = opened[place[goes_on]]
    # Within a place rows ascend, so every chain's rows stand together and begin with a known first block.
    starts = np.flatnonzero(first >= 0)
    filled = first[starts[np.searchsorted(starts, np.arange(len(first)), side="right") - 1]] if len(first) else first
    final = ends & (hit < len(now) - 1)
    if final.any():
        yield filled[final], now[hit[final]], place[final] + offset
    still = np.full(zero.shape[1], -1)
    open_now = hit == len(now) - 1
    still[place[open_now]] = filled[open_now]
    carried[offset] = (int(now[-1]), still)


def _candidates(group: Group) -> np.ndarray:
    """Start, end and period of every stretch that a seed extends to, as rows; all runs are among them."""
    found = [np.empty((0, 3), np.int64)]
    longest = int((group.ends - group.starts).max(initial=0))
    scale = 2
    while longest >= (LEAST if scale == 2 else 4 * scale):
        for first, last, d in _recurrences(group, scale):
            while len(first):
                at = first * scale
                text = group.of[at]
                start, end = group.starts[text], group.ends[text]
                fits = at + d < end
                first, last, d, at, start, end = (x[fits] for x in (first, last, d, at, start, end))
                right = group.longest(at, d, end - at - d, 1)
                left = group.longest(at, d, at - start, -1)
                size = left + right + d
                good = size >= np.maximum(LEAST, 2 * d)
                found.append(np.stack([at - left, at + right + d, d], 1)[good])
                # A chain that one stretch does not reach to the end of held a chance zero, or runs into the next text.
                first = np.maximum(first, (at + right) // scale) + 1
                again = first <= last
                first, last, d = first[again], last[again], d[again]
        scale *= 2
    return np.concatenate(found)


def runs(group: Group) -> tuple[np.ndarray, bool]:
    """Every run (start, end, period) by start and period; and whether all of them hold word by word."""
    rows = _candidates(group)
    order = np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))
    rows = rows[order]
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[smallest]
    sound = all(np.array_equal(group.ids[s:e - q], group.ids[s + q:e]) for s, e, q in rows.tolist())
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))], sound


def of_texts(texts: list[str | None]) -> list[tuple[Runs, bytes]]:
    """For every text its runs (start, length, period) by start and period, and its words without those that runs repeat."""
    seed = 1
    while True:
        group = Group(texts, seed)
        rows, sound = runs(group)
        if sound:
            break
        seed += 1  # two different stretches had one hash
    change = np.zeros(len(group.ids) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    of = group.of[rows[:, 0]] if len(rows) else np.empty(0, np.int64)
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    found = []
    for i, words in enumerate(group.words):
        start = int(group.starts[i])
        own = [(s - start, e - s, q) for s, e, q in rows[cuts[i]:cuts[i + 1]].tolist()]
        if own:
            words = [words[k] for k in np.flatnonzero(kept[start:int(group.ends[i])]).tolist()]
        found.append((own, b" ".join(words)))
    return found


RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def with_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs by start and period, and the collapsed text of every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            found = of_texts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own, _ in found], _RUN),
                 pa.array([words.decode() for _, words in found], pa.string())], ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, f"doc_id bigint, runs array<{RUN}>, collapsed string")


def repeating(doc_id: Column, text: Column) -> Column:
    """The text, of a tenth of the ids with its words from some place on in a period (both by the id's CRC-32)."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("bigint")

    def altered(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("bigint")
        # transform() gives the place of each word; slices of the array would be copied for each.
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))), " ")

    chosen = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, altered(w)).otherwise(text))[0]
    return F.when((h % 10 == 0) & text.isNotNull(), chosen).otherwise(text)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = with_runs(docs.select("doc_id", repeating(F.col("doc_id"), F.col("text")).alias("text")))
    # The longest, of these the first, of these the one with the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
