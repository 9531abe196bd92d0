"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Only the vocabulary comes from the sentencepiece library (a model file, read on the driver and broadcast: a few MB,
bounded by the vocabulary). The work is numpy over flat symbol arrays: the distinct words of a batch lie behind one
another, each round finds the best pair of every word with a segmented minimum of pair ranks, merges, compacts the
arrays, and drops words without a pair.

All places of a word's best pair merge at once when the new piece cannot take part in a pair of equal or better
rank (found out once for each piece); otherwise only the leftmost place does, since the next merge may then belong
elsewhere. Both give what the library gives. Overlapping places merge from the left.

Words begin at white space when no piece has white space after another character, as is checked; then no merge
crosses words. A run of white space that has pieces for every length up to some most, all ranked last, is cut by
arithmetic, so a long run takes no rounds. A word is cut where no piece has two characters side by side, and in a part that is long even so
(Chinese, encoded data) the places are kept by rank, so that a round costs what it changes. Words are remembered up to a fixed number.

Defined results: null is the empty text; empty texts have the begin and end ids only; unknown characters become their
UTF-8 bytes; repeated rows are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbazaar.llm.common import slices, table

SPACE = "▁"
#: Words remembered by a task, and the longest that is.
REMEMBERED, LONGEST = 400_000, 64
#: Symbols of a part of a word from which on rounds look only at the places that a merge can touch.
LONG_PART = 2048
_NONE = np.iinfo(np.int32).max


def _byte_by_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("llm-byte-by-byte", _byte_by_byte)


@dataclass
class Vocabulary:
    """Pieces by id, with the pairs that merge."""

    pieces: list[str]
    scores: np.ndarray
    normal: np.ndarray
    byte: dict[int, int]            # byte value to id
    begin: int
    end: int
    dummy_prefix: bool
    pair_keys: np.ndarray = field(init=False)    # open-addressing table of left << 32 | right; -1: free
    pair_ranks: np.ndarray = field(init=False)
    pair_ids: np.ndarray = field(init=False)
    alone: np.ndarray = field(init=False)        # by id: only the leftmost place may merge
    chars: np.ndarray = field(init=False)        # by code point
    space_run: int = field(init=False)           # longest run of white space that arithmetic may cut; 0: none
    splits_at_space: bool = field(init=False)
    side_by_side: np.ndarray = field(init=False)  # sorted: pairs of code points that some piece has

    def _hash(self, keys: np.ndarray, ranks: np.ndarray, ids: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.pair_keys = np.full(1 << self.bits, -1, np.int64)
        self.pair_ranks = np.full(1 << self.bits, _NONE, np.int32)
        self.pair_ids = np.zeros(1 << self.bits, np.int32)
        for key, slot, rank, i in zip(keys.tolist(), _slot(keys, self.bits).tolist(), ranks.tolist(), ids.tolist()):
            while self.pair_keys[slot] not in (-1, key):
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.pair_keys[slot], self.pair_ranks[slot], self.pair_ids[slot] = key, rank, i

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        if model.decode(model.encode("ﬁ  ½")) != "ﬁ  ½":
            raise ValueError("only models that leave the text as it is are supported")
        return cls(
            pieces=[model.id_to_piece(i) for i in ids],
            scores=np.array([model.get_score(i) for i in ids]),
            normal=np.array([not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in ids]),
            byte={int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)},
            begin=model.bos_id(), end=model.eos_id(),
            dummy_prefix=model.encode("a", out_type=str)[0].startswith(SPACE),
        )

    def __post_init__(self) -> None:
        by_text = {p: i for i, p in enumerate(self.pieces) if self.normal[i]}
        # Rank 0 is the highest score; equal scores share a rank and the leftmost goes first.
        ranks = np.unique(-self.scores, return_inverse=True)[1]
        size = len(self.pieces)
        keys, pair_ranks, pair_ids = [], [], []
        for text, i in by_text.items():
            for k in range(1, len(text)):
                left, right = by_text.get(text[:k]), by_text.get(text[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    pair_ranks.append(int(ranks[i]))
                    pair_ids.append(i)
        made, made_ranks = np.array(keys, np.int64), np.array(pair_ranks, np.int32)
        self._hash(made, made_ranks, np.array(pair_ids, np.int32))
        self.alone = np.zeros(size, bool)
        for part in (made >> 32, made & 0xFFFFFFFF):
            self.alone[part[made_ranks <= ranks[part]]] = True
        # Symbol of every code point; those outside the vocabulary are negative and never pair.
        self.chars = -1 - np.arange(0x110000, dtype=np.int32)
        for p, i in by_text.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        self.side_by_side = np.unique(np.array([(ord(a) << 32) | ord(b) for p in by_text for a, b in zip(p, p[1:])] or [-1], np.int64))
        self.splits_at_space = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in by_text)
        runs = {len(p): i for p, i in by_text.items() if set(p) == {SPACE}}
        others = [ranks[i] for p, i in by_text.items() if len(p) > 1 and set(p) != {SPACE}]
        long = [ranks[i] for n, i in runs.items() if n > 1]
        regular = sorted(runs) == list(range(1, len(runs) + 1)) and len(set(long)) == 1 and max(others, default=-1) < min(long, default=0)
        self.space_run = len(runs) if regular and len(runs) > 1 else 0
        self.runs = runs
        self.raw = [b""] * size
        for i, p in enumerate(self.pieces):
            if self.normal[i]:
                self.raw[i] = p.replace(SPACE, " ").encode()
        for value, i in self.byte.items():
            self.raw[i] = bytes([value])
        self.raw_flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_length = np.array([len(r) for r in self.raw], np.int64)
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).view(np.int64)


def _pairs(left: np.ndarray, right: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each pair and the piece it makes."""
    keys = (left.astype(np.int64) << 32) | right
    keys[(left < 0) | (right < 0)] = -2
    place = _slot(keys, voc.bits)
    there = voc.pair_keys[place]
    lost = np.flatnonzero((there != keys) & (there != -1))
    while len(lost):
        place[lost] = (place[lost] + 1) & ((1 << voc.bits) - 1)
        there = voc.pair_keys[place[lost]]
        lost = lost[(there != keys[lost]) & (there != -1)]
    return np.where(voc.pair_keys[place] == keys, voc.pair_ranks[place], _NONE), voc.pair_ids[place]


def merge_rounds(symbols: np.ndarray, word: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merge the symbols of each word (``word`` is ascending) until no pair remains; the symbols and words left.

    Each symbol carries the rank of the pair that begins at it; a round looks up only pairs next to a merge.
    """
    if not len(symbols):
        return symbols, word
    symbols = symbols.copy()
    rank, piece = _pairs(symbols, np.append(symbols[1:], -1), voc)
    rank[np.append(word[1:] != word[:-1], True)] = _NONE
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        lengths = np.diff(np.append(begins, len(symbols)))
        best = np.minimum.reduceat(rank, begins)
        open_ = best < _NONE
        if not open_.all():
            keep = np.repeat(open_, lengths)
            done.append((symbols[~keep], word[~keep]))
            symbols, word, rank, piece = symbols[keep], word[keep], rank[keep], piece[keep]
            lengths, best = lengths[open_], best[open_]
            if not len(symbols):
                break
        # All places of the best pair, and for each whether it is its word's leftmost.
        at = np.flatnonzero(rank == np.repeat(best, lengths))
        of = word[at]
        first = np.append(True, of[1:] != of[:-1])
        made = piece[at]
        single = voc.alone[made[first]][np.cumsum(first) - 1]
        # Of places one after another only every other one can merge, from the left.
        run_start = first | (np.append(-2, at[:-1]) + 1 != at)
        offset = np.arange(len(at)) - np.flatnonzero(run_start)[np.cumsum(run_start) - 1]
        chosen = np.where(single, first, offset % 2 == 0)
        at, made = at[chosen], made[chosen]
        symbols[at] = made
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, word, rank, piece = symbols[keep], word[keep], rank[keep], piece[keep]
        at -= np.arange(len(at))  # as many symbols went before each place
        near = np.concatenate([at, at[at > 0] - 1])
        right = np.minimum(near + 1, len(symbols) - 1)
        near_rank, piece[near] = _pairs(symbols[near], symbols[right], voc)
        rank[near] = np.where((word[near] == word[right]) & (right > near), near_rank, _NONE)
    symbols, word = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
    order = np.argsort(word, kind="stable")
    return symbols[order], word[order]


def merge_long(symbols: np.ndarray, voc: Vocabulary) -> np.ndarray:
    """The same for the symbols of one long word, in time about proportional to their number: places are kept by the rank of their pair, and a
    round looks at those of the best rank and their neighbours only.

    All places of a rank merge at once, from the left, up to the first one whose merge makes a pair of an equal or better rank.
    """
    n = len(symbols)
    symbols, after, before = symbols.copy(), np.arange(1, n + 1), np.arange(-1, n - 1)
    alive = np.ones(n, bool)
    rank, piece = _pairs(symbols, np.append(symbols[1:], -1), voc)
    waiting: dict[int, list[np.ndarray]] = {}
    order: list[int] = []

    def put(at: np.ndarray) -> None:
        at = at[rank[at] < _NONE]
        at = at[np.argsort(rank[at], kind="stable")]
        for part in np.split(at, np.flatnonzero(np.diff(rank[at])) + 1) if len(at) else ():
            r = int(rank[part[0]])
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(order, r)
            waiting[r].append(part)

    def right_of(at: np.ndarray) -> np.ndarray:
        """The symbols behind places, or one that pairs with nothing."""
        return np.where(after[at] < n, symbols[np.minimum(after[at], n - 1)], -1)

    put(np.arange(n))
    while order:
        best = heapq.heappop(order)
        at = np.unique(np.concatenate(waiting.pop(best)))
        at = at[alive[at] & (rank[at] == best)]
        if not len(at):
            continue
        # Of places one after another only every other one can merge, from the left.
        starts = np.append(True, after[at[:-1]] != at[1:])
        chosen = at[(np.arange(len(at)) - np.flatnonzero(starts)[np.cumsum(starts) - 1]) % 2 == 0]
        made = piece[chosen]
        if voc.alone[made].any():
            # What each merge meets: on its left the merges before it are done, on its right nothing is yet.
            left = np.where(before[chosen] >= 0, symbols[np.maximum(before[chosen], 0)], -1)
            beside = np.append(False, after[after[chosen[:-1]]] == chosen[1:])
            left[beside] = made[:-1][beside[1:]]
            worse = (_pairs(made, right_of(after[chosen]), voc)[0] > best) & (_pairs(left, made, voc)[0] > best)
            if not worse.all():
                last = int(np.argmin(worse)) + 1
                put(at[at > chosen[last - 1]])
                chosen, made = chosen[:last], made[:last]
        gone = after[chosen]
        symbols[chosen] = made
        alive[gone] = False
        rank[gone] = _NONE
        after[chosen] = after[gone]
        inner = chosen[after[chosen] < n]
        before[after[inner]] = inner
        near = np.concatenate([chosen, before[chosen][before[chosen] >= 0]])
        near = np.unique(near)
        rank[near], piece[near] = _pairs(symbols[near], right_of(near), voc)
        put(near)
    return symbols[alive]


class Encoder:
    """Encodes texts of a task; remembers words. A word is kept without the white space that it begins with, or
    with one less where there are several."""

    def __init__(self, voc: Vocabulary) -> None:
        self.voc = voc
        self.known: dict[str, bytes] = {}

    def _split(self, text: str | None) -> list[str]:
        if not text:
            return []
        text = text.replace(SPACE, " ")
        if not self.voc.dummy_prefix or not self.voc.splits_at_space:
            raise ValueError("only models with a prefix whose pieces have white space in front are supported")
        parts = text.split(" ")
        if "" not in parts:
            return parts
        words, run = [], 0
        for p in parts:
            if p:
                words.append(SPACE * run + p)
                run = 0
            else:
                run += 1
        if run:
            words.append(SPACE * (run - 1))
        return words

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        voc = self.voc
        # White space that arithmetic may cut is left to _lead.
        runs = {w: len(w) - len(w.lstrip(SPACE)) for w in words if w.startswith(SPACE)} if voc.space_run else {}
        cores = [w[runs.get(w, 0):] for w in words] if runs else words
        lengths = np.fromiter(map(len, cores), np.int64, len(cores)) + 1
        text = SPACE + SPACE.join(cores)
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        symbols, word = self._merged(voc.chars[codes], codes, np.repeat(np.arange(len(words), dtype=np.int32), lengths))
        left = np.bincount(word, minlength=len(words))
        ends = np.cumsum(left)
        begins = ends - left
        raw = symbols.astype("<u4").tobytes()
        found = {w: raw[a:b] for w, a, b in zip(words, (4 * begins).tolist(), (4 * ends).tolist())}
        odd = set(np.unique(word[symbols < 0]).tolist())
        if runs:
            odd.update(i for i, w in enumerate(words) if w in runs)
        for i in odd:
            ids = self._lead(symbols[begins[i]:ends[i]], runs.get(words[i], 0))
            found[words[i]] = (self._as_bytes(ids) if (ids < 0).any() else ids).astype("<u4").tobytes()
        return found

    def _merged(self, symbols: np.ndarray, codes: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of every word. Words are cut where no piece has both characters side by side: nothing merges over that."""
        voc = self.voc
        pairs = (codes[:-1].astype(np.int64) << 32) | codes[1:]
        apart = voc.side_by_side[np.minimum(np.searchsorted(voc.side_by_side, pairs), len(voc.side_by_side) - 1)] != pairs
        begins = np.flatnonzero(np.append(True, apart | (word[1:] != word[:-1])))
        lengths = np.diff(np.append(begins, len(symbols)))
        part = np.repeat(np.arange(len(begins), dtype=np.int32), lengths)
        of, long = word[begins], np.flatnonzero(lengths > LONG_PART)
        if not len(long):
            symbols, part = merge_rounds(symbols, part, voc)
            return symbols, of[part]
        merged = [merge_long(symbols[begins[i]:begins[i] + lengths[i]], voc) for i in long.tolist()]
        short = ~np.isin(part, long)
        rest, rest_part = merge_rounds(symbols[short], part[short], voc)
        symbols = np.concatenate([rest, *merged])
        part = np.concatenate([rest_part, np.repeat(long.astype(np.int32), [len(m) for m in merged])])
        order = np.argsort(part, kind="stable")
        return symbols[order], of[part[order]]

    def _lead(self, ids: np.ndarray, run: int) -> np.ndarray:
        """``run`` more pieces of white space before a word; its own first one belongs to them if it joined nothing."""
        if not run:
            return ids
        alone = ids[0] == self.voc.chars[ord(SPACE)]
        whole, rest = divmod(run + int(alone), self.voc.space_run)
        lead = [self.voc.runs[self.voc.space_run]] * whole + ([self.voc.runs[rest]] if rest else [])
        return np.concatenate([np.array(lead, np.int64), ids[1:] if alone else ids])

    def _as_bytes(self, ids: np.ndarray) -> np.ndarray:
        out: list[int] = []
        for i in ids.tolist():
            out.extend([i] if i >= 0 else (self.voc.byte[x] for x in chr(-1 - i).encode("utf-8", "replace")))
        return np.array(out, np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text with begin and end, as little-endian unsigned 32-bit integers."""
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.voc.begin, self.voc.end))
        split = [self._split(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = set().union(*split).difference(self.known)
        if new:
            found = self._encode_words(list(new))
            self.known.update(found)
        known = self.known
        encoded = [b"".join([begin, *map(known.__getitem__, words), end]) for words in split]
        for w in new:
            if len(w) > LONGEST:
                del known[w]
        return encoded


def decode(ids: list[bytes], voc: Vocabulary) -> list[str]:
    """The texts of ids as ``Encoder.encode`` returns them; control ids make no text."""
    texts = []
    for raw in ids:
        own = np.frombuffer(raw, "<u4").astype(np.int64)
        lengths = voc.raw_length[own]
        total = int(lengths.sum())
        # Positions of every byte of every piece in the flat table of pieces.
        where = np.repeat(voc.raw_start[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)
        text = voc.raw_flat[where].tobytes().decode("utf-8", "llm-byte-by-byte")
        shown = own[lengths > 0]
        prefixed = voc.dummy_prefix and len(shown) and voc.normal[shown[0]] and text.startswith(" ")
        texts.append(text[1:] if prefixed else text)
    return texts


def tokenized(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit, with begin and end), n_tokens and the decoded text."""
    voc = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(voc.value)
        for batch in slices(batches, "text", 2 << 20):
            ids = encoder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array(decode(ids, voc.value), pa.string())], ["doc_id", "ids", "n_tokens", "decoded"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, ids binary, n_tokens bigint, decoded string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    return tokenized(docs, model).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
