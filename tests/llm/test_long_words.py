"""Long words without white space against the library."""

import base64
import random
import time

import numpy as np
import pytest

from starbazaar.llm import sentencepiece_bpe
from test_text_operators import tokenizer


@pytest.fixture(scope="module")
def both():
    path, model = tokenizer()
    return sentencepiece_bpe.Vocabulary.load(path), model


def ids(voc, text):
    return np.frombuffer(sentencepiece_bpe.Encoder(voc).encode([text])[0], "<u4").tolist()


@pytest.mark.parametrize("long_part", [2, 50, sentencepiece_bpe.LONG_PART])
def test_long_words_equal_the_library(both, monkeypatch, long_part):
    monkeypatch.setattr(sentencepiece_bpe, "LONG_PART", long_part)
    voc, model = both
    draw = random.Random(long_part)
    texts = ["".join(draw.choice(letters) for _ in range(n)) for letters in (
        "abcdefghijklmnopqrstuvwxyz", "aehinorst", "ab", "aaab", "0123456789abcdef", "的一是不了人我在有他这为之大来", "éaè벨x😀", "er-on.in_") for n in (3, 40, 700, 5000)]
    texts += [base64.b64encode(draw.randbytes(4000)).decode(), "a" * 5001, "ha" * 2600, "=" * 4000 + "-" * 999, "the" * 2000 + " " + "and" * 1500]
    texts += ["".join(draw.choice(["tion", "ing", "er", "the", "ment", "x", "zq"]) for _ in range(2000))]
    for text in texts:
        assert ids(voc, text) == model.encode(text, add_bos=True, add_eos=True), text[:60]


def test_a_million_letters_take_seconds(both):
    voc, model = both
    draw = random.Random(1)
    text = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    begin = time.process_time()
    found = ids(voc, text)
    assert time.process_time() - begin < 60  # about 10 on an idle core
    assert found == model.encode(text, add_bos=True, add_eos=True)
