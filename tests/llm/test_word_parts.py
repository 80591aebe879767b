"""The word encoder learns each word once, whatever stands around it, and reads Arrow arrays as they are."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakestar.llm import tokenizer_words
from lakestar.llm.tokenizer_words import WordEncoder

WORD = public_tokenizers.path("word_bpe_49k.json")
LETTERS = [
    *"abJKWzsStTmdrevlL019'’.,!=<>|-_`\"éÉßÖœſİıŸ×÷Σσ€—日가̸֑̌́", " ", "  ", "\n", "\t", "\r", "\x0b", "\0", "\x85", "\xa0", "'s", "'LL",
    "the", "don't", "<|", "<|endoftext|>", "<|ENDOFTEXT|>",
]


@pytest.fixture
def learnt(monkeypatch):
    """Every part that is given to the library, in turn."""
    parts, learn = [], WordEncoder._learn
    monkeypatch.setattr(WordEncoder, "_learn", lambda self, some: parts.extend(some) or learn(self, some))
    return parts


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORD)
    tokenizer.no_truncation(), tokenizer.no_padding()
    return lambda texts: [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def _ids(encoder, texts):
    return [np.frombuffer(i, "<u2").tolist() for i in encoder.encode(texts)]


def test_a_word_is_learnt_once_with_all_its_marks_and_capitals(learnt, library):
    texts = [f" {word}{mark}" for word in ("house", "House", "HOUSE", "größe") for mark in ("", ".", ",", "!!", ")", "7", "'")]
    texts += [f" {number}" for number in range(1000, 1400)]
    assert _ids(WordEncoder(WORD), texts) == library(texts)
    assert len(learnt) < 40


def test_words_in_use_are_not_learnt_again(monkeypatch, learnt, library):
    monkeypatch.setattr(tokenizer_words, "KEPT_WORDS", 20)
    encoder = WordEncoder(WORD)
    for k in range(30):
        texts = [" always " + " ".join(chr(97 + k % 26) + chr(97 + i) + "q" * (k // 26) for i in range(8))]
        assert _ids(encoder, texts) == library(texts)
    assert sum(p.strip() == "always" for p in learnt) == 1


@pytest.mark.parametrize("group", [1, 40, 1_000_000])
def test_odd_texts_in_groups_and_slices_are_as_by_the_library(monkeypatch, library, group):
    monkeypatch.setattr(tokenizer_words, "GROUP_BYTES", group, raising=False)
    rng, encoder = random.Random(group), WordEncoder(WORD)
    for _ in range(20):
        some = rng.sample(LETTERS, rng.randint(3, len(LETTERS)))
        texts = [None if rng.random() < 0.05 else "".join(rng.choices(some, k=rng.randint(0, 20))) for _ in range(40)]
        assert _ids(encoder, texts) == library(texts)
        for kind in (pa.string(), pa.large_string()):
            assert _ids(encoder, pa.array(["é.", "x", *texts, "y"], kind).slice(2, 40)) == library(texts)
    assert _ids(encoder, []) == [] and _ids(encoder, pa.array([None, None], pa.string())) == [[], []]
