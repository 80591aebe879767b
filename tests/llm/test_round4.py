"""Encoders that look each distinct part up once and keep bounded tables; the pipeline's Arrow batches."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakestar.llm import bpe, quality
from lakestar.llm.bpe import ByteBPE
from lakestar.llm.quality import Tokens
from lakestar.llm.tokenizer_words import WordEncoder

TEXTS = [None, "", " ", "a  b\n\nc ", "Ärger um 3 Ä's\tund'll  <|endoftext|> über　alles", "x" * 300 + " y", "\n", "naïve \x1c ok"]


def _texts(n, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéñß'.9") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    return TEXTS + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def _library(name, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation(), tokenizer.no_padding()
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_parts_are_looked_up_once_a_group():
    class Counting(dict):
        looked = 0

        def get(self, key, default=None):
            Counting.looked += 1
            return super().get(key, default)

    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.known = Counting()
    texts = _texts(200)
    ids = [list(memoryview(i).cast("H")) for i in encoder.encode(texts)]
    assert ids == _library("word_bpe_49k.json", texts)
    assert Counting.looked <= len({p for t in texts for p in (t or "").replace("\n", " ").split(" ")})


@pytest.mark.parametrize("kept", [1, 50, 100_000])
def test_bpe_keeps_parts_that_are_used_again(monkeypatch, kept):
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", kept)
    monkeypatch.setattr(bpe, "groups_of_text", lambda texts: ([t or ""] for t in texts))
    coder, texts, most, last = ByteBPE(public_tokenizers.path("byte_bpe_50k.json")), _texts(60), 0, 0
    for text, ids in zip(texts, _library("byte_bpe_50k.json", texts)):
        assert [list(memoryview(i).cast("I")) for i in coder.encode(iter([text]))] == [ids]
        parts = len({*(text or "").split(" ")})
        assert len(coder.known) <= kept + parts and len(coder.former) <= kept + max(last, parts)
        most, last = max(most, len(coder.former)), max(last, parts)
    assert bool(most) == (kept < 100_000)
    coder.forget()
    assert not coder.known and not coder.former


def test_tokens_of_letters_need_no_pattern(monkeypatch):
    words = ["a", "A", "AB", "Ab", "aB", "ß", "É", "ÉÑ", "ñu", "中文", "ª", "ǅ", "ﬁn", "İ"]
    marked = [Tokens._hashes(f"{w}\n") for w in words]  # a mark after them, so the pattern is used
    assert all(quality.PARTS.fullmatch(w).groups() == ("", w, "") for w in words)
    monkeypatch.setattr(quality, "PARTS", None)
    found = [Tokens._hashes(w) for w in words]
    assert [word for word, _ in found] == [word for word, _ in marked]
    forms = {}
    for w, (_, form) in zip(words, found):
        case = "A" if w.isupper() and len(w) > 1 else "Aa" if w[:1].isupper() else "a"
        assert form == quality.xxhash.xxh3_64_intdigest(f"\0\0{case}\0")
        forms[case] = form
    assert len(set(forms.values())) == 3
    tokens = Tokens()
    numbers, sizes = tokens.read(["b a b", "", "a"])
    hashes, kinds, place = tokens.hashes(numbers)
    assert sizes.tolist() == [3, 0, 1] and len(hashes) == len(kinds) == 2 and place[0] == place[2] != place[1] == place[3]
    assert [a.size for a in tokens.hashes(numbers[:0])] == [0, 0, 0]


def test_stages_hand_small_batches_to_python(spark):
    before = spark.conf.get(corpus_pipeline.ARROW_ROWS)
    try:
        for session, expected in (("10000", "2000"), ("500", "500"), ("0", "2000")):
            spark.conf.set(corpus_pipeline.ARROW_ROWS, session)
            docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
            assert corpus_pipeline.bpe_encoding(spark, docs, "").first()["n_tokens"] == 2
            assert spark.conf.get(corpus_pipeline.ARROW_ROWS) == expected
    finally:
        spark.conf.set(corpus_pipeline.ARROW_ROWS, before)
