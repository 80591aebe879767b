"""The methods' own structures against plain versions, without Spark."""

import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from lakestar.llm.bpe import ByteBPE, byte_bpe
from lakestar.llm.decontaminate import FMIndex, Phrases, WaveletMatrix, find_spans, spans, suffix_array, words_of
from lakestar.llm.exact_dedup import build_filter, may_contain
from lakestar.llm.jaccard_join import gram_sets, parity_bits, signatures, size_classes
from lakestar.llm.language import Profiler
from lakestar.llm.quality import fit_network
from lakestar.llm.tokenizer_words import word_encoder
from lakestar.llm.url_rules import compile_globs, matches, rule_glob
from lakestar.llm.wordpiece import LongestMatch, pieces_of

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, "a  b", " x", "x ", "a\n b", "a \n\n b  ", "it's ÄÖ’s don'T 123 456", "<|endoftext|>x<|endoftext|>",
    "a <|endoftext|> b", "é́ ñ İstanbul ΣΑΣ", "\x1c a b　c", "\x1c!x", "!" * 1000, "ab" * 3000, " x",
    "<|startoftext|>Hi<|ENDOFTEXT|>", "日本語 テスト🙂🙂", "a\tb\r\nc", "  " * 300, "ſK", "\0",
]


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(BYTE)


def test_byte_bpe_on_odd_texts(byte_tokenizer):
    coder = ByteBPE(BYTE)
    for text, ids in zip(ODD, coder.encode(ODD)):
        wanted = byte_tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == wanted
        assert coder.decode(ids) == byte_tokenizer.decode(wanted, skip_special_tokens=False) == (text or "")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=60), max_size=4))
def test_byte_bpe_on_any_text(texts):
    tokenizer, coder = Tokenizer.from_file(BYTE) if not hasattr(test_byte_bpe_on_any_text, "t") else test_byte_bpe_on_any_text.t, byte_bpe(BYTE)
    test_byte_bpe_on_any_text.t = tokenizer
    for text, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_bad_bytes_decode_to_replacement_characters(byte_tokenizer):
    ids = byte_tokenizer.encode("🙂", add_special_tokens=False).ids[:1]
    assert ByteBPE(BYTE).decode(np.array(ids, "<u4").tobytes()) == byte_tokenizer.decode(ids)


def test_word_ids_of_odd_texts():
    tokenizer, encoder = Tokenizer.from_file(WORD), word_encoder(WORD)
    for text, ids in zip(ODD, encoder.encode(ODD)):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=80), st.integers(0, 6))
def test_wavelet_ranks_and_symbols(values, symbol):
    sequence = np.array(values, dtype=np.int64)
    matrix = WaveletMatrix(sequence, 3)
    at = np.arange(len(values) + 1)
    assert matrix.rank(np.full(len(at), symbol), at).tolist() == [values[:i].count(symbol) for i in at]
    assert matrix.symbols(at[:-1]).tolist() == values


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=4))
def test_backward_search_finds_every_occurrence(values, phrase):
    text = np.array([*values, 0], dtype=np.int64)
    assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    index = FMIndex(text, 5)
    low, high = index.search(np.array([[-1] * (4 - len(phrase)) + phrase]))
    found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    assert found == [i for i in range(len(values)) if values[i : i + len(phrase)] == phrase]


def naive_hits(text, items, window):
    """Hit marks and items of one text by comparing every place."""
    words = words_of(text)
    hit, found = [False] * len(words), set()
    for item, phrase_text in items:
        phrase = words_of(phrase_text)
        windows = [phrase[i : i + window] for i in range(max(1, len(phrase) - window + 1))] if phrase else []
        for w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit[i : i + len(w)] = [True] * len(w)
                    found.add(str(item))
    return hit, found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=25), max_size=5),
       st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=4))
def test_spans_equal_the_naive_ones(documents, phrases):
    texts = [" ".join(d) for d in documents]
    items = [(i, " ".join(p)) for i, p in enumerate(phrases)]
    hit, found = find_spans([words_of(t) for t in texts], Phrases.of(items, 4))
    at = 0
    for text, have in zip(texts, found):
        wanted, wanted_items = naive_hits(text, items, 4)
        own = hit[at : at + len(wanted)]
        assert own.tolist() == wanted and have == wanted_items
        assert [i for a, b in spans(own) for i in range(a, b)] == np.flatnonzero(wanted).tolist()
        at += len(wanted)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_fuse_filter_has_its_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
    built = build_filter(np.concatenate([keys, keys]))
    assert may_contain(built, keys).all()
    others = rng.integers(1 << 63, (1 << 64) - 1, 20_000, dtype=np.uint64)
    assert may_contain(built, others).mean() < 0.02 or n == 0


def greedy(word, initial, inner):
    count, at = 0, 0
    while at < len(word):
        pieces = initial if at == 0 else inner
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        count, at = count + 1, end
    return count


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=4), max_size=12),
       st.sets(st.text("abc", min_size=1, max_size=4), max_size=12), st.text("abcd", max_size=14))
def test_longest_match_is_greedy(initial, inner, word):
    assert LongestMatch(initial, inner).count(word) == greedy(word, initial, inner)


def test_longest_match_equals_the_library():
    initial, inner = pieces_of(BYTE)
    vocabulary = {"[UNK]": 0}
    for piece in [*initial, *("##" + p for p in inner)]:
        vocabulary.setdefault(piece, len(vocabulary))
    model = models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10_000)
    plain = [p for p in initial if not p.startswith("##")]
    automaton = LongestMatch(plain, inner)
    for word in ["hello", "unbelievable", "xqzzy", "straße", "123456789", "Ñandú", "thetheerereding", "日本", "a" * 500]:
        tokens = model.tokenize(word)
        wanted = -1 if [t.value for t in tokens] == ["[UNK]"] else len(tokens)
        assert automaton.count(word) == wanted


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + "(?s:.*)", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif glob[i] == "?":
            out, i = out + "(?s:.)", i + 1
        else:
            i += glob[i] == "\\"
            out, i = out + re.escape(glob[i]), i + 1
    return out + r"\Z"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab/*?.", min_size=0, max_size=40), min_size=1, max_size=6),
       st.lists(st.text("ab/.c", max_size=30), min_size=1, max_size=6))
def test_globs_equal_regular_expressions(globs, urls):
    # A loop of one kind directly after the other joins them.
    globs = [re.sub(r"\*{2,}", "**", g) for g in globs]
    got = matches(compile_globs(globs), urls)
    for i, url in enumerate(urls):
        assert got[i].tolist() == [bool(re.match(as_regex(g), url)) for g in globs]


def test_rule_globs_fit_hosts_subdomains_and_prefixes():
    automaton = compile_globs([rule_glob("example.org/en/1")])
    urls = [".example.org/en/1", ".a.b.example.org/en/123", ".badexample.org/en/1", ".example.org/en/2", ".x/example.org/en/1"]
    assert matches(automaton, urls)[:, 0].tolist() == [True, True, False, False, False]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 300), st.integers(0, 80), st.sampled_from([80, 90]), st.integers(0, 1 << 30))
def test_linked_sets_share_a_segment(size, differ, percent, seed):
    rng = np.random.default_rng(seed)
    left = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    gone = rng.integers(0, min(differ, len(left)) + 1)
    right = np.unique(np.concatenate([left[gone:], rng.integers(0, 1 << 63, differ - gone).astype(np.uint64)]))
    shared = len(np.intersect1d(left, right))
    bits = [parity_bits(s, percent) for s in (left, right)]
    least = min(map(len, bits))
    a, b = (np.bitwise_xor.reduce(x.reshape(-1, least), axis=0).view(np.uint64) for x in bits)
    assert np.bitwise_count(a ^ b).sum() <= len(left) + len(right) - 2 * shared
    if len(right) and shared < len(left) + len(right) - shared and \
            100 * shared >= percent * (len(left) + len(right) - shared):
        found, owner = signatures([left, right], percent)
        assert len(np.intersect1d(found[owner == 0], found[owner == 1]))


def test_size_classes_hold_partners():
    for percent in (80, 90):
        classes = size_classes(percent)
        small = np.arange(1, 3000)
        large = small * 100 // percent
        assert (classes.of(large) - classes.of(small) <= 1).all()


def test_grams_of_short_texts():
    empty, one, again, two = gram_sets(["", "A b", "a  B\n", "a b c d"], 3)
    assert len(empty) == 0 and len(one) == 1 and one.tolist() == again.tolist() and len(two) == 2


def test_bundles_are_sums_of_bound_letters():
    profiler = Profiler(64)
    row = profiler.bundles(["ab"])[0]
    a, b, gap = (profiler.place[ord(c)] if c != " " else 0 for c in "ab ")
    first, second, third = profiler.rotated
    wanted = first[gap] * second[a] * third[b] + first[a] * second[b] * third[gap]
    assert row.tolist() == wanted.tolist()
    assert not profiler.bundles(["", "12 !"]).any()


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 6))
    truth = 1 / (1 + np.exp(-2 * x[:, 0] * x[:, 1]))
    net = fit_network(x, (rng.random(2000) < truth).astype(float))
    fresh = rng.normal(size=(4000, 6))
    p = net.probabilities(fresh)
    wanted = 1 / (1 + np.exp(-2 * fresh[:, 0] * fresh[:, 1]))
    assert np.abs(p - wanted).mean() < 0.15 and net.temperature > 0
