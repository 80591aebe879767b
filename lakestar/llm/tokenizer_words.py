"""Ids of whole texts with a public tokenizer, from ids of their words that are kept while they recur."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, normalizers, pre_tokenizers

# Parts whose ids a task keeps in each of two generations (about 200 bytes each).
KEPT_WORDS = 250_000
# Parts of one call to the library, whose results are large, and of a line in it.
CALL_WORDS = 20_000
LINE_WORDS = 200
# Bytes of text whose parts are looked up together (one text may have more).
GROUP_BYTES = 8_000_000
# Fixed values of the tokenizer: the ending of a word's last token, the beginning of its special tokens, and
# words that it takes as one piece (letters up to U+017F but those that lower to more or are no letters).
WORD_END = "</w>"
SPECIAL = b"<|"
WORD = re.compile("[a-zA-ZÀ-ÖØ-öø-įı-ž]+")
# First bytes of U+0300 to U+037F, where the marks are that join an ASCII letter before them.
MARKS = (b"\xcc", b"\xcd")


def _table(kinds: dict[str, bytes]) -> bytes:
    """A table for bytes.translate: the number of the kind that a byte is in, else 0."""
    numbers = {byte: k for k, bytes_ in enumerate(kinds.values(), 1) for byte in bytes_}
    return bytes(numbers.get(byte, 0) for byte in range(256))


# A byte's kind, and for pairs of kinds in a row whether the second begins a part: always, or only after a
# letter of two bytes. A piece of the tokenizer is letters (and ' before some of them), one digit, or marks.
KINDS = _table({
    "blank": b" ", "letter": bytes(range(97, 123)), "digit": b"0123456789", "apostrophe": b"'",
    "mark": bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != 39),
    "first": b"\xc3\xc4\xc5", "tail": bytes(range(0x80, 0xC0)),
})
BLANK, LETTER, DIGIT, APOSTROPHE, MARK, FIRST, TAIL = range(1, 8)
BEGINS = np.zeros(64, dtype=np.uint8)
BEGINS[[8 * kind + BLANK for kind in range(8)]] = 1
for _pair in ((LETTER, DIGIT), (LETTER, APOSTROPHE), (LETTER, MARK), (DIGIT, LETTER), (DIGIT, DIGIT), (DIGIT, APOSTROPHE),
              (DIGIT, MARK), (APOSTROPHE, DIGIT), (MARK, DIGIT), (MARK, LETTER)):
    BEGINS[8 * _pair[0] + _pair[1]] = 1
BEGINS[[8 * TAIL + kind for kind in (DIGIT, APOSTROPHE, MARK)]] = 2
# Characters of two bytes from C3, C4 or C5 on that are no letters, or not once lowered: × ÷ İ.
NO_LETTERS = [0xC397, 0xC3B7, 0xC4B0]
BLANKS = bytes.maketrans(b"\t\n\r", b"   ")
LOWERED = bytes.maketrans(b"\t\n\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"   abcdefghijklmnopqrstuvwxyz")
# Characters of texts whose new words are encoded in one call.
GROUP_CHARS = 2_000_000


def groups_of_text(texts: Iterable[str | None], chars: int = GROUP_CHARS, most: int = 10_000) -> Iterator[list[str]]:
    """Consecutive texts, at most so many, of together about so many characters; null is the empty text."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= chars or len(group) == most:
            yield group
            group, size = [], 0
    if group:
        yield group


def parts_of(data: bytes, edges: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The parts of texts that lie one after the other in UTF-8, and the place of each text's first part.

    ``edges`` are the places of the texts in the data. A part ends at each blank and where the tokenizer parts
    pieces in any case: between a letter and a mark or digit, say. Parts are without blanks, and lower-cased
    where that changes no id: texts with special tokens (which have marks and letters) or with marks that join
    the letter before them are parted at blanks and else left.
    """
    lowered = data.translate(LOWERED)
    kinds = np.frombuffer(lowered.translate(KINDS), dtype=np.uint8)
    begins = np.zeros(len(data), dtype=np.uint8)
    begins[1:] = BEGINS[8 * kinds[:-1] + kinds[1:]]
    at = np.flatnonzero(begins == 2)
    values = np.frombuffer(lowered, dtype=np.uint8)
    before = values[at - 2].astype(np.int64) << 8 | values[at - 1]
    begins[at] = (kinds[at - 2] == FIRST) & ~np.isin(before, NO_LETTERS)
    if any(some in data for some in (SPECIAL, *MARKS)):
        plain = bytearray(lowered)
        for low, high in zip(edges.tolist(), edges[1:].tolist()):
            if any(data.find(some, low, high) >= 0 for some in (SPECIAL, *MARKS)):
                plain[low:high] = data[low:high].translate(BLANKS)
                begins[low:high] = kinds[low:high] == BLANK
        lowered = bytes(plain)
    begins[edges[edges < len(data)]] = 1
    starts, solid = np.flatnonzero(begins), kinds != BLANK
    # Every blank is the first byte of its part.
    ends = np.cumsum(np.diff(starts, append=len(data)) - ~solid[starts])
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    letters = np.frombuffer(lowered, dtype=np.uint8)[solid]
    parts = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    return parts, np.searchsorted(starts, edges)


class WordEncoder:
    """Little-endian 16-bit ids of texts, as the tokenizers library gives them for the whole text.

    The tokenizer drops white space and merges only within pieces, so the ids of a text are those of its parts
    (``parts_of``), one after the other; each distinct part is encoded by the library once while it is kept.
    Words of Latin letters are lower-cased here, which is all that the normaliser does to them, and encoded many
    to a line, whose ids are parted by the tokens that end a word. Parts that are not used again are let go
    after two generations.
    """

    def __init__(self, path: str):
        # Tasks share the cores already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        for tokenizer in (self.whole, self.words):
            tokenizer.no_truncation(), tokenizer.no_padding()
        self.ends = np.zeros(1 << 16, dtype=bool)
        self.ends[[i for token, i in self.whole.get_vocab().items() if token.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of new distinct parts."""
        words = [p for p in parts if WORD.fullmatch(p)]
        other = [p for p in parts if not WORD.fullmatch(p)]
        new: dict[str, bytes] = {}
        for at in range(0, len(words), CALL_WORDS):
            some = words[at : at + CALL_WORDS]
            lines = [" ".join(some[i : i + LINE_WORDS]).lower() for i in range(0, len(some), LINE_WORDS)]
            encoded = self.words.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.array([i for e in encoded for i in e.ids], dtype="<u2")
            # Each word ends with the one token of it that ends a word.
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 2
            if len(ends) != len(some):
                raise ValueError("a word has no end of its own")
            data, edges = ids.tobytes(), [0, *ends.tolist()]
            new.update(zip(some, [data[low:high] for low, high in zip(edges, edges[1:])]))
        for at in range(0, len(other), CALL_WORDS):
            some = other[at : at + CALL_WORDS]
            encoded = self.whole.encode_batch_fast(some, add_special_tokens=False)
            new.update(zip(some, (np.array(e.ids, dtype="<u2").tobytes() for e in encoded)))
        return new

    def _ids(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts, kept or learnt."""
        ids = list(map(self.known.get, parts))
        missing = [k for k, i in enumerate(ids) if i is None]
        if missing:
            found = {parts[k]: i for k in missing if (i := self.former.get(parts[k])) is not None}
            new = [parts[k] for k in missing if parts[k] not in found]
            if new:
                found.update(self._learn(new))
            for k in missing:
                ids[k] = found[parts[k]]
            if len(self.known) + len(found) > KEPT_WORDS:
                self.former, self.known = self.known, {}
            self.known.update(found)
        return ids

    def _encode_group(self, data: bytes, edges: np.ndarray) -> Iterator[bytes]:
        """Texts that lie one after the other: each distinct part is looked up once, and its ids are copied to all its places."""
        parts, firsts = parts_of(data, edges)
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        copied = pa.array(self._ids(distinct), pa.binary()).take(coded.indices)
        ends = np.frombuffer(copied.buffers()[1], dtype=np.int32)[copied.offset + firsts].tolist()
        ids = memoryview(copied.buffers()[2] or b"")
        for start, end in zip(ends, ends[1:]):
            yield bytes(ids[start:end])

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        """The ids of each text in turn; none for null."""
        column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        column = column.fill_null("")
        _, places, values = column.buffers()
        places = np.frombuffer(places or b"", dtype=np.int32)[column.offset : column.offset + len(column) + 1]
        at = 0
        while at < len(column):
            last = max(at + 1, int(np.searchsorted(places, int(places[at]) + GROUP_BYTES, "right")) - 1)
            edges = places[at : last + 1]
            data = values.slice(int(edges[0]), int(edges[-1] - edges[0])).to_pybytes() if values else b""
            yield from self._encode_group(data, edges - edges[0])
            at = last


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a tokenizer file, one per worker process."""
    return WordEncoder(path)
