"""Byte-level BPE: a segment tree over the ranks of adjacent pairs, for many words at once."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from lakestar.llm.common import release_memory
from lakestar.llm.tokenizer_words import groups_of_text

# Parts of text whose ids a task keeps (about 200 bytes each), twice: when so many are new or were used again
# since the last time, those that were not are let go.
KEPT_CHUNKS = 100_000
# Words are encoded together by the size of their trees, in blocks of about so many leaves.
BLOCK_LEAVES = 1 << 18
NONE = np.int64(1 << 62)

# The pattern that splits text before the merges, and the bytes that stand for themselves
# in the vocabulary file (the others follow from code point 256 on, in order).
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> list[str]:
    """The letter of each byte in the vocabulary file."""
    others = iter(range(256, 512))
    plain = set(PLAIN_BYTES)
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class PairTable:
    """Ranks and results of mergeable pairs, by open addressing in arrays."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], symbols: int):
        self.symbols = symbols
        self.mask = (1 << max(4, (4 * len(pairs)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, dtype=np.int64)
        self.ranks = np.full(self.mask + 1, NONE, dtype=np.int64)
        self.merged = np.zeros(self.mask + 1, dtype=np.int64)
        for (left, right), (rank, merged) in pairs.items():
            key = left * symbols + right
            at = self._home(key)
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.ranks[at], self.merged[at] = key, rank, merged

    def _home(self, key):
        return (key * 0x9E3779B1 >> 12) & self.mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; an empty slot (without a rank) for a pair that does not merge."""
        keys = left * self.symbols + right
        at = self._home(keys)
        wrong = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & self.mask
            seen = self.keys[at[wrong]]
            wrong = wrong[(seen != keys[wrong]) & (seen >= 0)]
        return at


def merge_words(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> np.ndarray:
    """Merge rows of symbols (filled with -1) in place of their first symbol; merged-away ones become -1.

    Each row has a segment tree with a leaf per adjacent pair that holds rank * width + place, so its root
    is the leftmost pair of lowest rank. A merge changes three leaves: the merged pair's own, and those of
    the pairs that begin before it and end after it. Every row takes one merge per step until its root is
    empty.
    """
    rows, width = symbols.shape
    size = 1 << max(1, (width - 1).bit_length())
    tree = np.full((rows, 2 * size), NONE, dtype=np.int64)
    following = np.tile(np.arange(1, width + 1), (rows, 1))
    before = np.tile(np.arange(-1, width - 1), (rows, 1))
    pair = np.arange(width - 1)[None, :] < (lengths - 1)[:, None]
    r, c = np.nonzero(pair)
    slots = table.find(symbols[r, c], symbols[r, c + 1])
    ranks = table.ranks[slots]
    tree[r, size + c] = np.where(ranks < NONE, ranks * size + c, NONE)
    level = size
    while level > 1:
        level >>= 1
        tree[:, level : 2 * level] = np.minimum(
            tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])

    # Flat views: a place of a row is at row * width + place, a node of its tree at row * 2 * size + node.
    nodes, ids, after, prior = tree.reshape(-1), symbols.reshape(-1), following.reshape(-1), before.reshape(-1)

    def pair_values(row, left):
        """The leaves of the pairs that begin at some places, each of which may be the last one of its row."""
        right = after[row * width + left]
        value = np.full(len(row), NONE, dtype=np.int64)
        inside = np.flatnonzero(right < lengths[row])
        at, left = row[inside] * width, left[inside]
        ranks = table.ranks[table.find(ids[at + left], ids[at + right[inside]])]
        value[inside] = np.where(ranks < NONE, ranks * size + left, NONE)
        return value

    row = np.flatnonzero(tree[:, 1] < NONE)
    while len(row):
        at, top = row * width, row * 2 * size
        place = nodes[top + 1] % size
        right = after[at + place]
        ids[at + place] = table.merged[table.find(ids[at + place], ids[at + right])]
        ids[at + right] = -1
        beyond = after[at + right]
        after[at + place] = beyond
        inner = np.flatnonzero(beyond < lengths[row])
        prior[at[inner] + beyond[inner]] = place[inner]
        left = prior[at + place]
        has = np.flatnonzero(left >= 0)
        nodes[top + size + right] = NONE
        nodes[top + size + place] = pair_values(row, place)
        nodes[top[has] + size + left[has]] = pair_values(row[has], left[has])
        # The three leaves' paths to the root, level by level.
        base = np.concatenate([top, top, top[has]])
        node = np.concatenate([right, place, left[has]]) + size
        for _ in range(size.bit_length() - 1):
            node >>= 1
            below = base + 2 * node
            nodes[base + node] = np.minimum(nodes[below], nodes[below + 1])
        row = row[nodes[top + 1] < NONE]
    return symbols


class ByteBPE:
    """Encoder and decoder of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary = model["model"]["vocab"]
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        size = max(vocabulary.values()) + 1
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max(size, *(i + 1 for i in self.specials.values())) if self.specials else size
        self.bytes_of = [b""] * size
        for token, i in vocabulary.items():
            if token not in self.specials:
                self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()
        self.sizes = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            pairs[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])
        self.table = PairTable(pairs, size)
        self.first = np.array([vocabulary[letter] for letter in byte_letters()], dtype=np.int64)
        self.split = regex.compile(SPLIT)
        marks = "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))
        self.special = regex.compile(f"({marks})") if marks else None
        self.forget()

    def forget(self) -> None:
        """Let the ids of parts go, which are parts of texts between blanks: those used of late, and those before."""
        self.known: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word (no merge crosses words)."""
        out: list[bytes] = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            width = max(2, len(words[order[at]]))
            cap = 1 << (width - 1).bit_length()  # words of up to this size share a block
            until = at
            while until < len(order) and len(words[order[until]]) <= cap and (until - at) * cap < BLOCK_LEAVES:
                until += 1
            picked = order[at:until]
            lengths = np.array([len(words[i]) for i in picked], dtype=np.int64)
            width = max(2, int(lengths.max()))
            symbols = np.full((len(picked), width), -1, dtype=np.int64)
            inside = np.arange(width)[None, :] < lengths[:, None]
            symbols[inside] = self.first[np.frombuffer(b"".join(words[i] for i in picked), dtype=np.uint8)]
            merged = merge_words(symbols, lengths, self.table)
            kept = merged >= 0
            flat, ends = merged[kept].astype("<u4").tobytes(), np.cumsum(kept.sum(axis=1)) * 4
            start = 0
            for i, end in zip(picked, ends.tolist()):
                out[i] = flat[start:end]
                start = end
            at = until
        return out

    def _encode_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of distinct texts without special tokens; distinct words of all of them are merged together."""
        split = {c: self.split.findall(c) for c in chunks}
        words = list({w for s in split.values() for w in s})
        ids = dict(zip(words, self.encode_words([w.encode("utf-8", "surrogatepass") for w in words])))
        return {c: b"".join([ids[w] for w in s]) for c, s in split.items()}

    def _learn(self, parts: list[str]) -> None:
        """Keep the ids of distinct parts that follow a blank; none for one that is empty
        or has white space at an end.

        The pattern always cuts before the blank of the others, so they are split as one text, and a word
        that begins with a blank begins a part. Parts of ASCII letters are one word each.
        """
        plain = [p for p in parts if p.isascii() and p.isalpha()]
        other = [p for p in parts if p and not (p.isascii() and p.isalpha()) and not (p[0].isspace() or p[-1].isspace())]
        split = self.split.findall("".join([f" {p}" for p in other]))
        words = list({*split, *(f" {p}" for p in plain)})
        ids = dict(zip(words, self.encode_words([w.encode("utf-8", "surrogatepass") for w in words])))
        self.known.update(dict.fromkeys(parts, b""))
        self.known.update(zip(plain, [ids[f" {p}"] for p in plain]))
        bounds = [*(i for i, w in enumerate(split) if w[0] == " "), len(split)]
        for part, start, end in zip(other, bounds[:-1], bounds[1:], strict=True):
            self.known[part] = ids[split[start]] if end - start == 1 else b"".join([ids[w] for w in split[start:end]])

    def _chunks(self, text: str) -> list[str]:
        """A text without special tokens, cut before single blanks, where the pattern always cuts.

        A blank that follows or precedes white space is no such place.
        """
        parts = text.split(" ")
        chunks, last = [[parts[0]]], parts[0]
        for part in parts[1:]:
            if not part or part[0].isspace() or not last or last[-1].isspace():
                chunks[-1].append(part)
            else:
                chunks.append(["", part])
            last = part
        return [" ".join(c) for c in chunks]

    def _encode_carefully(self, texts: list[str]) -> Iterator[bytes]:
        """Texts with special tokens, or with white space next to a blank."""
        # Every second piece is a special token.
        cut = [self.special.split(t) if self.special else [t] for t in texts]
        chunks = [[self._chunks(piece) for piece in pieces[::2]] for pieces in cut]
        ids = self._encode_chunks(list({c for text in chunks for piece in text for c in piece}))
        for pieces, text in zip(cut, chunks):
            coded = [b"".join(map(ids.__getitem__, piece)) for piece in text]
            marks = [np.array([self.specials[m]], "<u4").tobytes() for m in pieces[1::2]]
            yield b"".join(part for pair in zip(coded, [*marks, b""]) for part in pair)

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        """Texts cut at blanks: each distinct part is looked up once, and its ids are copied to all its places."""
        parts = pc.split_pattern(pa.array(texts, pa.string()), " ")
        coded, bounds = parts.values.dictionary_encode(), parts.offsets.to_numpy()
        distinct, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.known) > KEPT_CHUNKS:
            self.known, self.former = {}, self.known
        ids = list(map(self.known.get, distinct))
        unknown = [p for p, i in zip(distinct, ids) if i is None]
        self.known.update((p, i) for p in unknown if (i := self.former.get(p)) is not None)
        self._learn([p for p in unknown if p not in self.known])
        ids = list(map(self.known.__getitem__, distinct))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, starts = np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(sizes) - sizes
        # The first part of a text has no blank before it.
        at, firsts = bounds[:-1], [t.partition(" ")[0] for t in texts]
        begin = self._encode_chunks(list(set(firsts)))
        taken = sizes[index]
        taken[at] = 0
        ends = np.cumsum(taken)
        places = np.arange(ends[-1]) + np.repeat(starts[index] - (ends - taken), taken)
        out = flat[places]
        odd = (sizes == 0)[index]
        odd[at] = [p == "" or p[-1].isspace() for p in firsts]
        odd[at] &= np.diff(bounds) > 1
        careful = np.logical_or.reduceat(odd, at)
        if self.special:
            careful |= [self.special.search(t) is not None for t in texts]
        carefully = self._encode_carefully([t for t, c in zip(texts, careful) if c])
        for i, first in enumerate(firsts):
            if careful[i]:
                yield next(carefully)
            else:
                yield begin[first] + out[ends[bounds[i]] : ends[bounds[i + 1] - 1]].tobytes()

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text in turn; none for null. Texts are taken a group at a time."""
        for group in groups_of_text(texts):
            yield from self._encode_group(group)

    def decode(self, ids: bytes) -> str:
        """The text of little-endian 32-bit ids, special tokens included; bad bytes become U+FFFD."""
        numbers, parts = np.frombuffer(ids, dtype="<u4"), []
        for at in range(0, len(numbers), BLOCK_LEAVES):
            block = numbers[at : at + BLOCK_LEAVES]
            sizes = self.sizes[block]
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(self.starts[block] - (ends - sizes), sizes)
            parts.append(self.letters[places].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def byte_bpe(path: str) -> ByteBPE:
    """The coder of a vocabulary file, one per worker process."""
    return ByteBPE(path)


def bpe_digests(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Ids are those of the whole text, whatever its length; they are decoded again for the last column.
    Null and empty texts have no ids and decode to the empty text. Other columns are ignored.
    """

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(tokenizer_path)
        for batch in batches:
            sizes, digests, decoded = [], [], []
            for ids in coder.encode(text.as_py() for text in batch["text"]):
                sizes.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        # The worker lives on, perhaps for other work.
        coder.forget()
        release_memory()

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        code, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
