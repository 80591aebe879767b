"""Word-piece counts by a linear longest-match automaton."""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from lakestar.llm.bpe import byte_letters
from lakestar.llm.tokenizer_words import groups_of_text

WORD = re.compile(r"\w+|[^\w\s]+")
# Words whose counts a task keeps; when they are more, it starts anew.
KEPT_WORDS = 500_000


class LongestMatch:
    """A vocabulary trie with failure links and the number of pieces that following each link pops.

    ``initial`` pieces begin a word, ``inner`` pieces continue it. Reading a character either goes down
    the trie or follows links, each of which ends pieces for good, so a word takes time linear in its
    length and no piece is ever built.
    """

    ROOT, INNER = 0, 1

    def __init__(self, initial: Iterable[str], inner: Iterable[str]):
        down: dict[tuple[int, str], int] = {}
        whole = [False, False]
        for root, pieces in ((self.ROOT, initial), (self.INNER, inner)):
            for piece in pieces:
                node = root
                for c in piece:
                    at = down.get((node, c))
                    if at is None:
                        at = down[node, c] = len(whole)
                        whole.append(False)
                    node = at
                if piece:
                    whole[node] = True
        children: dict[int, list[tuple[str, int]]] = {}
        for (node, c), child in down.items():
            children.setdefault(node, []).append((c, child))
        fail = [-1] * len(whole)
        pops = [0] * len(whole)
        queue = deque([self.ROOT, self.INNER])
        while queue:
            node = queue.popleft()
            for c, child in children.get(node, ()):
                queue.append(child)
                if whole[child]:
                    fail[child], pops[child] = self.INNER, 1
                    continue
                link, popped = fail[node], pops[node]
                while link >= 0 and (link, c) not in down:
                    popped += pops[link]
                    link = fail[link]
                if link >= 0:
                    fail[child], pops[child] = down[link, c], popped
        self.down, self.fail, self.pops = down, fail, pops

    def count(self, word: str) -> int:
        """Pieces of the greedy longest match from the left; -1 when the word has no such cover."""
        node, pieces, get = self.ROOT, 0, self.down.get
        for c in word:
            child = get((node, c))
            while child is None:
                link = self.fail[node]
                if link < 0:
                    return -1
                pieces += self.pops[node]
                node = link
                child = get((node, c))
            node = child
        while node != self.INNER:
            if self.fail[node] < 0:
                return -1 if word else 0
            pieces += self.pops[node]
            node = self.fail[node]
        return pieces


def pieces_of(path: str) -> tuple[list[str], list[str]]:
    """Initial and inner pieces from a byte-level vocabulary file: tokens with a blank before begin a word.

    Tokens that are not whole UTF-8 characters, or hold white space, are no pieces.
    """
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    initial, inner = [], []
    for token in vocabulary:
        try:
            text = bytes(byte_of[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        piece = text.removeprefix(" ")
        if piece and not any(c.isspace() for c in piece):
            (initial if text != piece else inner).append(piece)
    return initial, inner


class PieceCounter:
    """Counts of whole texts, from those of their parts between white space."""

    def __init__(self, automaton: LongestMatch):
        self.automaton = automaton
        self.known: dict[str, tuple[int, int, int]] = {}

    def _part(self, part: str) -> tuple[int, int, int]:
        counts = [self.automaton.count(w) for w in WORD.findall(part)]
        unknown = counts.count(-1)
        return len(counts), sum(counts) + 2 * unknown, unknown  # an unknown word is one token

    def counts(self, texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
        """(words, tokens, unknown words) of each text."""
        for group in groups_of_text(texts):
            split = [t.split() for t in group]
            parts = {p for s in split for p in s}
            new = parts.difference(self.known)
            if len(self.known) + len(new) > KEPT_WORDS:
                new, self.known = parts, {}
            self.known.update((p, self._part(p)) for p in new)
            for s in split:
                found = [self.known[p] for p in s]
                yield tuple(map(sum, zip(*found))) if found else (0, 0, 0)


@lru_cache(maxsize=1)
def piece_counter(path: str) -> PieceCounter:
    """The counter of a vocabulary file, one per worker process."""
    return PieceCounter(LongestMatch(*pieces_of(path)))


def token_counts(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_tokens, n_unknown``.

    Words are runs of word characters and runs of other visible characters; a word without a cover by
    pieces is one unknown token. Null and empty texts count 0. Other columns are ignored.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(vocabulary_path)
        for batch in batches:
            columns = zip(*counter.counts(batch["text"].to_pylist())) if batch.num_rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
