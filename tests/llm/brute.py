"""Plain versions of the queries over small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def base_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) in order."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found)


def listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def encoded(texts, name: str) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def bpe_row(ids: list[int]) -> tuple[int, str, str]:
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def gram_set(text: str | None, n: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def jaccard_components(documents: list[tuple[int, str | None]], n: int, percent: int) -> dict[int, tuple[int, int]]:
    """(set size, least id reachable) of each id, by comparing all pairs."""
    sets = {d: gram_set(t, n) for d, t in documents}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}
