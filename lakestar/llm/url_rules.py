"""URL filter: all wildcard rules at once, as bits of one Shift-And automaton."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the query, as (host and path, verdict).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
# Rules of the method for urls that no rule fits, as globs over ".host/path": * stays inside the host or
# one path segment, ** crosses them, ? is one character.
GLOBS = (
    ("**.html", "block"),
    ("*.example.net/de/**", "block"),
    ("*.blog.**", "block"),
)
SLICE = 4096


def rule_glob(rule: str) -> str:
    """The glob of a host-and-path rule: the host, each subdomain, and paths with the rule's prefix.

    Wildcard characters in a rule are ordinary ones.
    """
    plain = "".join(f"\\{c}" if c in "*?\\" else c for c in rule)
    return f"*.{plain}**"


def _parsed(glob: str) -> list[tuple[str | None, str]]:
    """The glob as steps: (character to read or None for any, loop before it: '', 'segment' or 'all').

    A trailing loop is a last step whose character is the end mark.
    """
    steps, loop, i = [], "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            loop, i = "all", i + 2
        elif glob[i] == "*":
            loop, i = loop or "segment", i + 1
        else:
            any_one = glob[i] == "?"
            i += glob[i] == "\\" and i + 1 < len(glob)
            steps.append((None if any_one else glob[i], loop))
            loop, i = "", i + 1
    return [*steps, ("\0", loop)]  # the end mark: canonical urls hold no NUL


@dataclass(frozen=True)
class Automaton:
    """Masks of all globs, one bit per step, packed into 64-bit words."""

    words: int
    start: np.ndarray  # bits before which nothing has been read
    final: np.ndarray  # bit of each glob's end mark, as (word, bit)
    codes: np.ndarray  # characters that have masks of their own, sorted
    read: np.ndarray  # [class, word]: bits whose step reads the character
    stay: np.ndarray  # [class, word]: bits before whose step the character may be skipped


def compile_globs(globs: Sequence[str]) -> Automaton:
    """One automaton for all globs; class 0 stands for characters that no glob names."""
    steps = [(c, loop, last) for glob in globs for parsed in [_parsed(glob)]
             for (c, loop), last in zip(parsed, [False] * (len(parsed) - 1) + [True])]
    named = sorted({ord(c) for c, _, _ in steps if c is not None} | {ord("/"), 0})
    words = -(-max(1, len(steps)) // 64)
    read = np.zeros((len(named) + 1, words), dtype=np.uint64)
    stay, start, final = np.zeros_like(read), np.zeros(words, dtype=np.uint64), []
    first = True
    for i, (c, loop, last) in enumerate(steps):
        word, bit = i // 64, np.uint64(1 << (i % 64))
        if first:
            start[word] |= bit
        first = last
        for k, code in enumerate([None, *named]):
            if c == (None if code is None else chr(code)) and c is not None or c is None and code != 0:
                read[k, word] |= bit
            if code != 0 and (loop == "all" or loop == "segment" and code != ord("/")):
                stay[k, word] |= bit
        if last:
            final.append((word, i % 64))
    return Automaton(words, start, np.array(final, dtype=np.int64).reshape(-1, 2), np.array(named), read, stay)


def matches(automaton: Automaton, urls: Sequence[str]) -> np.ndarray:
    """[url, glob]: whether the whole url fits. All urls of a slice advance one character at a time.

    Bit i of the state says that step i is the next to be taken. Reading a character moves the bits whose
    step reads it one place up and keeps the bits whose loop takes it.
    """
    out = np.zeros((len(urls), len(automaton.final)), dtype=bool)
    order = np.argsort([len(u) for u in urls], kind="stable")
    for at in range(0, len(urls), SLICE):
        picked = order[at : at + SLICE]
        texts = [urls[i].replace("\0", "�") + "\0" for i in picked]
        lengths = np.array([len(t) for t in texts])
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        place = np.searchsorted(automaton.codes, flat)
        known = automaton.codes[np.minimum(place, len(automaton.codes) - 1)] == flat
        classes = np.where(known, place + 1, 0)
        begins = np.cumsum(lengths) - lengths
        state = np.repeat(automaton.start[None, :], len(picked), axis=0)
        done = np.zeros_like(state)
        live = 0
        for step in range(lengths[-1] if len(lengths) else 0):
            live = np.searchsorted(lengths, step, side="right")  # shorter urls have ended
            kind = classes[begins[live:] + step]
            now = state[live:]
            moved = now & automaton.read[kind]
            ended = lengths[live:] == step + 1
            done[live:][ended] = moved[ended]
            up = moved << np.uint64(1)
            up[:, 1:] |= moved[:, :-1] >> np.uint64(63)
            # A bit that leaves a glob's end mark would enter the next glob: starts are never entered.
            state[live:] = (up & ~automaton.start) | (now & automaton.stay[kind])
        for g, (word, bit) in enumerate(automaton.final):
            out[picked, g] = (done[:, word] >> np.uint64(bit)) & np.uint64(1) == 1
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` in lower case, and the path; both empty without one."""
    after = F.instr(url, "://")
    rest = F.when(after > 0, F.substring(url, after + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    globs: Sequence[tuple[str, str]] = GLOBS,
    default: str = "allow",
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    The canonical url is a dot, the lower-cased host and the path. The longest rule that fits decides (at
    equal length block before allow); without one the globs of the method do, block before allow, and
    without any of them ``default``. A null url and one without ``://`` have an empty host and path, fit no
    rule and get the method's verdict on ``.``. Rules travel in the task's code, as they are an argument;
    their work is one pass over each url whatever their number. Other columns are ignored.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[0]), r[1] != "block", r[0]))
    ordered = sorted(globs, key=lambda g: g[1] != "block")
    automaton = compile_globs([*(rule_glob(r) for r, _ in ranked), *(g for g, _ in ordered)])
    names = np.array([*(r for r, _ in ranked), *[None] * len(ordered), None], dtype=object)
    verdicts = np.array([*(v for _, v in ranked), *(v for _, v in ordered), default], dtype=object)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch["host"].to_pylist(), batch["path"].to_pylist()
            fits = matches(automaton, [f".{h}{p}" for h, p in zip(hosts, paths)])
            fits = np.concatenate([fits, np.ones((len(hosts), 1), dtype=bool)], axis=1)
            first = fits.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["host"], batch["path"],
                 pa.array(names[first], pa.string()), pa.array(verdicts[first], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return split.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
