"""Language identification with hyperdimensional n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.tokenizer_words import groups_of_text

DIMENSION = 1024
# Labelled documents per language that the profiles are learnt from, chosen by a hash of id and text.
SAMPLE_PER_LANGUAGE = 4_000
# Characters and number of documents that are profiled together, and n-grams bound at a time.
GROUP_CHARS = 1_000_000
GROUP_TEXTS = 256
GRAM_BLOCK = 4096
UNDETERMINED = "und"
# Profiles are summed as whole numbers in this unit, so that sums do not depend on their order.
UNIT = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 where it is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def letter_vectors(letters: np.ndarray, dimension: int) -> np.ndarray:
    """A random vector of +1 and -1 for each letter, from the letter alone; 0 stands for a gap."""
    return np.stack([
        np.random.default_rng(0xB17 + int(c)).integers(0, 2, dimension, dtype=np.int8) * 2 - 1 for c in letters])


class Profiler:
    """Bundles of the letter trigrams of documents.

    A trigram vector binds (multiplies) its letters' vectors, each permuted (rotated) by its place; a
    document's bundle is the sum of its trigrams' vectors. Runs of other characters are one gap.
    """

    def __init__(self, dimension: int):
        self.dimension = dimension
        self.place = np.zeros(0x110000, dtype=np.int32)  # letter: row of its vectors
        self.rows = 0
        self.rotated = [np.zeros((0, dimension), dtype=np.int8) for _ in range(3)]
        self._add(np.array([0], dtype=np.uint32))

    def _add(self, letters: np.ndarray) -> None:
        fresh = letter_vectors(letters, self.dimension)
        self.rotated = [np.concatenate([r, np.roll(fresh, 2 - i, axis=1)]) for i, r in enumerate(self.rotated)]
        self.place[letters] = np.arange(self.rows, self.rows + len(letters))
        self.rows += len(letters)

    def bundles(self, texts: list[str]) -> np.ndarray:
        """One row per text; zeros for a text without letters."""
        out = np.zeros((len(texts), self.dimension), dtype=np.float32)
        sizes = np.array([len(t) + 2 for t in texts], dtype=np.int64)
        joined = "".join(f" {t} " for t in texts)
        letters = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        text_of = np.repeat(np.arange(len(texts)), sizes)
        keep = letters > 0
        keep[1:] |= letters[:-1] > 0  # one gap after each run of letters, and one before each text
        keep[np.cumsum(sizes) - sizes] = True
        letters, text_of = letters[keep], text_of[keep]
        if len(letters) < 3:
            return out
        seen = np.unique(letters)
        new = seen[(self.place[seen] == 0) & (seen > 0)]
        if len(new):
            self._add(new)
        place = self.place[letters].astype(np.int64)
        grams = (place[:-2] * self.rows + place[1:-1]) * self.rows + place[2:]
        inside = (text_of[:-2] == text_of[2:]) & (letters[1:-1] > 0)
        grams, owner = grams[inside], text_of[:-2][inside]
        kinds, gram = np.unique(grams, return_inverse=True)
        for at in range(0, len(kinds), GRAM_BLOCK):
            block = kinds[at : at + GRAM_BLOCK]
            first, rest = np.divmod(block, self.rows * self.rows)
            second, third = np.divmod(rest, self.rows)
            bound = self.rotated[0][first] * self.rotated[1][second] * self.rotated[2][third]
            here = (gram >= at) & (gram < at + len(block))
            counts = np.bincount(
                owner[here] * len(block) + gram[here] - at, minlength=len(texts) * len(block))
            out += counts.reshape(len(texts), -1).astype(np.float32) @ bound.astype(np.float32)
        return out

    def directions(self, texts: list[str | None]) -> np.ndarray:
        """Bundles of unit length; zeros for texts without letters."""
        parts = [np.zeros((0, self.dimension), dtype=np.float32)]
        parts += [self.bundles(g) for g in groups_of_text(texts, GROUP_CHARS, GROUP_TEXTS)]
        rows = np.concatenate(parts)
        size = np.linalg.norm(rows, axis=1, keepdims=True)
        return np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)


@lru_cache(maxsize=1)
def profiler(dimension: int) -> Profiler:
    """One per worker process; its letters grow with those that it meets."""
    return Profiler(dimension)


def learn_prototypes(
    documents: DataFrame, learn: Column, *, dimension: int = DIMENSION, sample: int = SAMPLE_PER_LANGUAGE
) -> tuple[list[str], np.ndarray]:
    """(languages in order, one unit vector each): the bundle of each language's document directions.

    Learns from rows that ``learn`` marks and that have a language and text: all rows of a language with up to
    ``sample`` rows, else about so many, by hash. What reaches the driver is one sum per language.
    """
    rows = documents.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], np.zeros((0, dimension))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, sample / n))])
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.filter(chance < share[F.col("lang")]).select("lang", "text")

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            units = np.rint(profiler(dimension).directions(batch["text"].to_pylist()) * UNIT).astype(np.int64)
            langs = np.array(batch["lang"].to_pylist(), dtype=object)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + units[langs == lang].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                names=["lang", "sums"])

    partial = chosen.mapInArrow(add_up, "lang string, sums array<bigint>")
    sums = partial.select("lang", F.posexplode("sums").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
    found: dict[str, np.ndarray] = {}
    for row in sums.collect():  # languages times the dimension
        found.setdefault(row["lang"], np.zeros(dimension))[row["i"]] = row["v"]
    langs = sorted(found)
    prototypes = np.stack([found[lang] for lang in langs])
    size = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return langs, prototypes / np.where(size > 0, size, 1)


def identify_languages(documents: DataFrame, held_out: Column, **options) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Prototypes are learnt from documents that are not held out; only the text decides a prediction, by the
    largest cosine (of equal ones the language that sorts first). The score maps that cosine from [-1, 1]
    to [0, 1]. Null texts, texts without a letter, and all texts when nothing was learnt are ``und`` with
    score 0. Other columns are ignored.
    """
    dimension = options.get("dimension", DIMENSION)
    langs, prototypes = learn_prototypes(documents, ~held_out, **options)
    towards = prototypes.T.astype(np.float32)
    names = np.array([*langs, UNDETERMINED], dtype=object)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            directions = profiler(dimension).directions(batch["text"].to_pylist())
            best, score = np.full(batch.num_rows, len(langs)), np.zeros(batch.num_rows)
            some = directions.any(axis=1)
            if langs and some.any():
                cosines = directions[some] @ towards
                best[some] = cosines.argmax(axis=1)
                score[some] = np.clip((1 + cosines.max(axis=1).astype(float)) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(names[best], pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
