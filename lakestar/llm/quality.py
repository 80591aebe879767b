"""Quality classifier: random-indexing word vectors pooled per document, then a small network."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import BROADCAST_ROWS, free_name, release_memory, stored
from lakestar.llm.tokenizer_words import groups_of_text
from lakestar.operators.joins import count_rows

# Bounds of the fitted model: labelled documents that it is fitted to, and words with learnt vectors.
SAMPLE = 8_000
VOCABULARY = 4_000
DIMENSION = 64
NONZERO = 4  # entries of +1 or -1 in an index vector
WINDOW = 2  # neighbours on each side that make up a word's context
HIDDEN = 32
GROUP_CHARS = 500_000  # characters of texts that are pooled at a time
KEPT_TOKENS = 125_000  # about 200 bytes each
PARTS = re.compile(r"(\W*)(.*?)(\W*)", re.DOTALL)
# Hashes of the forms of tokens that are letters only.
WORD_FORMS = {case: xxhash.xxh3_64_intdigest(f"\0\0{case}\0") for case in ("A", "Aa", "a")}


def _entries(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vectors of hashed words: [word, NONZERO] each."""
    places, signs, rest = [], [], hashes.copy()
    for _ in range(NONZERO):
        places.append((rest % np.uint64(DIMENSION)).astype(np.int64))
        rest //= np.uint64(DIMENSION)
        signs.append((rest % np.uint64(2)).astype(np.int64) * 2 - 1)
        rest //= np.uint64(2)
    return np.stack(places, axis=1), np.stack(signs, axis=1)


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """The sparse random vector of each word, from the word alone."""
    places, signs = _entries(hashes)
    out = np.zeros((len(hashes), DIMENSION), dtype=np.float32)
    rows = np.arange(len(hashes))
    for k in range(NONZERO):
        out[rows, places[:, k]] += signs[:, k]
    return out


class Tokens:
    """Tokens of texts as numbers: for each distinct token the hashes of its word and of its form.

    The word is the token in lower case without its outer marks; the form is its case, its outer marks and
    whether it has digits, which counts as a second word.
    """

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.words, self.forms = array("Q"), array("Q")

    @staticmethod
    def _hashes(token: str) -> tuple[int, int]:
        if token.isalpha():  # no marks, no digits
            case = "A" if len(token) > 1 and token.isupper() else "Aa" if token[0].isupper() else "a"
            form = WORD_FORMS[case]
            return xxhash.xxh3_64_intdigest(token.lower()), form
        before, core, after = PARTS.fullmatch(token).groups()
        case = "A" if core.isupper() and len(core) > 1 else "Aa" if core[:1].isupper() else "a" if core else ""
        form = f"\0{before[:3]}\0{case}{'9' if any(c.isdigit() for c in core) else ''}\0{after[:3]}"
        return xxhash.xxh3_64_intdigest(core.lower()), xxhash.xxh3_64_intdigest(form)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token numbers of all texts, number of tokens of each)."""
        if len(self.number) > KEPT_TOKENS:
            self.clear()
        split = [t.split() for t in texts]
        sizes = np.array([len(s) for s in split], dtype=np.int64)
        for token in set(chain.from_iterable(split)).difference(self.number):
            word, form = self._hashes(token)
            self.number[token] = len(self.words)
            self.words.append(word)
            self.forms.append(form)
        numbers = map(self.number.__getitem__, chain.from_iterable(split))
        return np.fromiter(numbers, dtype=np.int64, count=int(sizes.sum())), sizes

    def hashes(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word and form hashes of the distinct numbers, and the place of each number among them."""
        distinct, place = np.unique(numbers, return_inverse=True)
        words, forms = (np.frombuffer(kept, dtype=np.uint64)[distinct] if len(distinct) else np.zeros(0, np.uint64)
                        for kept in (self.words, self.forms))
        return words, forms, place


@dataclass
class WordVectors:
    """Learnt vectors of the most frequent words of the sample; other words have their index vectors."""

    hashes: np.ndarray  # sorted
    vectors: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = index_vectors(hashes)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            out[known] = self.vectors[at[known]]
        return out


REPEAT = np.array([xxhash.xxh3_64_intdigest("\0repeat")], dtype=np.uint64)


def pooled(texts: list[str | None], vectors: WordVectors, tokens: Tokens) -> np.ndarray:
    """One row per text: mean word vector, mean form vector, and their lengths; zeros without tokens.

    A token that repeats the one before it adds the vector of a word of its own.
    """
    rows = [np.zeros((0, 2 * DIMENSION + 3), dtype=np.float32)]
    for group in groups_of_text(texts, GROUP_CHARS, 1_000):
        numbers, sizes = tokens.read(group)
        words, forms, place = tokens.hashes(numbers)
        table = np.concatenate([vectors.of(words), index_vectors(forms)], axis=1)
        owner = np.repeat(np.arange(len(group)), sizes)
        again = np.zeros(len(numbers), dtype=bool)
        again[1:] = (numbers[1:] == numbers[:-1]) & (owner[1:] == owner[:-1])
        # Counts of distinct tokens per text keep the sums small.
        pairs, counts = np.unique(owner * max(1, len(words)) + place, return_counts=True)
        which, token = np.divmod(pairs, max(1, len(words)))
        sums = np.zeros((len(group), 2 * DIMENSION), dtype=np.float32)
        edges = [*np.flatnonzero(np.diff(which, prepend=-1)).tolist(), len(which)]
        for start, end in zip(edges, edges[1:]):  # one text at a time, so that its columns are added in cache
            weights = counts[start:end, None].astype(np.float32)
            columns = np.ascontiguousarray((table[token[start:end]] * weights).T)
            sums[which[start]] = np.add.reduce(columns, axis=1)
        repeats = np.bincount(owner[again], minlength=len(group)).astype(np.float32)
        sums[:, DIMENSION:] += repeats[:, None] * index_vectors(REPEAT)
        distinct = np.bincount(which, minlength=len(group)).astype(np.float32)
        n = np.maximum(sizes, 1).astype(np.float32)[:, None]
        mean = sums / n
        lengths = np.stack([
            np.linalg.norm(mean[:, :DIMENSION], axis=1), np.linalg.norm(mean[:, DIMENSION:], axis=1),
            distinct / n[:, 0]], axis=1)
        rows.append(np.concatenate([mean, lengths], axis=1))
    return np.concatenate(rows)


@dataclass
class Network:
    """Two layers over standardised inputs, and the temperature of the logit."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.mean) / self.scale) @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def _loss(logits: np.ndarray, y: np.ndarray, temperature: float) -> float:
    z = logits / temperature
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit_network(x: np.ndarray, y: np.ndarray, *, epochs: int = 60, batch: int = 128, seed: int = 7) -> Network:
    """Fit by Adam on four fifths of the rows; the temperature minimises the loss on the others."""
    rng = np.random.default_rng(seed)
    x = x.astype(np.float64)
    order = rng.permutation(len(x))
    train, check = order[: -(-len(x) * 4 // 5)], order[-(-len(x) * 4 // 5):]
    scale = x.std(axis=0)
    net = Network(x.mean(axis=0), np.where(scale > 1e-6, scale, 1.0),
                  rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), 0.0)
    inputs = (x - net.mean) / net.scale
    weights = [net.first, net.first_bias, net.second, np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), batch):
            some = train[at : at + batch]
            a = inputs[some]
            pre = a @ weights[0] + weights[1]
            hidden = np.maximum(pre, 0)
            z = hidden @ weights[2] + weights[3][0]
            error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[some]) / len(some)
            back = np.outer(error, weights[2]) * (pre > 0)
            slopes = [a.T @ back + 1e-4 * weights[0], back.sum(axis=0), hidden.T @ error + 1e-4 * weights[2],
                      np.array([error.sum()])]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.second_bias = float(weights[3][0])
    logits = net.logits(x[check]) if len(check) else np.zeros(0)
    if len(check):
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 121))
        net.temperature = float(min(grid, key=lambda t: _loss(logits, y[check], t)))
    return net


@dataclass
class Model:
    """What scoring needs; ``network`` is None when there was one class or none, then ``prior`` is the score."""

    vectors: WordVectors
    network: Network | None
    prior: float

    def scores(self, texts: list[str | None], tokens: Tokens) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.prior)
        return self.network.probabilities(pooled(texts, self.vectors, tokens).astype(np.float64))


def _word_vectors(sample: DataFrame) -> WordVectors:
    """Random indexing over the sample: a word's vector is the sum of its neighbours' index vectors."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            for group in groups_of_text(batch["text"].to_pylist(), GROUP_CHARS):
                words, _, place = tokens.hashes(tokens.read(group)[0])
                distinct, at = np.unique(words, return_inverse=True)
                n = np.bincount(at[place], minlength=len(distinct))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])
            release_memory()

    counts = sample.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    chosen = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()]
    hashes = np.sort(np.array(chosen, dtype=np.int64).view(np.uint64))

    def context(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, sums = Tokens(), np.zeros((len(hashes), DIMENSION), dtype=np.int64)
        for batch in batches:
            for group in groups_of_text(batch["text"].to_pylist(), GROUP_CHARS):
                numbers, sizes = tokens.read(group)
                words, _, place = tokens.hashes(numbers)
                if not len(words):
                    continue
                index = index_vectors(words)
                at = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
                row = np.where(hashes[at] == words, at, -1)[place]
                owner = np.repeat(np.arange(len(group)), sizes)
                for shift in range(1, WINDOW + 1):
                    same = owner[shift:] == owner[:-shift]
                    for mine, other in ((slice(shift, None), slice(None, -shift)), (slice(None, -shift), slice(shift, None))):
                        use = same & (row[mine] >= 0)
                        # Pairs of a word and a neighbour are counted first: they recur.
                        pair, n = np.unique(row[mine][use] * len(words) + place[other][use], return_counts=True)
                        word, neighbour = np.divmod(pair, len(words))
                        starts = np.flatnonzero(np.diff(word, prepend=-1))
                        if len(starts):
                            sums[word[starts]] += np.add.reduceat(
                                index[neighbour] * n[:, None], starts, axis=0).astype(np.int64)
            release_memory()
        some = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["row", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "sums": [np.sum(np.stack(pdf["sums"]), axis=0)]})

    vectors = index_vectors(hashes)
    if len(hashes):
        summed = sample.mapInArrow(context, "row long, sums array<bigint>").groupBy("row").applyInPandas(
            add, "row long, sums array<bigint>")
        for r in summed.collect():  # at most one row per word of the vocabulary
            sums = np.array(r["sums"], dtype=np.float64)
            vectors[r["row"]] += sums / max(np.linalg.norm(sums), 1.0) * NONZERO**0.5
    return WordVectors(hashes, vectors)


def fit_quality(documents: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """Fit the model to labelled documents that ``learn`` marks: all, or about ``sample`` by hash of the id.

    Several labels of one id count by their mean; null labels and ids are left out, null texts are empty.
    """
    marked = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("__quality"))
    marked = stored(marked.filter(learn & F.col("doc_id").isNotNull()), "quality-labels")
    n = count_rows(marked)
    if n > sample:
        chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        marked = marked.filter(chance < sample / n)
    if min(n, sample) <= BROADCAST_ROWS:
        marked = F.broadcast(marked)
    chosen = documents.select("doc_id", "text").join(marked, "doc_id").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.col("__quality") >= 0.5).cast("int").alias("label"))
    chosen = stored(chosen.repartition(8, F.xxhash64("doc_id", "text")), "quality-sample")
    vectors = _word_vectors(chosen)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            rows = pooled(batch["text"].to_pylist(), vectors, tokens)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.string()), batch["label"], pa.array(list(rows), pa.list_(pa.float32()))],
                names=["doc_id", "label", "x"])

    found = chosen.mapInArrow(features, "doc_id string, label int, x array<float>").orderBy("doc_id", "label", "x").collect()
    if not found:
        return Model(vectors, None, 1.0)
    y = np.array([r["label"] for r in found], dtype=np.float64)
    if y.min() == y.max() or len(y) < 10:
        return Model(vectors, None, float(y.mean()))
    return Model(vectors, fit_network(np.array([r["x"] for r in found]), y), float(y.mean()))


def _scorer(documents: DataFrame, labels: DataFrame, held_out: Column):
    """A function of a text column that scores it by a model fitted to the documents not held out."""
    model = fit_quality(documents, labels, ~held_out)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by VOCABULARY, DIMENSION and HIDDEN

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = Tokens()
        for series in texts:
            yield pd.Series(shared.value.scores(list(series), tokens))
            release_memory()

    return score


def score_quality(documents: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """The documents' columns, and ``__held_out`` and ``__score``, the probability of label 1 by the text alone.

    The model is fitted to documents that are not held out, see `fit_quality`. Null and empty texts are
    scored as texts without words; without usable labels every score is 1, with one class or with fewer than
    ten labelled documents its share of label 1. Texts of any length are scored whole, repeated rows alike, and an
    empty table gives no rows. Columns of the two names in the input are replaced, all others are kept.
    """
    return documents.withColumns({"__held_out": held_out, "__score": _scorer(documents, labels, held_out)("text")})


def keep_good(documents: DataFrame, labels: DataFrame, held_out: Column, least: float = 0.5) -> DataFrame:
    """The documents with a score of at least ``least``, with all their columns, whatever their names.

    Scores are those of `score_quality`; so repeated rows stay or go together, null and empty texts are judged
    like texts without words, and an empty table gives no rows.
    """
    name = free_name(documents, "__score")
    scored = documents.withColumn(name, _scorer(documents, labels, held_out)("text"))
    return scored.filter(F.col(name) >= least).select(*documents.columns)
