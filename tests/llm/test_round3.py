"""Centroid clustering, importance resampling and substring dedup: brute force, parts and edges."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from lakestar.llm import resample as resampling
from lakestar.llm import substring_dedup as substrings
from lakestar.llm.centroids import cluster, packed, partial_distances, unpacked
from lakestar.llm.queries import QUERIES
from lakestar.llm.resample import feature_buckets, joined_crc, ranked, resample, splitters
from lakestar.llm.substring_dedup import merged_spans, repeated_words
from tests.llm.test_edges import SCHEMA, TEXTS, frame
from tests.llm.test_queries import SF, table

ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- resampling -------------------------------------------------------------------------------


def brute_resample(documents, target):
    """Rows as (doc_id, n_features, weight, score, rank)."""
    def features(text):
        words = ALPHANUMERIC.findall(lowered(text))
        runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]

    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    found = [(d, *features(x)) for d, x in documents]
    for _, _, f in found:
        np.add.at(s, f, 1)
    for x in target:
        np.add.at(t, features(x)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10_000) / ((a + 1) * (t.sum() + 10_000)))) for a, b in zip(s.tolist(), t.tolist())]
    rows = []
    for d, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    rank = {id(r): i for i, r in enumerate(able[: 5 * len(able) // 100], 1)}
    return [(r[0], r[2], r[3], r[4], rank.get(id(r))) for r in rows]


def by_text(rows):
    return sorted(map(repr, map(tuple, rows)))


def test_resampling_equals_brute_force(spark):
    expected = brute_resample(table(SF, "documents", "doc_id", "text"), [t for t, in table(SF, "benchmark", "text")])
    rows = QUERIES["op12_importance_resampling"](spark, SF)
    assert rows.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert by_text(rows.collect()) == by_text(expected) and any(r[4] for r in expected)


def test_checksums_are_joined():
    rng = random.Random(1)
    for length in (0, 1, 5, 63, 64, 65, 1000, 70_000):
        a, b = rng.randbytes(rng.randrange(30)), rng.randbytes(length)
        found = joined_crc(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([length]))
        assert found[0] == zlib.crc32(a + b)


def test_features_of_long_words():
    text = "x" * 5000 + " Ab é-9 " + "y" * 64
    words = ["x" * 5000, "ab", "é", "9", "y" * 64]
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(6 - n)]
    bucket, place, sizes = feature_buckets(["", text, "one"], 997, 3)
    assert sizes.tolist() == [0, 5, 1]
    assert sorted(bucket[place == 1].tolist()) == sorted(zlib.crc32(r.encode()) % 997 for r in runs)


def test_regular_sampling_ranks_ties_and_hot_scores(spark):
    rng = random.Random(2)
    rows = [(i % 50 if i % 3 else None, 20, 0, 0, 5 if i % 3 else rng.randrange(9), i % 7, i // 7) for i in range(700)]
    runs = {}
    for r in rows:
        runs.setdefault(r[5], []).append(r)
    ordered = []
    for number, own in runs.items():
        own.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0))
        ordered += [(*r[:5], number, i) for i, r in enumerate(own)]
    names = "doc_id long, n_words long, n_features long, weight long, score long, run long, place long"
    found = ranked(spark.createDataFrame(ordered, names)).collect()
    expected = sorted(ordered, key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[5], r[6]))
    assert [tuple(r)[:0] or (r["run"], r["place"]) for r in sorted(found, key=lambda r: r["rank"])] == [r[5:] for r in expected]
    sizes = {}
    for r in found:
        sizes[r["segment"]] = sizes.get(r["segment"], 0) + 1
    assert len(sizes) == 7 and max(sizes.values()) <= 2 * 700 / 7


def test_splitters_weigh_samples():
    samples = [((i,), 1) for i in range(10)] + [((100,), 90)]
    assert splitters(samples, 2) == [] or splitters(samples, 2) == [(100,)]
    assert splitters([((i,), 1) for i in range(9)], 3) == [(3,), (6,)] and splitters([], 3) == []


def test_resampling_edges(spark):
    many = [(i, f"w{i % 5} " * (15 + i % 20)) for i in range(300)]
    rows = TEXTS + many + [(7_000, many[25][1])] * 40
    documents, target = frame(spark, rows), frame(spark, [(0, "w1 w1 w2"), (1, None)])
    assert by_text(resample(documents, target).collect()) == by_text(brute_resample(rows, ["w1 w1 w2", None]))
    empty = frame(spark, [])
    assert resample(empty, target).count() == 0
    assert by_text(resample(documents, empty).collect()) == by_text(brute_resample(rows, []))
    assert resample(frame(spark, [(1, "short"), (2, None)]), target).select("rank").collect() == [(None,), (None,)]


# --- clustering -------------------------------------------------------------------------------


def brute_clusters(rows, k=8, rounds=10, d=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v]))
    start = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in start[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [nearest(v) for _, v in kept]
    inertia = [sum(f for f, o in last if o == j) for j in range(len(centroids))]
    return [(i, j, f, inertia[j], sum(inertia), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
            for (i, _), (f, j) in zip(kept, last)]


VECTORS = "vec_id long, embedding array<float>, label int, cluster string, chunk long, distance double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", None, 0.5) for i, v in rows], VECTORS)


def test_clusters_equal_brute_force_on_edges(spark):
    rng = random.Random(3)

    def vector():
        return [rng.randrange(-64, 64) / 32 for _ in range(64)]

    same = vector()
    rows = [(i, vector()) for i in range(60)] + [(i, same) for i in range(100, 140)] + [(5, vector()), (5, vector())]
    rows += [(None, vector()), (None, None), (200, None), (201, []), (202, vector()[:63]), (203, [*vector(), 0.0])]
    rows += [(204, [None, *vector()[1:]]), (205, [math.nan, *vector()[1:]]), (206, [-math.inf, *vector()[1:]])]
    rows += [(207, [1e6, *vector()[1:]]), (208, same), (208, same)]
    found = cluster(vectors(spark, rows).repartition(5)).collect()
    assert by_text(found) == by_text(brute_clusters(rows))


def test_few_and_no_vectors(spark):
    one = [(1, [0.5] * 64), (2, [0.25] * 64), (1, [0.5] * 64)]
    assert by_text(cluster(vectors(spark, one)).collect()) == by_text(brute_clusters(one))
    assert cluster(vectors(spark, [])).count() == 0
    assert cluster(vectors(spark, [(1, None), (2, [1.0])])).count() == 0


def test_a_distance_beyond_64_bits_fails():
    far = np.array([[1 << 61] * 3], dtype=np.int64)
    with pytest.raises(OverflowError):
        partial_distances(far, np.zeros((1, 3), dtype=np.int64))


def test_integers_are_packed_in_few_bytes():
    for most, size in ((100, 2), (1 << 20, 4), (1 << 40, 8)):
        values = np.array([-most, 0, most])
        assert len(packed(values)) == 3 * size and unpacked(packed(values), 3).tolist() == values.tolist()
    assert unpacked(packed(np.zeros(0, np.int64)), 0).tolist() == []


# --- substrings -------------------------------------------------------------------------------


def brute_removed(rows, window):
    """{(doc_id, text): (n_words, spans, kept)}; documents in the operator's order."""
    documents = {}
    for d, t, mark in rows:
        documents[(d is None, d or 0, mark)] = (d, t)
    seen, out = set(), {}
    for key in sorted(documents):
        d, t = documents[key]
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        spans, start = [], None
        for i, g in enumerate([*gone, False]):
            if g and start is None:
                start = i
            if not g and start is not None:
                spans.append((start, i))
                start = None
        out[(d, t)] = (len(words), spans, " ".join(w for w, g in zip(words, gone) if not g))
    return out


def check_removed(spark, rows, window=20):
    from pyspark.sql import functions as F

    documents = frame(spark, rows)
    marked = documents.select("doc_id", "text", F.xxhash64("text").alias("m")).collect()
    expected = brute_removed([tuple(r) for r in marked], window)
    found = repeated_words(documents, window).collect()
    got = sorted(repr((r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["kept_text"])) for r in found)
    want = sorted(repr((d, *expected[d, t])) for d, t in rows)
    assert got == want
    for r in found:
        assert r["n_removed"] == sum(b - a for a, b in r["spans"])
    return found


def near_copies(seed, documents=120, vocabulary=30):
    """Copies, near copies, shared passages and periodic texts."""
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(5, 120))] for _ in range(documents // 6)]
    passage, rows = [f"p{i}" for i in range(45)], []
    for i in range(documents):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(vocabulary)}"
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = passage[rng.randrange(10) :]
        if i % 11 == 0:
            words = ["a", "b", "c"][: 1 + i % 3] * 40
        rows.append((rng.randrange(documents), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_removed_words_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(substrings, "SHARD_CHARS", 4000)
    check_removed(spark, near_copies(seed))


def test_short_windows_and_small_groups(spark):
    check_removed(spark, near_copies(7), window=8)


def test_removal_edges(spark):
    passage = " ".join(f"q{i}" for i in range(40))
    rows = TEXTS + [(20, passage), (None, passage), (21, "x " + passage + "\ty"), (22, passage + " " + passage), (20, "z " + passage)]
    found = check_removed(spark, rows)
    assert any(r["n_removed"] for r in found)
    assert repeated_words(frame(spark, [])).count() == 0
    assert {tuple(r)[1:3] for r in repeated_words(frame(spark, [(1, None), (2, "")])).collect()} == {(0, 0)}


def test_frequent_runs_change_no_result(spark, monkeypatch):
    rows = near_copies(9)
    monkeypatch.setattr(substrings, "frequent_runs", lambda documents, run: np.zeros(0, np.uint64))
    check_removed(spark, rows)


def test_spans_are_merged():
    text, start, end = merged_spans(np.array([1, 0, 1, 1, 0]), np.array([5, 0, 0, 3, 9]), np.array([9, 4, 3, 4, 12]))
    assert list(zip(text.tolist(), start.tolist(), end.tolist())) == [(0, 0, 4), (0, 9, 12), (1, 0, 4), (1, 5, 9)]


def test_schema_has_clashing_names():
    assert "spans" in SCHEMA and "place" in SCHEMA and "bucket" in SCHEMA and resampling.BUCKETS == 10_000
