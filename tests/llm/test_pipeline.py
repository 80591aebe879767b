"""The pipeline's stages against brute force, each on its own input."""

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from lakestar.llm.common import read_table, stored
from lakestar.llm.decontaminate import WINDOW
from tests.llm import brute
from tests.llm.test_parts import naive_hits

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before each stage, and those of the last one, by stage."""
    docs, found = read_table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        found.append(docs.collect())
        docs = stored(stage(spark, docs, SF), "pipeline-test")
    return [*found, docs.collect()]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_quality_drops_what_it_rejects(stages):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    kept = set(ids(stages[1]))
    right = [(d in kept) == (q == 1) for d, q in labels.items()]
    assert sum(right) / len(right) > 0.95 and set(stages[1]) <= set(stages[0])


def test_exact_dedup_keeps_the_largest_id(stages):
    keep = {}
    for r in stages[1]:
        keep[r["text"]] = max(r["doc_id"], keep.get(r["text"], -1))
    assert ids(stages[2]) == sorted(keep.values()) and set(stages[2]) <= set(stages[1])


def test_one_of_each_group_stays(stages):
    groups = brute.jaccard_components([(r["doc_id"], r["text"]) for r in stages[2]], 5, 80)
    assert ids(stages[3]) == sorted(d for d, (_, c) in groups.items() if c == d)


def test_contaminated_documents_go(stages):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    clean = []
    for r in stages[3]:
        hit, _ = naive_hits(r["text"], items, WINDOW) if any(True for _ in items) else ([], set())
        if not (any(hit) and 20 * sum(hit) >= len(hit)):
            clean.append(r["doc_id"])
    assert ids(stages[4]) == sorted(clean)


def test_the_rest_is_encoded(stages):
    rows = stages[4]
    wanted = {r["doc_id"]: brute.bpe_row(i) for r, i in zip(rows, brute.encoded([r["text"] for r in rows], "byte_bpe_50k.json"))}
    assert {r["doc_id"]: tuple(r)[1:] for r in stages[5]} == wanted


def test_run_gives_the_same(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(stages[5])
