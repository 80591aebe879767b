"""The registered queries against their oracles, or brute force where they have none."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from lakestar.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.oracle import compare, connect

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def table(sf, name, *columns):
    return list(zip(*(pq.read_table(f"{sf}/{name}.parquet")[c].to_pylist() for c in columns)))


def result(spark, name, sf=SF):
    rows = QUERIES[name](spark, sf).collect()
    found = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(found) == pq.read_metadata(f"{sf}/documents.parquet").num_rows
    return found


def test_all_are_registered():
    assert sorted(int(n[2:].partition("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    rows, difference = compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name])
    assert difference == "" and rows > 0


def test_token_output(spark):
    found, start = result(spark, "op1_token_output"), 0
    documents = sorted(table(SF, "documents", "doc_id", "text"))
    for (doc_id, _), ids in zip(documents, brute.encoded([t for _, t in documents], "word_bpe_49k.json")):
        data = np.array([*ids, 1], "<u4").tobytes()
        assert tuple(found[doc_id])[1:] == (start, len(ids) + 1, zlib.crc32(data))
        start += len(ids) + 1


def test_bpe_encoding(spark):
    found, documents = result(spark, "op5_bpe_encoding"), table(SF, "documents", "doc_id", "text")
    for (doc_id, _), ids in zip(documents, brute.encoded([t for _, t in documents], "byte_bpe_50k.json")):
        assert tuple(found[doc_id])[1:] == brute.bpe_row(ids)


def test_secrets(spark):
    import hashlib

    found = result(spark, "op3_secret_scans", LARGER)
    total = 0
    for doc_id, text in table(LARGER, "documents", "doc_id", "text"):
        base, row = brute.base_spans(text), found[doc_id]
        total += len(base)
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s[1] == k for s in base) for k in range(3)]
        assert row["base_sha256"] == hashlib.sha256(brute.listed(base).encode()).hexdigest()
        assert set(filter(None, brute.listed(base).split(","))) <= set(row["spans"].split(","))
        assert row["n_live"] + row["n_copied"] == len(base)
    assert total


def test_quality_on_held_out_rows(spark):
    found, labels = result(spark, "op2_quality_classifier", LARGER), dict(table(LARGER, "labels", "doc_id", "quality"))
    assert all(r["held_out"] == (brute.crc(d) % 3 == 1) for d, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    held = [d for d in labels if found[d]["held_out"]]
    assert np.mean([found[d]["predicted"] == labels[d] for d in held]) > 0.95


def test_language_on_held_out_rows(spark):
    found = result(spark, "op7_language_id", LARGER)
    assert all(r["held_out"] == (brute.crc(d) % 4 == 2) for d, r in found.items())
    held = [(d, lang) for d, lang in table(LARGER, "documents", "doc_id", "lang") if found[d]["held_out"]]
    assert np.mean([found[d]["lang_pred"] == lang for d, lang in held]) > 0.97


def test_token_counts_are_whole(spark):
    found = result(spark, "op6_token_counts")
    assert all(r["n_unknown"] <= r["n_words"] <= r["n_tokens"] for r in found.values())
