"""Token ids in Arrow stream files: batches of equal-length sequences and masks, read without copies."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import open_file, stored, widened
from lakestar.llm.tokenizer_words import word_encoder
from lakestar.session import scratch_dir

SEQUENCE = 2048
# Sequences of a record batch, and bytes of text of a shard (one data file and one index file).
BATCH = 256
SHARD_BYTES = 64 << 20
END = 1  # fixed value of the contract: the id after each document


def data_schema(sequence: int) -> pa.Schema:
    """Ids and mask (1: token, 0: filling after the last token of a shard) of equal length."""
    return pa.schema([("ids", pa.list_(pa.uint16(), sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class ShardWriter:
    """Writes one shard: ``<shard>.ids.arrow`` and ``<shard>.docs.arrow``, renamed when complete."""

    def __init__(self, folder: str, shard: int, sequence: int, attempt: int):
        self.files, path = open_file(folder)
        self.names = [f"{path}/{shard:06d}.{kind}.arrow" for kind in ("ids", "docs")]
        self.open_names = [f"{n}.{attempt}" for n in self.names]
        self.sinks = [self.files.open_output_stream(n) for n in self.open_names]
        self.data = pa.ipc.new_stream(self.sinks[0], data_schema(sequence))
        self.index = pa.ipc.new_stream(self.sinks[1], INDEX)
        self.sequence, self.tokens, self.docs = sequence, 0, 0
        self.waiting, self.rows, self.held = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 2
        self.rows.append((doc_id, self.tokens, n))
        self.waiting.append(ids)
        self.tokens, self.docs, self.held = self.tokens + n, self.docs + 1, self.held + n
        if self.held >= self.sequence * BATCH:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        block = self.sequence * BATCH
        ids = np.frombuffer(b"".join(self.waiting), dtype="<u2")
        whole = len(ids) if last else len(ids) - len(ids) % block
        for at in range(0, whole, block):
            part = ids[at : min(at + block, whole)]
            filled = -(-len(part) // self.sequence) * self.sequence
            mask = np.arange(filled) < len(part)
            part = np.pad(part, (0, filled - len(part)))
            self.data.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(a), self.sequence) for a in (part, mask)],
                names=["ids", "mask"]))
        self.waiting = [ids[whole:].tobytes()]
        self.held = len(ids) - whole
        if self.rows:
            columns = [pa.array(c, pa.int64()) for c in zip(*self.rows)]
            self.index.write_batch(pa.RecordBatch.from_arrays(columns, schema=INDEX))
            self.rows = []

    def close(self) -> tuple[int, int]:
        """Documents and tokens of the shard, now visible under its final names."""
        self._flush(True)
        for stream, sink in zip((self.data, self.index), self.sinks):
            stream.close()
            sink.close()
        for temporary, name in zip(self.open_names, self.names):
            self.files.move(temporary, name)
        return self.docs, self.tokens


class Shard:
    """A written shard. Local files are mapped: a sequence or document is a view, not a copy."""

    def __init__(self, folder: str, shard: int):
        files, path = open_file(folder)
        data, index = (f"{path}/{shard:06d}.{kind}.arrow" for kind in ("ids", "docs"))
        local = os.path.exists(data)
        self.source = pa.memory_map(data) if local else files.open_input_file(data)
        self.batches = list(pa.ipc.open_stream(self.source))
        self.firsts = np.cumsum([0, *(b.num_rows for b in self.batches)])[:-1].tolist()
        with files.open_input_file(index) as file:
            self.documents = pa.ipc.open_stream(file).read_all()
        self.sequence = self.batches[0].schema.field("ids").type.list_size if self.batches else 0

    def _values(self, batch: pa.RecordBatch, name: str) -> pa.Array:
        return batch.column(name).flatten()

    def sequence_at(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a numpy view of the file) and mask of sequence i."""
        k = bisect_right(self.firsts, i) - 1
        batch, row = self.batches[k], i - self.firsts[k]
        ids = self._values(batch, "ids").to_numpy(zero_copy_only=True)
        at = row * self.sequence
        return ids[at : at + self.sequence], self._values(batch, "mask").slice(at, self.sequence)

    def document_ids(self, start: int, n: int) -> np.ndarray:
        """The ids from a token position of the shard: a view when they lie in one batch."""
        parts, block = [], self.sequence * BATCH
        while n:
            k, at = divmod(start, block)
            part = self._values(self.batches[k], "ids").to_numpy(zero_copy_only=True)[at : at + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, "<u2"), *parts])


def write_tokens(
    documents: DataFrame, tokenizer_path: str, *, sequence: int = SEQUENCE, shard_bytes: int = SHARD_BYTES
) -> tuple[str, DataFrame]:
    """(folder of the files, manifest with a row ``shard, docs, tokens`` per shard).

    Documents are encoded where they are read, dealt to shards by ranges of ``doc_id`` and written in its
    order, an end id after each. Shards are cut at quantiles of ``doc_id`` for about ``shard_bytes`` of
    text each; a shard is written batch by batch, so its size does not bound it by memory. Files get their
    names when complete, so a task that runs twice writes the same files again. Null texts are empty and
    null ids come first; rows that repeat an id follow each other by their tokens.
    """
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(1, -(-size // shard_bytes))
    cuts = [i / shards for i in range(1, shards)]
    bounds = documents.agg(F.percentile_approx("doc_id", F.lit(cuts), 100 * shards).alias("b")).first()["b"] if cuts else []
    bounds = sorted(set(bounds or []))
    folder = scratch_dir(spark, "tokens")
    spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(
        spark._jvm.org.apache.hadoop.fs.Path(folder))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_encoder(tokenizer_path), np.array([END], "<u2").tobytes()
        for batch in batches:
            ids = [i + end for i in encoder.encode(batch["text"])]
            shard = [0 if d is None else bisect_right(bounds, d) for d in batch["doc_id"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(shard, pa.int32()), pa.array(ids, pa.binary())],
                names=["doc_id", "shard", "ids"])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, writer, at = TaskContext.get().taskAttemptId(), None, None
        done = []
        for batch in batches:
            for doc_id, shard, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != at:
                    if writer:
                        done.append((at, *writer.close()))
                    writer, at = ShardWriter(folder, shard, sequence, attempt), shard
                writer.add(doc_id, ids)
        if writer:
            done.append((at, *writer.close()))
        if done:
            shard, docs, tokens = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(docs, pa.int64()), pa.array(tokens, pa.int64())],
                names=["shard", "docs", "tokens"])

    encoded = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encode, "doc_id long, shard int, ids binary")
    dealt = encoded.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "doc_id", "ids")
    return folder, stored(dealt.mapInArrow(write, "shard int, docs long, tokens long"), "token-manifest")


def read_tokens(folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it: the sum of the shards before (one manifest row
    per shard) and the place within the shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    tasks = max(1, manifest.count())

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before in zip(batch["shard"].to_pylist(), batch["before"].to_pylist()):
                written = Shard(folder, shard)
                for part in written.documents.to_batches():
                    starts, sizes = part["start"].to_pylist(), part["n_tokens"].to_pylist()
                    sums = [zlib.crc32(written.document_ids(s, n).astype("<u4")) for s, n in zip(starts, sizes)]
                    yield pa.RecordBatch.from_arrays(
                        [part["doc_id"], pa.array([before + s for s in starts], pa.int64()),
                         part["n_tokens"], pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = placed.select("shard", "before").repartitionById(tasks, "shard")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
