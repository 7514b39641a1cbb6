"""Token ids in Arrow stream files of equal-length sequences, and random access to them.

A file holds record batches of SEQUENCES rows; a row has `ids`
(fixed-size list of unsigned integers, 16 bits if the vocabulary fits), `mask`
(fixed-size list of booleans, false on the padding at a file's end) and
`starts`, the documents that begin in the row with their place. Lists of fixed
size have no offsets: sequence i of a memory-mapped file is a slice of its
buffers, without a copy.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwing.llm.common import bounded, stored
from parcelwing.llm.tokens import piece_encoder
from parcelwing.session import scratch

LENGTH = 2048
SEQUENCES = 64      # rows of a record batch
FILE_BYTES = 32 << 20   # text behind one file, about


def schema(length: int, wide: bool) -> pa.Schema:
    return pa.schema([
        ("ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)), ("mask", pa.list_(pa.bool_(), length)),
        ("starts", pa.list_(pa.struct([("doc_id", pa.int64()), ("row", pa.int64()), ("at", pa.int32())])))])


class SequenceWriter:
    """Cuts a run of documents into equal sequences and writes them batch by batch."""

    def __init__(self, sink, length: int, wide: bool):
        self.length, self.schema = length, schema(length, wide)
        self.kind = self.schema.field("ids").type.value_type.to_pandas_dtype()
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = self.tokens = self.docs = 0
        self.starts: list[tuple[int, int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.starts.append((self.held, doc_id, self.docs))
        self.parts.append(ids.astype(self.kind))
        self.held += len(ids)
        self.tokens += len(ids)
        self.docs += 1
        full = self.length * SEQUENCES
        if self.held >= full:
            self._flush(self.held // full * full)

    def _flush(self, upto: int) -> None:
        joined = np.concatenate(self.parts) if self.parts else np.zeros(0, self.kind)
        done, rest = joined[:upto], joined[upto:]
        rows = -(-len(done) // self.length)
        ids = np.zeros(rows * self.length, self.kind)
        ids[:len(done)] = done
        mask = np.arange(rows * self.length) < len(done)
        by_row: list[list] = [[] for _ in range(rows)]
        later = []
        for at, doc_id, number in self.starts:
            if at < rows * self.length:
                by_row[at // self.length].append({"doc_id": doc_id, "row": number, "at": at % self.length})
            else:
                later.append((at - upto, doc_id, number))
        fixed = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        batch = pa.RecordBatch.from_arrays([*fixed, pa.array(by_row, self.schema.field("starts").type)],
                                           schema=self.schema)
        for start in range(0, rows, SEQUENCES):
            self.writer.write_batch(batch.slice(start, SEQUENCES))
        self.parts, self.held, self.starts = [rest], len(rest), later

    def close(self) -> None:
        if self.held:
            self._flush(self.held)
        self.writer.close()


def _file(uri: str):
    return pafs.FileSystem.from_uri(uri) if "://" in uri else pafs.FileSystem.from_uri(os.path.abspath(uri))


def _write(folder: str, tokenizer: str, end: int, length: int, added: bool, batches) -> Iterator[pa.RecordBatch]:
    """Write one file for this partition; tell its number, documents and tokens.

    The file is written beside its name and moved there, so a retried or
    doubled task leaves one whole file with the same content.
    """
    encoder = piece_encoder(tokenizer, added)
    wide = max(encoder.whole.get_vocab_size(), end + 1) > 1 << 16
    context = TaskContext.get()
    part = context.partitionId()
    fs, base = _file(folder)
    fs.create_dir(base, recursive=True)
    name = f"{base}/part-{part:06d}.arrows"
    draft = f"{name}.{context.taskAttemptId()}"
    last = np.array([end], "<u4")
    with fs.open_output_stream(draft) as sink:
        writer = SequenceWriter(sink, length, wide)
        for batch in bounded(batches, "text", 4 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                writer.add(doc_id, np.concatenate((np.frombuffer(ids, "<u4"), last)))
        writer.close()
    if writer.docs:
        fs.move(draft, name)
    else:
        fs.delete_file(draft)
        return
    yield pa.RecordBatch.from_pylist([{
        "part": part, "file": f"{folder}/part-{part:06d}.arrows", "docs": writer.docs, "tokens": writer.tokens}])


def write_sequences(docs: DataFrame, folder: str, tokenizer: str, end: int, length: int = LENGTH,
                    added: bool = False) -> DataFrame:
    """Write docs(doc_id, text) in ascending doc_id order; return (part, file, docs, tokens) per file.

    A range partition is a file, so files and the rows in them follow doc_id
    (nulls first, ties by a hash of the text). Their number follows the bytes of
    all texts. A null text is empty and holds the end id alone. `folder` must be
    one that all executors share.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    least = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, (base.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_BYTES)
    # only ids and hashes are sampled for the bounds of the ranges
    ordered = base.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    told = "part long, file string, docs long, tokens long"
    return stored(ordered.mapInArrow(partial(_write, folder, tokenizer, end, length, added), told), "manifest")


class SequenceFile:
    """Random access to the equal-length sequences of one file."""

    def __init__(self, uri: str):
        fs, path = _file(uri)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.table = pa.ipc.open_stream(self.source).read_all()

    def __len__(self) -> int:
        return self.table.num_rows

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """ids and mask of sequence i, both views of the file's pages; the mask keeps its packed bits."""
        row = self.table.slice(i, 1)
        ids = row.column("ids").chunk(0).flatten().to_numpy(zero_copy_only=True)
        return ids, row.column("mask").chunk(0).flatten()

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, its start in the file and its ids, in order; a document may span sequences."""
        begun, held, length = None, [], self.table.schema.field("ids").type.list_size
        for chunk in self.table.to_batches():
            ids = chunk.column("ids").flatten().to_numpy(zero_copy_only=True)
            ids = ids[:int(pc.sum(chunk.column("mask").flatten()).as_py() or 0)]
            at = 0
            for row, starts in enumerate(chunk.column("starts").to_pylist()):
                for start in starts:
                    here = row * length + start["at"]
                    if begun is not None:
                        yield *begun, np.concatenate([*held, ids[at:here]])
                        begun = (start["doc_id"], begun[1] + sum(map(len, held)) + here - at)
                    else:
                        begun = (start["doc_id"], 0)
                    held, at = [], here
            held.append(ids[at:])
        if begun is not None:
            yield *begun, np.concatenate(held)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5
    for batch in batches:
        for uri, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
            rows = []
            for doc_id, start, ids in SequenceFile(uri).documents():
                rows.append((doc_id, before + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), len(rows)))
                if len(rows) == 10_000:
                    yield _columns(rows, kinds)
                    rows = []
            yield _columns(rows, kinds)


def _columns(rows, kinds) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:4], kinds)],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens and ids_crc32, from the files themselves.

    The manifest has a row per file; a running sum over it places the files,
    which are read in as many tasks.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))
    dealt = placed.select("file", "before", "part").repartition(max(1, manifest.count()), "part")
    return dealt.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end: int, length: int = LENGTH, added: bool = False) -> DataFrame:
    """Write docs to a new folder below the shared one and read every document back."""
    folder = scratch(docs.sparkSession, "sequences")
    return read_documents(write_sequences(docs, folder, tokenizer, end, length, added))
