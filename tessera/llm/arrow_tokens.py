"""Token-ID output: Arrow files of fixed-size-list batches.

Layout under ``out_dir``: per shard one ``tokens-*.arrow`` (Arrow IPC file;
``input_ids: fixed_size_list<uint>[seq_len]`` and ``attention_mask:
fixed_size_list<bool>[seq_len]``, equal-length sequences, the last one of a
shard padded and masked) and one ``index-*.arrow`` (doc_id, start in the
shard, n_tokens); ``manifest`` is a Parquet table of the shards in order.
The IPC footer gives random access to any batch, and its buffers are read
without a copy when the file is memory-mapped.

Scale: one range shuffle by document id; each shard is encoded and written
as a stream (a batch at a time), so memory does not grow with the shard.  A
retried task writes files under a new name, and only the attempt whose row
reached the manifest counts.

Defined results: null text is an empty text (the end id only); null ids sort
first; repeated rows are written each; an empty table gives no shard and no
rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import tokens as tk
from tessera.llm._common import arrow_schema, batch_of, open_store

MANIFEST = "shard int, tokens_path string, index_path string, n_docs long, n_tokens long, n_sequences long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def sequence_schema(seq_len: int, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("input_ids", pa.list_(id_type, seq_len)), ("attention_mask", pa.list_(pa.bool_(), seq_len))])


class ShardWriter:
    """Appends documents' ids; writes a batch whenever enough sequences are full."""

    def __init__(self, out_dir: str, shard: int, seq_len: int, batch_sequences: int, dtype: str):
        name = f"{shard:06d}-{uuid.uuid4().hex[:8]}"
        self.paths = [f"{out_dir}/tokens-{name}.arrow", f"{out_dir}/index-{name}.arrow"]
        self.seq_len, self.batch_ids, self.dtype = seq_len, seq_len * batch_sequences, np.dtype(dtype)
        self.schema = sequence_schema(seq_len, pa.from_numpy_dtype(self.dtype))
        self.files = []
        for path in self.paths:
            store, inner = open_store(path)
            self.files.append(store.open_output_stream(inner))
        self.tokens = pa.ipc.new_file(self.files[0], self.schema)
        self.index = pa.ipc.new_file(self.files[1], INDEX)
        self.buffer, self.buffered = [], 0
        self.docs, self.n_docs, self.n_tokens, self.n_sequences = [], 0, 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.docs.append((doc_id, self.n_tokens, n))
        self.n_docs, self.n_tokens = self.n_docs + 1, self.n_tokens + n
        self.buffer.append(ids)
        self.buffered += n
        if self.buffered >= self.batch_ids:
            self._flush(last=False)
        if len(self.docs) >= 10_000:
            self._flush_index()

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.buffer), dtype=self.dtype)
        done = 0
        while len(ids) - done >= self.batch_ids:
            self._write(ids[done:done + self.batch_ids], self.batch_ids)
            done += self.batch_ids
        rest = ids[done:]
        if last and len(rest):
            self._write(rest, -(-len(rest) // self.seq_len) * self.seq_len)
            rest = rest[:0]
        self.buffer, self.buffered = [rest.tobytes()], len(rest)

    def _write(self, ids: np.ndarray, padded: int) -> None:
        mask = np.arange(padded) < len(ids)
        ids = np.pad(ids, (0, padded - len(ids)))
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (ids, mask)]
        self.tokens.write_batch(pa.record_batch(columns, schema=self.schema))
        self.n_sequences += padded // self.seq_len

    def _flush_index(self) -> None:
        if self.docs:
            columns = [pa.array(c, pa.int64()) for c in zip(*self.docs)]
            self.index.write_batch(pa.record_batch(columns, schema=INDEX))
            self.docs = []

    def close(self) -> None:
        self._flush(last=True)
        self._flush_index()
        for x in (self.tokens, self.index, *self.files):
            x.close()


def write_token_files(docs: DataFrame, out_dir: str, tokenizer: str, *, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 1, seq_len: int = 2048,
                      batch_sequences: int = 256) -> DataFrame:
    """Encode every text, append ``end_id`` and write the ids in ascending
    order of ``id_col``.  Returns the manifest (a row per shard)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))

    store, inner = open_store(out_dir)
    store.create_dir(inner)

    def write(batches):
        from pyspark import TaskContext

        enc, writer = None, None
        for batch in batches:
            if batch.num_rows and writer is None:
                enc = tk.encoder(tokenizer)
                end = np.array([end_id], dtype=enc.dtype).tobytes()
                writer = ShardWriter(out_dir, TaskContext.get().partitionId(), seq_len, batch_sequences, enc.dtype)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                writer.add(doc_id, enc.encode(text.as_py()) + end)
        if writer is not None:
            writer.close()
            yield batch_of([(TaskContext.get().partitionId(), *writer.paths, writer.n_docs, writer.n_tokens,
                             writer.n_sequences)], MANIFEST)

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{out_dir}/manifest")
    return read_manifest(spark, out_dir)


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")


class TokenFile:
    """Random access to the sequences and masks of one shard's file."""

    def __init__(self, path: str):
        store, inner = open_store(path)
        source = pa.memory_map(inner) if type(store).__name__ == "LocalFileSystem" else store.open_input_file(inner)
        self.file = pa.ipc.open_file(source)
        self.seq_len = self.file.schema.field("input_ids").type.list_size
        self.per_batch = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0
        self._at, self._batch = -1, None

    def _get(self, k: int) -> pa.RecordBatch:
        if k != self._at:
            self._at, self._batch = k, self.file.get_batch(k)
        return self._batch

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """(ids, mask) of sequence i; views of the file's buffers."""
        batch, row = self._get(i // self.per_batch), i % self.per_batch
        ids, mask = (batch.column(c).slice(row, 1).flatten() for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def span(self, start: int, length: int):
        """The ids from ``start`` on, as views of one batch each."""
        size = self.per_batch * self.seq_len
        while length > 0:
            k, at = divmod(start, size)
            part = self._get(k).column(0).flatten().to_numpy(zero_copy_only=True)[at:at + length]
            if not len(part):
                raise ValueError("the index points beyond the file")
            yield part
            start, length = start + len(part), length - len(part)


def read_token_files(spark: SparkSession, out_dir: str) -> DataFrame:
    """The documents as the files hold them: doc_id, start (ids of all
    documents before it), n_tokens and the crc32 of its ids as little-endian
    unsigned 32-bit integers."""
    manifest = read_manifest(spark, out_dir)
    base, shards = 0, []
    for r in sorted(manifest.select("shard", "n_tokens", "tokens_path", "index_path").collect()):  # a row per shard
        shards.append((base, r["tokens_path"], r["index_path"]))
        base += r["n_tokens"]
    out = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                store, inner = open_store(shard["index_path"])
                file, index = TokenFile(shard["tokens_path"]), pa.ipc.open_file(store.open_input_file(inner))
                for k in range(index.num_record_batches):
                    docs = index.get_batch(k)
                    crcs = []
                    for start, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                        crc = 0
                        for part in file.span(start, n):
                            crc = zlib.crc32(part.astype("<u4").data, crc)
                        crcs.append(crc)
                    starts = pa.compute.add(docs.column(1), shard["base"])
                    yield pa.RecordBatch.from_arrays([docs.column(0), starts, docs.column(2), pa.array(crcs, pa.int64())], schema=arrow_schema(out))

    import pyarrow.compute  # noqa: F401 - so that pa.compute exists where read() runs

    rows = spark.createDataFrame(shards, "base long, tokens_path string, index_path string")
    return rows.repartition(max(1, len(shards))).mapInArrow(read, out)
