"""Token ids in Arrow files of equal-length sequences with masks.

A store is a folder of shards in ascending document order. A shard is an
Arrow IPC file whose batches hold two fixed-size lists per row: the ids of
one sequence and its mask (false where the shard's last sequence is padded).
The documents of a shard lie one after the other through its sequences; a
second Arrow file gives each one's id, start and length. A memory-mapped
shard gives any sequence, mask or document as views, without a copy.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import read, scratch_path, ship
from tillroll.llm.token_ids import encoder, production_path

MANIFEST = "shard int, n_docs long, n_tokens long"


def _names(path: str, shard: int) -> tuple[str, str]:
    return f"{path}/shard-{shard:07d}.arrow", f"{path}/shard-{shard:07d}.docs.arrow"


class _Whole:
    """A file that appears under its name once it is complete; a second attempt replaces it."""

    def __init__(self, fs, name: str):
        self.fs, self.name, self.part = fs, name, f"{name}.{uuid.uuid4().hex}.part"

    def __enter__(self):
        self.out = self.fs.open_output_stream(self.part)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            if self.fs.get_file_info(self.name).type != pafs.FileType.NotFound and self.fs.type_name != "local":
                self.fs.delete_file(self.name)
            self.fs.move(self.part, self.name)
        else:
            self.fs.delete_file(self.part)


class ShardWriter:
    """Fills sequences with the ids of one document after the other and writes batch by batch."""

    def __init__(self, out, length: int, dtype: str, rows: int = 64):
        self.length, self.rows, self.dtype = length, rows, np.dtype(dtype)
        self.schema = pa.schema({"ids": pa.list_(pa.from_numpy_dtype(self.dtype), length),
                                 "mask": pa.list_(pa.bool_(), length)},
                                metadata={"length": str(length), "rows": str(rows)})
        self.file = pa.ipc.new_file(out, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = 0

    def add(self, ids: np.ndarray) -> None:
        self.n_tokens += len(ids)
        whole = self.rows * self.length
        while self.n_held + len(ids) >= whole:
            self.held.append(ids[:whole - self.n_held])
            ids = ids[whole - self.n_held:]
            self._flush(whole)
        self.held.append(ids)
        self.n_held += len(ids)

    def _flush(self, n: int) -> None:
        size = -(-n // self.length) * self.length
        flat = np.zeros(size, self.dtype)
        flat[:n] = np.concatenate(self.held)
        mask = pa.array(np.arange(size) < n)
        self.file.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length),
             pa.FixedSizeListArray.from_arrays(mask, self.length)], schema=self.schema))
        self.held, self.n_held = [], 0

    def close(self) -> None:
        if self.n_held:
            self._flush(self.n_held)
        self.file.close()


class Shard:
    """Random access to a shard: views of its batches, not copies, if the file is memory-mapped."""

    def __init__(self, path: str, shard: int):
        fs, root = pafs.FileSystem.from_uri(path)
        names = _names(root, shard)
        local = fs.type_name == "local"
        self.file = pa.ipc.open_file(pa.memory_map(names[0]) if local else fs.open_input_file(names[0]))
        with (pa.memory_map(names[1]) if local else fs.open_input_file(names[1])) as f:
            self.docs = pa.ipc.open_file(f).read_all()
        self.length = int(self.file.schema.metadata[b"length"])
        self.rows = int(self.file.schema.metadata[b"rows"])
        self._batch = (-1, None)

    def _get(self, k: int) -> pa.RecordBatch:
        if self._batch[0] != k:
            self._batch = k, self.file.get_batch(k)
        return self._batch[1]

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of the k-th sequence."""
        batch, row = self._get(k // self.rows), k % self.rows
        at = row * self.length
        return (batch.column(0).values.to_numpy(zero_copy_only=True)[at:at + self.length],
                batch.column(1).values.slice(at, self.length))

    def tokens(self, start: int, n: int):
        """Yield views of the ids from ``start`` on, one per batch that they touch."""
        whole = self.rows * self.length
        while n > 0:
            k, at = divmod(start, whole)
            take = min(n, whole - at)
            yield self._get(k).column(0).values.to_numpy(zero_copy_only=True)[at:at + take]
            start, n = start + take, n - take


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 end: int = 2, length: int = 2048, shard_bytes: int = 32 << 20) -> DataFrame:
    """Encode whole texts, each followed by ``end``, and write them below ``path`` in ascending ``doc_id`` order.

    Returns the manifest, one row per shard (also written, as ``path``/manifest):
    shard, n_docs, n_tokens. ``path`` lies in a store that all executors reach
    (a shared folder, or any address that pyarrow's file systems know).

    Null texts are empty (one ``end``). Null ids come first; rows of one id are
    ordered by a hash of their text, and each is a document. An empty table gives no shard.
    Documents are dealt by ranges of id and text into shards of about ``shard_bytes`` of
    text, so repeated ids do not gather in one; other columns are left out. A
    shard that is written again, after a lost executor, holds the same.
    """
    spark = ship(docs.sparkSession)
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    size = given.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"]
    shards = max(1, -(-(size or 0) // shard_bytes))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    ranged = (given.withColumn("tie", F.xxhash64("text")).repartitionByRange(shards, *order)
              .sortWithinPartitions(*order, "text").select("doc_id", "text"))

    def write(batches):
        ids, n, shard = [], [], TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(path)
        enc = encoder(tokenizer)
        dtype = "<u2" if enc.vocabulary <= 1 << 16 else "<u4"
        tail = np.array([end], "<u4").tobytes()
        writer = whole = None
        try:
            for batch in batches:
                if writer is None and batch.num_rows:
                    fs.create_dir(root, recursive=True)
                    whole = _Whole(fs, _names(root, shard)[0])
                    writer = ShardWriter(whole.__enter__(), length, dtype)
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    for found in enc.encode(part.column(1).to_pylist()):
                        tokens = np.frombuffer(found + tail, "<u4").astype(dtype)
                        writer.add(tokens)
                        n.append(len(tokens))
                    ids += part.column(0).to_pylist()
            if writer is None:
                return
            writer.close()
        except BaseException as e:
            if whole is not None:
                whole.__exit__(type(e))
            raise
        whole.__exit__(None)
        starts = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
        table = pa.table({"doc_id": pa.array(ids, pa.int64()), "start": starts, "n_tokens": np.array(n, np.int64)})
        with _Whole(fs, _names(root, shard)[1]) as out, pa.ipc.new_file(out, table.schema) as f:
            f.write_table(table)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()),
                                          "n_docs": pa.array([len(n)], pa.int64()),
                                          "n_tokens": pa.array([sum(n)], pa.int64())})

    ranged.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document of the store.

    ``start`` counts the ids of all documents before it. A task reads one shard
    at a time, batch by batch.
    """
    ship(spark)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard: the running sum of their sizes is small work
    shards = (manifest(spark, path).withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
              .select("shard", "first"))
    n = max(1, shards.count())

    def load(batches):
        for batch in batches:
            for shard, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = Shard(path, shard)
                for part in s.docs.to_batches(max_chunksize=256):
                    starts, sizes = part.column(1).to_numpy(), part.column(2).to_numpy()
                    ids = [b"".join(v.astype("<u4").tobytes() for v in s.tokens(int(a), int(k)))
                           for a, k in zip(starts, sizes)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(starts + first, pa.int64()), pa.array(sizes, pa.int64()),
                         pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return shards.repartition(n, "shard").mapInArrow(load, "doc_id long, start long, n_tokens long, ids binary")


def query(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    write_tokens(read(spark, sf_dir, "documents"), path, production_path())
    return read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
