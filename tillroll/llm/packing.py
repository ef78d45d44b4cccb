"""Best-fit packing of documents into sequences of a fixed number of tokens.

Bounded-space best fit: a fixed number of open bins, found by a bitset with
one bit for each amount of free space; a piece goes to the fullest open bin
that still holds it, and when a new bin would be one too many, the fullest closes
first. Pieces come longest first, so bins close nearly full.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.llm.common import append_columns, read, ship, stored
from tillroll.llm.token_ids import encoder, production_path

PIECES = "pieces array<struct<piece:int,start:long,length:long,ids_crc32:long>>"


class OpenBins:
    """At most ``limit`` open bins of ``capacity``; numbers bins in the order in which they open."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.bits = 0  # bit k: an open bin with k tokens free
        self.open = self.opened = 0

    def put(self, length: int) -> tuple[int, int]:
        """Bin and place in it of a piece of this length (0 to capacity)."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.opened
            self.opened += 1
        if free > length:  # a full bin is closed
            self.by_free[free - length].append(number)
            self.bits |= 1 << (free - length)
            self.open += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        number = held.pop()
        if not held:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number


def pieces(docs: DataFrame, path: str, text: str = "text", capacity: int = 2048, end: int = 0) -> DataFrame:
    """One row per piece: the other columns of ``docs``, then piece, start, length, ids_crc32.

    A document's ids are those of its whole text and then ``end``; it is cut only
    if it has more than ``capacity``.
    """
    tail = np.array([end], "<u4").tobytes()

    def cut(texts):
        out = []
        for ids in encoder(path).encode(texts):
            ids += tail
            out.append([{"piece": k, "start": k * capacity, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                        for k, part in enumerate(ids[a:a + 4 * capacity] for a in range(0, len(ids), 4 * capacity))])
        return [out]

    given = append_columns(docs, [text], PIECES, cut, rows=256, drop=(text,))
    kept = [f"`{c}`" for c in given.columns if c.lower() not in ("piece", "start", "length", "ids_crc32", "pieces")]
    return given.select(*kept, F.explode("pieces").alias("_p")).select(*kept, "_p.*")


def pack(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048,
         end: int = 0, open_bins: int = 16384, share: int = 100_000) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences hold at most ``capacity`` tokens and have no gaps. Null and empty texts are the one
    id ``end``. Whole texts are encoded. Pieces are dealt by a hash of their content to tasks of
    about ``share`` pieces, each of which packs its own longest first with ``open_bins`` open
    bins; a task leaves at most its last open bins partly filled. Repeated rows, of
    one id or not, are packed each; a null id stays null; an empty table
    gives an empty one. Other columns are left out.

    The order within a task is fixed by the pieces themselves, so a task that runs again
    gives the same sequences.
    """
    ship(docs.sparkSession)
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = stored(pieces(given, path or production_path(), "text", capacity, end), "pieces")
    tasks = max(1, -(-found.count() // share))
    dealt = (found.withColumn("_task", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(tasks)).cast("int"))
             .repartition(tasks, "_task")
             .sortWithinPartitions("_task", F.col("length").desc(), "doc_id", "piece", "ids_crc32", "start"))

    def place(batches):
        task, bins = None, None
        for batch in batches:
            numbers, offsets = [], []
            for t, length in zip(batch.column("_task").to_pylist(), batch.column("length").to_pylist()):
                if t != task:
                    task, bins = t, OpenBins(capacity, open_bins)
                n, at = bins.put(length)
                numbers.append((t << 40) | n)
                offsets.append(at)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())],
                names=names)

    schema = StructType(found.schema.fields).add("sequence_id", "long").add("offset", "long")
    names = schema.names
    return dealt.mapInArrow(place, schema)


def query(spark, sf_dir):
    return pack(read(spark, sf_dir, "documents"))
