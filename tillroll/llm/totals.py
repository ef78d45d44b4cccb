"""Totals of keys over all blocks, sent back to the blocks that hold them.

A block sends its distinct keys with its own counts, in order, cut into slices by equal ranges of the key. A
slice's totals are made in one place and sent back. With as many slices as blocks, messages grow with
the square of the blocks; so beyond ``DIRECT`` blocks they go in two hops: about sqrt(n) groups of blocks times
sqrt(n) slices meet first, each such meeting sums its keys and cuts them finer, the fine slices meet, and
totals come back the same way. That is 4 * n ** 1.5 messages, and no meeting holds more keys than a few blocks do.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import packed, packed_keys, slices, stored, unpacked, unpacked_keys

#: Blocks up to which every block sends to every slice itself.
DIRECT = 256

SENT = "slice int, of_block long, keys binary, counts binary"


def slice_count(n_blocks: int, direct: int | None = None) -> int:
    """Slices that the blocks cut their keys into."""
    direct = DIRECT if direct is None else direct
    return max(1, -(-n_blocks // 2)) if n_blocks <= direct else max(2, isqrt(n_blocks - 1) + 1)


def messages(block: int, keys: np.ndarray, counts: np.ndarray, n: int) -> pa.RecordBatch:
    """A block's rows of ``SENT``: its distinct keys in order and their counts, by slice; empty slices are not sent."""
    edge = slices(keys, n)
    full = np.flatnonzero(np.diff(edge))
    cut = [slice(edge[k], edge[k + 1]) for k in full]
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()),
         pa.array([packed_keys(keys[c]) for c in cut], pa.binary()), pa.array([packed(counts[c]) for c in cut], pa.binary())],
        names=["slice", "of_block", "keys", "counts"])


#: Set in a marked total: more than one block holds the key.
SHARED = np.int64(-1 << 63)


def add_up(keys: list[np.ndarray], counts: list[np.ndarray], dtype, held: list[np.ndarray] | None = None):
    """Distinct keys in order, their totals (64-bit, at most what ``dtype`` holds), each sender's places among them, and
    how many blocks hold each (2 for more); ``held`` says so for each sender's keys, else a sender is a block."""
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    edge = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    places = [at[a:b] for a, b in zip(edge[:-1], edge[1:])]
    total, blocks = np.zeros(len(found), np.int64), np.zeros(len(found), np.uint8)
    for k, (p, c) in enumerate(zip(places, counts)):
        total[p] += c.astype(np.int64)              # a sender has a key once
        blocks[p] = np.minimum(blocks[p] + (np.uint8(1) if held is None else held[k]), 2)
    return found, np.minimum(total, np.iinfo(dtype).max).astype(dtype), places, blocks


def _read(table: pa.Table, dtype):
    held = [unpacked(h, np.uint8) for h in table["held"].to_pylist()] if "held" in table.column_names else None
    return ([unpacked_keys(k) for k in table["keys"].to_pylist()], [unpacked(c, dtype) for c in table["counts"].to_pylist()],
            dtype, held)


def corpus_totals(sent: DataFrame, n_blocks: int, dtype, sums=None, direct: int | None = None,
                  marked: bool = False) -> tuple[DataFrame, list[int]]:
    """``(of_block, slice, totals)`` for every row of ``sent``, in the order of its keys, and the sums asked for.

    ``sent`` are ``messages`` with ``slice_count`` slices and counts of type ``dtype``, which totals have too (no more than
    it holds). ``sums(keys, totals)`` gives numbers that are added up over all distinct keys. With ``marked`` (64-bit
    totals) those of keys that more than one block sent have the bit ``SHARED`` set.
    """
    n = slice_count(n_blocks, direct)
    size = np.dtype(dtype)

    def answer(table: pa.Table, by: str) -> pa.Table:
        found, total, places, blocks = add_up(*_read(table, size))
        extra = [int(x) for x in sums(found, total)] if sums else []
        total = total | np.where(blocks > 1, SHARED, 0) if marked else total
        rows = table.num_rows
        # the sums stand in one row
        return pa.table({by: table[by], "slice": table["slice"], **({"fine": table["fine"]} if by == "part" else {}),
                         "totals": pa.array([packed(total[p]) for p in places], pa.binary()),
                         "sums": pa.array([extra] + [None] * (rows - 1), pa.list_(pa.int64()))})

    def added(answers: DataFrame) -> tuple[DataFrame, list[int]]:
        if sums is None:
            return answers, []
        kept = stored(answers, "totals")
        width = len(sums(np.empty(0, np.uint64), np.empty(0, size)))
        got = kept.where("sums is not null").agg(*[F.sum(F.get("sums", F.lit(k))) for k in range(width)]).first()
        return kept, [x or 0 for x in got]

    if n_blocks <= (DIRECT if direct is None else direct):
        answers = sent.groupBy("slice").applyInArrow(
            lambda t: answer(t, "of_block"), "of_block long, slice int, totals binary, sums array<long>")
        answers, got = added(answers)
        return answers.select("of_block", "slice", "totals"), got

    sent = sent.withColumn("part", F.pmod(F.xxhash64("of_block"), F.lit(n)).cast("int"))

    def finer(keys: np.ndarray, k: int) -> np.ndarray:
        """Edges of the fine slices of a slice's keys."""
        wide = (1 << 64) // n
        step = max(1, wide // n)
        return np.concatenate([[0], np.searchsorted(keys, np.uint64(k * wide) + np.arange(1, n, dtype=np.uint64) * np.uint64(step)),
                               [len(keys)]])

    def gather(table: pa.Table) -> pa.Table:
        found, total, _, blocks = add_up(*_read(table, size))
        k, part = table["slice"][0].as_py(), table["part"][0].as_py()
        edge = finer(found, k)
        full = np.flatnonzero(np.diff(edge))
        cut = [slice(edge[f], edge[f + 1]) for f in full]
        return pa.table({"slice": pa.array([k] * len(full), pa.int32()), "fine": pa.array(full, pa.int32()),
                         "part": pa.array([part] * len(full), pa.int32()),
                         "keys": pa.array([packed_keys(found[c]) for c in cut], pa.binary()),
                         "counts": pa.array([packed(total[c]) for c in cut], pa.binary()),
                         "held": pa.array([packed(blocks[c]) for c in cut], pa.binary())})

    def back(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.schema([("of_block", pa.int64()), ("slice", pa.int32()), ("totals", pa.binary())]).empty_table()
        found, total, places, _ = add_up(*_read(table, size))
        edge = finer(found, table["slice"][0].as_py())
        for f, t in zip(told["fine"].to_pylist(), told["totals"].to_pylist()):
            total[edge[f]:edge[f + 1]] = unpacked(t, size)
        return pa.table({"of_block": table["of_block"], "slice": table["slice"],
                         "totals": pa.array([packed(total[p]) for p in places], pa.binary())})

    gathered = sent.groupBy("part", "slice").applyInArrow(gather, "slice int, fine int, part int, keys binary, counts binary, held binary")
    met = gathered.groupBy("slice", "fine").applyInArrow(
        lambda t: answer(t, "part"), "part int, slice int, fine int, totals binary, sums array<long>")
    met, got = added(met)
    told = met.select(F.col("part").alias("to_part"), F.col("slice").alias("to_slice"), "fine", "totals")
    return (sent.groupBy("part", "slice").cogroup(told.groupBy("to_part", "to_slice"))
            .applyInArrow(back, "of_block long, slice int, totals binary")), got
