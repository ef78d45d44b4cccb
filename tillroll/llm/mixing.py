"""Mixing sources to target weights (operator 13).

Every source's words are a stream: its documents in an order by hash, one behind the other, cut
into blocks of equal length. A target says how many words of the stream the mix takes, at most
``limit`` times over. Blocks are drawn in a permuted order, one permutation for each time
round, so the drawn ones are disjoint until all were drawn; the last is cut to fit. Which output shard gets
how many blocks of each source is drawn by a multivariate-hypergeometric splitting tree: the root holds each
source's block quota, a node hands its left half of the shards a random share of its blocks, all
sources together without replacement, and the right half the rest, down to single
shards; so the quotas add up exactly. A shard's pieces are put in an order of their own.

A document's place in its stream is a sum over buckets of the order plus a sum in its bucket, a block's place
in a permutation is a formula, and the words drawn before a block are another, so no task ever
sees a whole source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import mix as mixed_bits
from tillroll.llm.common import read, ship, stored

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text) -> F.Column:
    """Words of the text; none in a null one."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Each ``i`` below its ``n`` to its place in a permutation of ``range(n)`` chosen by its ``key``.

    A Feistel network of four rounds over the next even number of bits; what falls beyond ``n``
    goes through again, which ends as the network is a permutation itself.
    """
    x, n, key = (np.array(v, np.uint64) for v in (i, n, key))
    bits = np.frexp(np.maximum(n.astype(np.float64) - 1, 1))[1]          # of the largest number below n
    half = ((bits + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    open_ = np.ones(len(x), bool)
    while open_.any():
        left, right = x[open_] >> half[open_], x[open_] & mask[open_]
        for turn in range(4):
            f = mixed_bits(right + key[open_] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn + 1))
            left, right = right, left ^ (f & mask[open_])
        x[open_] = (left << half[open_]) | right
        open_ = x >= n
    return x.astype(np.int64)


def targets(sources: DataFrame, weights=(3, 1, 2), share: float = 1.5, limit: int = 2, max_rounds: int = 1000) -> DataFrame:
    """``sources(source, source_size)``, one row per source, with ``number``, ``weight`` and ``target``.

    Sources in code-point order, null last, get the weights in turn and share ``share`` times all sizes by
    weight; a target stops at ``limit`` times its source's size, and the excess is shared again by weight
    until none is above: all others then have one figure per weight, which grows from round to round.
    """
    listed = _numbered(sources)
    listed = stored(listed.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))), "sources")
    cap, w = F.lit(limit) * F.col("source_size"), F.col("weight")
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    for _ in range(max_rounds):
        full = cap <= level * w
        held, left = listed.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
                                F.coalesce(F.sum(F.when(~full, w)), F.lit(0))).first()
        new = (share * total - held) / left if left else level
        if new <= level:
            break
        level = new
    else:
        raise RuntimeError(f"targets still change after {max_rounds} rounds")
    return listed.withColumn("target", F.least(cap.cast("double"), F.lit(float(level)) * w))


def _numbered(sources: DataFrame) -> DataFrame:
    """``number`` from 0 in code-point order, null last, without one task that sees all."""
    order = [F.col("source").isNull(), F.col("source")]
    ranged = stored(sources.repartitionByRange(64, *order).withColumn("part", F.spark_partition_id()), "sources")
    sizes = {r["part"]: r["count"] for r in ranged.groupBy("part").count().collect()}      # 64 at most
    before, at = {}, 0
    for part in sorted(sizes):
        before[part], at = at, at + sizes[part]
    if not before:
        return ranged.select("source", "source_size", F.lit(0).cast("long").alias("number"))
    first = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return ranged.select("source", "source_size", (F.element_at(first, F.col("part")) + place).cast("long").alias("number"))


def shard_quotas(quotas: DataFrame, shards: int, blocks: int, seed: int) -> DataFrame:
    """``quotas(number, quota)`` of ``blocks`` in all to ``(number, shard, first, quota)``: a shard's run of each source's draws.

    One level of the tree is one grouping by node; a node's rows are the sources it has blocks of. The draw depends on
    seed and node alone.
    """
    def split(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        if hi - lo == 1:
            return table
        mid = (lo + hi) // 2
        quota, first = table["quota"].to_numpy(), table["first"].to_numpy()
        capacity = blocks * mid // shards - blocks * lo // shards
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        left = rng.multivariate_hypergeometric(quota, capacity, method="marginals")
        parts = []
        for a, b, q, f in ((lo, mid, left, first), (mid, hi, quota - left, first + left)):
            has = np.flatnonzero(q)
            parts.append(pa.table([table["number"].take(pa.array(has)), pa.array(np.full(len(has), a, np.int64)),
                                   pa.array(np.full(len(has), b, np.int64)), pa.array(f[has]), pa.array(q[has])],
                                  names=["number", "lo", "hi", "first", "quota"]))
        return pa.concat_tables(parts)

    nodes = quotas.where("quota > 0").select("number", F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"),
                                             F.lit(0).cast("long").alias("first"), "quota")
    for _ in range(max(0, int(shards - 1).bit_length())):
        nodes = nodes.groupBy("lo", "hi").applyInArrow(split, "number long, lo long, hi long, first long, quota long")
    return nodes.select("number", F.col("lo").alias("shard"), "first", "quota")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=(3, 1, 2),
        share: float = 1.5, limit: int = 2, seed: int = 13, block_words: int = 16_384, shard_blocks: int = 256,
        bucket_docs: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """Returns ``(listed, pieces)``.

    ``listed``: one row per row of ``docs``: doc_id, number (of its source), size, source_size, target, start (its
    place in its source's stream; with size > 0 number and start name the row). ``pieces``: what the mix holds, one row per
    drawn piece of a document: shard, place (in the shard), doc_id, number, start, round (from 0), word (the
    piece's first word in the document), n_words.

    A source's pieces have ``round(target)`` words in all; none of its words is drawn more than ``limit`` times, and none
    twice before all were drawn once. The same rows give the same mix, however they are partitioned.
    Null and wordless texts are listed and have no piece. Null is a source of its own. Rows that are equal in id, source
    and text are documents of their own (which of them is drawn is all one). An empty table gives empty ones.
    Blocks hold ``block_words`` words, or more where there would be over 2^28 blocks.
    """
    ship(docs.sparkSession)
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                        F.col(f"`{text}`").alias("text"))
    sized = given.select("doc_id", "source", word_count("text").alias("size"),
                         F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text").alias("h"))
    # equal rows are counted before they meet
    rows = stored(sized.groupBy("source", "doc_id", "size", "h").agg(F.count("*").alias("copies")), "sized")
    by_source = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    aims = stored(targets(by_source, weights, share, limit)
                  .withColumn("take", F.round("target").cast("long")), "targets")
    n_rows, total = rows.agg(F.count("*"), F.sum(F.col("size") * F.col("copies"))).first()
    block = max(block_words, -(-(total or 0) * limit // (1 << 28)))
    buckets = max(1, -(-n_rows // bucket_docs))

    # place in the stream: buckets are ranges of the hash
    bucket = F.least(F.floor((F.col("h") / F.lit(2.0 ** 64) + 0.5) * buckets), F.lit(buckets - 1)).cast("long")
    named = rows.join(aims.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    named = named.withColumn("bucket", bucket).withColumn("all", F.col("size") * F.col("copies"))
    in_order = Window.partitionBy("number", "bucket").orderBy("h", F.col("doc_id").asc_nulls_first(), "size")
    sums = named.groupBy("number", "bucket").agg(F.sum("all").alias("all"))
    starts = sums.select("number", "bucket", F.coalesce(F.sum("all").over(
        Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"))
    within = F.coalesce(F.sum("all").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = named.withColumn("within", within).join(starts, ["number", "bucket"])
    listed = placed.select("doc_id", "number", "size", "source_size", "target", "take", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), (F.col("begin") + F.col("within")).alias("at"))
    listed = stored(listed.select("doc_id", "number", "size", "source_size", "target", "take",
                                  (F.col("at") + F.col("copy") * F.col("size")).alias("start")), "listed")

    pieces = _drawn(listed, block, limit, seed)
    quotas = stored(pieces.groupBy("number").agg((F.max("draw") + 1).alias("quota")), "quotas")
    drawn = quotas.agg(F.sum("quota")).first()[0] or 0
    shards = max(1, -(-drawn // shard_blocks))
    runs = shard_quotas(quotas, shards, drawn, seed)
    owners = runs.select("number", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)).alias("draw"))
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "number", "start", "word", "round"),
                                                "number", "start", "word", "round")
    return listed, pieces.join(owners, ["number", "draw"]).select(
        "shard", (F.row_number().over(local) - 1).alias("place"), "doc_id", "number", "start", "round", "word", "n_words")


def _drawn(listed: DataFrame, block: int, limit: int, seed: int) -> DataFrame:
    """The pieces of documents that lie in drawn blocks: doc_id, number, start, round, word, n_words, draw.

    ``draw`` counts a source's drawn blocks over all rounds, in the order of drawing.
    """
    end = F.col("start") + F.col("size")
    cut = listed.where("size > 0 and take > 0").select(
        "doc_id", "number", "size", "source_size", "take", "start",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).alias("block"))

    def draw(batches):
        for batch in batches:
            c = {name: batch.column(k).to_numpy(zero_copy_only=False) for k, name in enumerate(batch.schema.names) if k}
            ids = batch.column(0)
            n = -(-c["source_size"] // block)                  # blocks of the source
            last = c["source_size"] - (n - 1) * block          # words of its last one
            words = np.where(c["block"] == n - 1, last, block)
            for turn in range(limit):
                quota = np.clip(c["take"] - turn * c["source_size"], 0, c["source_size"])
                key = mixed_bits(c["number"].astype(np.uint64) * np.uint64(limit) + np.uint64(turn) + np.uint64(seed << 32))
                place = permuted(c["block"], n, key)
                short = permuted(n - 1, n, key)                # where the short block comes
                before = place * block - np.where(short < place, block - last, 0)
                taken = np.clip(quota - before, 0, words)
                a = np.maximum(c["start"], c["block"] * block)
                b = np.minimum(c["start"] + c["size"], c["block"] * block + taken)
                has = np.flatnonzero(b > a)
                take = lambda v: pa.array(v[has].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(has)), take(c["number"]), take(c["start"]), pa.array(np.full(len(has), turn, np.int32)),
                     take(a - c["start"]), take(b - a), take(place + turn * n)],
                    names=["doc_id", "number", "start", "round", "word", "n_words", "draw"])

    return cut.mapInArrow(draw, "doc_id long, number long, start long, round int, word long, n_words long, draw long")


def query(spark, sf_dir):
    listed, pieces = mix(read(spark, sf_dir, "documents"))
    # rows with words are named by source and place; the others have no pieces
    taken = pieces.groupBy("number", "start").agg(F.sum("n_words").alias("taken"))
    full = listed.where("size > 0").join(taken, ["number", "start"], "left")
    none = listed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return full.unionByName(none).select("doc_id", "size", "source_size", "target",
                                         F.coalesce("taken", F.lit(0)).alias("taken"))
