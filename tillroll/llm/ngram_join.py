"""Jaccard join of documents on word n-grams, in size-banded tiles with bitmap signatures.

Sets that reach the threshold share at least one n-gram among the rarest ones of
each, taken in one order for all: by how many sets hold it, then by hash. N-grams
that only one set holds link nothing, so a set that has many of them is done with.
Sets that share a rare n-gram are connected, and each connected group, band by band of
set sizes, makes the tiles in which sets are compared: first by hashed bitmaps
(the bits in which two differ bound the overlap from above), then by exact
intersection of the sorted hash arrays. A set also visits the bands of
smaller sizes that it may link with.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import (
    mix, ngram_hashes, packed, packed_keys, read, ship, signed, slices, stored, unpacked, unpacked_keys,
    word_hashes, words,
)
from tillroll.llm.components import connected_components
from tillroll.llm.totals import SENT, corpus_totals, messages, slice_count

#: Upper end of a size band over its lower end.
BAND = 1.35


def band_starts(limit: int) -> np.ndarray:
    """Smallest size of each band, up to the band that holds ``limit``."""
    starts = [1]
    while starts[-1] <= limit:
        starts.append(max(starts[-1] + 1, math.floor(starts[-1] * BAND)))
    return np.array(starts)


def set_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words; of the whole sequence if it is shorter, none if empty."""
    if len(hashes) == 0:
        return np.empty(0, np.uint64)
    return np.unique(ngram_hashes(hashes, min(n, len(hashes))))


def word_sets(texts: list[str | None], n: int, room: int = 1 << 20) -> list[np.ndarray]:
    """The sets of the texts, cut into words some ``room`` characters at a time: lists of words take ten times a text's room."""
    sets, some, size = [], [], 0
    for k, text in enumerate(texts):
        some.append(words(text))
        size += len(text or "")
        if size >= room or k == len(texts) - 1:
            sets += [set_of(h, n) for h in word_hashes(some)]
            some, size = [], 0
    return sets


def bands_of(size: int, num: int, den: int, starts: np.ndarray) -> list[int]:
    """The set's own band, and the lower ones with sizes that reach the threshold with it."""
    own = int(np.searchsorted(starts, size, "right")) - 1
    least = max(1, -(-num * size // den))
    low = int(np.searchsorted(starts, least, "right")) - 1
    return list(range(own, low - 1, -1))


def rare_part(s: np.ndarray, held_by: np.ndarray, num: int, den: int) -> np.ndarray:
    """The rarest hashes of a set, of which any set that reaches the threshold with it shares one.

    ``held_by`` counts the sets that hold each hash (a bound and a rounding alike
    for all sets do no harm). Those that no other set holds are left out.
    """
    size = len(s) - -(-num * len(s) // den) + 1
    rare = np.lexsort((s, held_by))[:size]
    return s[rare[held_by[rare] > 1]]


def describe_sets(given: DataFrame, n: int, num: int, den: int, block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_shingles, digest, bands, parts (rare hashes) and, where it has parts, text of each row.

    Documents are dealt into blocks of about ``block_bytes`` of text by a hash of
    id and text. A block sends its distinct hashes, cut to 48 bits, as sorted slices with the
    number of its different sets that hold each; the sums come back.
    """
    starts = band_starts(1 << 40)
    size = given.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"]
    blocks_n = max(1, -(-(size or 0) // block_bytes))
    slices_n = slice_count(blocks_n)
    cut_bits = np.uint64(16)
    blocks = given.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks_n)).cast("long"))

    def block_sets(texts):
        sets = word_sets(texts, n)
        return sets, [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets]

    def block_keys(sets, digests):
        """Distinct short hashes of the block's different sets, and how many sets hold each."""
        different = {d: s for s, d in zip(sets, digests) if d is not None}
        every = np.concatenate([np.empty(0, np.uint64), *(np.unique(s >> cut_bits) for s in different.values())])
        return np.unique(every, return_counts=True)

    def count(table: pa.Table) -> pa.Table:
        keys, counts = block_keys(*block_sets(table["text"].to_pylist()))
        sent = messages(table["block"][0].as_py(), keys << cut_bits, np.minimum(counts, 255).astype(np.uint8), slices_n)
        return pa.Table.from_batches([sent])

    def describe(table: pa.Table, told: pa.Table) -> pa.Table:
        sets, digests = block_sets(table["text"].to_pylist())
        keys, _ = block_keys(sets, digests)
        total = np.zeros(len(keys), np.uint8)
        edge = slices(keys << cut_bits, slices_n)
        for k, t in zip(told["slice"].to_pylist(), told["totals"].to_pylist()):
            total[edge[k]:edge[k + 1]] = unpacked(t, np.uint8)
        parts = [rare_part(s, total[np.searchsorted(keys, s >> cut_bits)], num, den) if len(s) else s for s in sets]
        return pa.table({
            "doc_id": table["doc_id"], "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "digest": pa.array(digests, pa.binary()),
            "bands": pa.array([bands_of(len(s), num, den, starts) if len(s) else [] for s in sets], pa.list_(pa.int32())),
            "parts": pa.array([signed(p) for p in parts], pa.list_(pa.int64())),
            "text": pa.array([t if len(p) else None for t, p in zip(table["text"].to_pylist(), parts)], pa.string())})

    sent = blocks.groupBy("block").applyInArrow(count, SENT)
    answers, _ = corpus_totals(sent, blocks_n, np.uint8)
    return (blocks.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(
        describe, "doc_id long, n_shingles long, digest binary, bands array<int>, parts array<long>, text string"))


def sharing(sets: DataFrame, slice_keys: int = 1_500_000) -> DataFrame:
    """Links (a, b) between documents that share one of their ``parts``: each to the smallest id that has it.

    Tasks send the parts as sorted slices with the smallest id of each, not as rows; about
    ``slice_keys`` of them meet in one place, where each comes once from a run of
    documents, however many hold it.
    """
    total = sets.agg(F.sum(F.size("parts")).alias("n")).first()["n"] or 0
    n = max(1, -(-total // slice_keys))

    def pairs(of: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct links of ids with the smaller ones that they meet."""
        found = np.unique(np.stack([of, low])[:, of != low], axis=1)
        return found[0], found[1]

    def smallest(keys, ids):
        """Distinct keys in order, the smallest id of each, and the links of the others to it."""
        found, at = np.unique(keys, return_inverse=True)
        low = np.full(len(found), np.iinfo(np.int64).max)
        np.minimum.at(low, at, ids)
        return found, low, *pairs(ids, low[at])

    def send(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(1)
                counts = lists.value_lengths().to_numpy(zero_copy_only=False)
                held.append((lists.flatten().to_numpy().view(np.uint64), np.repeat(part.column(0).to_numpy(), counts)))
                size += len(held[-1][0])
                if size >= slice_keys:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)

    def flush(held):
        keys, low, a, b = smallest(*(np.concatenate(x) for x in zip(*held)))
        edge = slices(keys, n)
        full = np.flatnonzero(np.diff(edge))
        cut = [slice(edge[k], edge[k + 1]) for k in full]
        # links found here travel with the first slice
        own = [packed(x) if k == 0 else packed(x[:0]) for x in (a, b) for k in range(len(full))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([packed_keys(keys[c]) for c in cut], pa.binary()),
             pa.array([packed(low[c]) for c in cut], pa.binary()),
             pa.array(own[:len(full)], pa.binary()), pa.array(own[len(full):], pa.binary())],
            names=["slice", "keys", "ids", "a", "b"])

    def meet(table: pa.Table) -> pa.Table:
        ids = [np.concatenate([unpacked(x, np.int64) for x in table[c].to_pylist()]) for c in ("ids", "a", "b")]
        keys = np.concatenate([unpacked_keys(x) for x in table["keys"].to_pylist()])
        _, _, a, b = smallest(keys, ids[0])
        a, b = pairs(np.concatenate([a, ids[1]]), np.concatenate([b, ids[2]]))
        return pa.table({"a": a, "b": b})

    return (sets.where("doc_id is not null and size(parts) > 0").select("doc_id", "parts")
            .mapInArrow(send, "slice int, keys binary, ids binary, a binary, b binary")
            .groupBy("slice").applyInArrow(meet, "a long, b long"))


def needed(a, b, num: int, den: int):
    """Least overlap of sets of these sizes that reaches num / den."""
    return -(-num * (a + b) // (num + den))


def tile_forest(ids: list[int], sets: list[np.ndarray], mine: np.ndarray, home: np.ndarray,
                num: int, den: int, across: bool) -> list[tuple[int, int]]:
    """Links between the sets of a tile that join its parts; no pair within a part is tested again.

    Only pairs with a set at home are meant, and with ``across`` only those of
    the two different shares ``mine``.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[k]) for k in order], np.int64)
    ids, sets, mine, home = [ids[k] for k in order], [sets[k] for k in order], mine[order], home[order]
    width = 64
    while width < min(4 * size.max(initial=1), 1 << 14):
        width *= 2
    maps = np.empty((len(sets), width // 64), np.uint64)
    bits = np.zeros(width, bool)
    for k, s in enumerate(sets):
        bits[:] = False
        bits[(mix(s) >> np.uint64(20)).astype(np.int64) % width] = True
        maps[k] = np.packbits(bits).view(np.uint64)
    part, forest = np.arange(len(sets)), []
    for i in range(len(sets) - 1):
        end = int(np.searchsorted(size, size[i] * den // num, "right"))
        j = np.arange(i + 1, end)
        j = j[(part[j] != part[i]) & (home[j] | home[i])]
        if across:
            j = j[mine[j] != mine[i]]
        if not len(j):
            continue
        differ = np.bitwise_count(maps[j] ^ maps[i]).sum(axis=1, dtype=np.int64)
        j = j[(size[i] + size[j] - differ) // 2 >= needed(size[i], size[j], num, den)]
        for k in j:
            if part[k] == part[i]:
                continue
            both = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if den * both >= num * (size[i] + size[k] - both):
                forest.append((ids[i], ids[k]))
                part[part == part[k]] = part[i]
    return forest


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5,
                      num: int = 80, den: int = 100, tile_hashes: int = 2_000_000, tile_rows: int = 2048) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set
    are its distinct runs of ``n`` words, of the whole text; with fewer words
    the whole sequence. Documents link if ``den`` times the intersection is at
    least ``num`` times the union. ``component_id`` is the smallest id
    reachable by links, itself included.

    Null or empty texts, and texts without words, have size 0 and link with
    nothing. A row with a null id takes the component of its copies, else null;
    rows that repeat an id are one document and share its component. Extra columns
    are not read; an empty table gives an empty one.

    Equal sets meet as one. A crowded tile is dealt out in pairs of shares of
    at most ``tile_hashes`` hashes and ``tile_rows`` sets, so no task holds a group.
    """
    ship(docs.sparkSession)
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    sets = stored(describe_sets(given, n, num, den), "sets")
    # written, so that joins with it have a shuffle of their own, whose crowded digests can be split
    classes = stored(sets.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")

    group = stored(connected_components(sharing(sets)), "groups")
    shown = (sets.where("text is not null").select("doc_id", "digest", "n_shingles", "bands")
             .join(classes.select(F.col("digest").alias("of"), "rep"),
                   (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("rep"))))

    # tiles: band by band within a group, dealt out by hash if crowded
    member = (shown.join(group, F.col("rep") == F.col("node"))
              .select("rep", "component", "n_shingles", "digest", F.posexplode("bands").alias("at", "band"))
              .dropDuplicates(["digest", "band"]).withColumn("home", F.col("at") == 0))
    crowded = (member.groupBy("component", "band").agg(F.sum("n_shingles").alias("s"), F.count("*").alias("c"))
               .where("c > 1")
               .select("component", "band", F.ceil(F.greatest(
                   F.col("s") / tile_hashes, F.col("c") / tile_rows)).cast("int").alias("tiles")))
    dealt = (member.join(crowded, ["component", "band"])
             .withColumn("mine", F.pmod(F.xxhash64("digest"), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
             .select("rep", "digest", "component", "band", "home", "mine",
                     F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two")))
    with_text = (sets.where("text is not null").select(F.col("doc_id").alias("id"), F.col("digest").alias("of"), "text")
                 .join(dealt, (F.col("id") == F.col("rep")) & (F.col("of") == F.col("digest"))).drop("id", "of"))

    def match(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        t = table.drop_columns(["text"]).to_pydict()
        ids, sets, where, seen = [], [], [], set()
        for k, (s, d) in enumerate(zip(word_sets(table["text"].to_pylist(), n), t["digest"])):
            if d not in seen and xxhash.xxh128_digest(s.tobytes()) == d:  # not another row of that id
                seen.add(d)
                ids.append(t["rep"][k])
                sets.append(s)
                where.append(k)
        forest = tile_forest(ids, sets, np.array(t["mine"])[where], np.array(t["home"])[where],
                             num, den, t["one"][0] != t["two"][0])
        return pa.table({"a": pa.array([a for a, _ in forest], pa.int64()),
                         "b": pa.array([b for _, b in forest], pa.int64())})

    links = stored(with_text.groupBy("component", "band", "one", "two").applyInArrow(match, "a long, b long"), "links")
    # copies follow their class; only an id that comes with several texts links classes by itself
    several = (sets.where("doc_id is not null and digest is not null").groupBy(F.col("doc_id").alias("id"))
               .agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high").select("id"))
    own = (sets.join(several, F.col("doc_id") == F.col("id")).join(classes, "digest")
           .select(F.col("id").alias("a"), F.col("rep").alias("b")))
    component = connected_components(links.union(own))
    rep = classes.select(F.col("digest").alias("of"), "rep")
    return (sets.select("doc_id", "n_shingles", "digest").join(rep, F.col("digest") == F.col("of"), "left")
            .join(component, F.col("rep") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id")))


def query(spark, sf_dir):
    return similar_documents(read(spark, sf_dir, "documents"), n=3, num=90, den=100)


#: By definition: distinct 3-word shingles, every pair that shares one, components by reachability.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE x.n * 10 >= y.n * 9 AND y.n * 10 >= x.n * 9
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(l.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_of l ON l.a = w.doc_id
"""
