"""Benchmark decontamination by greedy string tiling (operator 6).

Seeds are runs of ``min_match`` words that a document shares with a benchmark
item, found by a running Karp-Rabin hash. Seeds on one diagonal grow into
matches; the longest match is marked as a tile, matches that overlap marked
words shrink, and so on until no match of ``min_match`` words is left. The
share of the item's words under tiles decides, so reordered passages count
as much as whole ones.

Both sides are tables of any size: seeds are joined by hash. A bitmap of the items' seeds, of fixed size, passes over
almost all places of a document first, so that only texts that may share a seed are written and shuffled. Each
pair of a text and an item with a common seed is tiled once, in groups of a bounded number of items per text.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import free_prefix, mix, read, ship, signed, stored
from tillroll.llm.repeated_passages import powers

_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, lower-cased: punctuation and white space don't count."""
    return _WORD.findall(text.lower()) if text else []


def seeds(codes: np.ndarray, n: int) -> np.ndarray:
    """Running Karp-Rabin hash of every run of ``n`` codes."""
    if len(codes) < n:
        return np.empty(0, np.uint64)
    h = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        h = h * _BASE + codes[k:len(codes) - n + 1 + k]
    return mix(h)


def tiles(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from the seeds (item place, document place) of ``n`` words each.

    Returns (item place, document place, length), no two overlapping in the item or in the
    document, the longest first; of equals the one earliest in the item, then in the document.
    """
    order = np.lexsort((i, j - i))
    i, j = i[order].astype(np.int64), j[order].astype(np.int64)
    out = []
    while len(i):
        starts = np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)])
        first = np.flatnonzero(starts)
        length = np.diff(np.concatenate([first, [len(i)]])) + n - 1
        best = np.lexsort((j[first], i[first], -length))[0]
        a, b, size = int(i[first[best]]), int(j[first[best]]), int(length[best])
        out.append((a, b, size))
        # a seed goes once one of its words is marked on either side
        free = ((i + n <= a) | (i >= a + size)) & ((j + n <= b) | (j >= b + size))
        i, j = i[free], j[free]
    return out


def tiles_by_length(item: np.ndarray, doc: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """What ``tiles`` returns, from the words' codes and without all pairs of seeds.

    For texts that repeat themselves, whose pairs of seeds are as many as the product of their lengths: the
    length of the longest match of unmarked words is found by halving, with the running hash of
    all runs of one length; its first place in the item, and there in the document, is marked.
    """
    free_i, free_j = np.ones(len(item), bool), np.ones(len(doc), bool)
    out = []

    def runs(codes, free, size):
        """Places and hashes of the unmarked runs of this length."""
        if len(codes) < size:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        marked = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(marked[size:] == marked[:-size])
        return at, run_hashes(codes, size)[at]

    def shared(size):
        i, of_item = runs(item, free_i, size)
        j, of_doc = runs(doc, free_j, size)
        both = np.isin(of_item, of_doc)
        if not both.any():
            return None
        first = int(np.argmax(both))
        return int(i[first]), int(j[np.argmax(of_doc == of_item[first])]), size

    most = min(len(item), len(doc))
    while most >= n:
        low, high, best = n, most, None
        while low <= high:
            size = (low + high) // 2
            found = shared(size)
            if found:
                best, low = found, size + 1
            else:
                high = size - 1
        if best is None:
            return out
        a, b, most = best
        out.append(best)
        free_i[a:a + most] = False
        free_j[b:b + most] = False
    return out


def run_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``size`` codes, by prefix sums: equal runs have equal ones wherever they stand."""
    up, down = powers(len(codes))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes) * up[:-1], dtype=np.uint64)])
    return mix((total[size:] - total[:-size]) * down[:len(codes) - size + 1])


class Coder:
    """Codes of words: each distinct word is hashed once while it is remembered."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.known) > 1_000_000:
            self.known = {}
        words, known = tokens(text), self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


class Block:
    """Some benchmark items, ``(id, codes of the words)``, and their seeds, in order of hash."""

    def __init__(self, items: list[tuple], min_match: int):
        self.items = []
        found = defaultdict(list)
        for item_id, codes in items:
            n = min(min_match, len(codes))
            if not n:
                continue
            h = seeds(codes, n)
            found[n].append((h, np.full(len(h), len(self.items)), np.arange(len(h))))
            self.items.append((item_id, codes, n))
        #: by seed length: hashes in order with their items and places
        self.seeds = {}
        for n, parts in found.items():
            h, item, place = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((place, item, h))
            self.seeds[n] = h[order], item[order], place[order]

    def coverage(self, codes: np.ndarray) -> list[tuple]:
        """(item, share of its words under tiles, words under tiles) for every item with a seed in the text."""
        out = []
        for n, (known, of, places) in self.seeds.items():
            h = seeds(codes, n)
            at = np.arange(len(h))
            low, high = np.searchsorted(known, h), np.searchsorted(known, h, side="right")
            at, low, high = at[high > low], low[high > low], high[high > low]
            if not len(at):
                continue
            # how many pairs each item has, without making them
            step = np.bincount(low, minlength=len(known) + 1) - np.bincount(high, minlength=len(known) + 1)
            times = np.cumsum(step)[:-1]
            pairs = np.bincount(of, times, len(self.items)).astype(np.int64)
            few = np.flatnonzero((pairs > 0) & (pairs <= FEW_PAIRS))
            for item in np.flatnonzero(pairs > FEW_PAIRS):
                out.append(self._judged(item, tiles_by_length(self.items[item][1], codes, n)))
            for some in _by_sum(few, pairs[few], 8 * FEW_PAIRS):
                out += self._tiled(n, some, known, of, places, at, low, high)
        return out

    def _tiled(self, n, some, known, of, places, at, low, high):
        """Items of few pairs, from the pairs themselves."""
        keep = np.flatnonzero(np.isin(of, some))
        # ranges among the kept seeds
        low, high = np.searchsorted(keep, low), np.searchsorted(keep, high)
        count = high - low
        place = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        item, i, j = of[keep][place], places[keep][place], np.repeat(at, count)
        order = np.argsort(item, kind="stable")
        item, i, j = item[order], i[order], j[order]
        edge = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1], [True]]))
        return [self._judged(item[a], tiles(i[a:b], j[a:b], n)) for a, b in zip(edge[:-1], edge[1:])]

    def _judged(self, item, found) -> tuple[int, float, int]:
        item_id, codes, _ = self.items[item]
        covered = sum(t[2] for t in found)
        return item_id, covered / len(codes), covered


#: Pairs of seeds of an item and a document that are made; items of more are tiled by length.
FEW_PAIRS = 50_000


def _by_sum(items: np.ndarray, sizes: np.ndarray, most: int):
    """The items in runs whose sizes add up to about ``most``."""
    if len(items):
        yield from np.split(items, np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1)


#: Bits of the bitmap of seeds that is broadcast (8 MB), whatever the number of items.
FILTER_BITS = 26


def _benchmark(benchmark: DataFrame, item_id: str, text: str, min_match: int) -> DataFrame:
    """One row per distinct item with words: key, id, codes of its words, and its distinct seeds."""
    given = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")

    def run(batches):
        code = Coder()
        for batch in batches:
            found = [code(t) for t in batch.column(2).to_pylist()]
            distinct = [np.unique(seeds(c, min(min_match, len(c)))) if len(c) else np.empty(0, np.uint64) for c in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes() for c in found], pa.binary()),
                 pa.array([min(min_match, len(c)) for c in found], pa.int32()),
                 pa.array([signed(d) for d in distinct], pa.list_(pa.int64()))], names=["item", "id", "codes", "n", "seeds"])

    rows = given.distinct().select(F.xxhash64(F.col("id").isNull(), "id", "text").alias("item"), "id", "text")
    return rows.mapInArrow(run, "item long, id long, codes binary, n int, seeds array<long>").where("n > 0")


def _bitmap(items: DataFrame) -> np.ndarray:
    """A bit for every hash of a seed, cut to ``FILTER_BITS``; its parts are made in tasks."""
    bit = F.col("seed").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bits = items.select(F.explode("seeds").alias("seed")).select(bit.alias("bit")).distinct().select(
        F.shiftright("bit", 16).cast("int").alias("part"), F.col("bit").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("bit"))

    def part_bits(table: pa.Table) -> pa.Table:
        hit = np.zeros(1 << 16, bool)
        hit[table["bit"].to_numpy()] = True
        return pa.table({"part": table["part"].slice(0, 1), "bits": pa.array([np.packbits(hit).tobytes()], pa.binary())})

    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in bits.groupBy("part").applyInArrow(part_bits, "part int, bits binary").collect():
        out[r["part"] << 13:(r["part"] + 1) << 13] = np.frombuffer(r["bits"], np.uint8)
    return out


def text_keys(text: str) -> list:
    """Two 64-bit hashes that name a text."""
    return [F.xxhash64(f"`{text}`"), F.xxhash64(F.lit(6), f"`{text}`")]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", min_match: int = 5, threshold: float = 0.6,
                       min_covered: int = 5, group_items: int = 2000, prefix: str = "") -> DataFrame:
    """Add ``item_id``, ``coverage``, ``covered`` and ``contaminated`` to each row of ``docs``.

    An item condemns a document (``contaminated``) if tiles of ``min_match`` words or more cover a share of
    ``threshold`` of its words there, and ``min_covered`` words or the length of the whole document: an item of a word or
    two condemns no text that merely holds it. ``coverage`` is the largest such share of an item, of those that
    condemn the document if any do; ``item_id`` the item (of
    equals the one with more words covered, then the smaller id; null ids last), ``covered`` its words
    under tiles. Items shorter than ``min_match`` words match as a whole.

    Words are runs of ``\\w`` in lower case; the whole text is read. A null or
    empty text, or one without a seed, has item_id null, coverage 0 and is clean. Null
    and empty items match nothing; repeated items and rows, and empty tables, are
    fine. The four columns replace those of the same name; ``prefix`` goes before their names.

    Equal texts are judged once. A text with very many items in question is dealt out, ``group_items`` of them
    at a time; a seed that very many texts and items hold is a key of a join that can be split.
    """
    spark = ship(docs.sparkSession)
    items = stored(_benchmark(benchmark, item_id, item_text, min_match), "items")
    lengths = [r["n"] for r in items.select("n").distinct().collect()]         # min_match at most
    bits = spark.sparkContext.broadcast(_bitmap(items))
    mask = np.uint64((1 << FILTER_BITS) - 1)

    def sought(batches):
        """Texts with a place that the bitmap lets through, and the distinct hashes of these places."""
        code, table = Coder(), bits.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, hashes = [], []
                for k, t in enumerate(part.column(2).to_pylist()):
                    codes = code(t)
                    found = []
                    for n in lengths:
                        h = seeds(codes, n)
                        b = (h & mask).astype(np.int64)
                        found.append(h[(table[b >> 3] >> (7 - (b & 7)).astype(np.uint8)) & 1 > 0])
                    some = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
                    if len(some):
                        rows.append(k)
                        hashes.append(signed(some))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [*(c.take(pa.array(rows)) for c in part.columns), pa.array(hashes, pa.list_(pa.int64()))],
                        names=["one", "two", "text", "seeds"])

    one, two = text_keys(text)
    asked = docs.where(F.col(f"`{text}`").isNotNull()).select(one.alias("one"), two.alias("two"), F.col(f"`{text}`").alias("text"))
    held = stored(asked.mapInArrow(sought, "one long, two long, text string, seeds array<long>")
                  .dropDuplicates(["one", "two"]), "sought")
    pairs = (held.select("one", "two", F.explode("seeds").alias("seed"))
             .join(items.select("item", F.explode("seeds").alias("seed")), "seed").select("one", "two", "item").distinct())
    pairs = stored(pairs, "seed_pairs")
    groups = pairs.groupBy("one", "two").agg(F.ceil(F.count("*") / group_items).cast("int").alias("groups"))
    of_item = pairs.join(groups, ["one", "two"]).withColumn("part", F.pmod(F.xxhash64("item"), F.col("groups")).cast("int"))
    of_item = of_item.join(items.select("item", "id", "codes"), "item").select(
        F.col("one").alias("a"), F.col("two").alias("b"), F.col("part").alias("p"), "id", "codes")
    dealt = held.select("one", "two", "text").join(groups, ["one", "two"]).select(
        "one", "two", "text", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))

    def judge(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not texts.num_rows or not found.num_rows:
            return _JUDGED.empty_table()
        block = Block([(i, np.frombuffer(c, np.uint64)) for i, c in zip(found["id"].to_pylist(), found["codes"].to_pylist())], min_match)
        codes = Coder()(texts["text"][0].as_py())
        got = block.coverage(codes)
        if not got:
            return _JUDGED.empty_table()
        enough = min(min_covered, len(codes))
        item, share, words, guilty = max(((*g, g[1] >= threshold and g[2] >= enough) for g in got),
                                         key=lambda x: (x[3], x[1], x[2], x[0] is not None, -(x[0] or 0)))
        return pa.table([texts["one"].slice(0, 1), texts["two"].slice(0, 1), pa.array([item], pa.int64()),
                         pa.array([share], pa.float64()), pa.array([words], pa.int32()), pa.array([guilty])], schema=_JUDGED)

    judged = dealt.groupBy("one", "two", "part").cogroup(of_item.groupBy("a", "b", "p")).applyInArrow(
        judge, "one long, two long, item long, share double, words int, guilty boolean")
    best = F.max(F.struct("guilty", "share", "words", F.col("item").isNotNull().alias("named"), (-F.col("item")).alias("minus")))
    best = judged.groupBy("one", "two").agg(best.alias("best"))

    free = free_prefix(docs)
    names = [f"{prefix}{c}" for c in ("item_id", "coverage", "covered", "contaminated")]
    told = stored(best.select(F.col("one").alias(f"{free}one"), F.col("two").alias(f"{free}two"), (-F.col("best.minus")).alias(f"{free}i"),
                              F.col("best.share").alias(f"{free}s"), F.col("best.words").alias(f"{free}w"), F.col("best.guilty").alias(f"{free}g")), "judged")
    joined = docs.join(told, (one == F.col(f"{free}one")) & (two == F.col(f"{free}two")), "left")
    share, words = F.coalesce(f"{free}s", F.lit(0.0)), F.coalesce(f"{free}w", F.lit(0))
    gone = {n.lower() for n in names}
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in gone], F.col(f"{free}i").alias(names[0]),
                         share.alias(names[1]), words.alias(names[2]),
                         F.coalesce(f"{free}g", F.lit(False)).alias(names[3]))


_JUDGED = pa.schema([("one", pa.int64()), ("two", pa.int64()), ("item", pa.int64()), ("share", pa.float64()), ("words", pa.int32()),
                     ("guilty", pa.bool_())])


def query(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return (find_contamination(docs, read(spark, sf_dir, "benchmark"))
            .select("doc_id", "contaminated", "item_id", "coverage", "covered"))
