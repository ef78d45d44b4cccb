"""Near duplicates among embeddings: subspace pigeonhole join.

Vectors are scaled to length one and rotated by a fixed orthogonal matrix, then
split into blocks of coordinates. Two vectors of cosine >= c lie at a squared
distance <= 2 - 2c; shared out over the blocks in proportion to their width,
at least one block keeps within its share. So a range join within each block,
over a grid on the block's first coordinates, meets every such pair, and the
union of its candidates is verified with the cosine in double precision.

A pair counts in the first block whose share it keeps, and there meets in one
tile only, so counts add up without ever writing pairs: a tile gives one
row per vector and grid cell, with its number of links and one link to the
smallest id of its part of the tile.
"""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import append_columns, read, ship, stored
from tillroll.llm.components import connected_components, min_labels

#: Rotated coordinates count in these steps, as whole numbers: squared distances of blocks are
#: then exact, so that every tile finds the same first block for a pair.
STEPS = 1 << 23
#: Room in each share for that rounding; the cosine decides, so it only adds candidates.
SLACK = 4e-6


@functools.cache
def rotation(dim: int, seed: int = 20) -> np.ndarray:
    """A fixed orthogonal matrix, which spreads each vector evenly over the blocks."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int, blocks: int) -> list[int]:
    n = max(1, min(blocks, dim))
    return [dim * k // n for k in range(n + 1)]


def budgets(dim: int, blocks: int, cosine: float) -> list[float]:
    """Each block's share of the squared distance, by its width."""
    e = block_edges(dim, blocks)
    return [(2 - 2 * cosine) * (b - a) / dim + SLACK for a, b in itertools.pairwise(e)]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaled by the largest component first, so that no square overflows or vanishes."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def usable(v) -> np.ndarray | None:
    """The vector in double precision, or None if it is null, empty, zero or holds a null or non-finite value."""
    if v is None or len(v) == 0 or None in v:
        return None
    a = np.array(v, dtype=np.float64)
    return a if np.isfinite(a).all() and a.any() else None


def _cells(dim: int, y: np.ndarray, blocks: int, cosine: float, grid: int) -> list[list[str]]:
    """Per vector its cells, home cell of each block first ("h") and the smaller neighbours it visits ("v")."""
    edges, out = block_edges(dim, blocks), [[] for _ in y]
    for b, share in enumerate(budgets(dim, blocks, cosine)):
        g = min(grid, edges[b + 1] - edges[b])
        side = math.sqrt(share) * (1 + 1e-4)
        at = np.floor(y[:, edges[b]:edges[b] + g] / side).astype(np.int64)
        ahead = [o for o in itertools.product((-1, 0, 1), repeat=g) if o > (0,) * g]
        for k, row in enumerate(at):
            out[k].append(f"h{dim}/{b}/" + ",".join(map(str, row)))
            out[k] += [f"v{dim}/{b}/" + ",".join(map(str, row - np.array(o))) for o in ahead]
    return out


def tile_links(left: np.ndarray, right: np.ndarray, allowed, block: int, blocks: int,
               cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (row of ``left``, row of ``right``) that link and whose first block within its share is ``block``.

    ``allowed(i, j)`` says which pairs are meant. One product of the blocks, in single precision and
    with room for its rounding, finds the candidates; the rest looks at these only.
    """
    dim = left.shape[1]
    edges, shares, turn = block_edges(dim, blocks), budgets(dim, blocks, cosine), rotation(dim)
    y, z = left @ turn, right @ turn
    p, q = (v[:, edges[block]:edges[block + 1]].astype(np.float32) for v in (y, z))
    near = (p * p).sum(axis=1)[:, None] + (q * q).sum(axis=1)[None, :]
    near -= 2 * (p @ q.T)
    i, j = np.nonzero(near <= shares[block] * 1.001 + 1e-5)
    del near
    keep = allowed(i, j)
    i, j = i[keep], j[keep]
    y, z = np.rint(y * STEPS), np.rint(z * STEPS)
    linked = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 15):  # slices: a group of near copies has very many candidates
        a, b = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
        # whole steps: the sums are exact, so every tile agrees which block is a pair's first
        inside = np.add.reduceat((y[a] - z[b]) ** 2, edges[:-1], axis=1) <= np.array(shares) * STEPS**2
        owned = inside[:, block] & ~inside[:, :block].any(axis=1)
        owned[owned] = (left[a[owned]] * right[b[owned]]).sum(axis=1) >= cosine
        linked[at:at + len(a)] = owned
    return i[linked], j[linked]


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    cosine: float = 0.93, blocks: int = 4, grid: int = 1, tile_rows: int = 2048) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null, they have the same
    number of components, and their cosine is >= ``cosine``. A vector that is
    null, empty, zero, or holds null or non-finite components links with
    nothing, and neither does one without id or label; its component is itself.
    ``n_links`` counts other ids; rows that repeat an id with the same vector are one
    vector, with different vectors they count apart but share the id's
    component. An empty table gives an empty one. Other columns are not read.

    Equal vectors of a label meet as one with a count, and a crowded cell is
    dealt out in pairs of tiles of ``tile_rows`` vectors, so no task holds a group.
    """
    ship(vectors.sparkSession)

    def describe(rows, labels):
        keys, packed, cells = [], [], [[] for _ in rows]
        by_dim = {}
        for k, (v, name) in enumerate(zip(rows, labels)):
            a = usable(v)
            ok = a is not None and name is not None
            packed.append(a.tobytes() if ok else None)
            keys.append(xxhash.xxh128_hexdigest(packed[-1] + b"/" + str(name).encode()) if ok else None)
            if ok:
                by_dim.setdefault(len(a), []).append((k, a))
        for dim, found in by_dim.items():
            y = unit(np.stack([a for _, a in found])) @ rotation(dim)
            for (k, _), c in zip(found, _cells(dim, y, blocks, cosine, grid)):
                cells[k] = c
        return [keys, packed, cells]

    given = append_columns(
        vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"),
                       F.col(f"`{label}`").alias("label")),
        ["embedding", "label"], "vec string, packed binary, cells array<string>", describe, drop=("embedding",))
    given = stored(given.withColumn("vec", F.when(F.col("vec_id").isNotNull(), F.col("vec"))), "vectors")

    # equal vectors of a label: one class with its smallest id and its number of ids
    ids = given.where("vec is not null").select("vec", "vec_id").distinct()
    # written, so that joins with it have a shuffle of their own, whose crowded keys can be split
    classes = stored(ids.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many")), "classes")
    shown = (given.join(classes.withColumnRenamed("vec", "of"), (F.col("vec") == F.col("of"))
                        & (F.col("vec_id") == F.col("rep")))
             .select("vec", "rep", "many", "label", "packed", "cells").dropDuplicates(["vec"]))
    placed = (shown.withColumn("cell", F.explode("cells")).drop("cells")
              .withColumn("home", F.substring("cell", 1, 1) == "h")
              .withColumn("cell", F.concat_ws("|", F.expr("substring(cell, 2)"), F.col("label").cast("string"))))
    crowded = (placed.groupBy("cell").agg(F.count("*").alias("n"))
               .select("cell", F.ceil(F.col("n") / tile_rows).cast("int").alias("tiles")).where("tiles > 1"))
    mine = F.pmod(F.xxhash64("vec"), F.col("tiles")).cast("int")
    dealt = (placed.join(crowded, "cell", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
             .withColumn("mine", mine)
             .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
             .withColumn("one", F.least("mine", "other")).withColumn("two", F.greatest("mine", "other"))
             .select("cell", "one", "two", "mine", "home", "vec", "rep", "many", "packed"))

    def match(table: pa.Table) -> pa.Table:
        t = table.sort_by("vec")
        rep, many = t["rep"].to_numpy(), t["many"].to_numpy()
        cell, one, two = t["cell"][0].as_py(), t["one"][0].as_py(), t["two"][0].as_py()
        x = unit(np.stack([np.frombuffer(v) for v in t["packed"].to_pylist()]))
        mine, home = t["mine"].to_numpy(), t["home"].to_numpy(zero_copy_only=False)
        left, right = np.flatnonzero(mine == one), np.flatnonzero(mine == two)

        def allowed(i, j):
            meant = home[left[i]] | home[right[j]]
            return meant & (i < j) if one == two else meant

        i, j = tile_links(x[left], x[right], allowed, int(cell.split("/")[1]), blocks, cosine)
        i, j = left[i], right[j]
        label = min_labels(len(rep), i, j)
        low = np.full(len(rep), np.iinfo(np.int64).max)
        np.minimum.at(low, label, rep)
        n = np.zeros(len(rep), np.int64)
        np.add.at(n, i, many[j])
        np.add.at(n, j, many[i])
        got = n > 0
        return pa.table({"vec": t["vec"].filter(pa.array(got)), "rep": rep[got], "n": n[got],
                         "peer": low[label][got]})

    found = stored(dealt.groupBy("cell", "one", "two").applyInArrow(match, "vec string, rep long, n long, peer long"),
                   "links")
    # copies follow their class; only an id that comes with several vectors links classes by itself
    several = (ids.groupBy(F.col("vec_id").alias("id")).agg(F.min("vec").alias("low"), F.max("vec").alias("high"))
               .where("low <> high").select("id"))
    own = (ids.join(several, F.col("vec_id") == F.col("id")).join(classes, "vec")
           .select(F.col("id").alias("a"), F.col("rep").alias("b")))
    component = connected_components(found.select(F.col("rep").alias("a"), F.col("peer").alias("b")).union(own))
    per_class = classes.join(found.groupBy("vec").agg(F.sum("n").alias("n")), "vec", "left").select(
        F.col("vec").alias("of"), "rep", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n"))
    return (given.select("vec_id", "vec").join(per_class, F.col("vec") == F.col("of"), "left")
            .join(component, F.col("rep") == F.col("node"), "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "rep", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def query(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "embeddings"))


#: By definition: every pair of equal label, and the components by their reachability.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(l.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counted c ON c.a = e.vec_id LEFT JOIN least_of l ON l.a = e.vec_id
"""
