"""Spelling variants: words one edit apart, found by k-d trees over letter counts (operator 11).

One inserted letter raises one letter count by one; one replaced letter raises one and lowers
another, an L1 distance of two. So the words of one length lie in a k-d tree over their
letter counts, and a word looks in the trees of its own length and of the next
longer one, leaving out every box that is more than these steps away. What is left is
verified letter by letter.

The upper part of each length's tree deals the words to tasks: a word is stored in one cell, and
looks in every cell whose box it can reach. A cell of too many words (anagrams, say, which no count tells
apart) is cut into tiles by hash of words and of lookers, and every looker meets every word of
its cells in just one tile. Each task has a tree of its own below. Pairs never leave a task: a
word gets a count and its best near word from each, and these are merged.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import read, ship, stored

LETTERS = "A-Za-zÀ-ÿ"
#: a-z, then the letters from U+00C0 on.
N_LETTERS = 26 + 64
#: Words in a leaf of a task's tree.
LEAF = 24

_RUNS = re.compile(f"[{LETTERS}]+").findall
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slip_every: int = 97,
                remembered: int = 400_000) -> DataFrame:
    """``(word, n)``: the distinct runs of Latin letters of whole texts, only A-Z lower-cased, and how often they stand.

    With ``slip_every`` k > 0 a run whose unsigned crc32 h of ``<doc_id>:<run>`` k divides loses its
    letter h % length (a planted slip); a null id is written as empty. Null texts have no runs; a run of
    one letter that loses it is no word. Counts are summed in each task before they are shuffled; a task
    remembers at most about ``remembered`` words at a time.
    """
    ship(docs.sparkSession)
    given = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("doc_id"),
                        F.col(f"`{text}`").alias("text")).where("text is not null")

    def table(total):
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                          names=["word", "n"])

    def count(batches):
        total: Counter = Counter()
        known: dict[str, tuple[str, bytes]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for ident, text_ in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    begin = zlib.crc32(f"{ident}:".encode())
                    # the crc is taken once for each different run of a text
                    for run, n in Counter(_RUNS(text_)).items():
                        try:
                            word, data = known[run]
                        except KeyError:
                            word = run.translate(_LOWER)
                            data = word.encode()
                            known[run] = word, data
                        if slip_every:
                            h = zlib.crc32(data, begin)
                            if h % slip_every == 0:
                                at_ = h % len(word)
                                word = word[:at_] + word[at_ + 1:]
                        total[word] += n
                if len(total) > remembered or len(known) > remembered:
                    yield table(total)
                    total, known = Counter(), {}
        yield table(total)

    return (given.mapInArrow(count, "word string, n long").where("word <> ''").groupBy("word")
            .agg(F.sum("n").alias("n")))


# ---------------------------------------------------------------- letters, boxes, trees

def letters_of(words: list[str], length: int) -> np.ndarray:
    """One row of code points per word; all words have ``length`` letters up to U+00FF."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Letter-count vectors, one row per word."""
    place = np.zeros(256, np.int64)
    place[97:123] = np.arange(26)
    place[0xC0:] = np.arange(26, N_LETTERS)
    n, length = letters.shape
    flat = (np.arange(n)[:, None] * N_LETTERS + place[letters]).ravel()
    return np.bincount(flat, minlength=n * N_LETTERS).reshape(n, N_LETTERS).astype(np.int32)


class Box:
    """A box of the tree: a leaf (``cell``), or a cut of one letter's count into up to ``at`` and more."""

    __slots__ = ("letter", "at", "low", "high", "left", "right", "cell")

    def __init__(self, cell=None):
        self.cell, self.letter, self.left, self.right = cell, -1, None, None


def build(counts: np.ndarray, leaf: int, max_cells: int | None = None) -> tuple[Box, list[np.ndarray]]:
    """A k-d tree: each box is cut at the mean of its most varied letter, until it has ``leaf`` words or no variety.

    Returns the root and, for each leaf's ``cell``, the rows in it.
    """
    cells: list[np.ndarray] = []
    root = Box()
    lows, highs = np.zeros(N_LETTERS, np.int64), np.full(N_LETTERS, np.iinfo(np.int32).max)
    todo = [(root, np.arange(len(counts)), lows, highs)]
    while todo:
        # the fullest box is cut first, so that a limit on cells leaves them even
        if max_cells is not None:
            todo.sort(key=lambda t: len(t[1]))
        box, rows, low, high = todo.pop()
        some = counts[rows]
        spread = some.var(axis=0) if len(rows) > leaf else None
        if spread is None or spread.max() == 0 or (max_cells is not None and len(cells) + len(todo) + 2 > max_cells):
            box.cell = len(cells)
            cells.append(rows)
            continue
        d = int(spread.argmax())
        at = int(np.floor(some[:, d].mean()))
        box.letter, box.at, box.low, box.high = d, at, int(low[d]), int(high[d])
        box.left, box.right = Box(), Box()
        less = some[:, d] <= at
        under, over = high.copy(), low.copy()
        under[d], over[d] = at, at + 1
        todo += [(box.left, rows[less], low, under), (box.right, rows[~less], over, high)]
    return root, cells


def reach(root: Box, counts: np.ndarray, up: int, down: int):
    """Yield ``(cell, rows)``: for each leaf the lookers that can come into its box.

    A looker can come there if its counts need raising by at most ``up`` in all and lowering by at most ``down``.
    """
    n = len(counts)
    todo = [(root, np.arange(n), np.zeros(n, np.int32), np.zeros(n, np.int32))]
    while todo:
        box, rows, raised, lowered = todo.pop()
        if not len(rows):
            continue
        if box.left is None:
            yield box.cell, rows
            continue
        c = counts[rows, box.letter]
        # only the change of this letter's share is added: the same letter may be cut again
        to_left = lowered + np.maximum(c - box.at, 0) - np.maximum(c - box.high, 0)
        to_right = raised + np.maximum(box.at + 1 - c, 0) - np.maximum(box.low - c, 0)
        ok = to_left <= down
        todo.append((box.left, rows[ok], raised[ok], to_left[ok]))
        ok = to_right <= up
        todo.append((box.right, rows[ok], to_right[ok], lowered[ok]))


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For all pairs of rows: whether words of one length differ in just one place."""
    return (a[:, None, :] != b[None, :, :]).sum(axis=2) == 1


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For all pairs: whether ``b`` (one longer) is ``a`` with one letter put in."""
    ahead = np.logical_and.accumulate(a[:, None, :] == b[None, :, :-1], axis=2).sum(axis=2)
    behind = np.logical_and.accumulate((a[:, None, :] == b[None, :, 1:])[:, :, ::-1], axis=2).sum(axis=2)
    return ahead + behind >= a.shape[1]


def near_pairs(home: np.ndarray, lookers: np.ndarray, up: int, down: int, differ, room: int = 1 << 22):
    """Yield ``(i, j)``: lookers and home words that are near, each pair once."""
    if not len(home) or not len(lookers):
        return
    root, cells = build(counts_of(home), LEAF)
    for cell, rows in reach(root, counts_of(lookers), up, down):
        words = cells[cell]
        step = max(1, room // max(1, home.shape[1]))
        for b in range(0, len(words), max(1, int(step ** 0.5))):
            some = words[b:b + max(1, int(step ** 0.5))]
            wide = max(1, step // len(some))
            for a in range(0, len(rows), wide):
                i, j = np.nonzero(differ(lookers[rows[a:a + wide]], home[some]))
                if len(i):
                    yield rows[a:a + wide][i], some[j]


def ranked(letters: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by larger n, then code-point order, and each row's place in this order."""
    letters = np.ascontiguousarray(letters)
    order = np.lexsort((letters.view(f"S{letters.shape[1]}").ravel(), -n))
    place = np.empty(len(n), np.int64)
    place[order] = np.arange(len(n))
    return order, place


# ---------------------------------------------------------------- on Spark

def near_words(words: DataFrame, cell_words: int = 20_000, fit_words: int = 16_384, max_cells: int = 1024) -> DataFrame:
    """``(word, n_near, near_n, near)`` of each word that has a near word: how many, and the one of largest n.

    ``words`` has distinct ``word`` (letters a-z and U+00C0-U+00FF) and ``n``. Two words are near if one inserted,
    deleted or replaced letter makes one of the other. Ties of n go to the smaller word in code-point order.
    A length of more than ``cell_words`` words is cut into cells by a tree fitted on about ``fit_words`` of them by
    hash, of the 64 lengths with most words (only the cuts depend on it: every word is placed and looked up).
    """
    spark = ship(words.sparkSession)
    words = words.where(F.rlike("word", F.lit("^[a-zÀ-ÿ]+$"))).select(
        "word", F.col("n").cast("long").alias("n"), F.char_length("word").alias("length"))
    sizes = (words.groupBy("length").count().where(F.col("count") > cell_words)
             .orderBy(F.desc("count")).limit(64).collect())
    trees: dict[int, Box] = {}
    for r in sizes:
        share = min(1.0, fit_words / r["count"])
        some = [w["word"] for w in words.where((F.col("length") == r["length"]) & (
            F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)))).select("word").orderBy("word").collect()]
        if some:
            cells = min(max_cells, -(-r["count"] // cell_words))
            trees[r["length"]] = build(counts_of(letters_of(some, r["length"])), 1, cells)[0]

    def deal(batches):
        """A home row and the looking rows of every word: length and cell, role (0 home, 1 same length, 2 shorter)."""
        for batch in batches:
            names, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            length = batch.column(2).to_numpy()
            for size in np.unique(length).tolist():
                rows = np.flatnonzero(length == size)
                counts = counts_of(letters_of([names[k] for k in rows], size))
                for target, role, up, down in ((size, 0, 0, 0), (size, 1, 1, 1), (size + 1, 2, 1, 0)):
                    if target in trees:
                        found = list(reach(trees[target], counts, up, down))
                    else:
                        found = [(0, np.arange(len(rows)))]
                    for cell, at in found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([names[k] for k in rows[at]], pa.string()), pa.array(n[rows[at]]),
                             pa.array(np.full(len(at), target, np.int32)), pa.array(np.full(len(at), cell, np.int32)),
                             pa.array(np.full(len(at), role, np.int32))], names=["word", "n", "length", "cell", "role"])

    dealt = words.mapInArrow(deal, "word string, n long, length int, cell int, role int")
    # cells of too many words, or lookers, become tiles
    crowd = (dealt.groupBy("length", "cell").agg(
        F.ceil(F.count(F.when(F.col("role") == 0, 1)) / cell_words).cast("int").alias("homes"),
        F.ceil(F.count(F.when(F.col("role") > 0, 1)) / (8 * cell_words)).cast("int").alias("lookers")))
    crowd = stored(crowd.where("homes > 0"), "crowd")
    by = F.xxhash64("word", F.lit(11))
    tiles = dealt.join(crowd, ["length", "cell"]).select(
        "word", "n", "length", "cell", "role",
        F.when(F.col("role") == 0, F.array(F.pmod(by, F.col("homes")).cast("int")))
        .otherwise(F.sequence(F.lit(0), F.col("homes") - 1)).alias("h"),
        F.when(F.col("role") > 0, F.array(F.pmod(by, F.greatest("lookers", F.lit(1))).cast("int")))
        .otherwise(F.sequence(F.lit(0), F.greatest("lookers", F.lit(1)) - 1)).alias("l"))
    tiles = tiles.withColumn("h", F.explode("h")).withColumn("l", F.explode("l"))

    def search(table: pa.Table) -> pa.Table:
        length = table["length"][0].as_py()
        role, n = table["role"].to_numpy(), table["n"].to_numpy()
        names = np.array(table["word"].to_pylist(), object)
        home = np.flatnonzero(role == 0)
        out = []
        if len(home):
            spelled = letters_of(list(names[home]), length)
            order, rank = ranked(spelled, n[home])
            for kind, up, down, differ in ((1, 1, 1, replaced), (2, 1, 0, inserted)):
                look = np.flatnonzero(role == kind)
                if not len(look):
                    continue
                asked = letters_of(list(names[look]), length - (kind == 2))
                many, best = np.zeros(len(look), np.int64), np.full(len(look), len(home))
                back, look_rank = ranked(asked, n[look])
                home_many, home_best = np.zeros(len(home), np.int64), np.full(len(home), len(look))
                for i, j in near_pairs(spelled, asked, up, down, differ):
                    np.add.at(many, i, 1)
                    np.minimum.at(best, i, rank[j])
                    if kind == 2:
                        np.add.at(home_many, j, 1)
                        np.minimum.at(home_best, j, look_rank[i])
                has = np.flatnonzero(many)
                near = home[order[best[has]]]
                out.append((names[look[has]], many[has], n[near], names[near]))
                has = np.flatnonzero(home_many)
                near = look[back[home_best[has]]]
                out.append((names[home[has]], home_many[has], n[near], names[near]))
        columns = [np.concatenate([o[k] for o in out]) if out else np.empty(0, object if k in (0, 3) else np.int64)
                   for k in range(4)]
        return pa.table([pa.array(columns[0].tolist(), pa.string()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.int64()), pa.array(columns[3].tolist(), pa.string())],
                        names=["word", "n_near", "near_n", "near"])

    found = tiles.groupBy("length", "cell", "h", "l").applyInArrow(
        search, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("near_n"), F.col("b.near").alias("near")))


def variant_groups(words: DataFrame, ratio: int = 2, max_rounds: int = 12) -> DataFrame:
    """One row per word: word, n, form, form_n, root, n_near.

    ``words`` has distinct ``word`` and ``n``. ``form`` is the near word of largest n (ties: smallest in code-point
    order) if that n is at least ``ratio`` (2 or more) times the word's own, else null; ``root`` follows forms to the
    last. Counts at least double at each step, so a chain has at most 63; pointers are doubled, each round is
    written. An empty table gives an empty one; rows without a word are left out; other columns are ignored.
    """
    words = words.where("word is not null").select("word", F.col("n").cast("long").alias("n"))
    found = words.join(near_words(words), "word", "left")
    held = F.col("near_n") >= ratio * F.col("n")
    forms = stored(found.select("word", "n", F.when(held, F.col("near")).alias("form"),
                                F.when(held, F.col("near_n")).alias("form_n"),
                                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")), "forms")
    now = stored(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(now.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return forms.join(now, "word", "left").select(
        "word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near")


def query(spark, sf_dir):
    counted = count_words(read(spark, sf_dir, "documents"))
    words = stored(counted.where((F.char_length("word") >= 5) & (F.col("n") >= 3)), "words")
    return variant_groups(words)
