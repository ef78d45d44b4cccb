"""Language-model scores by a weighted backoff automaton of word n-grams (operator 10).

States are the histories seen in training, of up to ``order - 1`` words, and the root, which has none. An arc of
state h reads a word v that was seen behind h, weighs log10 of the smoothed

    p(v | h) = (c(h v) + kappa * p(v | h')) / (c(h) + kappa),        h': h without its oldest word,

and leads to the longest history that h v ends with. A state's failure arc reads nothing, weighs log10 of
kappa / (c(h) + kappa) and leads to h'; the root's arcs weigh log10 of (c(v) + 0.1) / (N + 0.1 * (V + 1)) and
read any word. One pass from left to right carries the state and adds up the weights.

The counts cover all training documents, so they outgrow any one machine. Texts are dealt into blocks of
bounded size where they lie. Each block sends its distinct n-grams with its own counts, sorted and cut into
slices by key; a slice's total is made in one place and sent back to the blocks that asked for
it. N-grams of three words or more are sent length by length, and only those that other blocks may hold: both of
the n-grams of one word less in them are held by others. A block thus builds just the part of the automaton that its own texts walk through. Long texts are cut into
parts; a part's first state follows from the ``order - 1`` words before it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import (
    crc32_of_id, mix, packed, packed_keys, read, ship, slices, stored, unpacked, unpacked_keys,
)
from tillroll.llm.totals import DIRECT, SENT, SHARED, corpus_totals, messages, slice_count

#: Hashes of the end of a text and of the history before its first word; no word holds a space.
END, START = np.uint64(xxhash.xxh64_intdigest(b" end")), np.uint64(xxhash.xxh64_intdigest(b" start"))
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Tokens of a part of a text.
PART = 4096
_SPACE = re.compile(rb"[\x20\x09-\x0D]").search


def word_runs(text: str | None, room: int = 1 << 22):
    """The text's words, A-Z lower-cased, in lists from at most about ``room`` bytes each."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    at = 0
    while at < len(data):
        cut = _SPACE(data, at + room) if at + room < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


class Parts:
    """Parts of texts, end to end: ``tokens`` are hashes, ``starts`` where each part begins, ``lead`` how many of its
    first tokens are the words before it, which are read but not counted or scored."""

    def __init__(self, order: int):
        self.order, self.known = order, {}
        self.pieces, self.sizes, self.lead, self.rows = [], [], [], []

    def add(self, row, text: str | None) -> int:
        """Cut a text into parts; returns its number of bytes."""
        known, size = self.known, 0
        held = np.array([START])
        begun = False

        def cut(tokens, last):
            nonlocal held, begun
            at = 0
            while len(tokens) - at >= PART or (last and at < len(tokens)):
                some = tokens[at:at + PART]
                self.pieces += [held, some]
                self.sizes.append(len(held) + len(some))
                self.lead.append(len(held))
                self.rows.append((row, begun))
                begun = True
                held = np.concatenate([held, some])[-(self.order - 1):] if self.order > 1 else held[:0]
                at += PART
            return tokens[at:]

        rest = np.empty(0, np.uint64)
        for words in word_runs(text):
            for w in set(words).difference(known):
                known[w] = xxhash.xxh64_intdigest(w)
            size += sum(map(len, words)) + len(words)
            rest = cut(np.concatenate([rest, np.fromiter(map(known.__getitem__, words), np.uint64, len(words))]), False)
        cut(np.concatenate([rest, np.array([END])]), True)
        return size

    def arrays(self):
        tokens = np.concatenate(self.pieces) if self.pieces else np.empty(0, np.uint64)
        sizes = np.array(self.sizes, np.int64)
        return tokens, np.cumsum(sizes) - sizes, np.array(self.lead, np.int64)


def ngram_keys(tokens: np.ndarray, starts: np.ndarray, lead: np.ndarray, order: int):
    """Keys of the n-grams that end at each place, a row per length from 1 to ``order``, and which of them are there.

    Lengths up to seven have keys of their own (the lowest bits). N-grams do not reach over the start of a part; those that
    end in its lead are there as histories only (``counted`` is false for these places).
    """
    n = len(tokens)
    sizes = np.diff(np.concatenate([starts, [n]]))
    place = np.arange(n) - np.repeat(starts, sizes)
    counted = place >= np.repeat(lead, sizes)
    keys, there = np.zeros((order, n), np.uint64), np.zeros((order, n), bool)
    h = np.zeros(n, np.uint64)
    for k in range(order):
        # from the last word back: longer n-grams that end here build on shorter ones
        h[k:] = mix(h[k:] * _STEP + tokens[:n - k] + np.uint64(1)) if k else mix(tokens + np.uint64(1))
        there[k] = place >= k
        keys[k] = (h & ~np.uint64(7)) | np.uint64(k)
    # the start is a history, never a word
    there[0] &= tokens != START
    return keys, there, counted


class Block:
    """The n-grams of some parts: distinct ``keys`` in order, ``at[k]`` the place among them of the n-gram of k + 1 words
    that ends at each token (-1: none), ``counted`` which tokens belong to the parts themselves."""

    def __init__(self, tokens, starts, lead, order: int):
        self.tokens, self.starts, self.lead, self.order = tokens, starts, lead, order
        keys, there, self.counted = ngram_keys(tokens, starts, lead, order)
        # words repeat most: their distinct keys alone are sorted among those of the longer n-grams
        words, word = np.unique(keys[0, there[0]], return_inverse=True)
        self.keys, inverse = np.unique(np.concatenate([words, keys[1:][there[1:]]]), return_inverse=True)
        self.at = np.full(keys.shape, -1, np.int32)
        self.at[0, there[0]] = inverse[:len(words)][word]
        self.at[1:][there[1:]] = inverse[len(words):]
        self.length = (self.keys & np.uint64(7)).astype(np.int8) + 1
        # one place where each n-gram ends: it gives its last word, its history and its suffix
        self.place = np.zeros(len(self.keys), np.int32)
        for at in self.at:
            has = np.flatnonzero(at >= 0)
            self.place[at[has]] = has

    def counts(self, learn: np.ndarray) -> np.ndarray:
        """How often each n-gram stands in the parts that are learned from."""
        use = self.counted & np.repeat(learn, np.diff(np.concatenate([self.starts, [len(self.tokens)]])))
        out = np.zeros(len(self.keys), np.int64)
        for at in self.at:
            some = at[use & (at >= 0)]
            out += np.bincount(some, minlength=len(out))
        return out

    def levels(self) -> list[int]:
        """Lengths up to which n-grams go in one exchange each: two, then one more each."""
        return [2, *range(3, self.order + 1)]

    def sent(self, level: int, shared: np.ndarray) -> np.ndarray:
        """The places of the keys that this block sends in the exchange of a level, in order.

        ``shared`` tells of shorter n-grams which of them other blocks hold too: a longer one with an n-gram inside
        that no other block holds is in no other block, and its total is the block's own.
        """
        if level == 2:
            return np.flatnonzero(self.length <= 2)
        of = np.flatnonzero(self.length == level)
        place = self.place[of]
        return of[shared[self.at[level - 2, place]] & shared[self.at[level - 2, place - 1]]]

    def totals(self, local: np.ndarray, told: dict[int, dict[int, np.ndarray]], n: int,
               upto: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All keys' totals, from the answers (by level and slice) to what was sent, and which are shared."""
        total, shared = local.copy(), np.zeros(len(local), bool)
        for level in self.levels():
            if upto is not None and level >= upto:
                break
            of = self.sent(level, shared)
            edge = slices(self.keys[of], n)
            for k, t in told.get(level, {}).items():
                some = of[edge[k]:edge[k + 1]]
                total[some], shared[some] = t & ~SHARED, t < 0
        return total, shared


class Automaton:
    """The states and arcs that a block's parts can meet.

    A state is the place of its history among the block's keys, then come the root and the start. An arc is the place of the
    n-gram that its state's history and its word make: ``arc`` tells which there are, ``weight``, ``source`` and ``to`` what
    they weigh and join. ``fail`` and ``fail_weight`` are a state's failure arc.
    """

    def __init__(self, block: Block, total: np.ndarray, n_words: int, n_kinds: int, n_texts: int, kappa: float):
        k_, order = len(block.keys), block.order
        self.root, self.start = k_, k_ + 1
        length, place = block.length, block.place
        suffix, history = np.full(k_, self.root), np.full(k_, self.root)
        held = np.concatenate([total, [0, n_texts]]).astype(np.float64)      # the root's is not used
        p = np.empty(k_)
        of = np.flatnonzero(length == 1)
        p[of] = (total[of] + 0.1) / (n_words + 0.1 * (n_kinds + 1))
        for k in range(1, order):
            of = np.flatnonzero(length == k + 1)
            suffix[of] = block.at[k - 1, place[of]]
            before = block.at[k - 1, place[of] - 1]
            history[of] = np.where(before >= 0, before, self.start)
            p[of] = (total[of] + kappa * p[suffix[of]]) / (held[history[of]] + kappa)
        self.arc = (length == 1) | (total > 0)
        self.weight = np.log10(p)
        self.source = history
        # to the whole n-gram as history, if it is short enough, else without its oldest word
        to = np.where(length < order, np.arange(k_), suffix)
        self.to = np.where((total[np.minimum(to, k_ - 1)] > 0) & (to < k_), to, self.root) if k_ else to
        self.fail = np.concatenate([suffix, [self.root, self.root]])
        with np.errstate(divide="ignore"):
            self.fail_weight = np.log10(kappa / (held + kappa))
        self.order = order

    def walk(self, block: Block) -> np.ndarray:
        """log10 of each part's probability: all tokens at once.

        The arc that reads a token is that of the longest n-gram seen that ends with it: the state before holds the
        longest history seen, and failure arcs lead from it through all shorter ones. Where the arc leads
        is the state before the next token.
        """
        n = len(block.tokens)
        taken = np.full(n, -1)
        for at in block.at:
            taken = np.where((at >= 0) & self.arc[at], at, taken) if len(self.arc) else taken
        # a token without an arc is the start of a text
        read_ = taken >= 0
        after = np.full(n, self.start if self.order > 1 else self.root)
        after[read_] = self.to[taken[read_]]
        before = np.concatenate([[self.root], after[:-1]])
        before[block.starts] = self.root
        scored = np.flatnonzero(read_ & block.counted)
        arc, state = taken[scored], before[scored]
        # what a token adds: its failure arcs one after the other, then the arc
        gain = np.zeros((n, self.order))
        todo = np.arange(len(scored))
        for step in range(self.order):
            todo = todo[state[todo] != self.source[arc[todo]]]
            if not len(todo):
                break
            gain[scored[todo], step] = self.fail_weight[state[todo]]
            state[todo] = self.fail[state[todo]]
        gain[scored, -1] += self.weight[arc]
        part = np.repeat(np.arange(len(block.starts)), np.diff(np.concatenate([block.starts, [n]])) * self.order)
        return np.bincount(part, weights=gain.ravel(), minlength=len(block.starts))


_BLOCK = ("block long, doc_id array<long>, row array<long>, training array<boolean>, lead binary, size binary, "
          "word binary, hashes binary")


def _blocks(given: DataFrame, order: int, block_bytes: int) -> DataFrame:
    """One row per block of parts: words as numbers into the block's own list of hashes."""
    def run(batches):
        task = TaskContext.get().partitionId()
        parts, meta, size, n_blocks, k = Parts(order), [], 0, 0, 0

        def done():
            nonlocal parts, meta, size, n_blocks
            tokens, starts, lead = parts.arrays()
            hashes, word = np.unique(tokens, return_inverse=True)
            sizes = np.diff(np.concatenate([starts, [len(tokens)]]))
            rows = [meta[r] for r, _ in parts.rows]
            out = pa.RecordBatch.from_arrays([
                pa.array([(task << 33) + n_blocks], pa.int64()), pa.array([[r[1] for r in rows]], pa.list_(pa.int64())),
                pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[r[2] for r in rows]], pa.list_(pa.bool_())),
                *[pa.array([v], pa.binary()) for v in (packed(lead.astype(np.uint8)), packed(sizes.astype(np.uint32)),
                                                       packed(word.astype(np.uint32)), packed_keys(hashes))]],
                names=["block", "doc_id", "row", "training", "lead", "size", "word", "hashes"])
            parts, meta, size, n_blocks = Parts(order), [], 0, n_blocks + 1
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for ident, text, training in zip(*(part.column(c).to_pylist() for c in range(3))):
                    meta.append(((task << 33) + k, ident, training))
                    size += parts.add(len(meta) - 1, text)
                    k += 1
                    if size >= block_bytes or len(meta) >= 200_000:
                        yield done()
        if meta:
            yield done()

    return given.mapInArrow(run, _BLOCK)


def _unpack(block: pa.Table, order: int) -> Block:
    size = unpacked(block["size"][0].as_py(), np.uint32).astype(np.int64)
    hashes = unpacked_keys(block["hashes"][0].as_py())
    return Block(hashes[unpacked(block["word"][0].as_py(), np.uint32)], np.cumsum(size) - size,
                 unpacked(block["lead"][0].as_py(), np.uint8).astype(np.int64), order)


def _of(block: pa.Table, column: str) -> pa.Array:
    return block[column].combine_chunks().flatten()


def score_texts(docs: DataFrame, training: str, doc_id: str = "doc_id", text: str = "text", order: int = 3,
                kappa: float = 4.0, block_bytes: int = 4 << 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, training, n_tokens, n_known, train_tokens, base_score, score.

    ``training`` names a boolean column: true where a document is learned from
    (null: not). Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the whole text with
    A-Z lower-cased, then one end. ``score`` is log10 of the probability that the automaton of n-grams up to
    ``order`` (1 to 8) gives the text, ``base_score`` that of the root alone.

    Null and empty texts are the end alone; null ids are scored like others; repeated rows
    count as often as they stand there; without training documents p(v) is 1. An empty
    table gives an empty one; other columns are left out.

    A frequent n-gram comes once from each block, however often it stands there. Blocks hold about ``block_bytes`` of
    words, of texts that lie together; longer texts are parts of more steps of the walk, never one. Totals
    are 64-bit numbers.
    """
    spark = ship(docs.sparkSession)
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                        F.coalesce(F.col(f"`{training}`"), F.lit(False)).alias("training"))
    blocks = stored(_blocks(given, order, block_bytes), "lm_blocks")
    n_blocks = blocks.count()
    n = slice_count(n_blocks)
    texts = blocks.select(F.explode(F.arrays_zip("row", "training")).alias("r")).where("r.training").agg(
        F.count_distinct("r.row")).first()[0] if n_blocks else 0

    def opened(row: pa.Table) -> tuple[Block, np.ndarray]:
        block = _unpack(row, order)
        return block, block.counts(_of(row, "training").to_numpy(zero_copy_only=False).astype(bool))

    def by_level(told: pa.Table) -> dict:
        found: dict = {}
        for level, k, t in zip(*(told[c].to_pylist() for c in ("level", "slice", "totals"))):
            found.setdefault(level, {})[k] = unpacked(t, np.int64)
        return found

    def ask(row: pa.Table, block: Block, local: np.ndarray, of: np.ndarray) -> pa.RecordBatch:
        return messages(row["block"][0].as_py(), block.keys[of], local[of], n)

    def first(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(k, 1)])
                block, local = opened(row)
                yield ask(row, block, local, block.sent(2, np.zeros(0, bool)))

    def of_words(keys, totals):
        word = (keys & np.uint64(7)) == 0
        return totals[word].sum(), (totals[word] > 0).sum()

    answers, (n_words, n_kinds) = corpus_totals(blocks.mapInArrow(first, SENT), n_blocks, np.int64, of_words,
                                                 marked=True)
    # each level's answers are written once, those of the first, if sent directly, by corpus_totals
    answers = (answers if n_blocks <= DIRECT else stored(answers, "lm_totals")).withColumn("level", F.lit(2))

    def asks(level: int):
        def longer(row: pa.Table, told: pa.Table) -> pa.Table:
            if not row.num_rows:
                return _SENT.empty_table()
            block, local = opened(row)
            _, shared = block.totals(local, by_level(told), n, upto=level)
            return pa.Table.from_batches([ask(row, block, local, block.sent(level, shared))])

        return longer

    for level in range(3, order + 1):
        sent = blocks.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(asks(level), SENT)
        more, _ = corpus_totals(sent, n_blocks, np.int64, marked=True)
        answers = answers.unionByName(stored(more, "lm_totals").withColumn("level", F.lit(level)))

    def score(row: pa.Table, told: pa.Table) -> pa.Table:
        if not row.num_rows:
            return _SCORED.empty_table()
        block, local = opened(row)
        total, _ = block.totals(local, by_level(told), n)
        found = Automaton(block, total, n_words, n_kinds, texts, kappa).walk(block)
        own = block.counted
        count_ = np.where(block.at[0] >= 0, total[block.at[0]], 0)
        root = np.where(own, np.log10((count_ + 0.1) / (n_words + 0.1 * (n_kinds + 1))), 0.0)
        add = lambda v: np.add.reduceat(v, block.starts)
        return pa.table([_of(row, "row"), _of(row, "doc_id"), _of(row, "training"), pa.array(add(own.astype(np.int64))),
                         pa.array(add((own & (count_ > 0)).astype(np.int64))), pa.array(add(root)), pa.array(found)],
                        schema=_SCORED)

    scored = blocks.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(
        score, "row long, doc_id long, training boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.bool_or("training").alias("training"),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]).select(
        "doc_id", "training", "n_tokens", "n_known", F.lit(n_words).cast("long").alias("train_tokens"), "base_score", "score")


_SENT = pa.schema([("slice", pa.int32()), ("of_block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("training", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def query(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(crc32_of_id("doc_id") % 10 == 0, F.lit(False))
    found = score_texts(docs.withColumn("training", ~held), "training")
    return found.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score")
