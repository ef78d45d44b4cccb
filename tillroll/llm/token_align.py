"""Alignment of two tokenizers' tokens over whole texts (operator 12).

Both cut the same bytes. In a batch of texts every token has a start, counted in bytes over the batch, and its
text as key. ``pandas.merge_asof``, by that key, gives for each token's start the token of the other side that
covers it; both directions together are all overlaps, each once (equal starts are taken from
the first only). Where tokens of both sides end at one byte, a group ends.

Texts are cut into units where neither tokenizer can join what is left and right: at a single space between
two characters that are no white space. Each distinct unit is encoded once while a worker remembers
it, and a text of any length is taken in batches of bounded size. Whether a file's tokenizer allows this
is read from the file; if not, whole texts are units.

Counting links by pairs of ids is a grouping over Spark: a block of texts sends each of its pairs once, with
their number; totals come back to the block, which then sums them over each text's links.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import read, ship, stored

#: Characters' worth of remembered units a worker keeps; beyond, it starts afresh.
REMEMBERED = 2_000_000
#: Bytes of text aligned at a time.
BATCH = 1 << 18

# Fixed value: the pattern by which byte-level BPE files cut a text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_UNITS = re.compile(r"(?<=\S) (?=\S)").split


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Bytes that Latin-1 shows as a sign stand for themselves; the others, in order, are the letters from U+0100 on.
    """
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level BPE file of the tokenizers library; a text is given a space in front."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            self.bytes[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        before = config.get("pre_tokenizer") or {}
        self.apart = (config.get("normalizer") is None and before.get("type") == "ByteLevel"
                      and before.get("use_regex", True) and not before.get("add_prefix_space"))
        self.ranked = self._by_rank(config["model"]) if self.apart else None

    def _by_rank(self, model: dict):
        """An encoder of the same file for ASCII texts, several times as fast, if its merges are in the order of ids."""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        made = [model["vocab"].get(a + b, -1) for a, b in merges]
        if model["type"] != "BPE" or model.get("ignore_merges") or made != sorted(set(made)) or made[:1] <= [255]:
            return None
        import tiktoken
        known = set(made)
        ranks = {b: k for k, b in enumerate(self.bytes) if k in known or len(b) == 1}
        return tiktoken.Encoding("units", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, units: list[str]) -> list[list[int]]:
        """Ids of units, which begin with the space."""
        if self.ranked is not None and all(u.isascii() for u in units):
            return [self.ranked.encode_ordinary(u) for u in units]
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]


class Pieces:
    """A sentencepiece BPE file with byte fallback, which puts the space in front by itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for k in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(k)
            if self.model.is_byte(k):
                self.bytes.append(bytes([int(piece[1:-1], 16)]))
            elif self.model.is_control(k) or self.model.is_unknown(k):
                self.bytes.append(b"")
            else:
                self.bytes.append(piece.replace("▁", " ").encode())
        # no piece holds a space behind another character, and a space in front comes from the text alone
        inner = any("▁" in self.model.id_to_piece(k).lstrip("▁") for k in range(self.model.get_piece_size()))
        same = all(self.model.decode(self.model.encode(t)) == t for t in ("a  b", " a", "ﬁ Å", "a "))
        self.apart = not inner and same

    def encode(self, units: list[str]) -> list[list[int]]:
        return self.model.encode([u[1:] for u in units], num_threads=1) if units else []


class Side:
    """The tokens of remembered units of one tokenizer, end to end."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.widths = np.array([len(b) for b in tokenizer.bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        self.ids, self.first, self.number = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def learn(self, units: list[str], data: list[bytes], size: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Remember the units (``data``: their bytes, ``size``: how many); which of them give their own bytes again.

        Units that may stand next to each other (``apart``) are encoded as one text, which is cut at their ends;
        where that does not give the bytes again, one by one.
        """
        first, number, good = (np.zeros(len(units), t) for t in (np.int64, np.int64, bool))
        parts, at = [self.ids], len(self.ids)
        left = [np.flatnonzero(~apart)]
        plain = np.fromiter(map(str.isascii, units), bool, len(units))
        for some in (*_chunks(np.flatnonzero(apart & plain), 4000), *_chunks(np.flatnonzero(apart & ~plain), 4000)):
            ids = np.array(self.tokenizer.encode(["".join([units[k] for k in some])])[0], np.int32)
            ends, upto = np.cumsum(self.widths[ids]), np.cumsum(size[some])
            cut = np.searchsorted(ends, upto)
            if (len(ids) and ends[-1] == upto[-1] and (ends[cut] == upto).all()
                    and self._written(ids.tolist()) == b"".join([data[k] for k in some])):
                cut = np.concatenate([[0], cut + 1])
                first[some], number[some], good[some] = at + cut[:-1], np.diff(cut), True
                parts.append(ids)
                at += len(ids)
            else:
                left.append(some)
        for some in _chunks(np.concatenate(left), 4000):
            for k, ids in zip(some, self.tokenizer.encode([units[k] for k in some])):
                first[k], number[k], good[k] = at, len(ids), self._written(ids) == data[k]
                parts.append(np.array(ids, np.int32))
                at += len(ids)
        self.ids = np.concatenate(parts)
        self.first, self.number = np.concatenate([self.first, first]), np.concatenate([self.number, number])
        return good

    def _written(self, ids) -> bytes:
        return b"".join(map(self.tokenizer.bytes.__getitem__, ids))

    def tokens(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of units and how many each unit has."""
        n = self.number[units]
        at = np.repeat(self.first[units] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.ids[at].astype(np.int64), n


class Batch:
    """Some texts' tokens: ``a`` and ``b`` ids with their text's place ``a_text``, ``b_text`` and ``a_end``, ``b_end``
    in bytes over the batch; ``link_a``, ``link_b``: places of overlapping tokens, text by text; ``group_a``, ``group_b``:
    how many tokens of each side lie in groups up to each common end."""

    def __init__(self, a, a_text, a_width, b, b_text, b_width):
        self.a, self.a_text, self.a_end = a, a_text, np.cumsum(a_width)
        self.b, self.b_text, self.b_end = b, b_text, np.cumsum(b_width)
        a_start, b_start = self.a_end - a_width, self.b_end - b_width
        left = pd.DataFrame({"at": a_start, "text": a_text})
        right = pd.DataFrame({"at": b_start, "text": b_text})
        # for each start the token of the other side that covers it
        over_a = pd.merge_asof(left, right.assign(token=np.arange(len(b))), on="at", by="text")["token"].to_numpy(np.int64)
        over_b = pd.merge_asof(right, left.assign(token=np.arange(len(a))), on="at", by="text")["token"].to_numpy(np.int64)
        new = np.flatnonzero(a_start[over_b] != b_start)
        link_a, link_b = np.concatenate([np.arange(len(a)), over_b[new]]), np.concatenate([over_a, new])
        order = np.argsort(a_text[link_a], kind="stable")
        self.link_a, self.link_b = link_a[order], link_b[order]
        ends = np.intersect1d(self.a_end, self.b_end, assume_unique=True)
        self.group_a = np.searchsorted(self.a_end, ends) + 1
        self.group_b = np.searchsorted(self.b_end, ends) + 1
        self.group_text = a_text[self.group_a - 1]

    def written(self) -> tuple[bytes, np.ndarray]:
        """All groups as ``a1,a2|b1;`` one behind the other, and where each group ends."""
        ka, kb = len(self.a), len(self.b)
        group_of_a = np.searchsorted(self.group_a, np.arange(ka), side="right")
        group_of_b = np.searchsorted(self.group_b, np.arange(kb), side="right")
        place_a = np.arange(ka) + np.concatenate([[0], self.group_b])[group_of_a]
        place_b = np.arange(kb) + self.group_a[group_of_b]
        ids, mark = np.empty(ka + kb, np.int64), np.full(ka + kb, ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        mark[place_a[self.group_a - 1]], mark[place_b[self.group_b - 1]] = ord("|"), ord(";")
        digits = np.ones(len(ids), np.int64)
        top = 10
        while len(ids) and top <= ids.max():
            digits += ids >= top
            top *= 10
        end = np.cumsum(digits + 1)
        out = np.empty(end[-1] if len(end) else 0, np.uint8)
        out[end - 1] = mark
        rest = ids
        for k in range(int(digits.max()) if len(ids) else 0):
            has = digits > k
            out[end[has] - 2 - k] = rest[has] % 10 + 48
            rest = rest // 10
        return out.tobytes(), end[place_b[self.group_b - 1]]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = Side(ByteLevel(a_path)), Side(Pieces(b_path))
        self.apart = self.a.tokenizer.apart and self.b.tokenizer.apart
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.good, self.size = np.empty(0, bool), np.empty(0, np.int64)
        self.room = 0
        self.a.forget()
        self.b.forget()

    def units(self, text: str) -> list[str]:
        """The text, with its space, in parts that are encoded one by one."""
        if not self.apart:
            return [" " + text]
        first, *rest = _UNITS(" " + text)
        return [first, *[" " + u for u in rest]]

    def places(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Each text's units as places among the remembered ones."""
        if self.room > REMEMBERED:
            self.forget()
        new = [u for u in dict.fromkeys(u for t in texts for u in t) if u not in self.place]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.room += sum(map(len, new)) + 8 * len(new)
        data = [u.encode() for u in new]
        size = np.fromiter(map(len, data), np.int64, len(data))
        if new:
            apart = np.fromiter((len(u) > 1 and not u[1].isspace() and not u[-1].isspace() for u in new), bool, len(new))
            good = self.a.learn(new, data, size, apart) & self.b.learn(new, data, size, apart)
            self.good, self.size = np.concatenate([self.good, good]), np.concatenate([self.size, size])
        return [np.fromiter(map(self.place.__getitem__, t), np.int64, len(t)) for t in texts]

    def batch(self, parts: list[np.ndarray]) -> Batch:
        """Parts of texts (places of their units) aligned; ``a_text`` counts the parts."""
        sizes = [len(p) for p in parts]
        units = np.concatenate(parts)
        part = np.repeat(np.arange(len(parts)), sizes)
        sides = []
        for side in (self.a, self.b):
            ids, n = side.tokens(units)
            sides += [ids, np.repeat(part, n), side.widths[ids]]
        return Batch(*sides)

    def aligned(self, texts):
        """Yield ``(batch, rows)`` over an iterator of ``(row, text)``: for each part in the batch its row.

        A text may go on in the next batch. Texts without tokens (null, empty, or bytes that do not come back) are
        yielded as ``(None, rows)``.
        """
        pending: list[np.ndarray] = []
        rows: list = []
        size = 0
        for group in _grouped(texts, 256, BATCH // 2):
            split = [self.units(t) if t else [] for _, t in group]
            if self.room > REMEMBERED and pending:       # what is remembered is about to go
                yield self.batch(pending), rows
                pending, rows, size = [], [], 0
            none = []
            for (row, _), places in zip(group, self.places(split)):
                if not len(places) or not self.good[places].all():
                    none.append(row)
                    continue
                width = np.cumsum(self.size[places])
                at = begin = 0
                while at < len(places):
                    # a long text goes on in the next batch
                    upto = len(places) if width[-1] - begin <= BATCH else max(at + 1, int(np.searchsorted(width, begin + BATCH)))
                    pending.append(places[at:upto])
                    rows.append(row)
                    size += int(width[upto - 1] - begin)
                    at, begin = upto, width[upto - 1]
                    if size >= BATCH:
                        yield self.batch(pending), rows
                        pending, rows, size = [], [], 0
            if none:
                yield None, none
        if pending:
            yield self.batch(pending), rows


def _chunks(items: np.ndarray, n: int):
    for at in range(0, len(items), n):
        yield items[at:at + n]


def _grouped(texts, most: int, size: int):
    group, n = [], 0
    for row, text in texts:
        group.append((row, text))
        n += len(text or "")
        if len(group) >= most or n >= size:
            yield group
            group, n = [], 0
    if group:
        yield group


@functools.lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner; what it remembers serves all its tasks."""
    return Aligner(a_path, b_path)


# ---------------------------------------------------------------- on Spark

def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The alignment itself: doc_id, group, a_ids, b_ids of each group of each text, in order (``group`` from 0).

    ``a_ids`` and ``b_ids`` are the ids of the tokens between two common ends. Texts without tokens have no rows (see
    ``alignment``). Repeated ids give repeated rows.
    """
    ship(docs.sparkSession)
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        seen: dict = {}
        for batch, rows in aligner(a_path, b_path).aligned(_numbered(batches)):
            if batch is None:
                continue
            numbers = np.concatenate([np.arange(k) for k in np.bincount(batch.group_text, minlength=len(rows))])
            first = np.array([seen.get(r[0], 0) for r in rows])
            for k, r in zip(np.bincount(batch.group_text, minlength=len(rows)).tolist(), rows):
                seen[r[0]] = seen.get(r[0], 0) + k
            seen = {rows[-1][0]: seen[rows[-1][0]]}          # only the last text may go on
            ids = pa.array([r[1] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(batch.group_text)), pa.array(numbers + first[batch.group_text], pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], batch.group_a]), pa.int32()), pa.array(batch.a, pa.int32())),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], batch.group_b]), pa.int32()), pa.array(batch.b, pa.int32()))],
                names=["doc_id", "group", "a_ids", "b_ids"])

    return given.mapInArrow(run, "doc_id long, group long, a_ids array<int>, b_ids array<int>")


def _numbered(batches):
    """``((number in the task, doc_id), text)`` of all rows."""
    k = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for ident, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                yield (k, ident), text
                k += 1


_BLOCK = ("block long, row array<long>, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, sha256 array<string>, pairs array<long>, counts array<long>, links binary")


def _blocks(given: DataFrame, a_path: str, b_path: str, block_bytes: int) -> DataFrame:
    """One row per block of aligned text: its texts' parts, its distinct pairs of ids with their number of links, and
    the links of the parts, one behind the other, as places among these pairs."""
    def run(batches):
        task = TaskContext.get().partitionId()
        hashes: dict = {}
        parts, pairs, size, block = [], [], 0, 0

        def done():
            nonlocal parts, pairs, size, block
            keys, at = np.unique(np.concatenate(pairs), return_inverse=True) if pairs else (np.empty(0, np.int64),) * 2
            columns = list(zip(*parts))
            out = pa.RecordBatch.from_arrays([
                pa.array([(task << 33) + block], pa.int64()),
                *[pa.array([list(c)], t) for c, t in zip(columns, [pa.list_(pa.int64())] * 6 + [pa.list_(pa.string())])],
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys, pa.int64())),
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()),
                                         pa.array(np.bincount(at, minlength=len(keys)), pa.int64())),
                pa.array([at.astype(np.uint16 if len(keys) <= 1 << 16 else np.uint32).tobytes()], pa.binary())],
                names=["block", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha256", "pairs", "counts", "links"])
            parts, pairs, size, block = [], [], 0, block + 1
            return out

        for batch, rows in aligner(a_path, b_path).aligned(_numbered(batches)):
            if batch is None:
                parts += [((task << 33) + k, ident, 0, 0, 0, 0, "") for k, ident in rows]
            else:
                n = len(rows)
                count = lambda v: np.bincount(v, minlength=n).tolist()
                text, ends = batch.written()
                groups = np.bincount(batch.group_text, minlength=n)
                upto = ends[np.cumsum(groups) - 1].tolist()
                begin = 0
                for (k, ident), end, *four in zip(rows, upto, count(batch.a_text), count(batch.b_text), groups.tolist(),
                                                  count(batch.a_text[batch.link_a])):
                    # the mark behind a text's last group is no part of it
                    sha = hashes.setdefault(k, [hashlib.sha256(), b""])
                    sha[0].update(sha[1] + text[begin:end - 1])
                    sha[1] = b";"
                    begin = end
                    parts.append([(task << 33) + k, ident, *four, None])
                # a text's digest stands with its last part; all but the batch's last text have ended
                for k in list(hashes):
                    if k != rows[-1][0]:
                        _give(parts, (task << 33) + k, hashes.pop(k)[0].hexdigest())
                pairs.append(batch.a[batch.link_a] << 32 | batch.b[batch.link_b])
                size += int(batch.a_end[-1])
            if size >= block_bytes or len(parts) >= 50_000:
                # a text that goes on has its digest in a later block
                yield done()
        for k in list(hashes):
            _give(parts, (task << 33) + k, hashes.pop(k)[0].hexdigest())
        if parts:
            yield done()

    return given.mapInArrow(run, _BLOCK)


def _give(parts: list, row: int, digest: str) -> None:
    """Put a text's digest on its last part; if that went out with an earlier block, on one of its own."""
    for p in reversed(parts):
        if p[0] == row:
            p[-1] = digest
            return
    parts.append([row, None, 0, 0, 0, 0, digest])


def alignment(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
              block_bytes: int = 2 << 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_path`` is a byte-level BPE file of the tokenizers library, ``b_path`` a sentencepiece model. Special tokens' strings are
    plain text. ``n_links`` counts pairs of tokens whose bytes overlap; a pair of ids counts how many links of all
    texts hold it; ``n_best`` are the links whose count is their B id's highest (ties included), ``count_sum`` is
    the sum of the links' counts; ``groups_sha256`` hashes ``a1,a2|b1;a3|b2,b3``, the ids of all groups in order.

    Null and empty texts, and those whose tokens of either side do not give the text's bytes again, have zeros
    and an empty digest. Null and repeated ids are rows of their own. An empty table gives an empty one; other columns are left out.
    """
    ship(docs.sparkSession)
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    blocks = stored(_blocks(given, a_path, b_path, block_bytes), "aligned")
    parts = blocks.select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select(
        F.col("block").alias("of_block"), F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = stored(parts.groupBy("pair").agg(F.sum("n").alias("total")), "pair_counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    best = totals.groupBy(b_id.alias("b")).agg(F.max("total").alias("most"))
    known = totals.withColumn("b", b_id).join(best, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    told = parts.select("of_block", "pair").join(known, "pair")

    def score(block: pa.Table, told: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _SCORED.empty_table()
        links = np.frombuffer(block["links"][0].as_py(), np.uint16 if told.num_rows <= 1 << 16 else np.uint32)
        order = np.argsort(told["pair"].to_numpy(), kind="stable")      # the block's pairs are in this order
        total = told["total"].to_numpy()[order]
        first = told["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
        lists = {c: block[c].combine_chunks().flatten() for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha256")}
        n = lists["n_links"].to_numpy()
        edge = np.concatenate([[0], np.cumsum(n)])
        sums = [np.concatenate([[0], np.cumsum(v[links])]) for v in (first, total)]
        return pa.table([*lists.values(), *[pa.array(s[edge[1:]] - s[edge[:-1]], pa.int64()) for s in sums]], schema=_SCORED)

    scored = blocks.groupBy("block").cogroup(told.groupBy("of_block")).applyInArrow(
        score, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, sha256 string, n_best long, count_sum long")
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return (scored.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *sums, F.max("sha256").alias("groups_sha256"))
            .drop("row"))


_SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                     ("n_groups", pa.int64()), ("n_links", pa.int64()), ("sha256", pa.string()), ("n_best", pa.int64()),
                     ("count_sum", pa.int64())])


def production_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def query(spark, sf_dir):
    return alignment(read(spark, sf_dir, "documents"), *production_paths())
