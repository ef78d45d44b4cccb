"""Substring dedup: lines, paragraphs and passages that repeat, by hashing units of text (operator 3).

Units are whole lines and whole paragraphs (between blank lines) of ``line_words`` words or more, as they
stand. These alone would miss a passage in the middle of a line, so there are also passages of
``unit_words`` words that begin where the text itself says: at the word whose hash is the smallest of
``reach`` neighbours. Equal runs of ``unit_words + reach - 1`` words or
more therefore hold an equal passage wherever they stand, and as passages
are longer than their distance, those of a run cover it without gaps
(up to ``reach - 1`` words at either end).

Units are normalised (A-Z lower-cased, white space as one space), their
digests grouped over all documents, and the first occurrence of each is kept, by
document id and place in the text; all others are removed, in the same document
too, with their place in the original text retained.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import append_columns, free_prefix, mix, read, signed

#: Words of the shortest line or paragraph that is a unit: shorter ones recur in clean texts too.
LINE_WORDS = 15

_BASE = 0x9E3779B97F4A7C15
#: Odd numbers for two independent halves of a digest.
_HALF = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, np.uint64)
    up, down = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    return (np.cumprod(np.concatenate([one, np.full(size, up)]), dtype=np.uint64),
            np.cumprod(np.concatenate([one, np.full(size, down)]), dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base of the polynomial hashes, and of its inverse modulo 2**64."""
    up, down = _powers(max(1 << 16, 1 << n.bit_length()))
    return up[:n + 1], down[:n + 1]


def range_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of the values in each range, wherever it begins, by prefix sums."""
    up, down = powers(len(values))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values) * up[:-1], dtype=np.uint64)])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def hashed_words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased), where each begins, and the line it stands in."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (code == 32) | ((code >= 9) & (code <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(begin):
        return np.empty(0, np.uint64), begin, begin
    low = code.astype(np.uint64)
    low[(code >= 65) & (code <= 90)] += np.uint64(32)
    return range_hashes(low, begin, end), begin, np.cumsum(code == 10)[begin]


def picked(weights: np.ndarray, reach: int) -> np.ndarray:
    """Positions of the smallest weight (the rightmost of equals) of every ``reach`` neighbours, each once."""
    if len(weights) < reach:
        return np.empty(0, np.int64)
    near = np.lib.stride_tricks.sliding_window_view(weights, reach)[:, ::-1]
    return np.unique(np.arange(len(near)) + reach - 1 - near.argmin(axis=1))


def units(text: str | None, unit_words: int, reach: int, line_words: int = LINE_WORDS) -> tuple[np.ndarray, ...]:
    """Digest (two halves), start, end and kind (whole line or paragraph, or not) of the units of a text.

    A unit reaches to the next word behind it. Equal
    passages that follow each other, as in a run of one word, or that overlap,
    as in a text that repeats every few words, are one unit; lines and paragraphs never overlap their like.
    """
    h, begin, line = hashed_words(text or "")
    after = np.concatenate([begin[1:], [len(text or "")]]) if len(h) else begin
    one, two, start, end = _passages(h, begin, after, unit_words, reach)
    whole = len(one)
    lines = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(h) else np.empty(0, np.int64)
    # white space with two line feeds or more holds a blank line
    paragraphs = np.flatnonzero(np.concatenate([[True], line[1:] - line[:-1] > 1])) if len(h) else lines
    for firsts, more_than_a_line in ((lines, False), (paragraphs, True)):
        a, b = firsts, np.concatenate([firsts[1:], [len(h)]])[:len(firsts)]
        ok = b - a >= line_words
        if more_than_a_line:
            ok &= line[b - 1] != line[a]
        a, b = a[ok], b[ok]
        if len(a):
            one, two = (np.concatenate([x, mix(range_hashes(h * half, a, b))]) for x, half in zip((one, two), _HALF))
            start, end = np.concatenate([start, begin[a]]), np.concatenate([end, after[b - 1]])
    return one, two, start, end, np.arange(len(one)) >= whole


def _passages(h, begin, after, unit_words: int, reach: int) -> tuple[np.ndarray, ...]:
    """Digests, starts and ends of the passages that begin at picked words."""
    n = len(h) - unit_words + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.arange(n)
    one, two = (range_hashes(h * half, at, at + unit_words) for half in _HALF)
    at = picked(mix(one ^ two), reach)
    one, two, start, end = one[at], two[at], begin[at], after[at + unit_words - 1]
    new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])[:len(at)]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]) - 1 if len(first) else first
    one, two, start, end = one[first], two[first], start[first], end[last]
    order = np.lexsort((start, two, one))  # equal units side by side, by place
    one, two, start, end = one[order], two[order], start[order], end[order]
    new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (start[1:] >= end[:-1])])[:len(order)]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(order)]]) - 1 if len(first) else first
    one, two, start, end = one[first], two[first], start[first], end[last]
    order = np.argsort(start)
    return one[order], two[order], start[order], end[order]


def merged(spans) -> list[tuple[int, int]]:
    """Union of spans, in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return "".join(out)


def text_key(text: str) -> Column:
    """Tells the texts of one id apart, of rows that repeat it."""
    return F.xxhash64(f"`{text}`")


def repeated_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   unit_words: int = 35, reach: int = 16, line_words: int = LINE_WORDS) -> DataFrame:
    """(doc_id, key, start, end) of every unit but the first of its digest, in characters of the text.

    Units are in order of document, text (its ``text_key``) and place. Rows that
    repeat an id and its text are one text.
    """
    def find(texts):
        found = [units(t, unit_words, reach, line_words)[:4] for t in texts]
        one, two, start, end = (np.concatenate(x) for x in zip(*found))
        rows = pa.StructArray.from_arrays(
            [pa.array(signed(one)), pa.array(signed(two)), pa.array(start.astype(np.int32)),
             pa.array(end.astype(np.int32))], names=["one", "two", "start", "end"])
        edges = np.concatenate([[0], np.cumsum([len(x[0]) for x in found])]).astype(np.int32)
        return [pa.ListArray.from_arrays(edges, rows)]

    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_key(text).alias("key"),
                        F.col(f"`{text}`").alias("text"))
    found = append_columns(given.where("doc_id is not null"), ["text"],
                           "units array<struct<one:long,two:long,start:int,end:int>>",
                           find, rows=256, drop=("text",)).select("doc_id", "key", F.explode("units").alias("u"))
    found = found.select("doc_id", "key", "u.one", "u.two", "u.start", "u.end")
    place = F.struct("doc_id", "key", "start")
    shared = (found.groupBy("one", "two").agg(F.min(place).alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("one", "two", "first"))
    return found.join(shared, ["one", "two"]).where(place != F.col("first")).select("doc_id", "key", "start", "end")


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    unit_words: int = 35, reach: int = 16, line_words: int = LINE_WORDS,
                    removed: str = "removed") -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; column ``removed`` holds their (start, end) in the old text.

    A line, paragraph or passage stays where it first stands in the document with the smallest id;
    all others are cut, in that document too. Whole lines and paragraphs of ``line_words`` words or more are
    all found. Inside a line, a run that repeats so closely that its passages
    overlap themselves (every ``unit_words - 1`` words or less) is one passage, runs of at least
    ``unit_words + reach - 1`` words (50) are found for sure, and shorter ones than
    ``unit_words`` never. A cut takes the white space behind it along. Offsets count code points, of the whole text.

    Null and empty texts and short ones stay as they are, with ``removed``
    empty. Rows with a null id are left alone. Rows that repeat an id are one
    document: with the same text they share what is cut, of different texts
    each loses its own spans. Column ``removed`` is replaced if it is there.
    A passage in very many documents is counted before the shuffle, and the join that
    brings it back can be split. An empty table stays empty.
    """
    free = free_prefix(docs)
    spans = (repeated_units(docs, doc_id, text, unit_words, reach, line_words)
             .groupBy(F.col("doc_id").alias(f"{free}of"), F.col("key").alias(f"{free}key"))
             .agg(F.collect_set(F.struct("start", "end")).alias(f"{free}spans")))
    joined = docs.join(spans, (F.col(f"`{doc_id}`").cast("long") == F.col(f"{free}of"))
                       & (text_key(text) == F.col(f"{free}key")), "left").drop(f"{free}of", f"{free}key")

    def apply(texts, found):
        out, gone = [], []
        for t, s in zip(texts, found):
            s = merged((x["start"], x["end"]) for x in s) if s and t else []
            out.append(cut(t, s) if s else t)
            gone.append([{"start": a, "end": b} for a, b in s])
        return [out, gone]

    return append_columns(joined, [text, f"{free}spans"], f"`{text}` string, `{removed}` array<struct<start:int,end:int>>",
                          apply, rows=256, drop=(f"{free}spans",))


def query(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return (remove_repeated(docs).withColumn("n_removed", F.size("removed"))
            .select("doc_id", "text", "n_removed", "removed"))
