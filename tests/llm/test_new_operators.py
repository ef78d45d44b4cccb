"""Operators 11 to 13 against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tillroll.llm import mixing, spelling, token_align


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# ---------------------------------------------------------------- 11

def near(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts):
    out = {}
    for w, n in counts.items():
        ns = [v for v in counts if near(w, v)]
        best = min(ns, key=lambda v: (-counts[v], v), default=None)
        out[w] = [best if best and counts[best] >= 2 * n else None, len(ns)]
    rows = set()
    for w, (form, many) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, counts[w], form, counts.get(form), root, many))
    return rows


def brute_words(docs):
    total = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return total


def test_words_of_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in _docs(spark).select("doc_id", "text").collect()]
    got = {r["word"]: r["n"] for r in spelling.count_words(_docs(spark), remembered=2000).collect()}
    want = brute_words(docs)
    want.pop("", None)
    assert got == dict(want)
    odd = spark.createDataFrame([(1, None), (None, "Éa ÀB"), (2, ""), (3, "×÷ x1y")], "doc_id int, text string")
    assert {r["word"]: r["n"] for r in spelling.count_words(odd, slip_every=0).collect()} == {
        "Éa": 1, "Àb": 1, "×÷": 1, "x": 1, "y": 1}


@pytest.mark.parametrize("cell_words", [20_000, 60])
def test_variants_equal_brute_force(spark, cell_words, monkeypatch):
    rng = random.Random(5)
    counts = {}
    for _ in range(500):
        w = "".join(rng.choice("abcé") for _ in range(rng.randint(5, 9)))
        counts[w] = rng.choice([3, 3, 5, 6, 7, 12, 50, 400])
        if rng.random() < 0.5:
            k = rng.randrange(len(w))
            counts[w[:k] + rng.choice(["", "a", "z"]) + w[k + 1:]] = rng.choice([3, 6])
    counts["a" * 3000], counts["a" * 2999], counts["b" + "a" * 2999] = 9, 3, 4
    words = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n int, near string")
    plain = spelling.near_words
    monkeypatch.setattr(spelling, "near_words", lambda w: plain(w, cell_words=cell_words, fit_words=100))
    got = spelling.variant_groups(words)
    assert {(r["word"], r["n"], r["form"], r["form_n"], r["root"], r["n_near"]) for r in got.collect()} == brute_variants(counts)
    assert got.count() == len(counts)


def test_variants_of_nothing(spark):
    assert spelling.variant_groups(spark.createDataFrame([], "word string, n int")).count() == 0
    assert spelling.variant_groups(spark.createDataFrame([(None, 3), ("häuser", 2)], "word string, n int")).collect()[0][:2] == ("häuser", 2)


def test_reach_finds_every_box_within_the_budget():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 4, (400, spelling.N_LETTERS)) * (np.arange(spelling.N_LETTERS) < 6)
    root, cells = spelling.build(counts.astype(np.int32), 7)
    for up, down in ((0, 0), (1, 0), (1, 1)):
        found = set()
        for cell, rows in spelling.reach(root, counts, up, down):
            found |= {(int(i), int(j)) for i in rows for j in cells[cell]}
        gap = counts[None] - counts[:, None]
        ok = (np.maximum(gap, 0).sum(2) <= up) & (np.maximum(-gap, 0).sum(2) <= down)
        assert {tuple(p) for p in np.argwhere(ok).tolist()} <= found


# ---------------------------------------------------------------- 12

def brute_alignment(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a_path, b_path = token_align.production_paths()
    ta = Tokenizer.from_file(a_path)
    ta.encode_special_tokens = True
    tb = SentencePieceProcessor(model_file=b_path)
    letters = token_align.byte_letters()
    vocab = {k: t for t, k in ta.get_vocab().items()}
    all_, count = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = ta.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tb.encode(text) if text else []
        ba = [bytes(letters[c] for c in vocab[k]) for k in a]
        bb = [bytes([int(tb.id_to_piece(k)[1:-1], 16)]) if tb.is_byte(k) else tb.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if not text or b"".join(ba) != whole or b"".join(bb) != whole:
            all_.append(None)
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            x, y = ea[i], eb[j]
            i, j = i + (x <= y), j + (y <= x)
        groups, i, j = [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            x, y = ea.index(e, i) + 1, eb.index(e, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        count.update(links)
        all_.append((len(a), len(b), groups, links))
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (r[0], r[1], len(r[2]), len(r[3]), sum(count[p] == best[p[1]] for p in r[3]), sum(count[p] for p in r[3]),
             hashlib.sha256(";".join(r[2]).encode()).hexdigest()) for r in all_]


ODD = ["", None, " ", "  two  spaces ", "a", "\n", "x\n\ny z", "tab\tand nbsp 　wide", "▁ lower block", "<|endoftext|> <s> </s> <0x41>",
       "日本語 のテキスト", "🙂🙂 🇦🇹", "é é Å ﬁ", "don't I'll we've", "1234 5678.90", "\x00 \x01", "a " * 50, " lead", "trail ",
       "​ zero ‍", "don 't", "a\x85b c\x1cd \x1f e", "İı ẞ ß"]


def test_alignment_equals_brute_force(spark, monkeypatch):
    texts = [r["text"] for r in _docs(spark).select("text").limit(40).collect()] + ODD + ODD[:9]
    rng = random.Random(3)
    pool = " \n\t aAé'0-._ßЖ語🙂▁́<>|"
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    monkeypatch.setattr(token_align, "BATCH", 3000)
    docs = spark.createDataFrame([(i, t, i, "s") for i, t in enumerate(texts)], "doc_id int, text string, row int, _in0 string").repartition(3)
    want = {(i, *w) for i, w in enumerate(brute_alignment(texts))}
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = token_align.alignment(docs, *token_align.production_paths(), block_bytes=20_000).select(*cols).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(texts)


def test_long_texts_are_aligned_in_parts(monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdeé.") for _ in range(rng.randint(1, 9))) for _ in range(4000))
    al = token_align.Aligner(*token_align.production_paths())
    whole = [b for b, _ in al.aligned([(0, text)])]
    monkeypatch.setattr(token_align, "BATCH", 700)
    parts = [b for b, _ in al.aligned([(0, text)])]
    assert len(whole) == 1 and len(parts) > 10
    assert b"".join(b.written()[0] for b in parts) == whole[0].written()[0]


def test_groups_and_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "same text"), (None, "same text"), (7, "aligned tokens here"), (7, None)], "doc_id int, text string")
    got = token_align.alignment(docs, *token_align.production_paths()).collect()
    assert sorted((r["doc_id"] or 0, r["n_a"] > 0) for r in got) == [(0, True), (0, True), (7, False), (7, True)]
    rows = token_align.align(docs, *token_align.production_paths()).where("doc_id = 7").orderBy("group").collect()
    written = ";".join(",".join(map(str, r["a_ids"])) + "|" + ",".join(map(str, r["b_ids"])) for r in rows)
    assert [r["group"] for r in rows] == list(range(len(rows)))
    assert hashlib.sha256(written.encode()).hexdigest() in {r["groups_sha256"] for r in got}
    assert token_align.alignment(docs.limit(0), *token_align.production_paths()).count() == 0


def test_byte_letters_are_those_of_the_file():
    from tokenizers import pre_tokenizers
    assert set(token_align.byte_letters()) == set(pre_tokenizers.ByteLevel.alphabet())
    assert public_tokenizers.path("byte_bpe_50k.json") == token_align.production_paths()[0]


# ---------------------------------------------------------------- 13

def brute_targets(sizes, share=1.5, limit=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    rest, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = rest / sum(w[s] for s in open_)
        full = {s for s in open_ if limit * sizes[s] < level * w[s]}
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        target |= {s: float(limit * sizes[s]) for s in full}
        rest -= sum(limit * sizes[s] for s in full)
        open_ -= full
    return target


def test_targets_and_taken_words(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in _docs(spark).collect()]
    docs += [(None, "a b c", None)] * 5 + [(900, None, "srcx"), (901, " \x0b", "srcx"), (902, "Å " * 30000, "häß"), (902, "one", "häß")]
    df = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id int, text string, source string, number string, start int")
    listed, pieces = mixing.mix(df, block_words=100, shard_blocks=9, bucket_docs=20)
    rows, held = listed.collect(), pieces.collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += words(t)
    target = brute_targets(dict(sizes))
    assert sorted((r["doc_id"] or -1, r["size"]) for r in rows) == sorted((d or -1, words(t)) for d, t, _ in docs)
    numbers = {s: k for k, s in enumerate(sorted(s for s in sizes if s) + [None])}
    by_number = {numbers[s]: (sizes[s], target[s]) for s in sizes}
    for r in rows:
        assert (r["source_size"], pytest.approx(r["target"])) == (by_number[r["number"]][0], by_number[r["number"]][1])
    taken, times, whole = Counter(), Counter(), {(r["number"], r["start"]): r["size"] for r in rows if r["size"]}
    for p in held:
        assert 0 < p["n_words"] and p["word"] + p["n_words"] <= whole[p["number"], p["start"]]
        taken[p["number"]] += p["n_words"]
        for k in range(p["n_words"]):
            times[p["number"], p["start"] + p["word"] + k] += 1
    for k, (size, aim) in by_number.items():
        assert abs(taken[k] - aim) <= 0.5
        most = {times[k, w] for w in range(size)}
        assert not most or max(most) <= 2 and max(most) - min(most) <= 1      # all once before any twice
    shards = Counter(p["shard"] for p in held)
    assert sorted(shards) == list(range(len(shards))) and len(shards) > 3
    assert sorted((p["shard"], p["place"]) for p in held) == sorted((s, i) for s, n in shards.items() for i in range(n))
    again = mixing.mix(df.repartition(7), block_words=100, shard_blocks=9, bucket_docs=20)[1].collect()
    assert sorted(map(str, again)) == sorted(map(str, held))


def test_quotas_split_exactly(spark):
    quotas = spark.createDataFrame([(0, 500), (1, 0), (2, 37), (3, 1)], "number long, quota long")
    runs = mixing.shard_quotas(quotas, 11, 538, seed=1).collect()
    per_shard, per_source = Counter(), {}
    for r in runs:
        per_shard[r["shard"]] += r["quota"]
        per_source.setdefault(r["number"], []).append((r["first"], r["quota"]))
    assert all(v in (48, 49) for v in per_shard.values()) and len(per_shard) == 11
    for number, quota in ((0, 500), (2, 37), (3, 1)):
        at = 0
        for first, n in sorted(per_source[number]):
            assert first == at
            at += n
        assert at == quota


def test_permutation_and_empty_mix(spark):
    for n in (1, 2, 3, 5, 64, 65, 1000):
        i = np.arange(n)
        assert sorted(mixing.permuted(i, np.full(n, n), np.full(n, 7)).tolist()) == i.tolist()
    both = mixing.permuted(np.array([3, 3]), np.array([10, 5000]), np.array([1, 1]))
    assert both[0] == mixing.permuted(np.array([3]), np.array([10]), np.array([1]))[0]
    nothing = spark.createDataFrame([], "doc_id int, text string, source string")
    assert [d.count() for d in mixing.mix(nothing)] == [0, 0]
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id int, text string, source string")
    listed, pieces = mixing.mix(blank)
    assert listed.count() == 2 and pieces.count() == 0
    assert {r["target"] for r in listed.agg(F.max("target").alias("target")).collect()} == {0.0}
