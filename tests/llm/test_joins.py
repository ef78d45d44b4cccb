"""Embedding and n-gram joins against brute force, and components against a plain search."""

import itertools
import math
import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import embedding_dedup as emb
from tillroll.llm import ngram_join as ngr
from tillroll.llm.common import words
from tillroll.llm.components import connected_components, min_labels


def roots(nodes, links):
    """Smallest node reachable from each, by plain search."""
    near = {n: set() for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(near):
        if n not in out:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = n
                    todo += near[x]
    return out


def shingles(text, n):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def brute_documents(rows, n, num, den):
    """rows: (doc_id, text), ids distinct."""
    sets = {i: shingles(t, n) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    root = roots(sets, links)
    return sorted((i, len(s), root[i]) for i, s in sets.items())


def varied(seed, groups=12, copies=8, length=60, vocabulary=40):
    """Groups of texts that drift apart word by word, with exact copies and short ones."""
    r = random.Random(seed)
    word = [f"w{k}" for k in range(vocabulary)]
    out = []
    for _ in range(groups):
        t = [r.choice(word) for _ in range(r.randint(1, length))]
        for _ in range(r.randint(1, copies)):
            t = list(t)
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                t[r.randrange(len(t))] = r.choice(word)
            if r.random() < .2:
                t.append(r.choice(word))
            out.append(" ".join(t))
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100)])
def test_documents_equal_brute_force(spark, n, num, den):
    rows = varied(n)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngr.similar_documents(df, n=n, num=num, den=den, tile_rows=3)  # small tiles: shares of a crowded group
    assert sorted(map(tuple, got.collect())) == brute_documents(rows, n, num, den)


def test_document_edge_cases(spark):
    long = " ".join(f"a{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\ttwo"), (6, "one two three"), (7, long),
            (8, long.upper()), (8, long.upper()), (None, "one two"), (9, "É x y"), (10, "é x y"), (11, "a b c")]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows],
                               "doc_id long, text string, component_id int, N_SHINGLES string")
    got = sorted(map(tuple, ngr.similar_documents(df, n=3, num=90, den=100).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 29998, 7), (8, 29998, 7),
                          (8, 29998, 7), (None, 1, 4), (9, 1, 9), (10, 1, 10), (11, 1, 11)], key=str)
    assert ngr.similar_documents(df.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.sampled_from([(90, 100), (80, 100), (1, 2)]))
def test_linked_sets_share_a_rare_hash(common, left, right, t):
    """Any two sets at the threshold share a hash of their rare parts, whatever the counts, and meet in a band."""
    num, den = t
    r = np.random.default_rng(common * 7919 + left * 61 + right)
    h = r.permutation(np.unique(r.integers(0, 1 << 64, common + left + right, dtype=np.uint64)))
    a, b = np.sort(h[:common + left]), np.sort(np.concatenate([h[:common], h[common + left:]]))
    if den * common < num * (len(a) + len(b) - common):
        return
    starts = ngr.band_starts(1 << 20)
    x, y = ngr.bands_of(len(a), num, den, starts), ngr.bands_of(len(b), num, den, starts)
    assert x[0] in y or y[0] in x
    for most in (2, 5, 200):
        held = {int(k): int(r.integers(1, most)) for k in h} | {int(k): int(r.integers(2, most + 1)) for k in h[:common]}
        p, q = (ngr.rare_part(s, np.array([held[int(k)] for k in s], np.uint8), num, den) for s in (a, b))
        assert set(p.tolist()) & set(q.tolist())


def test_sharing_over_many_slices(spark):
    r = random.Random(8)
    big = [r.randrange(-(1 << 63), 1 << 63) for _ in range(60)]
    rows = [(k, [r.choice(big) for _ in range(r.randint(0, 3))]) for k in range(80)] + [(None, big), (90, big[:1] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, parts array<long>").repartition(5)
    holders = {}
    for k, parts in rows:
        for p in parts:
            if k is not None:
                holders.setdefault(p, set()).add(k)
    links = [(min(h), k) for h in holders.values() for k in h]
    ids = {k for k, _ in rows if k is not None}
    for size in (9, 1000):
        got = [tuple(x) for x in ngr.sharing(df, size).collect()]
        assert all(a > b for a, b in got)
        assert roots(ids, got) == roots(ids, links)


def test_an_id_with_several_texts_links_their_classes(spark):
    rows = [(3, "a b c d"), (1, "x y z w"), (3, "x y z w"), (2, "a b c d"), (5, "p q r s")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, ngr.similar_documents(df, n=3).collect()))
    assert got == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (3, 2, 1), (5, 2, 5)]
    v, w = [1.0, 0.0], [0.0, 1.0]
    vec = spark.createDataFrame([(3, v, 1), (1, w, 1), (3, w, 1), (2, v, 1)], "vec_id long, embedding array<double>, label int")
    assert sorted((x.vec_id, x.n_links, x.component_id) for x in emb.near_duplicates(vec).collect()) == [
        (1, 1, 1), (2, 1, 1), (3, 1, 1), (3, 1, 1)]


def test_bitmap_bound_never_loses_a_link():
    rows = varied(5, groups=6, copies=12)
    sets = ngr.word_sets([t for _, t in rows], 3)
    found = ngr.tile_forest(list(range(len(sets))), sets, np.zeros(len(sets), int), np.ones(len(sets), bool),
                            90, 100, False)
    links = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
             if 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))]
    n = range(len(sets))
    assert roots(n, found) == roots(n, links)
    assert len(found) < len(sets)


def test_components(spark):
    r = random.Random(3)
    links = [(k, k + 1) for k in range(100, 160)]  # a chain
    links += [(500, k) for k in range(501, 560)]  # a star
    links += [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(80)]
    links += [(7, 7), (9, None)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {x.node: x.component for x in connected_components(df).collect()}
    true = [x for x in links if None not in x and x[0] != x[1]]
    assert got == roots({n for x in true for n in x}, true)
    assert connected_components(df.limit(0)).collect() == []


def test_min_labels():
    assert min_labels(6, np.array([5, 3, 1]), np.array([3, 1, 4])).tolist() == [0, 1, 2, 1, 1, 1]
    assert min_labels(2, np.array([], int), np.array([], int)).tolist() == [0, 1]


def brute_vectors(rows, cosine=0.93):
    def ok(v):
        return v is not None and len(v) and None not in v and all(map(math.isfinite, v)) and any(v)

    use = [(i, np.array(v, float), name) for i, v, name in rows if i is not None and name is not None and ok(v)]
    links = [(a[0], b[0]) for a, b in itertools.combinations(use, 2)
             if a[2] == b[2] and len(a[1]) == len(b[1]) and a[0] != b[0]
             and a[1] @ b[1] / math.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= cosine]
    ids = {i for i, _, _ in rows if i is not None}
    root = roots(ids, links)
    n = {i: sum(i in x for x in links) for i in ids}
    return sorted((i, n[i], root[i], root[i] == i) for i, _, _ in rows if i is not None)


@pytest.mark.parametrize("dim, grid, blocks", [(64, 1, 4), (16, 2, 4), (3, 1, 8)])
def test_vectors_equal_brute_force(spark, dim, grid, blocks):
    r = np.random.default_rng(dim)
    rows, base = [], r.normal(size=(6, dim))
    for k in range(150):
        v = base[r.integers(6)] + r.normal(size=dim) * r.choice([0, .1, .25, .4])
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(r.integers(3))))
    rows += [(150, rows[0][1], rows[0][2]), (151, [x * 2 for x in rows[0][1]], rows[0][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = emb.near_duplicates(df, grid=grid, blocks=blocks, tile_rows=16)
    assert sorted(map(tuple, got.collect())) == brute_vectors(rows)


def test_vector_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None, 1), (2, [0.0, 0.0, 0.0], 1), (3, [1.0, None, 2.0], 1), (4, [1.0, float("nan"), 2.0], 1),
            (5, [1.0, float("inf"), 2.0], 1), (6, [], 1), (7, v, 1), (8, v, 1), (9, v, None), (10, v, 2),
            (11, [1.0, 2.0], 1), (12, [1e300, 2e300, 3e300], 1), (13, [1e-300, 2e-300, 3e-300], 1)]
    df = spark.createDataFrame([(*x, 0, "y") for x in rows],
                               "vec_id long, embedding array<double>, label int, n_links int, VEC string")
    exp = [(k, 0, k, True) for k in (1, 2, 3, 4, 5, 6, 9, 10, 11)] + [(7, 3, 7, True)] + [
        (k, 3, 7, False) for k in (8, 12, 13)]
    assert sorted(map(tuple, emb.near_duplicates(df).collect())) == sorted(exp)
    twice = spark.createDataFrame([(1, v, 1), (1, v, 1), (2, v, 1), (None, v, 1)],
                                  "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, emb.near_duplicates(twice).collect()), key=str) == sorted(
        [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, False)], key=str)
    assert emb.near_duplicates(df.limit(0)).collect() == []


def test_words_of_a_crowded_tile_are_cut_a_part_at_a_time():
    """pipeline: a tile's texts are not all lists of words at once, nor its bitmaps whole bytes a bit."""
    r = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in r.integers(0, 5000, 2000)) for _ in range(400)] + [None, "", " "]
    expected = [ngr.set_of(h, 5) for h in ngr.word_hashes([words(t) for t in texts])]
    tracemalloc.start()
    sets = ngr.word_sets(texts, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    some = ngr.tile_forest(list(range(400)), sets[:400], np.zeros(400, int), np.ones(400, bool), 80, 100, False)
    bits = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(sets, expected)) and len(sets) == 403 and not some
    assert peak < 30 << 20 and bits < 3 << 20, (peak, bits)
