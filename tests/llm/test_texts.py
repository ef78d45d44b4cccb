"""Operators on texts and pages against brute force, exact round trips and held-out accuracy."""

import html as html_lib
import itertools
import math
import random
import time
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import decontaminate as dec
from tillroll.llm import html_text as htm
from tillroll.llm import language_id as lng
from tillroll.llm import lm_score as lm
from tillroll.llm import packing as pck
from tillroll.llm import repeated_passages as rep
from tillroll.llm import token_files as tok
from tillroll.llm import totals as tot
from tillroll.llm import url_rules as url
from tillroll.llm.common import packed, scratch_path, unpacked, words
from tillroll.llm.token_ids import Encoder, production_path

SF = "/root/testdata/sf0.001"


def docs_of(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


# --- repeated passages

def test_passages_found_wherever_they_stand(spark):
    r = random.Random(1)
    word = [f"w{k}" for k in range(5000)]

    def some(n):
        return [r.choice(word) for _ in range(n)]

    passage = some(60)
    texts = {1: " ".join(some(80) + passage + some(90)), 2: "\n".join([" ".join(some(100) + passage), " ".join(some(40))]),
             3: " ".join(w.upper() for w in passage) + "\n" + " ".join(some(70)), 4: " ".join(some(200)),
             5: " ".join(some(30) + passage[:20] + some(30))}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: x for x in rep.remove_repeated(df).collect()}
    for k in (1, 4, 5):
        assert got[k].text == texts[k] and got[k].removed == []
    for k in (2, 3):
        gone = " ".join(texts[k][s.start:s.end] for s in got[k].removed).lower().split()
        assert len(gone) >= 60 - 2 * 15 and " ".join(gone) in " ".join(passage)
        assert got[k].text == rep.cut(texts[k], [(s.start, s.end) for s in got[k].removed])


def test_passages_equal_brute_force(spark):
    df = docs_of(spark).select("doc_id", "text")
    got = {x.doc_id: [(s.start, s.end) for s in x.removed] for x in rep.remove_repeated(df).collect() if x.removed}
    assert got == brute_occurrences([tuple(x) for x in df.collect()], 35, 16)
    assert got


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("aA zZ é\t\n\r\x0b\x1c\xa0 😀"), max_size=60))
def test_hashed_words(text):
    """Equal hashes for equal words, and their places in code points."""
    h, begin, line = rep.hashed_words(text)
    found = [m for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    assert begin.tolist() == [m.start() for m in found]
    assert line.tolist() == [text[:m.start()].count("\n") for m in found]
    w = [m[0].encode().lower() for m in found]
    assert len(set(zip(w, h.tolist()))) == len(set(w)) == len(set(h.tolist()))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
def test_picked_covers_every_window(values, reach):
    w = np.array(values, np.uint64)
    got = set(rep.picked(w, reach).tolist())
    for a in range(len(values) - reach + 1):
        near = values[a:a + reach]
        assert max(k for k in range(a, a + reach) if values[k] == min(near)) in got


def brute_lines(rows, floor):
    """Spans of repeated lines and paragraphs, by splitting the texts."""
    found = []
    for i, t in rows:
        for block in re.finditer(r"[^\n]+", t):
            found.append((i, block.start(), tuple(block[0].lower().split()), block[0]))
        at = 0
        for block in re.split(r"(\n\s*\n)", t):
            lines = [x for x in block.split("\n") if x.strip()]
            if len(lines) > 1:
                found.append((i, at + len(block) - len(block.lstrip()), tuple(block.lower().split()), block))
            at += len(block)
    seen, gone = set(), {}
    for i, start, w, block in sorted(found):
        if len(w) >= floor:
            if w in seen:
                start += len(block) - len(block.lstrip()) if block[0] == " " else 0
                gone.setdefault(i, set()).update(range(start, start + len(block.strip())))
            seen.add(w)
    return gone


@pytest.mark.parametrize("floor", [1, 4])
def test_lines_and_paragraphs_of_any_length(spark, floor):
    r = random.Random(8)
    pool = [" ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.randint(1, 9))) for _ in range(25)]
    rows = [(i, "".join(r.choice(pool).capitalize() + r.choice(["\n", "\n", "\n\n", "\n \n"]) for _ in range(r.randint(1, 9))))
            for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    space = lambda i, places: {k for k in places if not texts[i][k].isspace()}
    got = {x.doc_id: space(x.doc_id, {k for s in x.removed for k in range(s.start, s.end)})
           for x in rep.remove_repeated(df, line_words=floor).collect() if x.removed}
    assert got == {i: space(i, p) for i, p in brute_lines(rows, floor).items()} and len(got) > 20


def test_passage_edge_cases(spark):
    same = " ".join(f"x{k}" for k in range(60))
    rows = [(None, same), (1, None), (2, ""), (3, "short"), (4, same), (4, same), (5, same), (5, same), (6, same * 2)]
    df = spark.createDataFrame([(*x, "r", 1) for x in rows], "doc_id long, text string, removed string, _OF int")
    got = rep.remove_repeated(df)
    assert got.columns.count("removed") == 1
    by = {}
    for x in got.collect():
        by.setdefault(x.doc_id, []).append(x.text)
    assert by[None] == [same] and by[1] == [None] and by[2] == [""] and by[4] == [same, same]
    assert all(len(t.split()) <= 30 for t in by[5]) and len(by[5]) == 2
    assert rep.remove_repeated(df.limit(0)).collect() == []
    run = "the " * 300
    alone = spark.createDataFrame([(1, run)], "doc_id long, text string")
    assert rep.remove_repeated(alone).first().text == run


def brute_occurrences(rows, unit_words, reach):
    """Spans to remove: every unit but the first of its normalised words, by (doc_id, start)."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        _, _, start, end, line = rep.units(t, unit_words, reach)
        for a, b, whole in sorted(zip(start.tolist(), end.tolist(), line)):
            w = tuple(words(t[a:b]))
            u = whole, w if whole else w[:unit_words]
            if u in seen:
                out.setdefault(i, []).append((a, b))
            seen.add(u)
    return {i: rep.merged(s) for i, s in out.items()}


def test_passages_repeated_inside_one_document(spark):
    r = random.Random(3)

    def some(n):
        return " ".join(f"w{r.randrange(5000)}" for _ in range(n))

    passage, period = some(60), some(20) + " "
    inside = " ".join([some(40), passage, some(50), passage, some(45), passage])
    rows = [(1, inside), (2, period * 10), (3, some(200)), (4, some(70) + " " + passage), (4, some(90)),
            (None, passage + " " + passage), (5, some(50) + " " + period * 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # by text and id: the rows of 4 have texts of their own
    old = {(i, t[:60]): t for i, t in rows}
    got = {next(k for k in old if k[0] == x.doc_id and x.text[:60] == k[1]): x for x in rep.remove_repeated(df).collect()}
    assert len(got) == len(rows)
    for k, x in got.items():
        assert x.text == rep.cut(old[k], [(s.start, s.end) for s in x.removed])
    first = got[1, inside[:60]]
    assert first.text.count(passage) == 1 and len(first.text.split()) <= 40 + 60 + 50 + 45 + 2 * 30
    assert all(s.start > inside.index(passage) + len(passage) for s in first.removed)
    assert [bool(got[k].removed) for k in old] == [True, False, False, True, False, False, True]


def test_passages_equal_occurrences_by_brute_force(spark):
    df = docs_of(spark, "/root/testdata/sf0.01").select("doc_id", "text")
    rows = [tuple(x) for x in df.collect()]
    got = {x.doc_id: [(s.start, s.end) for s in x.removed] for x in rep.remove_repeated(df).collect() if x.removed}
    assert got == brute_occurrences(rows, 35, 16)


# --- decontamination

def brute_tiles(a, b, n):
    """Greedy string tiling by its definition."""
    ma, mb, out = [False] * len(a), [False] * len(b), []
    while True:
        best = None
        for i, j in itertools.product(range(len(a)), range(len(b))):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ma[i + k] and not mb[j + k]:
                k += 1
            if k >= n and (best is None or k > best[2]):
                best = (i, j, k)
        if best is None:
            return out
        i, j, k = best
        ma[i:i + k], mb[j:j + k] = [True] * k, [True] * k
        out.append(best)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=2, max_size=14), st.lists(st.integers(0, 3), max_size=20), st.integers(2, 4))
def test_tiles_equal_definition(a, b, n):
    pairs = [(i, j) for i in range(len(a) - n + 1) for j in range(len(b) - n + 1) if a[i:i + n] == b[j:j + n]]
    got = dec.tiles(*np.array(pairs).T, n) if pairs else []
    assert got == brute_tiles(a, b, n)


def test_contamination(spark):
    r = random.Random(2)
    item = [f"b{k}" for k in range(40)]
    other = [f"d{k}" for k in range(400)]
    shuffled = item[25:] + [r.choice(other)] + item[:25]
    rows = [(1, " ".join(other[:50] + item + other[50:])), (2, " ".join(shuffled).upper() + "!"), (3, " ".join(item[:15])),
            (4, None), (5, ""), (6, " ".join(other)), (6, " ".join(other)), (None, ", ".join(item)), (7, "tiny one")]
    df = spark.createDataFrame([(*x, 3, "c") for x in rows], "doc_id long, text string, item_id int, CONTAMINATED string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item)), (3, None), (4, ""), (5, "tiny one")],
                                  "item_id long, text string")
    got = dec.find_contamination(df, bench)
    assert sorted(got.columns) == ["contaminated", "coverage", "covered", "doc_id", "item_id", "text"]
    by = {x.doc_id: x for x in got.collect()}
    assert [k for k in (1, 2, 3, 4, 5, 6, 7, None) if by[k].contaminated] == [1, 2, 7, None]
    assert by[1].coverage == by[2].coverage == 1 and by[1].item_id == 1 and by[3].coverage == 15 / 40
    assert by[4].item_id is None and by[4].coverage == 0 and by[7].item_id == 5
    one_by_one = dec.find_contamination(df, bench, group_items=1)  # an item per group
    assert sorted(map(str, one_by_one.collect())) == sorted(map(str, got.collect()))
    assert not any(x.contaminated for x in dec.find_contamination(df, bench.limit(0)).collect())
    assert dec.find_contamination(df.limit(0), bench).collect() == []


def test_contamination_equals_brute_force(spark):
    docs = docs_of(spark).select("doc_id", "text")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [dec.tokens(x.text) for x in bench.collect()]
    true = set()
    for x in docs.collect():
        t = dec.tokens(x.text)
        grams = Counter(tuple(t[k:k + 5]) for k in range(len(t) - 4))
        for w in items:
            if sum(tuple(w[k:k + 5]) in grams for k in range(len(w) - 4)):
                if sum(k for _, _, k in brute_tiles(w, t, 5)) >= .6 * len(w):
                    true.add(x.doc_id)
    got = {x.doc_id for x in dec.find_contamination(docs, bench).collect() if x.contaminated}
    assert got == true and got


# --- packing

def test_encoder_equals_whole_texts(spark):
    e = Encoder(production_path())
    assert e.apart
    texts = [x.text for x in docs_of(spark).collect()] + [
        None, "", " \n\t ", "It's the DON'T ' 's x'S Σας ΑΣ İstanbul a\x1cb <|endoftext|>x ½ ² 12.5 _a_ ß ǅ a\xa0b",
        "é ́ a b 日本語 \U0001f600!! a'll'd", "x" * 5000]
    whole = [np.array(e.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode(texts) == whole


def test_packing(spark):
    df = docs_of(spark).select("doc_id", "text")
    extra = spark.createDataFrame([(None, "no id"), (1, None), (1, ""), (1, ""), (10**15, "word " * 9000)], df.schema)
    df = df.union(extra)
    got = pck.pack(df.withColumn("LENGTH", F.lit(1))).collect()
    e = Encoder(production_path())
    expected = Counter()
    for d, t in df.collect():
        ids = e.encode([t])[0] + b"\0\0\0\0"
        for k in range(-(-len(ids) // 8192)):
            part = ids[k * 8192:(k + 1) * 8192]
            expected[d, k, k * 2048, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == expected
    held = {}
    for x in got:
        held.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(x.length for x in got)
    assert len(held) <= math.ceil(total / 2048 * 1.02) + 1
    assert pck.pack(df.limit(0)).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 5))
def test_open_bins_follow_the_rule(lengths, limit):
    bins = pck.OpenBins(20, limit)
    free = {}  # open bins by plain search
    for n in lengths:
        number, at = bins.put(n)
        fits = [f for f in free.values() if f >= n]
        if fits:
            assert free[number] == min(fits)
        else:
            assert number not in free
            if len(free) >= limit:
                full = min(free.values())
                closed = [k for k, f in free.items() if f == full and k not in itertools.chain(*bins.by_free.values())]
                assert closed
                del free[closed[0]]
            free[number] = 20
        assert at == 20 - free[number]
        free[number] -= n
        if not free[number]:
            del free[number]
        assert bins.open == len(free) <= limit


# --- URL rules

def brute_verdict(u, rules):
    host = path = ""
    if u is not None and "://" in u:
        host, path, _ = re.fullmatch(r"(?s)([^/?#]*)([^?#]*)(.*)", u.split("://", 1)[1]).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(-len(h + p), -len(h), v != "block", h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p) and " " not in host]
    return (host, path, min(fit)[3], min(fit)[4]) if fit else (host, path, None, "allow")


def test_url_rules(spark):
    rules = [*url.PRODUCTION_RULES, ("block", "x.com", "/a.b"), ("allow", "com", "/a.b/c"), ("block", "net", ""),
             ("block", "org", "/q"), ("allow", "Org", "/r+(")]
    hosts = ["example.org", "www.Example.ORG", "notexample.org", "x.com", "a.x.com", "com", "", "net", "EXAMPLE.org:80", "é.com"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/123/x", "/en/2", "/fr/", "/de/x?y", "/a.b", "/aXb", "/a.b/c#d", "/r+(x",
             "/de/://x", "//es/", "/\nes/"]
    urls = [f"{s}://{h}{p}" for s in ("http", "") for h in hosts for p in paths] + [None, "", "example.org/es/", "://", "http://"]
    df = spark.createDataFrame([(k % 7, u, "h") for k, u in enumerate(urls * 2)], "page_id long, url string, host string").withColumn("_url", F.lit(1))
    got = sorted(((x.url, x.host, x.path, x.rule, x.verdict) for x in url.judge_urls(df, rules).collect()), key=str)
    low = [(v, h.lower(), p) for v, h, p in rules]
    assert got == sorted(((u, *brute_verdict(u, low)) for u in urls * 2), key=str)
    assert url.judge_urls(df.limit(0), rules).collect() == []
    none = spark.createDataFrame([], "verdict string, host string, path string")
    assert {x.verdict for x in url.judge_urls(df, none).collect()} == {"allow"}


def test_url_rules_hosts_with_spaces(spark):
    rules = [*url.PRODUCTION_RULES, ("block", "b c.net", "/"), ("block", "", "/any"), ("block", "net", "")]
    expected = {"http://a b.example.org/es/x": ("example.org/es/", "block"), "http:// example.org/es/": ("org/", "allow"),
                "http://example.org /es/": (None, "allow"), "http://b c.net/x y": ("b c.net/", "block"),
                "http://a\n.b c.net/": ("b c.net/", "block"), "http://xb c.net/": ("net", "block"),
                "http://a b/any": ("/any", "block"), "http://example.org/es / x": ("org/", "allow"),
                "http://a b.net\n/": (None, "allow")}
    df = spark.createDataFrame([(u,) for u in expected], "url string")
    assert {x.url: (x.rule, x.verdict) for x in url.judge_urls(df, rules).collect()} == expected


def test_url_rules_run_no_python(spark):
    plan = url.query(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- main text

def expected_text(page):
    """The article of the test pages, by cutting their known frame."""
    m = re.search(r"<article>(.*?)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", m[1]) if m else []
    blocks = (" ".join(html_lib.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in blocks)
    return "\n\n".join(b for b in blocks if b)


def test_main_text_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {x.page_id: x.text for x in htm.query(spark, SF).collect()}
    assert got == {x.page_id: expected_text(x.html) for x in pages.collect()}


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="top"><h1>Site name</h1></header>
<ul class="menu"><li><a href=/>Home</a><li><a href=/x>News</a></ul><div id="cookie-notice"><p>We use cookies here.</p></div>
<div class="content"><h1>Long&nbsp;title &amp; more</h1><p>First  paragraph with
several <b>bold</b> words&#46;</p><!-- note --><aside><p>See also this and that and more of it.</p></aside>
<script>if (a < b) document.write("<p>no</p>")</script><p>Second paragraph, <a href=y>linked</a> words follow here<br>and go on.</p>
<form><label>Mail</label><input name=q></form><ul><li>one point</li><li>another point</li></ul></div>
<section class="comments"><h3>Comments</h3><p>Nice article, thanks a lot to all of you from me.</p></section>
<footer><p>&copy; 2020 all rights reserved by somebody</p></footer></body></html>"""


def test_main_text_without_article_markup():
    assert htm.main_text(PAGE, htm.Weights()) == "\n\n".join([
        "Long title & more", "First paragraph with several bold words.",
        "Second paragraph, linked words follow here and go on.", "one point", "another point"])


def test_main_text_edge_cases(spark):
    w = htm.Weights()
    rows = [(1, None), (2, ""), (3, "<p></p>"), (4, "just words"), (5, "<p>a" + " b" * 200_000), (6, "<script>x y z"),
            (7, "<p title='a > b'>one</p><p>two < three"), (7, "<p title='a > b'>one</p><p>two < three"), (8, "<" * 500)]
    df = spark.createDataFrame([(*x, "t", 1) for x in rows], "page_id long, html string, TEXT string, n int")
    got = {x.page_id: x.text for x in htm.extract_main_text(df, w).collect()}
    assert got[1] == got[2] == got[3] == got[6] == "" and got[4] == "just words"
    assert len(got[5]) == 400_001 and got[7] == "one\n\ntwo < three"
    assert htm.extract_main_text(df.limit(0), w).collect() == []
    assert htm.fit_weights(df.limit(0)) == w


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=25))
def test_best_region_is_the_largest_sum(scores):
    a, b = htm.best_region(scores)
    most = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
    assert sum(scores[a:b]) == max(most, 0)


# --- token files

def test_token_files_round_trip(spark):
    df = docs_of(spark).select("doc_id", "text").withColumn("start", F.lit("clash"))
    extra = spark.createDataFrame([(None, "no id", ""), (-5, None, ""), (7, "again", ""), (7, "again", "")], df.schema)
    df, path = df.union(extra), scratch_path(spark, "t")
    manifest = tok.write_tokens(df, path, production_path(), length=256, shard_bytes=100_000)
    got = sorted((tuple(x) for x in tok.read_documents(spark, path).collect()), key=lambda x: x[1])
    e = Encoder(production_path())
    texts = Counter((d, e.encode([t])[0] + b"\2\0\0\0") for d, t, _ in df.collect())
    assert Counter((d, bytes(b)) for d, _, _, b in got) == texts
    at, ids = 0, []
    for d, start, n, data in got:
        assert start == at and len(data) == 4 * n
        at += n
        ids.append(d)
    assert ids == [None, *sorted(d for d in ids if d is not None)]
    shards = sorted(manifest.collect())
    assert len(shards) > 3 and sum(x.n_tokens for x in shards) == at
    # equal-length sequences and masks, as views of the mapped file
    for x in shards:
        s = tok.Shard(path, x.shard)
        used = 0
        for k in range(-(-x.n_tokens // 256)):
            tokens, mask = s.sequence(k)
            assert len(tokens) == len(mask) == 256 and tokens.dtype == np.uint16
            assert tokens.base is not None and not tokens.flags.owndata
            used += pa.compute.sum(mask).as_py()
        assert used == x.n_tokens
    empty = scratch_path(spark, "t")
    tok.write_tokens(df.limit(0), empty, production_path())
    assert tok.read_documents(spark, empty).collect() == []


def test_a_shard_written_twice_is_the_same(spark):
    path, df = scratch_path(spark, "t"), docs_of(spark)
    tok.write_tokens(df, path, production_path())
    first = open(f"{path}/shard-0000000.arrow", "rb").read()
    other = scratch_path(spark, "t")
    tok.write_tokens(df.repartition(5), other, production_path())
    assert open(f"{other}/shard-0000000.arrow", "rb").read() == first


# --- language ID

def test_language_accuracy_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = lng.query(spark, sf).join(docs_of(spark, sf).select("doc_id", "lang"), "doc_id")
    n, right = got.where("held_out and lang_pred <> 'und'").agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200 and right / n > .97


def test_language_landmarks_travel_as_buckets():
    """pipeline, op9: the function sent to the tasks holds no matrix of landmarks by buckets, and adds up the same."""
    from pyspark.cloudpickle import dumps
    rng = np.random.default_rng(1)
    marks = [np.unique(rng.integers(0, lng.BUCKETS, 900)) for _ in range(64)]
    root = rng.random((64, 64))
    sums = lng._sums(marks, root, ["a", "b"])
    assert len(dumps(sums)) < 1 << 18 < lng._rows(marks).nbytes
    texts = ["some words here", "d'autres mots", "", "123"]
    got = next(sums([pa.RecordBatch.from_pydict({"text": texts, "lang": list("abab")})])).to_pydict()
    phi = lng.kernel([lng.ngrams(t) for t in texts], marks).astype(float) @ root
    assert np.allclose(np.frombuffer(got["gram"][0]).reshape(64, 64), phi.T @ phi)
    assert np.allclose(np.frombuffer(got["cross"][0]).reshape(64, 2), np.stack([phi[0] + phi[2], phi[1] + phi[3]], 1))


def test_language_edge_cases(spark):
    docs = docs_of(spark)
    model = lng.fit_production(docs)
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (4, "the and of the with"), (4, "the and of the with"), (5, "x" * 300_000)]
    df = spark.createDataFrame([(*x, 7, "s") for x in rows], "doc_id long, text string, score int, LANG_PRED string")
    got = lng.identify(df, model)
    assert sorted(got.columns) == ["doc_id", "lang_pred", "score", "text"]
    by = {x.doc_id: x for x in got.collect()}
    assert [by[k].lang_pred for k in (1, 2, 3, 4)] == ["und", "und", "und", "en"] and by[1].score == 0
    assert all(0 <= x.score <= 1 for x in by.values())
    assert lng.identify(df.limit(0), model).collect() == []
    assert lng.fit(docs.limit(0)) is None
    assert {x.lang_pred for x in lng.identify(df, None).collect()} == {"und"}
    assert lng.fit(spark.createDataFrame([(1, "123", "en"), (2, None, "en")], "doc_id long, text string, lang string")) is None


def test_language_scores_equal_the_kernel():
    """Folding the landmarks into one matrix gives what the kernel itself gives."""
    texts = ["the cat and the dog", "der hund und die katze", "le chien et le chat", "el perro y el gato"]
    sets = [lng.ngrams(t) for t in texts]
    for a, b in itertools.product(range(4), repeat=2):
        x, y = set(sets[a]), set(sets[b])
        assert abs(lng.kernel(sets, sets)[a, b] - len(x & y) / math.sqrt(len(x) * len(y))) < 1e-6
    alpha = np.arange(8.0).reshape(4, 2)
    model = lng.Model(["p", "q"], (lng._rows(sets).T @ alpha).astype(np.float32))
    assert np.allclose(lng.score(sets, model), lng.kernel(sets, sets) @ alpha, atol=1e-4)


def test_stray_labels_are_not_learned(spark):
    df = docs_of(spark).select("doc_id", "text", "lang")
    stray = df.withColumn("lang", F.concat(F.lit("x"), F.col("doc_id").cast("string"))).limit(120)
    model = lng.fit(df.unionByName(stray), max_labels=4, landmarks=20)
    assert model.languages == sorted(r[0] for r in df.where("lang is not null").select("lang").distinct().collect())[:4]


# --- hostile pages and items

def test_unclosed_tags_take_linear_time():
    page = "<div class=x><p>" * 40_000 + "words of the text " * 10 + "</section>" * 30_000 + "</div>" * 40_000
    start = time.perf_counter()
    assert "words of the text" in htm.main_text(page, htm.Weights())
    page = "<div class=ad><article>" * 40_000 + "words of the text " * 10
    htm.main_text(page, htm.Weights())
    assert time.perf_counter() - start < 20


def test_equal_words_are_tiled_in_time():
    start = time.perf_counter()
    code = dec.Coder()
    found = dec.Block([(1, code("same " * 20_000)), (2, code("same " * 7))], 5).coverage(code("same " * 20_000))
    assert sorted(found) == [(1, 1.0, 20_000), (2, 1.0, 7)]
    assert time.perf_counter() - start < 20


def test_tiles_by_length_equal_tiles_by_seeds():
    r = random.Random(9)
    for _ in range(200):
        a = np.array([r.choice([1, 1, 1, 2, 3]) for _ in range(r.randint(3, 25))], np.uint64)
        b = np.array([r.choice([1, 1, 2, 2, 3]) for _ in range(r.randint(3, 40))], np.uint64)
        n = r.randint(1, 4)
        i, j = np.nonzero(dec.seeds(a, n)[:, None] == dec.seeds(b, n)[None, :])
        assert dec.tiles(i, j, n) == dec.tiles_by_length(a, b, n)


def test_a_short_item_needs_enough_words(spark):
    docs = spark.createDataFrame([(1, "yes it is so"), (2, "one two three four five six")], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "yes"), (2, "two three four five six")], "item_id int, text string")
    got = {r.doc_id: (r.item_id, r.coverage, r.covered, r.contaminated) for r in dec.find_contamination(docs, bench).collect()}
    assert got == {1: (1, 1.0, 1, False), 2: (2, 1.0, 5, True)}


# --- language-model scores

def smoothed(rows, kappa, order=3):
    """p(v | history) by the formulas, and the counts of the words and of all tokens."""
    seen, total = Counter(), 0
    for _, t, learn in rows:
        if learn:
            run = ["start", *words(t), "end"]
            total += len(run) - 1
            seen.update(tuple(run[a:b]) for b in range(2, len(run) + 1) for a in range(max(0, b - order), b))
            seen["start",] += 1
    one = {g[0]: n for g, n in seen.items() if len(g) == 1 and g[0] != "start"}

    def p(history, v):
        if not history:
            return (one.get(v, 0) + .1) / (total + .1 * (len(one) + 1))
        return (seen[*history, v] + kappa * p(history[1:], v)) / (seen[history] + kappa)

    return p, one, total


def brute_scores(rows, kappa, order=3):
    """rows: (id, text, training). One token after the other."""
    p, one, total = smoothed(rows, kappa, order)
    out = []
    for i, t, learn in rows:
        run = ["start", *words(t), "end"]
        score = sum(math.log10(p(tuple(run[max(0, k - order + 1):k]), run[k])) for k in range(1, len(run)))
        out.append((i, bool(learn), len(run) - 1, sum(v in one for v in run[1:]), total,
                    sum(math.log10(p((), v)) for v in run[1:]), score))
    return out


def close(got, expected):
    key = lambda x: str(x[:4])
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert [x[:5] for x in got] == [x[:5] for x in expected]
    for a, b in zip(got, expected):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("block_bytes, order", [(1 << 24, 3), (20_000, 3), (20_000, 2)])
def test_scores_equal_brute_force(spark, block_bytes, order):
    df = docs_of(spark).select("doc_id", "text").withColumn("learn", F.col("doc_id") % 3 != 0).repartition(3)
    got = lm.score_texts(df, "learn", block_bytes=block_bytes, order=order).collect()
    close(got, brute_scores([tuple(x) for x in df.collect()], 4.0, order))


def automaton_scores(rows, kappa, order):
    """One block of all rows, by the operator's own parts, without Spark."""
    parts = lm.Parts(order)
    for k, (_, t, _) in enumerate(rows):
        parts.add(k, t)
    block = lm.Block(*parts.arrays(), order)
    row = np.array([r for r, _ in parts.rows])
    learn = np.array([bool(x[2]) for x in rows])
    total, _ = block.totals(block.counts(learn[row]), {}, 1)
    word = (block.keys & np.uint64(7)) == 0
    n_words, n_kinds = int(total[word].sum()), int((total[word] > 0).sum())
    found = lm.Automaton(block, total, n_words, n_kinds, int(learn.sum()), kappa).walk(block)
    return np.bincount(row, found, len(rows)), (n_words, n_kinds)


@pytest.mark.parametrize("order", [1, 2, 3, 4, 5])
def test_one_pass_over_parts_equals_brute_force(order, monkeypatch):
    monkeypatch.setattr(lm, "PART", 7)
    rng = random.Random(order)
    rows = [(k, " ".join(rng.choice("aaabbcdé") for _ in range(rng.randint(0, 60))), rng.random() < .6) for k in range(60)]
    rows += [(98, "new words only here", False), (99, "a b new a b c a b", False)]
    got, _ = automaton_scores(rows, 4.0, order)
    assert got == pytest.approx([x[6] for x in brute_scores(rows, 4.0, order)], rel=1e-9)


def test_long_texts_are_read_in_runs():
    text = "Ab  cd\n" * 50 + "x" * 100
    assert [w for run in lm.word_runs(text, room=17) for w in run] == words(text)
    assert list(lm.word_runs(None)) == [] and [w for run in lm.word_runs(" \x0b ", 1) for w in run] == []


def test_totals_go_beyond_32_bits():
    keys = [np.array([8, 9, 16], np.uint64), np.array([8, 16], np.uint64)]
    counts = [np.array([2**32 - 1, 5, 1], np.int64), np.array([2**32 - 1, 2], np.int64)]
    found, total, places, held = tot.add_up(keys * 3, counts * 3, np.int64)
    assert held.tolist() == [2, 2, 2] and tot.add_up(keys, counts, np.int64)[3].tolist() == [2, 1, 2]
    assert found.tolist() == [8, 9, 16] and total.tolist() == [6 * (2**32 - 1), 15, 9]
    assert places[1].tolist() == [0, 2] and tot.add_up(keys, counts, np.uint8)[1].tolist() == [255, 5, 3]


@pytest.mark.parametrize("direct", [0, 1000])
def test_totals_over_blocks(spark, direct):
    r = np.random.default_rng(1)
    messages, totals = {}, Counter()
    for n_blocks in (30, 120):
        rows, totals, held = [], Counter(), {}
        n = tot.slice_count(n_blocks, direct)
        for b in range(n_blocks):
            keys = np.unique(r.integers(0, 1 << 64, 3000, np.uint64, endpoint=False) | np.uint64(1 << 63 if b % 2 else 0))
            keys = np.unique(np.concatenate([keys[:2990], np.arange(0, 10, dtype=np.uint64) << np.uint64(60)]))
            counts = r.integers(0, 9, len(keys)).astype(np.int64)
            held[b] = keys
            totals.update(dict(zip(keys.tolist(), counts.tolist())))
            rows += tot.messages(b, keys, counts, n).to_pylist()
        sent = spark.createDataFrame(rows, tot.SENT)
        answers, (sums, kinds) = tot.corpus_totals(sent, n_blocks, np.int64, lambda k, t: (t.sum(), len(k)), direct, marked=True)
        holders = Counter(k for keys in held.values() for k in keys.tolist())
        got = answers.collect()
        assert (sums, kinds) == (sum(totals.values()), len(totals)) and len(got) == len(rows)
        for b, keys in held.items():
            mine = sorted((x["slice"], x["totals"]) for x in got if x["of_block"] == b)
            told = np.concatenate([tot.unpacked(t, np.int64) for _, t in mine])
            assert (told & ~tot.SHARED).tolist() == [totals[k] for k in keys.tolist()]
            assert (told < 0).tolist() == [holders[k] > 1 for k in keys.tolist()]
        messages[n_blocks] = len(rows)
    # four times the blocks: sixteen times the messages, or less than ten
    assert messages[120] / messages[30] < 10 or direct


def test_the_model_is_a_distribution():
    """Over all known words and one unknown, the probabilities after any history add up to one."""
    p, one, _ = smoothed([(1, "a b a c a b b", True), (2, "b a", True)], 4.0)
    for history in ((), ("a",), ("b",), ("start",), ("a", "b"), ("start", "b"), ("c", "c"), ("z", "a")):
        assert sum(p(history, v) for v in [*one, "unknown"]) == pytest.approx(1)


def test_ids_of_every_character_below_250_hex():
    e = Encoder(production_path())
    r = random.Random(6)
    texts = [form.format(chr(k)) for k in range(1, 0x250) for form in ("{}", "a{}", "{}b", "a{}b", " {} x", "1{}2")]
    pool = [chr(k) for k in range(1, 0x250)] + [" "] * 60
    texts += ["".join(r.choice(pool) for _ in range(r.randint(1, 30))) for _ in range(8000)]
    whole = e.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert e.encode(texts) == [np.array(w.ids, "<u4").tobytes() for w in whole]


def test_scores_beat_the_base_on_held_out_texts(spark):
    held, base, full = lm.query(spark, "/root/testdata/sf0.01").where("held_out").agg(
        F.count("*"), F.sum("base_score"), F.sum("score")).first()
    assert held > 50 and full > base


def test_answers_are_written_once(spark, monkeypatch):
    """op10: the totals of a level are not written again with those of the next."""
    written, stored = [], lm.stored

    def kept(df, name):
        out = stored(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(lm, "stored", kept)
    docs = spark.createDataFrame([(k, f"the cat sat on the mat {k % 7} and the dog ran {k}", k % 3 > 0) for k in range(60)],
                                 "doc_id long, text string, training boolean")
    lm.score_texts(docs, "training", order=4, block_bytes=400).count()
    sizes = [n for name, n in written if name == "lm_totals"]
    blocks = dict(written)["lm_blocks"]
    # of each longer level at most one answer a block and slice
    assert len(sizes) == 2 and all(n <= blocks * tot.slice_count(blocks) for n in sizes)
    assert sizes[1] <= sizes[0]


@pytest.mark.parametrize("dtype", [np.uint8, np.uint32, np.int64])
def test_packed_numbers_are_compressed(dtype):
    values = np.minimum(np.random.default_rng(4).geometric(0.4, 20_000), 200).astype(dtype)
    data = packed(values)
    assert (unpacked(data, dtype) == values).all() and len(data) < 0.4 * len(values)
    assert len(unpacked(packed(values[:0]), dtype)) == 0 and unpacked(packed(values[:1]), dtype).tolist() == [values[0]]


def test_walk_reads_all_tokens_at_once(monkeypatch):
    """op10: the steps of a walk do not grow with a part's tokens."""
    parts = lm.Parts(3)
    parts.add(0, "a b c d e " * 800)
    block = lm.Block(*parts.arrays(), 3)
    total = block.counts(np.array([True]))
    found = lm.Automaton(block, total, 4001, 6, 1, 4.0)
    calls = []
    where = np.where
    monkeypatch.setattr(np, "where", lambda *a: calls.append(1) or where(*a))
    assert len(found.walk(block)) == 1 and len(calls) < 50
