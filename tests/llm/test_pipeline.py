"""Registered queries against their SQL, and the pipeline's stages against brute force."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipe
from tillroll.llm.decontaminate import Block, Coder
from tillroll.llm.language_id import ngrams
from tillroll.llm.common import words
from tillroll.llm.queries import ORACLE, QUERIES
from tillroll.llm.token_ids import Encoder, production_path

from test_joins import brute_documents
from test_texts import brute_occurrences
from tillroll.llm.repeated_passages import cut

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    expected = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.select(*cols).collect()), key=str) == sorted(expected, key=str)


def test_all_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")}
    assert names["pipeline"] is pipe.run
    assert set(entry.oracle_sql()) <= set(names)


def test_stages_equal_brute_force(spark):
    """Each stage over its own input; the last one's ids against the whole texts'."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    code = Coder()
    bench = Block([(i, code(t)) for i, t in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()], 5)
    rows = {x.doc_id: x.asDict() for x in docs.collect()}
    for name, stage in pipe.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        if name == "language":
            rows = {i: r for i, r in rows.items() if len(ngrams(r["text"]))}
        elif name == "near_duplicates":
            same = brute_documents([(i, r["text"]) for i, r in rows.items()], 5, 80, 100)
            rows = {i: rows[i] for i, _, root in same if i == root}
        elif name == "repeated_passages":
            gone = brute_occurrences([(i, r["text"]) for i, r in rows.items()], 35, 16)
            rows = {i: r | {"text": cut(r["text"], gone.get(i, []))} for i, r in rows.items()}
            rows = {i: r for i, r in rows.items() if words(r["text"]) or i not in gone}
            rows = {i: r | {"n_chars": len(r["text"])} for i, r in rows.items()}
        elif name == "benchmark":
            rows = {i: r for i, r in rows.items() if all(c < .6 or n < min(5, len(code(r["text"]))) for _, c, n in bench.coverage(code(r["text"])))}
        found = docs.collect()
        assert {x.doc_id: x.asDict() for x in found} == rows and len(found) == len(rows)
        docs = spark.createDataFrame(found, docs.schema)
    enc = Encoder(production_path())
    got = {}
    for x in pipe.STAGES[-1][1](spark, docs, SF).collect():
        got[x.doc_id] = got.get(x.doc_id, 0) + x.length
    assert got == {i: len(enc.encode([r["text"]])[0]) // 4 + 1 for i, r in rows.items()}


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, _lang_pred string, removed int"
    same = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80))
    rows = [(1, None, None, None, None, 1, "k", 2), (2, "", "en", "s", 0, 1, "k", 2), (3, same, "en", None, 9, None, None, None),
            (3, same, "en", None, 9, None, None, None), (4, same + " more", None, "s", None, 5, "k", 2),
            (None, "an unnamed text", "en", "s", 3, 5, "k", 2), (5, "12 34", "de", "s", 5, 5, "k", 2)]
    docs = spark.createDataFrame(rows, schema)
    kept = {"language": 4, "near_duplicates": 2, "repeated_passages": 2, "benchmark": 2}
    for name, stage in pipe.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == spark.createDataFrame([], schema).columns
        found = docs.collect()
        assert len(found) == kept[name], name
        assert {x.score for x in found} <= {5, None}
        docs = spark.createDataFrame(found, schema)
    assert {x.doc_id for x in pipe.STAGES[-1][1](spark, docs, SF).collect()} == {3, None}
    empty = spark.createDataFrame([], schema)
    for _, stage in pipe.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_near_duplicates_by_row(spark):
    """Different texts of one id all stay, near copies without an id are reduced."""
    def some(name, more=""):
        return " ".join(f"{name}{k}" for k in range(80)) + more

    rows = [(7, some("a"), 1), (7, some("b"), 2), (7, some("b"), 2), (8, some("b", " more"), 3), (None, some("c"), 4),
            (None, some("c", " more"), 4), (None, some("c"), 4), (None, some("a", " more"), 5), (9, some("d"), 6),
            (3, some("d", " more"), 7), (None, some("e"), 8), (None, None, 9), (None, None, 9), (None, " ", 10), (5, None, 11),
            (5, "", 12), (2, some("f"), 13), (2, some("f", " more"), 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key int")
    stage = dict(pipe.STAGES)["near_duplicates"]
    got = stage(spark, docs, SF)
    assert got.columns == docs.columns
    found = got.collect()
    assert sorted(x._key for x in found) == [1, 2, 4, 7, 8, 9, 9, 10, 11, 12, 13]
    assert {x.doc_id for x in found} == {None, 2, 3, 5, 7}
    assert stage(spark, docs.limit(0), SF).collect() == []
