"""From raw documents to packed training sequences, one written stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, language_id, ngram_join, packing, repeated_passages
from tillroll.llm.common import free_prefix, read, scratch_path, stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows; what it calls ``und`` goes, and so do null texts.

    It learns from the stage's own labelled documents.
    """
    free = free_prefix(docs)
    found = language_id.identify(docs, language_id.fit_production(docs), prefix=free)
    return found.where(F.col(f"{free}lang_pred") != language_id.UNKNOWN).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8): the smallest id.

    Rows of one id and one text are one document, of which one row stays. Rows of one id with
    different texts are documents of their own, and so are rows without an id, which
    come after all others. Of rows without an id those without words all stay.
    """
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty() and docs.where("doc_id is null").isEmpty():
        same = ngram_join.similar_documents(docs, n=5, num=80, den=100)
        others = same.where("doc_id <> component_id").select("doc_id").distinct()
        return docs.join(others, "doc_id", "left_anti").select(*docs.columns)
    return _one_of_each_row(docs, repeated)


def _one_of_each_row(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``one_of_each`` by rows: those without an id, or whose id is among ``repeated``, get one made of id and text."""
    free = free_prefix(docs)
    key, odd = f"{free}key", f"{free}odd"
    made = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    named = (docs.where("doc_id is not null")
             .join(repeated.select(F.col("doc_id").alias(f"{free}of")), F.col("doc_id") == F.col(f"{free}of"), "left")
             .withColumn(odd, F.col(f"{free}of").isNotNull()).drop(f"{free}of"))
    unnamed = docs.where("doc_id is null").withColumn(odd, F.lit(True))
    rows = stored(named.union(unnamed).withColumn(key, F.when(F.col(odd), made).otherwise(F.col("doc_id"))), "rows")

    same = ngram_join.similar_documents(rows, doc_id=key, n=5, num=80, den=100)
    found = (same.select("doc_id", "component_id").distinct().withColumnRenamed("doc_id", f"{free}of")
             .join(rows.select(key, F.col("doc_id").alias(f"{free}id")).distinct(), F.col(f"{free}of") == F.col(key)))
    kept = (found.groupBy("component_id")
            .agg(F.min(F.struct(F.col(f"{free}id").isNull(), f"{free}id", key)).alias("first"))
            .select(F.col(f"first.{key}").alias(key)))
    stay = rows.join(kept, key, "left_semi").select(*rows.columns)
    wordless = F.col("doc_id").isNull() & ~F.coalesce(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    single = F.col(odd) & ~wordless
    return (stay.where(~single).union(stay.where(single).dropDuplicates([key]))).select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines, paragraphs and passages that stand earlier are cut out of the text; ``n_chars`` follows.

    A document that holds nothing else goes.
    """
    gone = f"{free_prefix(docs)}removed"
    found = repeated_passages.remove_repeated(docs, removed=gone)
    left = (F.size(gone) == 0) | F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    return found.where(left).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    free = free_prefix(docs)
    found = decontaminate.find_contamination(docs, read(spark, sf_dir, "benchmark"), prefix=free)
    return found.where(~F.col(f"{free}contaminated")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("repeated_passages", without_repeats),
    ("benchmark", without_benchmark),
    ("packing", packed),
]

#: Classifier, tiling and tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
