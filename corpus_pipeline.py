"""The corpus pipeline: documents in, cleaned, mixed and encoded documents out.

Each stage is written as Parquet to the shared folder and read again by the next one. Rows keep their columns through all
stages but the last; a stage changes rows, never the order or the names of columns. Null texts and empty tables pass through;
see the operators for what each of them does with nulls, ties, repeated rows and very long texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.minhash import one_of_each
from shelfcast.llm.mixing import mixed_documents
from shelfcast.llm.pieces import decode_ids, encode_texts
from shelfcast.llm.store import packed, saved, unpacked
from shelfcast.llm.templates import deduplicated_documents
from shelfcast.llm.toxicity import fit_grammar, score_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half."""
    grammar = fit_grammar(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(packed(docs, text=F.col("text")), grammar)
    return unpacked(scored.where("toxicity < 0.5"))


def drop_templates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that recur across documents."""
    done = deduplicated_documents(docs)
    if "n_chars" not in docs.columns:
        return done
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all without words."""
    return one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document taken twice is there twice."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether they decode to the same text."""
    coded = decode_ids(encode_texts(docs.select("doc_id", "source", "text")))
    n = F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("bigint")
    return coded.select("doc_id", "source", "ids", n.alias("n_pieces"), F.col("decoded").eqNullSafe(F.col("text")).alias("same"))


STAGES: list[tuple[str, Stage]] = [
    ("drop_toxic", drop_toxic),
    ("drop_templates", drop_templates),
    ("drop_near_duplicates", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]
#: SQL can't express the learned grammar, the draws by hash and the tokenizer; tests compare with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
