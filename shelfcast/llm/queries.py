"""The operators applied to the whole given tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.html import extract_text
from shelfcast.llm.importance import resample
from shelfcast.llm.minhash import near_duplicates
from shelfcast.llm.mixing import mix_sources
from shelfcast.llm.mixing_model import score_texts
from shelfcast.llm.oracles import ORACLES  # noqa: F401
from shelfcast.llm.phrases import collocations
from shelfcast.llm.pieces import decode_ids, encode_texts
from shelfcast.llm.pii import find_personal_data
from shelfcast.llm.projection import near_vectors
from shelfcast.llm.quality import judge_quality
from shelfcast.llm.store import fresh_path
from shelfcast.llm.templates import dedup_lines
from shelfcast.llm.toxicity import fit_grammar, held_out, score_toxicity
from shelfcast.llm.warc import read_pages, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(function):
        QUERIES[name] = function
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_pareto_mix")
def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


@query("op2_toxic_grammar")
def op2_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_grammar(docs, table(spark, sf_dir, "labels")))
    score = F.col("toxicity")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


@query("op3_context_mixing")
def op3_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_piece_viterbi")
def op4_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    whole = decode_ids(encode_texts(docs))
    n = F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("bigint")
    return whole.select("doc_id", "ids", n.alias("n_pieces"), F.col("decoded").eqNullSafe(F.col("text")).alias("same"))


@query("op5_quality_cascade")
def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "quality.*")


@query("op6_line_templates")
def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("row.doc_id", F.col("lines").alias("n_lines"), F.col("dropped").alias("n_dropped"), F.col("left").alias("text"))


@query("op7_boosted_dom")
def op7_boosted_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query("op8_circulant_minhash")
def op8_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_boosted_pii")
def op9_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "personal.*")


@query("op10_projection_passes")
def op10_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op11_phrase_trees")
def op11_phrase_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


@query("op12_importance_resampling")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))


@query("op13_warc_revisits")
def op13_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    pages = read_pages(spark, path, html=False)
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
