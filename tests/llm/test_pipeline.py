from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shelfcast.llm.minhash import near_duplicates
from shelfcast.llm.pieces import MODEL, pieces_of
from shelfcast.llm.toxicity import fit_grammar, score_toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and names["pipeline"] is corpus_pipeline.run


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    (_, toxic), (_, lines), (_, near), (_, mix), (_, encode) = corpus_pipeline.STAGES
    one = toxic(spark, docs, SF_DIR).cache()
    assert one.columns == docs.columns
    bad = {r["doc_id"] for r in score_toxicity(docs, fit_grammar(docs, labels)).where("toxicity >= 0.5").collect()}
    assert bad and {r["doc_id"] for r in one.collect()} == {r["doc_id"] for r in docs.collect()} - bad
    two = lines(spark, one, SF_DIR).cache()
    before = {r["doc_id"]: r["text"] for r in one.collect()}
    for r in two.collect():
        rest = iter(before[r["doc_id"]].split("\n"))
        assert r["text"] == "" or all(line in rest for line in r["text"].split("\n"))  # what is left is in order
        assert r["n_chars"] == len(r["text"])
    three = near(spark, two, SF_DIR).cache()
    first = {r["doc_id"] for r in near_duplicates(two).where("kept").collect()}
    assert {r["doc_id"] for r in three.collect()} == first and three.columns == docs.columns
    four = mix(spark, three, SF_DIR).cache()
    assert four.columns == docs.columns and four.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    five = encode(spark, four, SF_DIR).collect()
    assert len(five) == four.count() and all(r["same"] for r in five)
    texts = {r["doc_id"]: r["text"] for r in four.collect()}
    pieces = pieces_of(MODEL)
    assert all(b"".join(pieces.spelled[i] for i in r["ids"]).decode() == texts[r["doc_id"]] for r in five)


def test_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        rows = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, SF_DIR)
            assert rows.columns == docs.columns
        n = rows.count()
        assert corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR).where("same").count() == n
