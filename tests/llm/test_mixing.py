from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shelfcast.llm.mixing import mix_sources, mixed_documents, source_targets


def shared(sizes: dict, weights=(3, 1, 2), share=1.5, cap=2.0) -> dict:
    """Targets worked out one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        free = sum(w for s, w in weight.items() if s not in full)
        left = total - cap * sum(sizes[s] for s in full)
        target = {s: cap * sizes[s] if s in full else left * weight[s] / free for s in order}
        above = {s for s in order if s not in full and target[s] > cap * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 900, "c": 50, None: 300}, {"z": 1, "Z": 1, "é": 1, "a": 0}, {"one": 7}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()], "source string, size bigint")
    got = {r["source"]: r["target"] for r in source_targets(rows, (3, 1, 2), 1.5, 2.0).collect()}
    assert got == pytest.approx(shared(sizes))


def test_mix(spark):
    draws = [(i, f"s{i % 4}" if i % 3 else "hot", " ".join(["w"] * (1 + i * 7 % 97))) for i in range(3000)]
    docs = spark.createDataFrame(draws, "doc_id bigint, source string, text string")
    one, two = (mix_sources(d).select("row.*", "size", "source_size", "target", "copies").collect() for d in (docs, docs.repartition(7)))
    assert sorted((r["doc_id"], r["copies"]) for r in one) == sorted((r["doc_id"], r["copies"]) for r in two)
    taken, target, size = {}, {}, {}
    for r in one:
        assert r["size"] == len(r["text"].split()) and 0 <= r["copies"] <= 2
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
    assert target == pytest.approx(shared(size))
    for s in target:
        assert abs(taken[s] - target[s]) <= 97
    likely = [sum(r["copies"] for r in one if r["size"] in span) / sum(r["size"] in span for r in one) for span in (range(1, 30), range(60, 98))]
    assert likely[0] < likely[1]  # unequal probabilities: longer documents come more often


def test_odd_rows(odd_docs, no_docs):
    rows = mix_sources(odd_docs).select("row.doc_id", "row.text", "size", "copies").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["size"] or not r["copies"]
    twins = [r["copies"] for r in rows if r["doc_id"] == 11]
    assert twins[0] == twins[1]
    mixed = mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mix_sources(no_docs).count() == 0
    assert mix_sources(odd_docs.withColumn("text", F.lit(None).cast("string"))).where("copies > 0").count() == 0
