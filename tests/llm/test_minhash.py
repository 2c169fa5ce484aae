from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from llm.invented import prose
from shelfcast.llm.components import components
from shelfcast.llm import minhash
from shelfcast.llm.minhash import _permuted, _shared_counts, near_duplicates, one_of_each, shingle_sets


def sets_of(texts, k):
    out = []
    for t in texts:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\n", " ").replace("\t", " ").split(" ") if x]
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def grouped(ids, texts, k, percent=80):
    sets, up = sets_of(texts, k), list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[max(top(i), top(j))] = min(top(i), top(j))
    low = {}
    for i in range(len(texts)):
        if ids[i] is not None:
            low[top(i)] = min(low.get(top(i), ids[i]), ids[i])
    return [low.get(top(i)) if sets[i] else ids[i] for i in range(len(texts))], [len(s) for s in sets]


def test_permutation():
    x = np.arange(1 << 20, dtype=np.uint32) * np.uint32(4099)
    assert len(np.unique(_permuted(x))) == len(np.unique(x))


def test_sets():
    texts = ["A b C d e", "a B c D E", "a b c", "a b", None, "", "a a a a a a", prose(3, 400)]
    keys, bounds = shingle_sets(pa.array(texts), 4)
    got = [set(keys[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
    want = sets_of(texts, 4)
    assert [len(s) for s in got] == [len(s) for s in want]
    assert [[len(a & b) for b in got] for a in got] == [[len(a & b) for b in want] for a in want]


def changed(text, n, seed):
    draw, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.random()}"
    return " ".join(words)


def test_groups(spark):
    base = [prose(100 + i, 120) for i in range(25)]
    texts = [t for i, t in enumerate(base) for t in [t] * (1 + i % 3)]
    texts += [changed(base[0], k % 5, k) for k in range(60)] + [changed(base[1], 3, k) for k in range(40)]
    chain = prose(500, 150).split(" ")
    texts += [" ".join(chain[3 * k : 3 * k + 100]) for k in range(15)]  # each near to the next, the ends far apart
    random.Random(1).shuffle(texts)
    ids = [3 * i + 7 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in near_duplicates(docs, shingle=4).collect()}
    low, sizes = grouped(ids, texts, 4)
    assert [got[i]["component_id"] for i in ids] == low
    assert [got[i]["n_shingles"] for i in ids] == sizes
    assert [got[i]["kept"] for i in ids] == [i == c for i, c in zip(ids, low)]


@pytest.mark.parametrize("block", [3, 16])
def test_large_buckets(spark, monkeypatch, block):
    """Many texts a little below the likeness share buckets with a tight group, over several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    base = prose(900, 160)
    texts = [changed(base, 4 + k % 3, k) for k in range(70)] + [changed(base, k % 2, 1000 + k) for k in range(40)] + [prose(k, 50) for k in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    low, _ = grouped(range(len(texts)), texts, 4)
    assert len(set(low)) > 40 and low.count(0) < 70
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, shingle=4).collect()} == dict(enumerate(low))


def test_shared_counts():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 3000, n, dtype=np.uint64)) for n in draw.integers(1, 900, 60)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    every = np.arange(60)
    for first, second in ((every, every), (every[:50], every[40:]), (every[:4], every[9:12])):
        other = first[:, None] != second
        assert (_shared_counts(sets, first, second) == want[np.ix_(first, second)])[other].all()


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    low, _ = grouped([r["doc_id"] for r in rows], [r["text"] for r in rows], 5)
    got = near_duplicates(odd_docs).collect()
    none_last = lambda x: (x is None, x or 0)
    assert sorted((r["component_id"] for r in got), key=none_last) == sorted(low, key=none_last)
    left = one_of_each(odd_docs)
    assert left.columns == odd_docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert ids.count(11) == 1 and ids.count(12) == 2 and 3 in ids and 4 in ids and (1 in ids) != (-15 in ids)
    assert near_duplicates(no_docs).count() == 0 and one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("pairs", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 3), (9, 8), (3, 8), (1, 2), (7, 7)], []])
def test_components(spark, pairs):
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    up = {}
    for a, b in pairs:
        if a != b:
            x, y = up.setdefault(a, {a}), up.setdefault(b, {b})
            x |= y
            for n in x:
                up[n] = x
    assert got == {n: min(s) for n, s in up.items()}
