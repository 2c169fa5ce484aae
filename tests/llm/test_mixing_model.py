from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from shelfcast.llm.mixing_model import BUCKETS, GATES, HISTORY, INPUTS, PAIRS, PREDICTORS, Model, _lowered, _profiles, _read, _summed, _united, beginnings, code_heads, code_words, head_codes, kind_centres, log10_of_words, score_texts, squeezed, stretched
from shelfcast.llm.store import saved
from shelfcast.llm.text import mix, split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + ["\n"]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def compare(rows, got):
    counts = collections.Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (i is None, i or 0, held(i), len(ts), sum(counts[t] > 0 for t in ts), n, round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts), 6))
        for i, text in rows for ts in [tokens(text)]
    )
    assert want == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got, again = (score_texts(d, slot_bits=20).collect() for d in (docs, docs.repartition(3)))
    compare(rows, got)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    other = {r["doc_id"]: r["score"] for r in again}
    assert all(other[r["doc_id"]] == pytest.approx(r["score"], rel=0.1) for r in got)


def test_odd_rows(odd_docs, no_docs):
    compare([(r["doc_id"], r["text"]) for r in odd_docs.collect()], score_texts(odd_docs, slot_bits=16, kinds=2).collect())
    assert score_texts(no_docs, slot_bits=16).count() == 0


def test_beginnings():
    words = sorted([b"thing", b"things", b"think", b"thinks", b"thorn", b"the", b"", "éclair".encode(), b"x" * 60])
    times, kinds = np.arange(1, len(words) + 1), np.array([i % 2 for i in range(len(words))])
    shared = beginnings(pa.array(words, pa.binary()), kinds, times)
    ended = [w + b" " for w in words]
    for i, w in enumerate(ended):
        for j in range(4, min(len(w), 28)):
            for place in range(8):
                alike = [k for k, x in enumerate(ended) if x[:j] == w[:j] and len(x) > j and x[j] >> (8 - place) == w[j] >> (8 - place)]
                n = [sum(times[k] for k in alike if ended[k][j] >> (7 - place) & 1 == b) for b in (0, 1)]
                assert shared.odds[8 * (j - 4) + place, i] == pytest.approx(math.log((n[1] + 0.3) / (n[0] + 0.3)), abs=1e-5)


def test_probabilities_of_all_short_words_add_up_to_less_than_one():
    model = Model(16, np.random.Generator(np.random.PCG64(2)).integers(0, 1 << 16, len(PREDICTORS) << 16).astype(np.uint16))
    model.weights, model.refined = np.full((GATES, INPUTS), 0.2), np.zeros(256 * BUCKETS)
    words = [b""] + [bytes([a]) for a in range(256) if a != 32]
    block = pa.table({"word": pa.array(words, pa.binary()), "kind": np.zeros(len(words), np.int32), "n": np.zeros(len(words), np.int64)})
    first = 10 ** log10_of_words(model, block)
    assert 0 < first.sum() < 1


def test_kinds_are_fitted_to_all_texts(spark):
    """The centres are the means of all texts of their kind, though they start from few."""
    texts = [[f"{a * 3} {a} {b * (i % n)}{i}" for i in range(900)] for a, b, n in (("ab", "ba ", 7), ("xq", "zq ", 11))]
    rows = spark.createDataFrame([(t,) for t in texts[0] + texts[1]], "text string").repartition(3)
    centres = kind_centres(rows, 2, fit_rows=60)
    for some in texts:
        alone = _profiles(*_lowered(pa.array(some))).mean(0)
        assert min(abs(c - alone).max() for c in centres) < 1e-9
    assert _summed(rows, centres)[0].tolist() == [900, 900]
    assert kind_centres(rows.where("false"), 3).shape == (3, PAIRS)


def test_squeezed_rows():
    values = np.array([0, 1, 254, 255, 256, 65_535, 70_000, 3, 510])
    cut = np.array([0, 0, 4, 8, 9])
    for unit in (np.uint8, np.uint16):
        got, counts = stretched(squeezed(values, cut, unit).to_pylist(), unit)
        assert got.tolist() == values.tolist() and counts.tolist() == [0, 4, 4, 1]
    none, counts = stretched([], np.uint8)
    assert len(none) == len(counts) == 0


def test_lists_move_packed(spark, tmp_path):
    """The lists of words once moved as a row for each word of a chunk, twice, which took more disk than the texts four times."""
    texts = [" ".join(f"w{(i * 37 + j * j) % 40_000}" for j in range(500)) for i in range(2_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    rows = saved(_read(docs, np.zeros((2, PAIRS)), 16), "test-read")
    different = len({w for t in texts for w in t.split()})
    assert rows.where("words is not null").count() <= 2 * 16 * rows.select("chunk").distinct().count()
    united = saved(_united(rows.where("words is not null").select("chunk", "bucket", "words", "lengths", "kinds", "n", "m")), "test-united")
    words = united.where("word is not null")
    assert words.count() == different + 1
    want = collections.Counter(t for i, text in enumerate(texts) if not held(i) for t in text.split())
    assert {bytes(r["word"]).decode(): r["n"] for r in words.where("n > 0 and word != x''").collect()} == dict(want)


def test_contexts_reach_over_blanks():
    """Heads and tails hold every byte of the texts once, each with the last four bytes of its text; contexts once ended at the word's start."""
    texts = ["the cat sat on a mat", "", "  a\n\tab abc abcd  éclair ", "x", "on the mat"]
    data, bounds = _lowered(pa.array(texts))
    words, kinds = split_words(data, bounds), np.array([0, 1, 0, 3, 2])
    coded = code_heads(head_codes(words, kinds))
    got = collections.Counter((int(b), *map(int, c)) for b, *c in zip(coded.data, *coded.contexts))
    tails = [(data[a:b].tobytes(), kinds[t]) for a, b, t in zip(words.starts, words.ends, words.text_of)]
    coded = code_words(pa.array([w for w, _ in tails], pa.binary()), np.array([k for _, k in tails]), begin=HISTORY)
    got += collections.Counter((int(b), *map(int, c)) for b, *c in zip(coded.data, *coded.contexts))
    want = collections.Counter()
    for text, kind in zip(texts, kinds):
        line = b"".join(w + b" " for w in text.encode().split()) + b" "
        for i, byte in enumerate(line):
            past = (b" " + line[:i])[::-1]
            last = [sum((past[k] + 1) << 9 * k for k in range(min(n, len(past)))) for n in range(1, 5)]
            contexts = [mix(np.array([(last[n - 1] * 64 + p + (int(mix(np.array([kind + 1], np.uint64))[0]) if k else 0)) % 2**64], np.uint64))[0] for p, (n, k) in enumerate(PREDICTORS)]
            want[byte, *map(int, contexts)] += 1
    assert got == want


def test_word_order_counts(spark):
    """Texts of the same words in another order once had the same score."""
    words = "amber birch cedar dune ember fjord grove heath inlet jetty".split()
    texts = [" ".join(words[(i + j) % 10] for j in range(40)) for i in range(300)]
    mixed = np.random.Generator(np.random.PCG64(5))
    rows = [(i, t) for i, t in enumerate(texts) if not held(i)]
    given = [i for i in range(300, 400) if held(i)]
    rows += [(i, texts[0]) for i in given] + [(i + 1_000_000, " ".join(mixed.permutation(texts[0].split()))) for i in range(200) if held(i + 1_000_000)]
    scores = {r["doc_id"]: r["score"] for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string"), slot_bits=16, kinds=1).collect()}
    assert max(v for k, v in scores.items() if k >= 1_000_000) < min(scores[i] for i in given) - 1
