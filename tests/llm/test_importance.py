from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm.invented import prose
from shelfcast.llm.importance import LONGEST_ROW, crc_rows, crc_spans, resample, resampled_documents, shares


def buckets_of(text, longest, buckets):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def drawn(docs, target, longest=1, buckets=10_000, least_words=20, percent=10, seed=2024):
    s, t = Counter(), Counter()
    parts = [(i, *buckets_of(x, longest, buckets)) for i, x in docs]
    for _, _, b in parts:
        s.update(b)
    for x in target:
        t.update(buckets_of(x, longest, buckets)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets))))
    rows = []
    for i, n, b in parts:
        weight = sum(map(gain, b)) // len(b) if b else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((n >= least_words, i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[3], r[2]))
    most = percent * len(fit) // 100
    return [(*r[1:], k + 1 if k < most else None) for k, r in enumerate(fit)] + [(*r[1:], None) for r in rows if not r[0]]


def test_checksums():
    draw = np.random.default_rng(3)
    rows = draw.integers(0, 256, (50, 33), dtype=np.uint8)
    assert crc_rows(rows).tolist() == [zlib.crc32(r.tobytes()) for r in rows]
    data = draw.integers(0, 256, 40_000, dtype=np.uint8)
    starts = draw.integers(0, 30_000, 600)
    ends = starts + np.concatenate([draw.integers(0, 30, 590), [0, 1, LONGEST_ROW, LONGEST_ROW + 1, 9000, 9000, 2000, 2000, 0, 10_000]])
    assert crc_spans(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


@pytest.mark.parametrize("settings", [{}, {"longest": 2, "buckets": 300, "least_words": 2, "percent": 50}, {"percent": 0}, {"percent": 100, "seed": 7}])
def test_same_as_brute_force(spark, odd_docs, settings):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()] + [(1000 + i, prose(i % 90, 5 + i)) for i in range(120)]
    target = [prose(3, 60), prose(5, 30), None, ""]
    docs = spark.createDataFrame([(*r, 9, "x") for r in rows], "doc_id bigint, text string, weight int, rank string").repartition(4)
    got = resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), **settings)
    none_first = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=none_first) == sorted(drawn(rows, target, **settings), key=none_first)


def test_draw_is_nearer_to_the_target(spark):
    few = lambda i, kind: " ".join(f"{kind}{(i * 7 + k * k) % 50}" for k in range(60))
    like = [few(i, "like") for i in range(40)]
    docs = spark.createDataFrame(list(enumerate([few(i, "other") for i in range(400)] + like)), "doc_id bigint, text string")
    target = spark.createDataFrame([(t,) for t in like], "text string")
    left = resampled_documents(docs, target)
    assert left.columns == docs.columns and left.count() == 44 and left.where("doc_id >= 400").count() > 30
    far = np.abs(shares(docs, buckets=5000) - shares(target, buckets=5000)).sum()
    assert np.abs(shares(left, buckets=5000) - shares(target, buckets=5000)).sum() < 0.7 * far


def test_empty(no_docs, odd_docs):
    assert resample(no_docs, odd_docs.select("text")).count() == 0
    assert resample(odd_docs, no_docs.select("text")).count() == odd_docs.count()
