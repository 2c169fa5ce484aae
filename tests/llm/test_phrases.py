from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm.invented import prose
from shelfcast.llm import phrases
from shelfcast.llm.phrases import collocations, phrase_counts


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def counted(rows, longest):
    found, total = Counter(), Counter()
    for lang, text in ((("und" if r[0] is None else r[0]), r[1]) for r in rows):
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            words = [w for w in re.split("[ \t]", piece) if w]
            total[lang] += len(words)
            for i in range(len(words)):
                for n in range(1, min(longest, len(words) - i) + 1):
                    found[lang, " ".join(words[i : i + n])] += 1
    return found, total


def mined(rows, longest, least, covered, top):
    found, total = counted(rows, longest)
    candidates = {k: n for k, n in found.items() if " " in k[1] and n >= least}
    best = Counter()
    for (lang, phrase), a in candidates.items():
        w = phrase.split(" ")
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                part = lang, " ".join(w[i : i + n])
                best[part] = max(best[part], a)
    out = []
    for (lang, phrase), a in candidates.items():
        if (lang, phrase) in best and 100 * best[lang, phrase] >= covered * a:
            continue
        w, cuts = phrase.split(" "), []
        for k in range(1, len(w)):
            left, right = found[lang, " ".join(w[:k])], found[lang, " ".join(w[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, phrase.encode(), left, right))
    result, ranks = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= top:
            result.append((lang, ranks[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return result


ROWS = [("en", prose(i % 9, 150).upper() if i % 4 else prose(i, 90)) for i in range(60)]
ROWS += [("es", "en es. en es, es en\tes  en"), ("en", "es en es! es en"), (None, "a b c d a b c d: a b c d"), ("und", "a b c d\r\na  b c d")] * 5
ROWS += [("en", None), ("en", ""), (None, None), ("", "x y x y x y"), ("en", "of the " * 400), ("en", "é漢 🙂é漢 🙂\x00a \x01b " * 12), ("de", ".,;:!? \t\n")]


@pytest.mark.parametrize("settings", [{}, {"budget": 20, "most": 2000}, {"longest": 4, "least": 3, "covered": 80, "top": 25}, {"longest": 2, "least": 1}])
def test_same_as_brute_force(spark, settings):
    docs = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "lang string, text string, phrase string, n int").repartition(5)
    got = sorted(tuple(r) for r in collocations(docs, **settings).collect())
    asked = {k: settings.get(k, v) for k, v in {"longest": 3, "least": 10, "covered": 50, "top": 2000}.items()}
    assert got == sorted(mined(ROWS, **asked))


def test_heavy_prefixes_keep_their_counts():
    batch = pa.RecordBatch.from_pydict({"lang": pa.array([r[0] for r in ROWS], pa.string()), "text": pa.array([r[1] for r in ROWS], pa.string())})
    want, _ = counted(ROWS, 3)
    for heavy_from in (1, 5, 10**9):
        keys = [np.empty(0, np.uint64)]
        for suffixes, _ in phrases._suffixes(iter([batch]), 3, 3000):
            keys += [k[c >= heavy_from] for d in (0, 1) for k, c in [np.unique(suffixes.keys[d][suffixes.room > d], return_counts=True)]]
        rows = [phrases._keyed_rows(s, names, np.unique(np.concatenate(keys)), 3) for s, names in phrases._suffixes(iter([batch]), 3, 3000)]
        table = pa.Table.from_batches(rows).sort_by([("lang", "ascending"), ("prefix", "ascending")]).combine_chunks()
        got = Counter()
        for nodes in phrases._subtrees(table, 2):
            for row in nodes.to_pylist():
                assert (row["lang"], row["phrase"]) not in got
                got[row["lang"], row["phrase"]] = row["n"]
        assert got == {k: n for k, n in want.items() if n >= 2}


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    got = sorted(tuple(r) for r in collocations(odd_docs, least=3).collect())
    assert got == sorted(mined(rows, 3, 3, 50, 2000)) and len(got) > 100
    assert collocations(no_docs).count() == 0
    nodes, totals = phrase_counts(no_docs)
    assert nodes.count() == 0 and totals.where("n > 0").count() == 0
