from __future__ import annotations

import collections
import re

from llm.invented import prose
from shelfcast.llm.quality import COUNTS, RULES, judge_quality, judged
import pyarrow as pa

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


TEXTS = [
    prose(1, 200), "a b c a b c a b c", "line\nline\n line\n\n\nline\nx", "# * $ | <tag> 漢字 é", "", None, " \n ", prose(2, 49), prose(3, 50), "one\n" * 80, prose(4, 60) + "\n" + prose(4, 60), "a b c d\na b c d\r\n",
    " ".join(w + "***" for w in prose(5, 90).split()), prose(6, 120).upper(), " ".join(str(i) for i in range(100)), "\n".join(prose(i, 5) + "..." for i in range(20)),
]


def test_counts():
    for order in (list(RULES), list(RULES)[::-1]):
        got = judged(pa.array(TEXTS, pa.string()).fill_null(""), order).to_pylist()
        for text, row in zip(TEXTS, got):
            n = counted(text)
            assert tuple(row[c] for c in COUNTS) == n
            assert row["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert [r["kept"] for r in got] == [t in (prose(1, 200), prose(3, 50)) for t in TEXTS]


def test_odd_rows(odd_docs, no_docs):
    for row in judge_quality(odd_docs, sample_rows=5).collect():
        assert tuple(row["quality"][c] for c in COUNTS) == counted(row["text"])
        assert not (row["quality"]["kept"] and row["quality"]["base_failed"])
    assert judge_quality(no_docs).count() == 0
