from __future__ import annotations

import random

from llm.invented import prose
from shelfcast.llm.templates import dedup_lines, deduplicated_documents

LONG = "we hold that every one of these long lines has been put into many texts by hand and should be taken out again"


def body(seed):
    return [prose(seed * 100 + k, 30).replace("\n", " ") for k in range(6)]


def test_templates(spark):
    texts, clean = [], []
    for i in range(60):
        lines = body(i + 1)
        clean.append("\n".join(lines))
        put = [f"Posted on 2024-0{1 + i % 9}-1{i % 10} by user{i} in the open news group", "All rights kept here", f"The office in {prose(9000 + i, 1).split(' ')[0].strip('.')} is open all day and has a phone on the wall"]
        if i % 5 == 0:
            put.append(LONG)
        for p in put:
            lines.insert(random.Random(i).randrange(len(lines) + 1), p)
        texts.append("\n".join(lines))
    copied = "\n".join(body(777))
    texts += [copied] * 12 + [copied.replace(" ", "  ", 1).replace(copied.split(" ")[5], "zzz", 1) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in dedup_lines(docs).select("row.doc_id", "lines", "dropped", "left").collect()}
    for i, c in enumerate(clean):
        assert got[i]["left"] == c
        assert got[i]["lines"] == len(texts[i].split("\n")) and got[i]["dropped"] == len(texts[i].split("\n")) - 6
    for i in range(60, len(texts)):  # copies of a whole document are no templates
        assert got[i]["left"] == texts[i]


def test_partly_alike_documents_are_no_copies(spark):
    """Pairs that share a passage, and pages that are mostly the same: below the likeness of near duplicates."""
    def line(seed, words):
        return prose(seed, words).replace("\n", " ")

    shared = [line(50_000 + k, 60) for k in range(40)]
    texts = [f"{line(60_000 + 2 * k + i, 20)}\n{shared[k]}" for k in range(40) for i in range(2)]
    site = [line(70_000 + k, 25) for k in range(6)]
    pages = ["\n".join([*site[:3], line(80_000 + i, 40), *site[3:]]) for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts + pages)), "doc_id bigint, text string")
    left = {r["doc_id"]: r["left"] for r in dedup_lines(docs).select("row.doc_id", "left").collect()}
    for i, text in enumerate(texts):
        assert left[i] == text.split("\n")[0]
    for i, page in enumerate(pages):
        assert left[len(texts) + i] == page.split("\n")[3]


def line(seed, words):
    return prose(seed, words).replace("\n", " ")


def test_more_documents_bring_nothing_back(spark):
    """Short and long lines recur in a fixed number of documents; single lines count, and stay."""
    fold = [f"{line(100_000 + 3 * i, 30)}\n{put}\n{line(100_001 + 3 * i, 30)}" for i, put in enumerate(["Read more"] * 105 + ["Back to the start page"] * 11 + ["Never seen twice here"] * 9)]
    single = line(110_000, 30)
    pair = [single, f"{line(110_001, 30)}\n{single}\n{line(110_002, 30)}"]
    others = [f"{line(200_000 + 2 * i, 12)}\n{line(200_001 + 2 * i, 12)}" for i in range(1500)]
    for texts in (fold + pair, fold + pair + others):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        got = {r["doc_id"]: r for r in dedup_lines(docs).select("row.doc_id", "dropped", "left").collect()}
        assert [got[i]["dropped"] for i in range(len(texts))] == [1] * 116 + [0] * 9 + [0, 1] + [0] * (len(texts) - 127)
        assert got[126]["left"] == "\n".join(pair[1].split("\n")[::2])


def test_against_counts_by_hand(spark):
    """Long lines without digits, in documents that are no copies of each other: a template is a line, or one with a free third."""
    draw = random.Random(5)
    pool = [line(300_000 + k, 12) for k in range(60)]
    texts = []
    for i in range(300):
        rows = [line(400_000 + 10 * i + k, 25) for k in range(5)]
        for _ in range(draw.randint(0, 2)):
            words = draw.choice(pool).split()
            if draw.random() < 0.5:
                words[draw.randrange(3, 12)] = f"own{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100]}"
            rows.insert(draw.randrange(len(rows) + 1), " ".join(words))
        texts.append("\n".join(rows))

    def templates(text):
        """Of every line: its templates, with the number of documents each one must be in."""
        for row in text.split("\n"):
            words, kinds = row.split(), {}
            kinds[tuple(words)] = 3 if len(words) < 20 else 2
            for j in range(3):
                a, b = (3 + (len(words) - 3) * k // 3 for k in (j, j + 1))
                kinds[(*words[:a], None, *words[b:], j)] = kinds[tuple(words)] + 1
            yield kinds

    within: dict[tuple, set[int]] = {}
    for i, text in enumerate(texts):
        for kinds in templates(text):
            for k in kinds:
                within.setdefault(k, set()).add(i)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    left = {r["doc_id"]: r["left"] for r in dedup_lines(docs).select("row.doc_id", "left").collect()}
    expected = {}
    for i, text in enumerate(texts):
        rows = zip(text.split("\n"), templates(text))
        expected[i] = "\n".join(row for row, kinds in rows if all(len(within[k]) < least for k, least in kinds.items()))
    assert left == expected and sum(expected[i] != t for i, t in enumerate(texts)) > 100


def test_many_lines_in_one_text(spark):
    rows = [f"this is the line {a} and {b} of a long table of words" for a in "abcdefgh" for b in range(5000)]
    texts = ["\n".join(rows), "\n".join([line(1, 40), rows[7], line(2, 40)]), "\n".join([line(3, 40), rows[8], line(4, 40)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["dropped"] for r in dedup_lines(docs).select("row.doc_id", "dropped").collect()}
    assert got[1] == got[2] == 1 and got[0] >= 5000


def test_odd_rows(odd_docs, no_docs):
    left = deduplicated_documents(odd_docs)
    key = lambda r: str(r)
    assert left.columns == odd_docs.columns
    assert sorted(left.collect(), key=key) == sorted(odd_docs.collect(), key=key)
    assert deduplicated_documents(no_docs).count() == 0
