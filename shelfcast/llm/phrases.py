"""Phrase collocations from depth-truncated suffix trees, built by groups of word prefixes.

The corpus is partitioned vertically. A prefix is a word whose occurrences fit the memory budget; a word with more is extended by
the word that follows, and so on. Prefixes are dealt to groups of about the budget, and each group builds the subtrees below its
prefixes without looking at another one. Suffixes end with their piece, or after ``longest`` words. A task that reads texts sends
each prefix once with all its suffixes, equal ones counted, so that a frequent phrase costs no more than a row. The counts of
all phrases are the sums over the leaves below their nodes; nodes above the prefixes are counted by rows without suffixes.

Only heavy prefixes are known everywhere. One that has more than half a budget has this share in at least one task, so tasks report
prefixes by their own share, and the sums of what they report tell the heavy ones, at most four of a length for each budget
in the corpus. The budget grows where these would pass HEAVIEST. Whether a prefix is extended changes where it is
counted, never its count.

Counts of parts are looked up by a join; those of the few parts in a large share of the corpus are sent to all tasks (SHARE
bounds them), as the candidates that they are in could not be dealt out. Arithmetic is on decimals.

Defined results: null text is empty; null lang counts as ``und``; words hold any characters but blanks, tabs and the breaks;
equal rows count each; ties in score and count go by the phrase's bytes; an empty table gives an empty result; other columns do
not matter. Words and phrases are told apart in tasks by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.store import arrow_rows, discard, saved
from shelfcast.llm.text import LOWER, buffer_of, column, mix, pieces, prefix_sums, span_hashes

HEAVIEST, SHARE, SALTS = 1 << 20, 4096, 16
_BREAK = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_BETWEEN = _BREAK | np.isin(np.arange(256), list(b" \t"))
_STEP = np.uint64(0x9E3779B97F4A7C15)
KEYED = "lang string, prefix string, n bigint, rest binary, counts binary"
NODES = "lang string, phrase string, words int, n bigint"


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all spans one after another, and their bounds."""
    sizes = ends - starts
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], sizes)], bounds


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    raw, bounds = _gathered(data, starts, ends)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(raw))


class Suffixes:
    """The words of some texts and the hashes of the prefixes of the suffix that begins at each.

    ``data`` holds the lower-cased words with one blank after each; word i begins at ``begins[i]``. ``room`` is the number of words
    of the suffix, ``keys[d]`` the hash of lang and its first d + 1 words where it has as many.
    """

    def __init__(self, texts: pa.Array, langs: np.ndarray, lang_keys: np.ndarray, longest: int):
        raw, bounds = buffer_of(texts)
        raw = LOWER[raw]
        inside = np.concatenate([[False], ~_BETWEEN[raw], [False]])
        edge = np.zeros(len(raw) + 1, bool)
        edge[bounds] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        breaks = np.concatenate([[0], np.cumsum(_BREAK[raw])])
        text = np.searchsorted(bounds, starts, "right") - 1
        n = len(starts)
        joins = (text[1:] == text[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]]) if n else np.empty(0, bool)
        self.room = np.ones(n, np.int64)
        for _ in range(longest - 1):
            self.room[:-1] = np.where(joins, np.minimum(self.room[1:] + 1, longest), 1)
        words, sizes = _gathered(raw, starts, ends)
        self.lang, self.begins = langs[text], sizes + np.arange(n + 1)
        self.data = np.full(self.begins[-1], 32, np.uint8)
        self.data[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(sizes))] = words
        each = span_hashes(prefix_sums(self.data), self.begins[:-1], self.begins[1:] - 1)
        self.keys = [mix(each + mix(lang_keys)[self.lang])]  # one of them mixed once more, as sums go both ways
        for d in range(1, longest):
            key = self.keys[-1].copy()
            key[: n - d] = mix(key[: n - d] * _STEP + each[d:]) if n > d else key[: n - d]
            self.keys.append(np.where(self.room > d, key, self.keys[-1]))

    def end(self, at: np.ndarray, words: np.ndarray | int) -> np.ndarray:
        """Where the first ``words`` words of the suffixes end."""
        return self.begins[at + words] - 1


def _langs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Code of each row's lang, the hash of each lang, and the langs."""
    coded = pc.fill_null(column(batch, "lang"), "und").dictionary_encode()
    data, bounds = buffer_of(coded.dictionary)
    return coded.indices.to_numpy(), span_hashes(prefix_sums(data), bounds[:-1], bounds[1:]), coded.dictionary


def _suffixes(batches: Iterator[pa.RecordBatch], longest: int, most: int) -> Iterator[tuple[Suffixes, pa.Array]]:
    for batch in batches:
        codes, keys, names = _langs(batch)
        for at, to in pieces(column(batch, "text"), most):
            yield Suffixes(column(batch, "text").slice(at, to - at), codes[at:to], keys, longest), names


def _reported(docs: DataFrame, longest: int, share: float, most: int) -> DataFrame:
    """(lang, key, n) of prefixes with at least ``share`` of the words read at once, and the words of each lang with key null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for suffixes, names in _suffixes(batches, longest, most):
            n = len(suffixes.room)
            by_lang = np.bincount(suffixes.lang, minlength=len(names))
            yield pa.RecordBatch.from_arrays([names, pa.nulls(len(names), pa.int64()), pa.array(by_lang)], ["lang", "key", "n"])
            for d in range(longest - 1):
                key, count = np.unique(suffixes.keys[d][suffixes.room > d], return_counts=True)
                held = count >= max(1.0, share * n)
                key, count = key[held].view(np.int64), count[held]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(key), pa.string()), pa.array(key), pa.array(count)], ["lang", "key", "n"])

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, key bigint, n bigint")
    return rows.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _keyed_rows(s: Suffixes, names: pa.Array, heavy: np.ndarray, longest: int) -> pa.RecordBatch:
    """A row for each prefix: how many suffixes begin with it, what follows in them, and how often where not always once."""
    _, one, count = np.unique(s.keys[-1], return_index=True, return_counts=True)
    room = s.room[one]
    depth = np.ones(len(one), np.int64)
    entries = []
    for d in range(1, longest):
        at = np.minimum(np.searchsorted(heavy, s.keys[d - 1][one]), max(len(heavy) - 1, 0))
        further = (depth == d) & (room > d) & ((heavy[at] == s.keys[d - 1][one]) if len(heavy) else False)
        entries.append((one[further], count[further], np.full(further.sum(), d), np.zeros(further.sum(), bool)))
        depth[further] = d + 1
    entries.append((one, count, depth, room > depth))
    one, count, depth, goes_on = (np.concatenate(x) for x in zip(*entries))
    key = np.choose(depth - 1, [k[one] for k in s.keys]) if len(one) else np.empty(0, np.uint64)
    order = np.argsort(key, kind="stable")
    one, count, depth, goes_on, key = one[order], count[order], depth[order], goes_on[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    follows = np.flatnonzero(goes_on)
    starts, ends = s.begins[one[follows] + depth[follows]], s.end(one[follows], s.room[one[follows]]) + 1
    rest, bounds = _gathered(s.data, starts, ends)
    rest[bounds[1:] - 1] = 10
    cut = np.searchsorted(follows, np.append(first, len(key)))
    total = np.add.reduceat(count, first) if len(first) else count
    at = one[first]
    several = np.concatenate([[0], np.cumsum(count[follows] > 1)])
    told = several[cut[1:]] > several[cut[:-1]]
    sizes = np.where(told, np.diff(cut), 0)
    counted = count[follows][np.repeat(told, np.diff(cut))].astype(np.int32)

    def blobs(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
        return pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])

    return pa.RecordBatch.from_arrays(
        [
            names.take(pa.array(s.lang[at])), _strings(s.data, s.begins[at], s.end(at, depth[first])), pa.array(total),
            blobs(rest, bounds[cut]), blobs(counted, np.concatenate([[0], np.cumsum(sizes)]) * 4),
        ],
        ["lang", "prefix", "n", "rest", "counts"],
    )


def _keyed(docs: DataFrame, heavy: np.ndarray, longest: int, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for suffixes, names in _suffixes(batches, longest, most):
            yield _keyed_rows(suffixes, names, heavy, longest)

    return docs.select("lang", "text").mapInArrow(run, KEYED)


def _subtrees(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """The nodes with ``least`` suffixes or more of whole subtrees; the rows of a prefix stand together."""
    langs, prefixes = (table.column(c).combine_chunks() for c in ("lang", "prefix"))
    n, depth = table.column("n").to_numpy(), pc.count_substring(prefixes, " ").to_numpy() + 1
    same = pc.and_(pc.equal(langs[1:], langs[:-1]), pc.equal(prefixes[1:], prefixes[:-1])).to_numpy(zero_copy_only=False)
    tree = np.concatenate([[0], np.cumsum(~same)]) if len(n) else np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], ~same])) if len(n) else tree
    total = np.add.reduceat(n, first) if len(n) else n
    root = first[total >= least]

    def nodes(at: np.ndarray, phrases: pa.Array, words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [langs.take(pa.array(at)), phrases, pa.array(words.astype(np.int32)), pa.array(counts)], ["lang", "phrase", "words", "n"]
        )

    yield nodes(root, prefixes.take(pa.array(root)), depth[root], total[total >= least])
    held = np.flatnonzero((total >= least)[tree]) if len(n) else tree
    rests, counts = (table.column(c).combine_chunks().take(pa.array(held)) for c in ("rest", "counts"))
    data, bounds = buffer_of(rests.cast(pa.large_binary()).view(pa.large_string()))
    if not len(data):
        return
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    row = np.searchsorted(bounds, starts, "right") - 1
    raw, raw_bounds = buffer_of(counts.cast(pa.large_binary()).view(pa.large_string()))
    count = np.ones(len(row), np.int64)
    count[(np.diff(raw_bounds) > 0)[row]] = raw.view(np.int32)
    row = held[row]
    sums, of = prefix_sums(data), mix(tree[row].astype(np.uint64) + np.uint64(1))
    blanks = np.flatnonzero(data == 32)
    next_blank = np.searchsorted(blanks, starts)
    step = 0
    while len(starts):
        step += 1
        inner = next_blank + step - 1
        at = blanks[np.minimum(inner, max(len(blanks) - 1, 0))] if len(blanks) else ends
        more = (inner < len(blanks)) & (at < ends)
        stops = np.where(more, at, ends)
        _, one, which = np.unique(mix(of + span_hashes(sums, starts, stops)), return_index=True, return_inverse=True)
        order = np.argsort(which, kind="stable")
        node_total = np.add.reduceat(count[order], np.flatnonzero(np.concatenate([[True], np.diff(which[order]) > 0])))
        big = node_total >= least
        one = one[big]
        tails = _strings(data, starts[one], stops[one])
        phrases = pc.binary_join_element_wise(prefixes.take(pa.array(row[one])), tails, " ")
        yield nodes(row[one], phrases, depth[row[one]] + step, node_total[big])
        more &= big[which]
        starts, ends, count, row, of, next_blank = (x[more] for x in (starts, ends, count, row, of, next_blank))


def _grown(keyed: DataFrame, groups: int, least: int) -> DataFrame:
    """(lang, phrase, words, n): the nodes of all subtrees; a partition is a group of prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            langs, prefixes = column(batch, "lang"), column(batch, "prefix")
            same = pc.and_(pc.equal(langs, langs[-1]), pc.equal(prefixes, prefixes[-1])).to_numpy(zero_copy_only=False)
            last = int(np.argmax(same))  # the rows of the last prefix wait for the next batch
            if last or held and (column(held[-1], "prefix")[-1], column(held[-1], "lang")[-1]) != (prefixes[-1], langs[-1]):
                yield from _subtrees(pa.Table.from_batches([*held, batch.slice(0, last)]), least)
                held = []
            held.append(batch.slice(last))
        if held:
            yield from _subtrees(pa.Table.from_batches(held), least)

    return keyed.repartition(groups, "lang", "prefix").sortWithinPartitions("lang", "prefix").mapInArrow(run, NODES)


def phrase_counts(docs: DataFrame, *, longest: int = 3, least: int = 10, budget: int = 200_000, most: int = 1 << 22) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of all phrases of up to ``longest`` words and at least ``least`` occurrences, and (lang, n) of all words.

    ``budget`` is the number of suffixes that a subtree may hold, ``most`` the bytes of text that a task works on at once.
    """
    spark = docs.sparkSession
    arrow_rows(spark, 1000)
    docs = docs.select("lang", "text")
    about = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 5 + 1
    budget = max(budget, 4 * about // HEAVIEST)
    reported = saved(_reported(docs, longest, budget / 4 / about, most), "phrases-reported")
    totals = reported.where("key is null").select("lang", "n")
    words = totals.agg(F.sum("n")).first()[0] or 0
    heavy = reported.where(F.col("key").isNotNull() & (F.col("n") * 4 > budget)).select("key").collect()
    heavy = np.sort(np.array([r["key"] for r in heavy], np.int64).view(np.uint64))
    groups = max(words // (4 * budget) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return saved(_grown(_keyed(docs, heavy, longest, most), groups, least), "phrases-nodes"), totals


def _looked_up(rows: DataFrame, part: str, to: str, known: DataFrame, frequent: Column) -> DataFrame:
    """``rows`` with the count of a part, which every part has; the frequent ones are sent to all tasks."""
    few = known.where(frequent).select(F.col("lang").alias("its"), F.col("phrase").alias("of"), F.col("n").alias(to))
    both = rows.join(F.broadcast(few), (F.col("lang") == F.col("its")) & (F.col(part) == F.col("of")), "left").drop("its", "of")
    rest = known.where(~frequent).select("lang", F.col("phrase").alias(part), F.col("n").alias(to))
    return both.where(F.col(to).isNotNull()).unionByName(both.where(F.col(to).isNull()).drop(to).join(rest, ["lang", part]))


def collocations(docs: DataFrame, *, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2000, **settings) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``top`` phrases of 2 to ``longest`` words of each lang of ``docs(lang, text)``.

    The score of a phrase is that of its weakest cut. A phrase inside a longer one that is seen at least ``least`` times and has
    ``covered`` percent of its occurrences is left out.
    """
    nodes, totals = phrase_counts(docs, longest=longest, least=least, **settings)
    every = totals.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") * SHARE >= every
    candidates = nodes.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    split = candidates.withColumn("w", F.split("phrase", " ")).select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    part = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    cuts = split.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    heads = saved(_looked_up(cuts, "head", "l", nodes, frequent), "phrases-heads")
    cuts = _looked_up(heads, "tail", "r", nodes, frequent)
    exact = lambda c: F.col(c).cast("decimal(14,0)")
    share = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (exact("a") * exact("a")), exact("l") * exact("r"))
    weakest = cuts.withColumn("score", share).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = candidates.where("words > 2").withColumn("w", F.split("phrase", " "))
    longer = longer.select("lang", "a", "words", "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    longer = longer.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
    inner = longer.select("lang", "a", part(F.col("at"), F.col("size")).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    scored = weakest.join(inner, ["lang", "phrase"], "left").where(F.coalesce(F.col("most") * 100 < F.col("a") * covered, F.lit(True)))
    scored = saved(scored.select("lang", "phrase", "a", "cut.*"), "phrases-scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    best = saved(best, "phrases-best")
    discard(nodes, heads, scored)
    n = totals.select(F.col("lang").alias("its"), "n")
    return best.join(n, F.col("lang") == F.col("its")).select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
