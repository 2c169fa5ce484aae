"""Language-model scores by online logistic context mixing.

A word is coded as its bytes and a blank, a text's end as a blank alone, each byte as eight binary decisions. Several bit
predictors give their odds of the next bit: hashed on the last one to four bytes, blank and word before included, on some of
these with the kind of the document, and on the whole word so far, with and without the kind. The odds are added in the
logistic domain with weights from a set that a gate chooses by the bit's place and by how often the two longest contexts were
seen. Counts of the finished bits refine the sum. The bits of all words add up to the probability of the text.

Four bytes with a blank among them reach ``HISTORY`` bytes of the word before at most, and only from the first ``HISTORY``
bytes of a word. So a word has two parts. Its head is those first bytes, its end included if it is that short: their probability
depends on them, on the last ``HISTORY`` bytes before the blank and on the kind of document. That of the tail, all bytes
after these, depends on the word and the kind. So the corpus is summed up to (word, kind, times) and (head, bytes before, kind,
times) first, by Spark, and everything is learned and scored there, once for each different word and head. Texts are read once
and never move; what moves is each chunk's lists of different words and heads, which grow with the corpus. A chunk's list is cut
into parcels by hashes, a packed row each; the parcels of one bucket meet in a task, which gives each different word or head a
number, and later puts the scores in the place of the numbers.

* Hashed predictors: the bits of the training words' heads and tails are counted by context, summed up by Spark over all tasks, and packed to two
  bytes a slot. ``slot_bits`` bounds the tables that are sent to the tasks.
* The word so far: words are put in order over all tasks, split where the first four bytes change. There, the words that
  share a beginning are neighbours, and their counts are differences of running sums: exact, without any table.
* Weights and refinement: an eighth of the training documents is left out of the counts. Each task goes over its words in
  small random steps, predicts a step, then corrects its weights by the error and counts what came true at the predicted odds.
  The weights are averaged over steps and tasks, the counts added. Then the eighth joins the counts.
* Kinds of documents: ``kinds`` centres of byte-pair profiles. They start from at most ``fit_rows`` training texts drawn by hash and
  become, ``passes`` times, the means of all training texts that are nearest to them, summed up over all tasks. A text's kind is
  told by log10(kinds) more.

Defined results: null and empty texts consist of the end alone; texts are read whole; the held-out tenth is in no count; a
null doc_id counts as held out; equal rows score alike; without any training text all words are unknown; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.store import arrow_rows, discard, free_shuffles, saved
from shelfcast.llm.text import LOWER, Words, buffer_of, column, mix, pieces, split_words
from shelfcast.llm.toxicity import held_out

END = 32  # ends a word
HISTORY = 3  # bytes of a word's head, and bytes before the blank that they are predicted from
NONE = 10  # in a head: no byte; no word has it
TASK_HEADS = 500_000  # heads looked at by a task at least
CHUNK = 5 << 20  # bytes of text whose words share a list
BUCKET = 4 << 20  # bytes of text for each bucket of words
PAIRS = 256
#: Hashed predictors: bytes of context, and whether the kind of document belongs to it.
PREDICTORS = ((1, False), (2, False), (3, False), (4, False), (2, True), (4, True))
LONGEST = 3  # the hashed predictor whose confidence the gate looks at
SHARED, DEEPEST = 4, 28  # bytes at which the predictors on the whole word so far begin and end
BLOCK = 20_000  # words looked at together
INPUTS = len(PREDICTORS) + 3  # the word so far, the same with the kind, and a constant
CONFIDENCES = 6
GATES = 8 * CONFIDENCES * CONFIDENCES
BUCKETS = 48
_FINE = 16  # steps of a packed count for each doubling
_COUNTS = np.concatenate([np.arange(16), 16 * 2 ** (np.arange(1, 241) / _FINE)])  # count by its packed byte


def _packed(counts: np.ndarray) -> np.ndarray:
    exact = np.minimum(counts, 15)
    above = np.rint(np.log2(np.maximum(counts, 1) / 16) * _FINE) + 15
    return np.clip(np.where(counts < 16, exact, above), 0, 255).astype(np.uint16)


def _odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + 0.3) / (n0 + 0.3)).astype(np.float32)


def _tables_of_states() -> tuple[np.ndarray, np.ndarray]:
    """Odds and confidence by state, the packed counts of 0 and of 1."""
    n0, n1 = np.repeat(_COUNTS, 256), np.tile(_COUNTS, 256)
    return _odds(n0, n1), _confidence(n0 + n1)


def _confidence(n: np.ndarray) -> np.ndarray:
    return np.searchsorted([0.5, 1.5, 3.5, 15.5, 255.5], n).astype(np.uint8)


# Documents to lists of words


def _profiles(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each text's frequencies of hashed byte pairs, square-rooted."""
    n = len(bounds) - 1
    counts = np.zeros((n, PAIRS))
    for i in range(n):
        part = data[bounds[i] : bounds[i + 1]].astype(np.uint32)
        counts[i] = np.bincount((part[:-1] * 251 + part[1:]) * np.uint32(2654435761) >> np.uint32(24), minlength=PAIRS)
    return np.sqrt(counts / np.maximum(1, counts.sum(1, keepdims=True)))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x @ centres.T - (centres**2).sum(1) / 2).argmax(1)


def _summed(training: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By centre, how many of all texts are nearest to it, and the sum of their profiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros_like(centres), np.zeros(len(centres), np.int64)
        for batch in _chunks(batches):
            x = _profiles(*_lowered(column(batch, "text")))
            near = _nearest(x, centres)
            n += np.bincount(near, minlength=len(centres))
            for k in np.unique(near):
                total[k] += x[near == k].sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n), pa.array([t.tobytes() for t in total], pa.binary())], ["kind", "n", "total"])

    total, n = np.zeros_like(centres), np.zeros(len(centres), np.int64)
    for r in training.select("text").mapInArrow(run, "kind bigint, n bigint, total binary").collect():
        n[r["kind"]] += r["n"]
        total[r["kind"]] += np.frombuffer(r["total"])
    return n, total


def kind_centres(training: DataFrame, kinds: int, fit_rows: int = 4000, rounds: int = 12, passes: int = 3) -> np.ndarray:
    """Centres of the kinds: means of the profiles of all texts of ``training``, started from a part of them."""
    some, size = training, training.count()
    if size > fit_rows:
        some = training.where(F.pmod(F.xxhash64(F.lit(19), "text"), F.lit(1 << 20)) < int((1 << 20) * fit_rows / size))
    texts = sorted(r["text"] for r in some.collect())
    x = _profiles(*_lowered(pa.array(texts, pa.string()))) if texts else np.zeros((1, PAIRS))
    centres = x[np.linspace(0, len(x) - 1, kinds).astype(int)]
    for _ in range(rounds):
        near = _nearest(x, centres)
        centres = np.stack([x[near == k].mean(0) if (near == k).any() else centres[k] for k in range(kinds)])
    for _ in range(passes if size > len(texts) else 0):
        n, total = _summed(training, centres)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def _lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = buffer_of(texts)
    return LOWER[data], bounds


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in portions of about CHUNK bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(column(batch, "text")), 0)
        held.append(batch)
        size += pc.sum(sizes).as_py() or 0
        if size >= CHUNK:
            yield from _cut(held)
            held, size = [], 0
    if held:
        yield from _cut(held)


def _cut(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = pa.Table.from_batches(held).combine_chunks().to_batches()
    for batch in whole:
        for at, to in pieces(column(batch, "text"), CHUNK):
            yield batch.slice(at, to - at)


def squeezed(values: np.ndarray, cut: np.ndarray, unit: type) -> pa.Array:
    """Whole numbers from 0 on as small units, in rows that begin at ``cut``. The largest unit is added to those after it."""
    top = np.iinfo(unit).max
    more, rest = np.divmod(values.astype(np.int64), top)
    ends = np.cumsum(more + 1)
    units = np.full(ends[-1] if len(ends) else 0, top, unit)
    units[ends - 1] = rest
    return _binary(units, np.concatenate([[0], ends])[cut])


def stretched(rows: list[bytes], unit: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in ``squeezed`` rows, and how many each row has."""
    units = np.frombuffer(b"".join(rows), unit)
    ends = np.flatnonzero(units != np.iinfo(unit).max) + 1
    sums = np.concatenate([[0], np.cumsum(units, dtype=np.int64)])
    bounds = np.concatenate([[0], np.cumsum([len(r) // units.itemsize for r in rows])])
    return np.diff(sums[np.concatenate([[0], ends])]), np.diff(np.searchsorted(ends, bounds, "right"))


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows of the values' bytes; ``bounds`` counts values."""
    offsets = (np.asarray(bounds) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _joined(rows: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(rows.to_pylist()), kind)


def head_codes(words: Words, kinds: np.ndarray) -> np.ndarray:
    """The heads of all words, then of the end of each text, as numbers: the kind of the document, the bytes before the blank before the
    word, where words are one blank apart, and the first bytes of the word with its end, a byte each."""
    n, sizes = len(words.first) - 1, words.ends - words.starts
    data, ends = np.append(words.data, np.uint8(END)), np.append(words.ends, 0)
    text = np.concatenate([words.text_of, np.arange(n)])
    before = np.concatenate([np.arange(len(sizes)), words.first[1:]]) - 1
    room = np.where(before < words.first[text], 0, np.append(sizes, 0)[before])
    earlier = np.where(before > words.first[text], data[np.maximum(ends[before - 1] - 1, 0)], NONE)  # seen over a word of one byte
    starts, own = np.append(words.starts, np.zeros(n, np.int64)), np.append(sizes, np.zeros(n, np.int64))
    code = kinds[text].astype(np.uint64)
    for back in range(HISTORY, 0, -1):
        over = np.where(back == room + 1, END, earlier)
        byte = np.where(room >= back, data[np.maximum(ends[before] - back, 0)], np.where(room > 0, over, NONE))
        code = code << np.uint64(8) | byte.astype(np.uint64)
    for j in range(HISTORY):
        byte = np.where(j < own, data[np.minimum(starts + j, len(data) - 1)], np.where(j == own, END, NONE))
        code = code << np.uint64(8) | byte.astype(np.uint64)
    return code


def _by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of a list by buckets, each entry's place in it, and the buckets in order."""
    bucket = (hashes >> np.uint64(16)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return order, rank, bucket[order].astype(np.int64)


def _placed(text: np.ndarray, place: np.ndarray, size: int, n: int) -> tuple[pa.Array, pa.Array]:
    """For each of ``n`` texts its places in a list of that size, as steps, and their times."""
    pairs, count = np.unique(text.astype(np.int64) * size + place, return_counts=True)
    cut = np.searchsorted(pairs, np.arange(n + 1, dtype=np.int64) * size)
    steps = np.diff(pairs % max(1, size), prepend=0)
    steps[cut[:-1]] = pairs[cut[:-1]] % max(1, size)
    return squeezed(steps, cut, np.uint16), squeezed(count, cut, np.uint8)


ROWS = (
    "chunk bigint, doc_id {kind}, held boolean, n_tokens bigint, places binary, times binary, head_places binary, head_times binary, "
    "bucket bigint, words binary, lengths binary, kinds binary, heads binary, n binary, m binary"
)


def _read(docs: DataFrame, centres: np.ndarray, buckets: int) -> DataFrame:
    """Three sorts of rows: each document with the places of its words and heads in its chunk's lists (as steps) and their times, and
    both lists in parcels by bucket: words and their kind, or heads, and their times in training documents, in all (n) and in the
    eighth for the weights (m). A list is in order of buckets. The end of a text is the empty word."""
    kind_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(_chunks(batches)):
            yield from _rows_of_chunk((part << 32) + number, batch, centres, buckets)

    eighth = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(8)) == 0
    marked = docs.select("doc_id", "text", held_out(F.col("doc_id"), 10).alias("held"), eighth.alias("practice"))
    return marked.mapInArrow(run, ROWS.format(kind=kind_type))


def _rows_of_chunk(chunk: int, batch: pa.RecordBatch, centres: np.ndarray, buckets: int) -> list[pa.RecordBatch]:
    """A function of its own, so that nothing of one chunk is held while the next one is read."""
    n, doc_id = len(batch), column(batch, "doc_id")
    data, bounds = _lowered(column(batch, "text"))
    words, kinds = split_words(data, bounds), _nearest(_profiles(data, bounds), centres)
    trained = ~column(batch, "held").to_numpy(zero_copy_only=False)
    flags = trained, trained & column(batch, "practice").to_numpy(zero_copy_only=False)
    text = np.concatenate([words.text_of, np.arange(n)])

    def counted(place: np.ndarray, size: int) -> list[np.ndarray]:
        return [np.bincount(place, flag[text], size).astype(np.int64) for flag in flags]

    heads, place = np.unique(head_codes(words, kinds), return_inverse=True)
    order, rank, bucket = _by_bucket(mix(heads), buckets)
    heads, place = heads[order], rank[place]
    head_places, head_times = _placed(text, place, len(heads), n)
    used, parcel = _parcels(bucket)
    packed = {c: squeezed(v, parcel, np.uint8) for c, v in zip("nm", counted(place, len(heads)))}
    of_heads = _rows(chunk, len(used), doc_id.type, bucket=pa.array(used), heads=_binary(heads, parcel), **packed)
    del heads, place, order, rank

    hashes = np.concatenate([words.hashes(1 << 18), np.zeros(n, np.uint64)])
    _, first, place = np.unique(_keys(hashes, kinds[text]), return_index=True, return_inverse=True)
    order, rank, bucket = _by_bucket(hashes[first], buckets)
    first, place = first[order], rank[place]
    del hashes, order, rank
    places, times = _placed(text, place, len(first), n)
    lists = {"places": places, "times": times, "head_places": head_places, "head_times": head_times}
    of_texts = _rows(chunk, n, doc_id.type, doc_id_=doc_id, held=column(batch, "held"), n_tokens=pa.array(words.counts + 1), **lists)
    starts, stops = (np.append(v, np.zeros(n, np.int64))[first] for v in (words.starts, words.ends))
    spans, (used, parcel) = stops - starts, _parcels(bucket)
    offsets = np.concatenate([[0], np.cumsum(spans)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, spans)
    values = spans, kinds[text[first]], *counted(place, len(first))
    packed = {c: squeezed(v, parcel, np.uint8) for c, v in zip(("lengths", "kinds", "n", "m"), values)}
    of_words = _rows(chunk, len(used), doc_id.type, bucket=pa.array(used), words=_binary(data[at], offsets[parcel]), **packed)
    return [of_texts, of_words, of_heads]


def _parcels(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a list, and where in the list each begins, with its end."""
    used, begin = np.unique(bucket, return_index=True)
    return used, np.append(begin, len(bucket))


def _keys(hashes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    return mix(hashes + kinds.astype(np.uint64) + np.uint64(1))


def _rows(chunk: int, size: int, doc_id: pa.DataType, **given: pa.Array) -> pa.RecordBatch:
    binary = lambda *names: {c: pa.binary() for c in names}
    lists, parcels = binary("places", "times", "head_places", "head_times"), binary("words", "lengths", "kinds", "heads", "n", "m")
    kinds = {"held": pa.bool_(), "n_tokens": pa.int64(), **lists, "bucket": pa.int64(), **parcels}
    names = ["chunk", "doc_id", *kinds]
    arrays = [pa.array(np.full(size, chunk, np.int64)), given.get("doc_id_", pa.nulls(size, doc_id)), *(given.get(k, pa.nulls(size, t)) for k, t in kinds.items())]
    return pa.RecordBatch.from_arrays(arrays, names)


def _united(parcels: DataFrame) -> DataFrame:
    """Two sorts of rows: the different words and kinds of each bucket, numbered, with their times in all chunks and ``known``, those of
    the word in all kinds; and for each parcel the numbers of its words."""
    schema = "bucket bigint, number bigint, word binary, kind int, n bigint, m bigint, known bigint, chunk bigint, numbers binary"

    def unite(table: pa.Table) -> pa.Table:
        (lengths, counts), (kinds, _), (n, _), (m, _) = (stretched(table[c].to_pylist(), np.uint8) for c in ("lengths", "kinds", "n", "m"))
        data, ends = _joined(table["words"], np.uint8), np.cumsum(lengths)
        starts = ends - lengths
        hashes = Words(data, ends, starts, ends, counts).hashes()
        _, first, number = np.unique(_keys(hashes, kinds), return_index=True, return_inverse=True)
        size = len(first)
        times, again = (np.bincount(number, v, size).astype(np.int64) for v in (n, m))
        _, word = np.unique(hashes[first], return_inverse=True)
        known = np.bincount(word, times).astype(np.int64)[word]
        offsets = np.concatenate([[0], np.cumsum(lengths[first])])
        at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts[first], lengths[first])
        bucket = table["bucket"][0].as_py()
        columns = [np.full(size, bucket), np.arange(size), _binary(data[at], offsets), kinds[first].astype(np.int32), times, again, known]
        parts = [pa.array(c) if isinstance(c, np.ndarray) else c for c in columns]
        whole = pa.table([*parts, pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary())], names)
        rows, cut = len(table), np.concatenate([[0], np.cumsum(counts)])
        empty = [pa.nulls(rows, t) for t in whole.schema.types[1:7]]
        linked = pa.table([pa.array(np.full(rows, bucket)), *empty, table["chunk"], squeezed(number, cut, np.uint16)], names)
        return pa.concat_tables([whole, linked])

    names = [c.split()[0] for c in schema.split(", ")]
    return parcels.groupBy("bucket").applyInArrow(unite, schema)


def _united_heads(parcels: DataFrame) -> DataFrame:
    """As ``_united``, for heads: the different ones of each bucket, numbered, with their times, and the numbers of each parcel's."""
    schema = "bucket bigint, number bigint, head bigint, n bigint, m bigint, chunk bigint, numbers binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def unite(table: pa.Table) -> pa.Table:
        (n, counts), (m, _) = (stretched(table[c].to_pylist(), np.uint8) for c in ("n", "m"))
        different, number = np.unique(_joined(table["heads"], np.uint64), return_inverse=True)
        size, rows, bucket = len(different), len(table), table["bucket"][0].as_py()
        times = [pa.array(np.bincount(number, v, size).astype(np.int64)) for v in (n, m)]
        none = lambda k, *types: [pa.nulls(k, t) for t in types]
        head = [pa.array(np.full(size, bucket)), pa.array(np.arange(size)), pa.array(different.view(np.int64)), *times, *none(size, pa.int64(), pa.binary())]
        link = [pa.array(np.full(rows, bucket)), *none(rows, *[pa.int64()] * 4), table["chunk"], squeezed(number, np.concatenate([[0], np.cumsum(counts)]), np.uint16)]
        return pa.concat_tables([pa.table(head, names), pa.table(link, names)])

    return parcels.groupBy("bucket").applyInArrow(unite, schema)


def _put_back(links: DataFrame, scored: DataFrame, score: str) -> DataFrame:
    """For each parcel the scores of its words or heads, in the order of the chunk's list, and of words also their times in training
    texts. Four bytes hold a score to seven digits, more than the packed counts that it comes from."""
    counted = "known" in scored.columns

    def match(table: pa.Table, scored: pa.Table) -> pa.Table:
        place = scored["number"].to_numpy()
        numbers, counts = stretched(table["numbers"].to_pylist(), np.uint16)
        cut = np.concatenate([[0], np.cumsum(counts)])
        scores, known = np.zeros(len(place), np.float32), np.zeros(len(place), np.int64)
        scores[place] = scored[score].to_numpy()
        columns = [table["chunk"], table["bucket"], _binary(scores[numbers], cut)]
        if counted:
            known[place] = scored["known"].to_numpy()
            columns.append(squeezed(known[numbers], cut, np.uint16))
        return pa.table(columns, ["of_chunk", "bucket", score, *["known"] * counted])

    pairs = links.groupBy("bucket").cogroup(scored.groupBy("bucket"))
    return pairs.applyInArrow(match, f"of_chunk bigint, bucket bigint, {score} binary" + ", known binary" * counted)


# Predictors over words


@dataclass
class Coded:
    """The bytes of some words or heads, one after another: each byte's word and place in it, and the hashed predictors' contexts."""

    data: np.ndarray
    word: np.ndarray
    inside: np.ndarray
    contexts: list[np.ndarray]


def code_words(words: pa.Array, kinds: np.ndarray, only: int | None = None, begin: int = 0) -> Coded:
    """The bytes from ``begin`` on, with the contexts of all hashed predictors, or of one; the first bytes as at the start of a text.

    From ``HISTORY`` on, no context reaches beyond the blank before the word, so these hold anywhere.
    """
    words = words.cast(pa.large_binary())
    bounds = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    n = len(words)
    data = np.full(len(raw) + n, END, np.uint8)
    data[np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(bounds))] = raw
    starts = bounds[:-1] + np.arange(n)
    word = np.repeat(np.arange(n), np.diff(bounds) + 1)
    inside = np.arange(len(data)) - starts[word]
    some = np.flatnonzero(inside >= begin)
    inside, word = inside[some], word[some]
    last, recent = np.zeros(len(some), np.uint64), []
    for back in range(1, _reach(only) + 1):
        byte = np.where(some >= back, data[np.maximum(some - back, 0)], END).astype(np.uint64)  # before a word lies the end of another
        last = last | np.where(inside >= back - 1, byte + np.uint64(1), np.uint64(0)) << np.uint64(9 * (back - 1))
        recent.append(last)
    return Coded(data[some], word, inside, _contexts(recent, kinds[word].astype(np.uint64), only))


def code_heads(heads: np.ndarray, only: int | None = None) -> Coded:
    """As ``code_words``, for heads as ``head_codes`` made them."""
    parts = [heads >> np.uint64(8 * (2 * HISTORY - 1 - i)) & np.uint64(255) for i in range(2 * HISTORY)]
    own = np.stack(parts[HISTORY:], 1)
    there = own != NONE
    past = [np.where(p == NONE, np.uint64(0), p + np.uint64(1)) for p in parts]
    past.insert(HISTORY, np.full(len(heads), END + 1, np.uint64))
    word, inside = np.nonzero(there)
    last, recent = np.zeros(own.shape, np.uint64), []
    for back in range(1, _reach(only) + 1):
        last = last | np.stack([past[HISTORY + 1 + j - back] for j in range(HISTORY)], 1) << np.uint64(9 * (back - 1))
        recent.append(last[there])
    return Coded(own[there].astype(np.uint8), word, inside, _contexts(recent, (heads >> np.uint64(16 * HISTORY))[word], only))


def _reach(only: int | None) -> int:
    return HISTORY + 1 if only is None else PREDICTORS[only][0]


def _contexts(recent: list[np.ndarray], kind: np.ndarray, only: int | None) -> list[np.ndarray]:
    """By predictor, from each byte's last one, two and more bytes as numbers."""
    contexts = []
    for p, (length, with_kind) in enumerate(PREDICTORS):
        if only not in (None, p):
            continue
        contexts.append(mix(recent[length - 1] * np.uint64(64) + np.uint64(p) + (mix(kind + np.uint64(1)) if with_kind else np.uint64(0))))
    return contexts


def _coded(rows: pa.RecordBatch | pa.Table, only: int | None = None) -> Coded:
    """Heads, or the tails of words."""
    if "head" in rows.schema.names:
        return code_heads(column(rows, "head").to_numpy().view(np.uint64), only)
    return code_words(column(rows, "word"), column(rows, "kind").to_numpy(), only, HISTORY)


def _slots(context: np.ndarray, node: np.ndarray, slot_bits: int) -> np.ndarray:
    return ((context + node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - slot_bits)).astype(np.int64)


def _bits(data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Place of the bit, the byte so far with a leading 1, and the bit."""
    node = np.ones(len(data), np.int64)
    for place in range(8):
        bit = (data >> np.uint8(7 - place)) & np.uint8(1)
        yield place, node, bit.astype(np.int64)
        node = 2 * node + bit


def _counted(words: DataFrame, heads: DataFrame, slot_bits: int) -> DataFrame:
    """(slot, n0, n1, m0, m1) of all hashed predictors: the times of a 0 and a 1, in all and in the eighth for the weights."""
    size = 1 << slot_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = list(batches), np.empty((2, 2 * size))
        for p in range(len(PREDICTORS)):
            counts[:] = 0
            for batch in held:
                coded = _coded(batch, only=p)
                times, again = (column(batch, c).to_numpy().astype(float)[coded.word] for c in ("n", "m"))
                some = np.flatnonzero(again)
                again = again[some]
                for _, node, bit in _bits(coded.data):
                    cell = 2 * _slots(coded.contexts[0], node, slot_bits) + bit
                    np.add.at(counts[0], cell, times)
                    np.add.at(counts[1], cell[some], again)
            used = np.flatnonzero(counts[0].reshape(size, 2).any(1))
            for at in range(0, len(used), 1 << 16):
                some = used[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(some + p * size), *(pa.array(c[2 * some + v].astype(np.int64)) for c in counts for v in (0, 1))], ["slot", "n0", "n1", "m0", "m1"])

    both = [df.mapInArrow(run, "slot bigint, n0 bigint, n1 bigint, m0 bigint, m1 bigint") for df in (words, heads)]
    return both[0].unionAll(both[1]).groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "m0", "m1")])


def _state_tables(counts: DataFrame, slot_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed states of all predictors, without the eighth and in all; their size is fixed by ``slot_bits``."""
    block = 1 << 16

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        n0, n1, m0, m1 = (frame[c].to_numpy(float) for c in ("n0", "n1", "m0", "m1"))
        out = {"block": [int(frame["slot"].iloc[0]) // block]}
        for name, zeros, ones in (("some", n0 - m0, n1 - m1), ("whole", n0, n1)):
            states = np.zeros(block, np.uint16)
            states[frame["slot"].to_numpy() % block] = _packed(zeros) * 256 + _packed(ones)
            out[name] = [states.tobytes()]
        return pd.DataFrame(out)

    tables = [np.zeros(len(PREDICTORS) << slot_bits, np.uint16) for _ in range(2)]
    packed = counts.groupBy(F.floor(F.col("slot") / block).alias("b")).applyInPandas(pack, "block bigint, some binary, whole binary")
    for r in saved(packed, "words-states").toLocalIterator():
        for table, name in zip(tables, ("some", "whole")):
            table[r["block"] * block : (r["block"] + 1) * block] = np.frombuffer(r[name], np.uint16)
    return tables[0], tables[1]


@dataclass
class Model:
    slot_bits: int
    states: np.ndarray
    weights: np.ndarray | None = None
    refined: np.ndarray | None = None


_ODDS, _CONFIDENCE = _tables_of_states()


@dataclass
class Shared:
    """For bit ``place`` of byte ``inside`` of each word, at [8 * (inside - SHARED) + place, word]: odds from the words that begin
    alike, the same by kind, and the confidence of the first."""

    odds: np.ndarray
    kind_odds: np.ndarray
    confidence: np.ndarray


def beginnings(words: pa.Array, kinds: np.ndarray, times: np.ndarray) -> Shared:
    """Counts of what follows the same beginning. The words are in order and whole by their first SHARED bytes.

    Words with one beginning are a range of places; the next bit cuts the range in two, and running sums of the times give
    both counts.
    """
    n = len(words)
    words = words.cast(pa.large_binary())
    bounds = np.frombuffer(words.buffers()[1], np.int64, n + 1, words.offset * 8)
    raw = np.append(np.frombuffer(words.buffers()[2] or b"", np.uint8), np.uint8(END))
    sizes = np.diff(bounds)
    lengths = np.minimum(sizes + 1, DEEPEST)
    places = np.arange(DEEPEST)[:, None]
    padded = np.where(places < sizes, raw[np.minimum(bounds[:-1] + places, len(raw) - 1)], END).astype(np.uint8)
    total = np.concatenate([[0], np.cumsum(times)]).astype(float)
    by_kind = np.zeros((int(kinds.max(initial=0)) + 1, n + 1))
    for k in range(len(by_kind)):
        by_kind[k, 1:] = np.cumsum(np.where(kinds == k, times, 0))
    changes = np.flatnonzero((padded[:SHARED, 1:] != padded[:SHARED, :-1]).any(0)) + 1 if n else np.empty(0, np.int64)
    edges = np.concatenate([[0], changes, [n]])
    group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    low, high = edges[group], edges[group + 1]
    out = Shared(*(np.zeros((8 * (DEEPEST - SHARED), n), t) for t in (np.float32, np.float32, np.uint8)))
    for j in range(SHARED, DEEPEST):
        alive = np.flatnonzero(lengths > j)
        if not len(alive):
            break
        for place in range(8):
            bit = (padded[j] >> np.uint8(7 - place)) & np.uint8(1)
            zeros = np.concatenate([[0], np.cumsum(bit == 0)])
            lo, hi = low[alive], high[alive]
            middle = lo + zeros[hi] - zeros[lo]
            own = bit[alive]
            k = kinds[alive]
            counts = [total[middle] - total[lo], total[hi] - total[middle], by_kind[k, middle] - by_kind[k, lo], by_kind[k, hi] - by_kind[k, middle]]
            row = 8 * (j - SHARED) + place
            out.odds[row, alive] = _odds(counts[0], counts[1])
            out.kind_odds[row, alive] = _odds(counts[2], counts[3])
            out.confidence[row, alive] = _confidence(counts[0] + counts[1])
            low[alive], high[alive] = np.where(own == 1, middle, lo), np.where(own == 1, hi, middle)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The ordered rows in blocks, cut only where the first SHARED bytes change."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if len(held) < BLOCK:
            continue
        heads = pc.binary_slice(held.column("word").combine_chunks(), 0, SHARED).to_pylist()
        cut = len(heads)
        while cut > 0 and heads[cut - 1] == heads[-1]:
            cut -= 1
        if cut:
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut).combine_chunks()
    if held is not None and len(held):
        yield held.combine_chunks()


def _in_order(words: DataFrame) -> DataFrame:
    return words.repartitionByRange(F.substring("word", 1, SHARED)).sortWithinPartitions("word", "kind")


class Inputs:
    """What the mixer gets for the bits of a block of heads, or of words from byte ``begin`` on."""

    def __init__(self, model: Model, block: pa.Table, begin: int = 0):
        self.model = model
        if "head" in block.schema.names:  # all their bytes lie before SHARED
            self.coded = _coded(block)
            self.shared = Shared(*(np.zeros((8 * (DEEPEST - SHARED), 1), t) for t in (np.float32, np.float32, np.uint8)))
            return
        words = block.column("word").chunk(0) if block.column("word").num_chunks else pa.array([], pa.binary())
        kinds, times = block.column("kind").to_numpy(), block.column("n").to_numpy()
        self.coded = code_words(words, kinds, begin=begin)
        self.shared = beginnings(words, kinds, times)

    def __call__(self, node: np.ndarray, place: int, at: np.ndarray | slice) -> tuple[list[np.ndarray], np.ndarray]:
        size, odds, coded = 1 << self.model.slot_bits, [], self.coded
        for p, context in enumerate(coded.contexts):
            state = self.model.states[_slots(context[at], node, self.model.slot_bits) + p * size]
            odds.append(_ODDS[state])
            if p == LONGEST:
                sure = _CONFIDENCE[state].astype(np.int64)
        inside, word = coded.inside[at], coded.word[at]
        deep = (inside >= SHARED) & (inside < DEEPEST)
        cell = np.where(deep, (8 * (inside - SHARED) + place) * self.shared.odds.shape[1] + word, 0)
        odds.append(np.where(deep, self.shared.odds.ravel().take(cell), 0))
        odds.append(np.where(deep, self.shared.kind_odds.ravel().take(cell), 0))
        odds.append(np.ones(len(node), np.float32))
        begun = np.where(deep, self.shared.confidence.ravel().take(cell), np.where(inside < SHARED, CONFIDENCES - 1, 0))
        return odds, (place * CONFIDENCES + sure) * CONFIDENCES + begun


def _sum_of(weights: np.ndarray, odds: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
    total = np.zeros(len(gate))
    for of_input, o in zip(np.ascontiguousarray(weights.T), odds):
        total += of_input.take(gate) * o
    return np.clip(total, -12, 12)


def _cell(mixed: np.ndarray, node: np.ndarray) -> np.ndarray:
    return node * BUCKETS + np.clip((mixed + 12) * (BUCKETS / 24), 0, BUCKETS - 1).astype(np.int64)


def _started() -> np.ndarray:
    weights = np.full((GATES, INPUTS), 0.2)
    weights[:, -1] = 0.0
    return weights


def _learn(words: DataFrame, heads: DataFrame, shared: Broadcast, step: int = 2048, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """The gate's weight sets, averaged over the tasks, and by byte so far and predicted odds the shift to what came true."""
    cells, sets = 256 * BUCKETS, CONFIDENCES * CONFIDENCES

    def run(blocks: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        weights, squares = _started(), np.full((GATES, INPUTS), 1e-3)
        summed, seen = np.zeros((GATES, INPUTS)), np.zeros(GATES)
        ones, whole, predicted = np.zeros(cells), np.zeros(cells), np.zeros(cells)
        draw = np.random.Generator(np.random.PCG64(1))
        for block in blocks:
            inputs = Inputs(shared.value, block, HISTORY)
            coded = inputs.coded
            times = block.column("m").to_numpy().astype(float)[coded.word]
            order = np.flatnonzero(times)
            order = order[np.argsort(draw.permutation(len(block))[coded.word[order]], kind="stable")]
            for begin in range(0, len(order), step):
                at = order[begin : begin + step]
                strength = times[at]
                for place, node, bit in _bits(coded.data[at]):
                    odds, gate = inputs(node, place, at)
                    gate, own = gate - place * sets, slice(place * sets, (place + 1) * sets)
                    mixed = _sum_of(weights[own], odds, gate)
                    error = (bit - 1 / (1 + np.exp(-mixed))) * strength
                    used = np.bincount(gate, strength, sets)
                    slope = np.stack([np.bincount(gate, error * o, sets) for o in odds], 1) / np.maximum(used, 1e-9)[:, None]
                    squares[own] += slope**2
                    weights[own] += rate * slope / np.sqrt(squares[own])
                    summed[own] += weights[own] * used[:, None]
                    seen[own] += used
                    first = BUCKETS << place  # the bytes so far are 2**place numbers from 2**place on
                    cell = _cell(mixed, node) - first
                    whole[first : 2 * first] += np.bincount(cell, strength, first)
                    ones[first : 2 * first] += np.bincount(cell, strength * bit, first)
                    predicted[first : 2 * first] += np.bincount(cell, strength * mixed, first)
        yield _sums("weight", np.arange(GATES * INPUTS), summed.ravel(), np.repeat(seen, INPUTS), np.zeros(GATES * INPUTS))
        filled = np.flatnonzero(whole)
        yield _sums("cell", filled, ones[filled], whole[filled], predicted[filled])

    sums = "what string, place bigint, a double, b double, c double"
    of_words = _in_order(words).mapInArrow(lambda batches: run(_blocks(batches)), sums)
    of_heads = heads.mapInArrow(lambda batches: run(pa.Table.from_batches([b]) for b in batches), sums)
    added = of_words.unionAll(of_heads).groupBy("what", "place")
    weights, shift = _started(), np.zeros(cells)
    for r in added.agg(*[F.sum(c).alias(c) for c in "abc"]).collect():
        if r["b"] <= 0:
            continue
        if r["what"] == "weight":
            weights[divmod(r["place"], INPUTS)] = r["a"] / r["b"]
            continue
        mean = r["c"] / r["b"]
        came = (r["a"] + 20 / (1 + math.exp(-mean))) / (r["b"] + 20)
        shift[r["place"]] = min(4.0, max(-4.0, math.log(came / (1 - came)) - mean))
    return weights, shift


def _sums(what: str, place: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([what] * len(place), pa.string()), pa.array(place), *map(pa.array, values)], ["what", "place", "a", "b", "c"])


def log10_of_words(model: Model, block: pa.Table, begin: int = 0) -> np.ndarray:
    """The log10 probability of each word with its end, from byte ``begin`` on, or of each head."""
    inputs = Inputs(model, block, begin)
    total = np.zeros(len(inputs.coded.data))
    for place, node, bit in _bits(inputs.coded.data):
        odds, gate = inputs(node, place, slice(None))
        mixed = _sum_of(model.weights, odds, gate)
        final = mixed + 0.5 * model.refined[_cell(mixed, node)]
        total -= np.log1p(np.exp(np.where(bit == 1, -final, final)))  # |final| is 14 at most
    return np.bincount(inputs.coded.word, total, len(block)) / math.log(10)


def _scored_words(words: DataFrame, shared: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            scores = pa.array(log10_of_words(shared.value, block, HISTORY))
            yield from block.select(["bucket", "number", "known"]).append_column("score", scores).to_batches()

    return _in_order(words.drop("m")).mapInArrow(run, "bucket bigint, number bigint, known bigint, score double")


def _scored_heads(heads: DataFrame, shared: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = log10_of_words(shared.value, pa.Table.from_batches([batch]))
            yield batch.select(["bucket", "number"]).append_column("head_score", pa.array(scores))

    return heads.mapInArrow(run, "bucket bigint, number bigint, head_score double")


def _with(spark: SparkSession, model: Model, use: Callable[[Broadcast], object]):
    """The result of ``use`` on the model as sent to the tasks; it must be worked out when it returns."""
    shared = spark.sparkContext.broadcast(model)
    try:
        return use(shared)
    finally:
        shared.destroy()


def _adder(places: pd.Series, times: pd.Series) -> Callable[[np.ndarray], np.ndarray]:
    """For texts with places in a list, as steps, and their times: adds up by text what is given by place."""
    steps, lengths = stretched(places.to_list(), np.uint16)
    often, _ = stretched(times.to_list(), np.uint8)
    of, begun = np.repeat(np.arange(len(lengths)), lengths), np.concatenate([[0], np.cumsum(steps)])
    at = begun[1:] - begun[np.cumsum(lengths) - lengths][of]
    return lambda values: np.bincount(of, often * values[at], len(lengths))


def score_texts(docs: DataFrame, *, kinds: int = 8, fit_rows: int = 4000, slot_bits: int = 22) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    arrow_rows(spark, 500)
    training = docs.where(~held_out(F.col("doc_id"), 10)).select("text").where("text is not null")
    centres = kind_centres(training, kinds, fit_rows)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = saved(_read(docs, centres, max(8, size // BUCKET)), "words-read", compression="zstd")  # packed rows shrink by little else
    arrow_rows(spark, 20_000)
    united = saved(_united(rows.where("words is not null").select("chunk", "bucket", "words", "lengths", "kinds", "n", "m")), "words-united")
    united_heads = saved(_united_heads(rows.where("heads is not null").select("chunk", "bucket", "heads", "n", "m")), "heads-united")
    free_shuffles(spark)
    words = united.where("word is not null").drop("chunk", "numbers")
    heads = united_heads.where("head is not null").drop("chunk", "numbers")
    heads = heads.coalesce(math.ceil((heads.count() + 1) / TASK_HEADS))
    totals = words.agg(F.sum("n"), F.sum(F.when(F.col("known") > 0, F.col("n") / F.col("known")))).first()
    train_tokens, different = int(totals[0] or 0), round(totals[1] or 0)
    trained, trained_heads = words.where("n > 0").select("word", "kind", "n", "m"), heads.where("n > 0").select("head", "n", "m")
    slot_bits = max(16, min(slot_bits, math.ceil(math.log2(16 * trained.count() + 1))))
    practice = trained.withColumn("n", F.col("n") - F.col("m"))
    slots = saved(_counted(trained, trained_heads, slot_bits), "words-slots")
    some, whole = _state_tables(slots, slot_bits)
    discard(slots)
    model = Model(slot_bits, some)
    model.weights, model.refined = _with(spark, model, lambda shared: _learn(practice, trained_heads.where("m > 0"), shared))
    model.states = whole
    score_all = lambda shared: (saved(_scored_words(words, shared), "words-scored"), saved(_scored_heads(heads, shared), "heads-scored"))
    scores, head_scores = _with(spark, model, score_all)
    free_shuffles(spark)
    links, head_links = (df.where("numbers is not null").select("chunk", "bucket", "numbers") for df in (united, united_heads))
    found = saved(_put_back(links, scores, "score"), "words-found")
    discard(united, scores)
    found_heads = saved(_put_back(head_links, head_scores, "head_score"), "heads-found")
    discard(united_heads, head_scores)
    found = found.unionByName(found_heads, allowMissingColumns=True)
    per_token = -math.log10(train_tokens + 0.1 * (different + 1))
    kind_type = docs.schema["doc_id"].dataType.simpleString()

    def add_up(texts: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("bucket")
        known, _ = stretched(table["known"].dropna().to_list(), np.uint16)
        score, head_score = (np.frombuffer(b"".join(table[c].dropna()), np.float32).astype(float) for c in ("score", "head_score"))
        base = np.log10(known + 0.1) + per_token
        add = _adder(texts["places"], texts["times"])
        add_heads = _adder(texts["head_places"], texts["head_times"])
        return pd.DataFrame(
            {
                "doc_id": texts["doc_id"], "held_out": texts["held"], "n_tokens": texts["n_tokens"], "n_known": add(known > 0).astype(np.int64),
                "train_tokens": train_tokens, "base_score": add(base), "score": add(score) + add_heads(head_score) - math.log10(kinds),
            }
        )

    texts = rows.where("places is not null").select("chunk", "doc_id", "held", "n_tokens", "places", "times", "head_places", "head_times")
    result = "doc_id {}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double".format(kind_type)
    return texts.groupBy("chunk").cogroup(found.groupBy("of_chunk")).applyInPandas(add_up, result)
