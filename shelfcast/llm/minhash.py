"""Near-duplicate texts by circulant MinHash, bands and an exact check.

A text's set are its distinct shingles of ``shingle`` lower-case words. One permutation of the 32-bit numbers places every
shingle, a second one, shifted by k, gives coordinate k: ``second(first(x) + k)``. Equal sets become one class by a 128-bit
fingerprint before anything is compared. Classes that share a band are candidates; the links are confirmed on the full sets.

No pair is ever a row. The classes of a bucket meet in a task with their sets, which compares them with each other and passes on
links that connect what is apart, at most one for each class. Waves of bands follow each other: a bucket whose classes are in
one component by then is not looked at again. A bucket above BLOCK is cut into blocks. In the early waves each block is compared
by itself, otherwise than in the wave before; in the last one, all blocks are. There the largest component of a bucket meets the
others only, so a group of copies with a few strangers costs no more than its rows. So no two classes that share a band and
stay apart are left uncompared, however large their bucket. Where very many classes share a bucket without being alike, the
work in tasks grows with their square and the rows with the square over BLOCK.

Defined results: null text and text without words has an empty set, linked with nothing; fewer words than a shingle make
one shingle of them all; equal rows and equal sets are linked; component_id is the smallest doc_id that can be reached, null
if none of the component has one, and ``kept`` says that the row's doc_id is that one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import forest, joined_labels
from shelfcast.llm.mixing import WORD
from shelfcast.llm.store import arrow_rows, discard, free_shuffles, packed, saved, unpacked
from shelfcast.llm.text import column, mix, pieces, words_of

BANDS, ROWS = 40, 6
WAVES = (2, 8, BANDS)  # bands looked at by the end of each wave
BLOCK = 256  # classes
_COLUMNS = 4096


def _permuted(x: np.ndarray) -> np.ndarray:
    """A bijection of the 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after another, and the bounds of each text."""
    words = words_of(texts, lower=True)
    hashes, text, counts = words.hashes(), words.text_of, words.counts
    keys = np.empty(0, np.uint64)
    at = np.empty(0, np.int64)
    if len(hashes) >= shingle:
        keys = hashes[shingle - 1 :].copy()
        for back in range(1, shingle):
            keys = mix(keys) + hashes[shingle - 1 - back : len(hashes) - back]
        whole = text[shingle - 1 :] == text[: len(text) - shingle + 1]
        keys, at = mix(keys[whole]), text[shingle - 1 :][whole]
    for i in np.flatnonzero((counts > 0) & (counts < shingle)):
        short = np.uint64(counts[i])
        for h in hashes[words.first[i] : words.first[i + 1]]:
            short = mix(np.array([short], np.uint64) + h)[0]
        keys, at = np.append(keys, short), np.append(at, i)
    order = np.argsort(at, kind="stable")
    keys, bounds = keys[order], np.searchsorted(at[order], np.arange(len(counts) + 1))
    sets = [np.unique(keys[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else keys), np.concatenate([[0], np.cumsum(sizes)])


def band_keys(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit key for each text with a set (rows) and band."""
    placed = _permuted((keys ^ (keys >> np.uint64(32))).astype(np.uint32))
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(starts), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = mix(key + np.minimum.reduceat(_permuted(placed + np.uint32(k)), starts))
        out[:, band] = key
    return out


def _fingerprints(keys: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    first = np.concatenate([[0], np.cumsum(mix(keys), dtype=np.uint64)]).astype(np.uint64)
    second = np.concatenate([[0], np.cumsum(mix(keys + np.uint64(77)), dtype=np.uint64)]).astype(np.uint64)
    both = np.stack([first[bounds[1:]] - first[bounds[:-1]], second[bounds[1:]] - second[bounds[:-1]]], 1)
    return [both[i].tobytes() if bounds[i + 1] > bounds[i] else None for i in range(len(bounds) - 1)]


def _signed(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, print, bands) of each row; print and bands are null for an empty set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in pieces(column(batch, "text"), 1 << 21):
                part = batch.slice(at, to - at)
                keys, bounds = shingle_sets(column(part, "text"), shingle)
                full = np.diff(bounds) > 0
                bands = band_keys(keys, bounds) if full.any() else np.empty((0, BANDS), np.uint64)
                offsets = pa.array(np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(bands.ravel().view(np.int64)), mask=pa.array(~full))
                prints = pa.array(_fingerprints(keys, bounds), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), column(part, "text_key"), pa.array(np.diff(bounds)), prints, lists],
                    ["doc_id", "text_key", "n_shingles", "print", "bands"],
                )

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return keyed.mapInArrow(run, f"doc_id {kind}, text_key bigint, n_shingles bigint, print binary, bands array<bigint>")


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(class, keys) of ``texts(class, text)``: the sorted 64-bit shingle hashes of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in pieces(column(batch, "text"), 1 << 21):
                part = batch.slice(at, to - at)
                keys, bounds = shingle_sets(column(part, "text"), shingle)
                raw = [keys[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([column(part, "class"), pa.array(raw, pa.binary())], ["class", "keys"])

    return texts.mapInArrow(run, "class bigint, keys binary")


def _labelled(buckets: DataFrame, labels: DataFrame, wave: int) -> DataFrame:
    """(bucket, class, label, own, low, high): what this wave compares, by bucket and pair of blocks; ``own`` is the row's block."""
    marked = buckets.where(F.col("band") < WAVES[wave]).join(labels.withColumnRenamed("node", "class"), "class")
    parts = marked.groupBy("bucket", "band", "label").agg(F.count(F.lit(1)).alias("n"))
    by_bucket = parts.groupBy("bucket", "band").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("largest"))
    new = F.col("band") >= ((0,) + WAVES)[wave]
    last = wave == len(WAVES) - 1
    wanted = by_bucket.where((F.col("largest.n") < F.col("n")) & (new | F.lit(last) & (F.col("n") > BLOCK)))
    wanted = saved(wanted.select("bucket", "n", F.col("largest.n").alias("main"), F.col("largest.label").alias("main_label")), "minhash-mixed")
    rows = marked.join(wanted, "bucket")
    of = lambda n: F.pmod(F.xxhash64("class", F.lit(wave)), F.greatest(F.ceil(n / BLOCK), F.lit(1)))
    if not last:
        own = of(F.col("n"))
        return rows.select("bucket", "class", "label", own.alias("own"), own.alias("low"), own.alias("high"))
    small, in_main = F.col("n") <= BLOCK, F.col("label") == F.col("main_label")
    rest = F.ceil((F.col("n") - F.col("main")) / BLOCK)
    own = F.when(small, F.lit(0)).when(in_main, rest + of(F.col("main"))).otherwise(of(F.col("n") - F.col("main")))
    most = F.when(small, F.lit(0)).when(in_main, rest - 1).otherwise(rest + F.ceil(F.col("main") / BLOCK) - 1)
    met = rows.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0).cast("bigint"), most.cast("bigint"))))
    return met.select("bucket", "class", "label", "own", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"))


def _shared_counts(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How many shingles each set of ``first`` shares with each other one of ``second``."""
    if len(first) * len(second) <= 40:
        out = np.zeros((len(first), len(second)), np.int64)
        for i, x in enumerate(first):
            for j, y in enumerate(second):
                a, b = sets[x], sets[y]
                out[i, j] = (a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum()
        return out
    used = np.union1d(first, second)
    owner = np.repeat(used, [len(sets[i]) for i in used])
    _, place, times = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    numbered = np.cumsum(times > 1) - 1
    several = times[place] > 1
    owner, place = owner[several], numbered[place[several]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(first), len(second)), np.float32)
    at = {side: np.full(len(sets), -1) for side in ("first", "second")}
    at["first"][first], at["second"][second] = np.arange(len(first)), np.arange(len(second))
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, _COLUMNS):
        lo, hi = np.searchsorted(place, [start, start + _COLUMNS])
        grids = []
        for side, n in (("first", len(first)), ("second", len(second))):
            row = at[side][owner[lo:hi]]
            grid = np.zeros((n, _COLUMNS), np.float32)
            grid[row[row >= 0], place[lo:hi][row >= 0] - start] = 1
            grids.append(grid)
        total += grids[0] @ grids[1].T
    return np.rint(total).astype(np.int64)


def _connecting(ids: np.ndarray, labels: np.ndarray, raw: list[bytes], in_low: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the labels of one group; all pairs are compared if it is one block, else those between two."""
    first, second = np.flatnonzero(in_low), np.flatnonzero(~in_low)
    second = second if len(second) else first
    size = np.array([len(r) // 8 for r in raw])
    low, high = np.minimum.outer(size[first], size[second]), np.maximum.outer(size[first], size[second])
    asked = (labels[first][:, None] != labels[second][None, :]) & (percent * high <= 100 * low)
    asked &= first[:, None] < second[None, :] if first is second else True
    rows, cols = np.flatnonzero(asked.any(1)), np.flatnonzero(asked.any(0))
    if not len(rows):
        return ids[:0], ids[:0]
    first, second, asked = first[rows], second[cols], asked[np.ix_(rows, cols)]
    shared = _shared_counts([np.frombuffer(r, np.uint64) for r in raw], first, second)
    alike = asked & (100 * shared >= percent * (size[first][:, None] + size[second][None, :] - shared))
    x, y = np.nonzero(alike)
    x, y = first[x], second[y]
    used = forest(labels[x], labels[y])
    return ids[x[used]], ids[y[used]]


def _links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect the components of each bucket."""
    keys = ["bucket", "low", "high"]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.join(sets, "class").repartition(tasks, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def compared(table: pa.Table) -> pa.RecordBatch:
            key = np.stack([table.column(c).to_numpy() for c in keys])
            ids, labels, own = (table.column(c).to_numpy() for c in ("class", "label", "own"))
            raw = table.column("keys").to_pylist()
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            found = [(ids[:0], ids[:0])]
            for at, to in zip(np.append(0, cuts), np.append(cuts, len(ids))):
                if (labels[at:to] != labels[at]).any():
                    found.append(_connecting(ids[at:to], labels[at:to], raw[at:to], own[at:to] == key[1, at], percent))
            a, b = (np.concatenate(x) for x in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            last = np.ones(len(table), bool)
            for c in keys:
                values = table.column(c).to_numpy()
                last &= values == values[-1]
            cut = int(np.argmax(last))  # the last group waits for the next batch; groups are of two blocks at most
            if cut:
                yield compared(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None:
            yield compared(held)

    return dealt.select(*keys, "own", "class", "label", "keys").mapInArrow(run, "a bigint, b bigint").distinct()


def _classes(signed: DataFrame) -> DataFrame:
    """One row for each different set: class, print, the smallest doc_id, the key of one of its texts, bands."""
    grouped = signed.where("print is not null").groupBy("print").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("text_key", "doc_id")).alias("one"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size")
    )
    return saved(grouped.withColumn("class", F.monotonically_increasing_id()), "minhash-classes")


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, group, component_id and kept for every row of ``docs(doc_id, text)``.

    Links are pairs of texts with ``100 * shared >= percent * joint`` shingles. ``group`` numbers the components, null for an
    empty set; ``text_key`` is the text's xxhash64.
    """
    arrow_rows(docs.sparkSession, 500)
    signed = saved(_signed(docs, shingle), "minhash-signed")
    classes = _classes(signed)
    bands = classes.select("class", F.posexplode("bands").alias("band", "bucket"))
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    # Written first: between two plain exchanges Spark can split a bucket with very many rows.
    buckets = saved(bands.join(saved(shared, "minhash-shared"), "bucket"), "minhash-buckets")
    free_shuffles(docs.sparkSession)
    made = [classes, buckets]
    wanted = classes.join(buckets.select("class").distinct(), "class", "left_semi").select("class", "one")
    held = docs.select("doc_id", "text").join(wanted, (F.xxhash64("text") == F.col("one.text_key")) & F.col("doc_id").eqNullSafe(F.col("one.doc_id")))
    sets = saved(_sets(held.select("class", "text").dropDuplicates(["class"]), shingle), "minhash-sets")
    free_shuffles(docs.sparkSession)
    made.append(sets)
    labels = buckets.select(F.col("class").alias("node")).distinct().withColumn("label", F.col("node"))
    for wave in range(len(WAVES)):
        links = saved(_links(_labelled(buckets, labels, wave), sets, percent), "minhash-links")
        labels = saved(joined_labels(labels, links), "minhash-labels")
        free_shuffles(docs.sparkSession)
    named = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select("print", "doc_id", F.coalesce("label", "class").alias("label"))
    lowest = named.groupBy("label").agg(F.min("doc_id").alias("component"))
    groups = saved(named.join(lowest, "label").select("print", F.col("label").alias("group"), "component"), "minhash-groups")
    discard(*made)
    component = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return signed.join(groups, "print", "left").select(
        "doc_id", "text_key", "n_shingles", "group", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def one_of_each(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with empty sets, and one row of each component: that with the smallest doc_id, then text key."""
    found = saved(near_duplicates(docs.select("doc_id", "text"), shingle=shingle, percent=percent), "minhash-found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("one")
    stay = found.where(F.col("group").isNotNull()).groupBy("group").agg(first).select(F.col("one.doc_id").alias("its"), F.col("one.text_key").alias("its_key"))
    whole = packed(docs, doc_id=F.col("doc_id"), text_key=F.xxhash64("text"), worded=F.coalesce(F.col("text"), F.lit("")).rlike(WORD))
    matched = whole.join(stay, (F.col("text_key") == F.col("its_key")) & F.col("doc_id").eqNullSafe(F.col("its")))
    return unpacked(matched.where("worded").dropDuplicates(["doc_id", "text_key"]).select("row").union(whole.where("not worded").select("row")))
