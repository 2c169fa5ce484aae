"""Importance resampling towards a target distribution, over hashed n-gram features.

The features of a text are its runs of 1 to ``longest`` consecutive words, and a feature's bucket is the crc32 of its bytes
modulo ``buckets``. The distinct features of some texts are grouped by equal length into two-dimensional uint8 arrays. Each array's
checksums are updated column by column, all features of that length at once, and the buckets are scattered back to the texts.
Features above LONGEST_ROW bytes, of which a table would hold few rows and very many columns, go to zlib one by one.

A bucket's gain is the log ratio of its smoothed shares in the target texts and in all documents. A document's weight is the mean
gain of its features, and Gumbel noise from a hash of its id turns the weights into a draw without replacement: the highest
scores are drawn. Ranks come from a range-partitioned order and the counts of its partitions, so no task sees all scores.
What tasks are sent is one gain for each bucket.

Defined results: null texts and texts without words have no features and weight 0; a null id is hashed as an empty one and comes
last in ties; rows that are the same get the same score, each with a rank of its own, and rows of one id and score are
ordered by weight and number of features; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.store import arrow_rows, saved
from shelfcast.llm.text import LOWER, Words, buffer_of, column, pieces, prefix_sums, span_hashes

LONGEST_ROW = 2048
_IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


def crc_rows(rows: np.ndarray) -> np.ndarray:
    """The crc32 of each row of a two-dimensional uint8 array."""
    state = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for col in rows.T:
        state = _CRC[(state ^ col) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
    return ~state


def crc_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of each span of ``data``."""
    out, length = np.empty(len(starts), np.uint32), ends - starts
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order])) + 1
    for at in np.split(order, cuts) if len(order) else []:
        n = int(length[at[0]])
        if n > LONGEST_ROW:
            out[at] = [zlib.crc32(data[starts[i] : ends[i]]) for i in at]
            continue
        for part in np.split(at, range(1 << 16, len(at), 1 << 16)):
            out[part] = crc_rows(data[starts[part][:, None] + np.arange(n)])
    return out


def words_in(texts: pa.Array) -> Words:
    """The words of some texts, lower-cased."""
    data, bounds = buffer_of(texts)
    data = LOWER[data]
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))


def _joined(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words with one blank after each, and where each begins; one bound more than words."""
    sizes = words.ends - words.starts + 1
    begins = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(begins[-1]) + np.repeat(words.starts - begins[:-1], sizes)
    out = words.data[np.minimum(at, max(len(words.data) - 1, 0))]
    out[begins[1:] - 1] = 32
    return out, begins


def feature_buckets(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of each feature, and the number of words of each text."""
    words = words_in(texts)
    data, begins = _joined(words)
    text, n = words.text_of, len(words.starts)
    sums = prefix_sums(data)
    found_text, found = [], []
    for size in range(1, longest + 1):
        first = np.arange(max(n - size + 1, 0))
        first = first[text[first] == text[first + size - 1]]
        starts, ends = begins[first], begins[first + size] - 1
        _, one, place = np.unique(span_hashes(sums, starts, ends), return_index=True, return_inverse=True)
        found.append((crc_spans(data, starts[one], ends[one]) % np.uint32(buckets))[place].astype(np.int64))
        found_text.append(text[first])
    return np.concatenate(found_text), np.concatenate(found), words.counts


def bucket_counts(texts: DataFrame, *, longest: int, buckets: int) -> DataFrame:
    """(bucket, n): the features of all ``texts(text)`` by bucket, summed up in each task first."""
    arrow_rows(texts.sparkSession, 1000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for at, to in pieces(column(batch, "text")):
                total += np.bincount(feature_buckets(column(batch, "text").slice(at, to - at), longest, buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": total[held]})

    return texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, *, longest: int, buckets: int) -> np.ndarray:
    """floor(1000 ln) of the ratio of each bucket's share in the target and in the documents, one added to every count."""
    spark = docs.sparkSession
    every = spark.range(buckets).select(F.col("id").alias("bucket"))
    counts = every
    for name, texts in (("s", docs), ("t", target)):
        counts = counts.join(bucket_counts(texts, longest=longest, buckets=buckets).withColumnRenamed("n", name), "bucket", "left")
    counts = saved(counts.fillna(0, ["s", "t"]), "importance-buckets")
    totals = counts.agg(F.sum("s"), F.sum("t")).first()
    ratio = (F.col("t") + 1).cast("double") * F.lit(totals[0] + buckets) / ((F.col("s") + 1).cast("double") * F.lit(totals[1] + buckets))
    rows = counts.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("bigint").alias("gain")).collect()
    gains = np.zeros(buckets, np.int64)
    gains[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    return gains


def weighed(docs: DataFrame, gains: np.ndarray, *, longest: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row of ``docs(doc_id, text)``."""
    arrow_rows(docs.sparkSession, 1000)
    kind, buckets = docs.schema["doc_id"].dataType.simpleString(), len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in pieces(column(batch, "text")):
                part = batch.slice(at, to - at)
                text, bucket, n_words = feature_buckets(column(part, "text"), longest, buckets)
                n = np.bincount(text, minlength=to - at)
                total = np.bincount(text, gains[bucket], to - at).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array(n_words.astype(np.int64)), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel variate, floored, from the first 32 bits of a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their rank from 1, a saved table; every partition holds a range of the order."""
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = placed.select("*", F.shiftright("place", 33).alias("part")).withColumn("place", F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))
    placed = saved(placed, "importance-placed")
    before, starts = 0, []
    for part, n in sorted(placed.groupBy("part").count().collect()):
        starts.append((part, before))
        before += n
    offsets = spark.createDataFrame(starts, "part bigint, before bigint")
    return placed.join(F.broadcast(offsets), "part").withColumn("rank", F.col("place") + F.col("before") + 1).drop("part", "place", "before")


def resample(
    docs: DataFrame, target: DataFrame, *, longest: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: int = 2024
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs(doc_id, text)``; rank is null where it isn't drawn.

    Of the N rows with at least ``least_words`` words, floor(percent * N / 100) are drawn.
    """
    gains = bucket_gains(docs, target, longest=longest, buckets=buckets)
    scored = weighed(docs, gains, longest=longest).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = saved(scored, "importance-scored")
    fit = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")]
    inside = ranked(scored.where(fit), order)
    drawn = percent * scored.where(fit).count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.where(~fit).withColumn("rank", F.lit(None).cast("bigint"))
    return inside.withColumn("rank", rank).unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def resampled_documents(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns; a drawn id brings the rows that share it."""
    drawn = resample(docs, target, **settings).where(F.col("rank").isNotNull()).select("doc_id").distinct()
    return docs.join(drawn, "doc_id", "left_semi")


def shares(texts: DataFrame, *, longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """The share of each bucket in the features of ``texts(text)``, to compare a draw with its target."""
    rows = bucket_counts(texts, longest=longest, buckets=buckets).collect()
    out = np.zeros(buckets)
    out[[r["bucket"] for r in rows]] = [r["n"] for r in rows]
    return out / max(out.sum(), 1.0)
