"""Line dedup by a log-template tree.

Each line is parsed to a fixed depth: its token count, then its leading tokens, lead to a leaf. Inside a leaf a line stands
for up to four templates. In the first, tokens with digits are variable fields. In each of the others, one third of the
tokens after the leading ones is a variable field too, so lines that differ in one place meet in one of them. A template that
recurs across documents is boilerplate, and its lines are dropped.

Copies of whole documents are no boilerplate. Every text has a sketch: two bits of each of 128 minima over its shingles, which
are those of the near duplicates. A document is a copy of the first one with the template if 109 lanes agree, as they do on
average from a likeness of 0.8 on, the one at which near duplicates are linked; at 0.7 one document in fifty passes as a copy,
at 0.9 one in five hundred does not. A template must have enough documents besides the copies of its first one, see
``LEAST_DOCUMENTS``. Where these are at least half of its documents, all of them lose the line, otherwise
only these do.

Templates are counted by hash, summed up before the shuffle. Only lines of recurring templates are looked at again, and the
texts move once, to meet the places of their dropped lines.

Defined results: null stays null, an empty text empty; a line without words is never dropped, nor is the only line with words
of a text, which counts as a document of its template nevertheless; a text that loses all its lines becomes empty, its row stays; equal rows lose the same lines; an empty table stays empty;
other columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.minhash import shingle_sets
from shelfcast.llm.store import arrow_rows, discard, packed, saved
from shelfcast.llm.text import buffer_of, column, lines_of, mix, pieces, prefix_sums, span_hashes, split_words

LEADING, FIELDS, LEAST_GENERAL = 3, 3, 9
SHINGLE, LANES, ALIKE = 5, 128, 109
LENGTHS = (3, 8, 20)  # tokens at which the next class begins
#: Documents a template must be in by class of length: short lines recur by chance. One more is asked for with a variable third.
#: The numbers do not grow with the corpus, so other documents never bring a dropped line back.
LEAST_DOCUMENTS = (100, 10, 3, 2)
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_FIELD = np.uint64(0x5851F42D4C957F2D)
_LANE_BITS = mix(np.arange(1, LANES + 1, dtype=np.uint64))
_LANE_FACTORS = mix(np.arange(LANES + 1, 2 * LANES + 1, dtype=np.uint64)) | np.uint64(1)


def _sketches(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two bits of each of LANES minima over each text's shingles, 32 to a 64-bit number; 0 for a text without words."""
    out = np.zeros((len(bounds) - 1, LANES // 32), np.uint64)
    full = bounds[1:] > bounds[:-1]
    starts = bounds[:-1][full]
    for lane in range(LANES if len(starts) else 0):
        low = mix(np.minimum.reduceat((keys ^ _LANE_BITS[lane]) * _LANE_FACTORS[lane], starts)) & np.uint64(3)
        out[full, lane // 32] |= low << np.uint64(2 * (lane % 32))
    return out


def parse(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines with words: text, place in the text, template key, and FIELDS general keys (0 for short lines).

    The two lowest bits of a key tell its length class; bit 2 tells a general one. Last, each text's sketch.
    """
    data, bounds = buffer_of(texts)
    words = split_words(data, bounds)
    hashes = span_hashes(prefix_sums(data), words.starts, words.ends)
    sketches = _sketches(*shingle_sets(texts, SHINGLE))
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data], dtype=np.int64)])
    hashes[digits[words.ends] > digits[words.starts]] = _FIELD
    starts, ends, text = lines_of(data, bounds)
    first_line = np.searchsorted(text, np.arange(len(bounds) - 1))
    place = np.arange(len(text)) - first_line[text]
    lo, hi = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    worded = hi > lo
    lo, hi, text, place = lo[worded], hi[worded], text[worded], place[worded]
    n = hi - lo
    sums = prefix_sums(hashes)
    length = np.searchsorted(LENGTHS, n, "right").astype(np.uint64)

    def tagged(key: np.ndarray, general: int) -> np.ndarray:
        return (key & ~np.uint64(7)) | np.uint64(4 * general) | length

    keys = tagged(span_hashes(sums, lo, hi), 0)
    lead = np.minimum(lo + LEADING, hi)
    leaf = mix(span_hashes(sums, lo, lead) + n.astype(np.uint64))
    cuts = [lead + (hi - lead) * j // FIELDS for j in range(FIELDS + 1)]
    parts = [mix(span_hashes(sums, cuts[j], cuts[j + 1]) + np.uint64(j + 1)) for j in range(FIELDS)]
    whole = leaf + sum(parts[1:], parts[0])
    general = np.stack([tagged(mix(whole - parts[j] + np.uint64(1000 + j)), 1) for j in range(FIELDS)], 1)
    general[n < LEAST_GENERAL] = 0
    return text, place, keys, general, sketches


def _parsed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, places, keys, general, sketch) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def lists(text: np.ndarray, values: np.ndarray, width: int, n: int) -> pa.Array:
        offsets = np.searchsorted(text, np.arange(n + 1)) * width
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.ravel()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in pieces(column(batch, "text")):
                part = batch.slice(at, to - at)
                text, place, keys, general, sketches = parse(column(part, "text"))
                n = to - at
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "doc_id"), column(part, "text_key"), lists(text, place.astype(np.int32), 1, n),
                        lists(text, keys.view(np.int64), 1, n), lists(text, general.view(np.int64), FIELDS, n),
                        lists(np.arange(n), sketches.view(np.int64), LANES // 32, n),
                    ],
                    ["doc_id", "text_key", "places", "keys", "general", "sketch"],
                )

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return keyed.mapInArrow(
        run, f"doc_id {kind}, text_key bigint, places array<int>, keys array<bigint>, general array<bigint>, sketch array<bigint>"
    )


def _least() -> Column:
    """How many documents the template of a key must be in."""
    needed = F.array(*[F.lit(n) for n in LEAST_DOCUMENTS])
    return F.get(needed, F.col("key").bitwiseAND(F.lit(3)).cast("int")) + (F.col("key").bitwiseAND(F.lit(4)) / 4).cast("int")


def _alike() -> Column:
    """The row's sketch agrees with that of the first document of its template."""
    unlike = []
    for i in range(LANES // 32):
        differ = F.get("sketch", F.lit(i)).bitwiseXOR(F.get("first_sketch", F.lit(i)))
        unlike.append(F.bit_count(differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(0x5555555555555555))))
    return sum(unlike[1:], unlike[0]) <= LANES - ALIKE


def _dropped_places(parsed: DataFrame) -> DataFrame:
    """(doc_id, text_key, drop): the places of the lines to drop, for each text that loses some."""
    every = parsed.select(F.explode(F.array_distinct(F.concat("keys", "general"))).alias("key")).where("key <> 0")
    # Tables that are joined by key are written first: between two plain exchanges Spark can split a key with very many rows.
    recurring = saved(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= _least()), "lines-recurring")
    several = (F.size("keys") > 1).alias("several")
    lines = parsed.select("row_id", "sketch", several, "general", "places", F.posexplode("keys").alias("i", "own"))
    at = F.col("i")
    lines = lines.select(
        "row_id", "sketch", "several", F.get("places", at).alias("place"),
        F.explode(F.array(F.col("own"), *[F.get("general", at * FIELDS + j) for j in range(FIELDS)])).alias("key"),
    ).where("key <> 0")
    seen = saved(lines.join(recurring, "key"), "lines-seen")
    first = seen.groupBy("key").agg(F.min(F.struct("row_id", "sketch")).alias("one")).select("key", F.col("one.sketch").alias("first_sketch"))
    first = saved(first, "lines-first")
    judged = saved(seen.join(first, "key").select("key", "row_id", "several", "place", "n", (~_alike()).alias("other")), "lines-judged")
    others = judged.where("other").select("key", "row_id", "n").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("others"), F.first("n").alias("n"))
    templates = others.where(F.col("others") + 1 >= _least()).select("key", (2 * F.col("others") >= F.col("n")).alias("from_all"))
    templates = saved(templates, "lines-templates")
    hits = judged.where("several").join(templates, "key").where(F.col("other") | F.col("from_all"))
    hits = hits.groupBy("row_id").agg(F.collect_set("place").alias("drop"))
    texts = parsed.select("row_id", "doc_id", "text_key").join(hits, "row_id").select("doc_id", "text_key", "drop")
    drops = saved(texts.dropDuplicates(["doc_id", "text_key"]), "lines-drops")
    discard(parsed, recurring, seen, first, judged, templates)
    return drops


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as a struct ``row``, with ``lines``, ``dropped`` and the text that is ``left``."""
    arrow_rows(docs.sparkSession, 500)
    parsed = saved(_parsed(docs).withColumn("row_id", F.monotonically_increasing_id()), "lines-parsed")
    drops = _dropped_places(parsed).select(F.col("doc_id").alias("its"), F.col("text_key").alias("its_key"), "drop")
    whole = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    joined = whole.join(drops, (F.xxhash64("text") == F.col("its_key")) & F.col("doc_id").eqNullSafe(F.col("its")), "left")
    joined = joined.withColumn("parts", F.split("text", "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "drop")  # by a hash set, in order
    left = F.array_join(F.transform(places, lambda i: F.get("parts", i)), "\n")
    return joined.select(
        "row", F.coalesce(F.size("parts"), F.lit(0)).cast("bigint").alias("lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("bigint").alias("dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(left).alias("left"),
    )


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of the texts."""
    done = dedup_lines(docs)
    return done.select(*[(F.col("left") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
