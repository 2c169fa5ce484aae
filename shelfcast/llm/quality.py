"""Quality rules as a short-circuit cascade.

The counts that every text gets are vectorised over Arrow batches. The rules which decide about the rest are run in an order
worked out from a sample: seconds per row and share of rows rejected are measured for each rule, and the rule that rejects
most per second comes first. A later rule only sees the texts that all earlier ones let through. The order changes the cost,
never the verdict.

Defined results: null and empty texts have no words, all counts 0, and fail the base rules; text without a letter fails;
texts are read whole; repeated rows get the same verdict; an empty sample leaves the rules in their listed order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.store import arrow_rows
from shelfcast.llm.text import buffer_of, column, lines_of, mix, pieces, prefix_sums, span_hashes, split_words

LEAST_WORDS, MOST_REPEATED = 50, 50  # words; percent
_NOT_CONTINUED = np.array([b & 0xC0 != 0x80 for b in range(256)])
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _by_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: the key occurs elsewhere too; the key occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    before[order[1:][same]] = True
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again, before


def base_counts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    words = split_words(data, bounds)
    sums = prefix_sums(data)
    hashes, text = span_hashes(sums, words.starts, words.ends), words.text_of
    covered = np.zeros(len(hashes), bool)
    if len(hashes) > 2:
        whole = text[2:] == text[:-2]
        key = mix(hashes[:-2] * np.uint64(3) + mix(hashes[1:-1] * np.uint64(5) + mix(hashes[2:] + text[2:].astype(np.uint64))))
        at = np.flatnonzero(whole)
        found = at[_repeats(key[at])[0]]
        for shift in range(3):
            covered[found + shift] = True
    starts, ends, line_text = lines_of(data, bounds)
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, line_text = starts[worded], ends[worded], line_text[worded]
    _, before = _repeats(mix(span_hashes(sums, starts, ends) + line_text.astype(np.uint64)))
    n = len(bounds) - 1
    word_bytes = np.concatenate([[0], np.cumsum(_NOT_CONTINUED[data], dtype=np.int64)])
    chars = word_bytes[words.ends] - word_bytes[words.starts]
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": np.bincount(text, chars, n).astype(np.int64),
        "n_symbols": _by_text(_SYMBOL[data], bounds),
        "n_dup_lines": np.bincount(line_text, before, n).astype(np.int64),
        "n_repeat_words": np.bincount(text, covered, n).astype(np.int64),
        "n_lines": np.bincount(line_text, minlength=n).astype(np.int64),
    }


@dataclass
class Rows:
    """Some rows of a batch: their counts, and their bytes once a rule asks for them."""

    texts: pa.Array
    counts: dict[str, np.ndarray]
    index: np.ndarray

    def __getitem__(self, name: str) -> np.ndarray:
        return self.counts[name][self.index]

    def raw(self) -> tuple[np.ndarray, np.ndarray]:
        whole = len(self.index) == len(self.texts)
        return buffer_of(self.texts if whole else self.texts.take(pa.array(self.index)))


def _many_symbols(rows: Rows) -> np.ndarray:
    return 10 * rows["n_symbols"] > rows["n_words"]


def _odd_word_length(rows: Rows) -> np.ndarray:
    return (2 * rows["word_chars"] < 5 * rows["n_words"]) | (rows["word_chars"] > 12 * rows["n_words"])


def _repeated_lines(rows: Rows) -> np.ndarray:
    return 10 * rows["n_dup_lines"] > 3 * rows["n_lines"]


def _few_words_with_letters(rows: Rows) -> np.ndarray:
    data, bounds = rows.raw()
    words = split_words(data, bounds)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data], dtype=np.int64)])
    lettered = letters[words.ends] > letters[words.starts]
    return 10 * np.bincount(words.text_of, lettered, len(bounds) - 1) < 6 * words.counts


def _shouting(rows: Rows) -> np.ndarray:
    data, bounds = rows.raw()
    return 2 * _by_text(_UPPER[data], bounds) > _by_text(_LETTER[data], bounds)


def _lines_cut_off(rows: Rows) -> np.ndarray:
    """Most lines end in three dots or an ellipsis."""
    data, bounds = rows.raw()
    starts, ends, text = lines_of(data, bounds)
    full = ends - starts >= 3
    last = [np.where(full, data[np.maximum(ends - k, 0)] if len(data) else 0, 0) for k in (1, 2, 3)]
    dots = (last[0] == 46) & (last[1] == 46) & (last[2] == 46) | (last[0] == 0xA6) & (last[1] == 0x80) & (last[2] == 0xE2)
    n = len(bounds) - 1
    return 2 * np.bincount(text, dots, n) > np.bincount(text[ends > starts], minlength=n)


RULES: dict[str, Callable[[Rows], np.ndarray]] = {
    "many_symbols": _many_symbols,
    "odd_word_length": _odd_word_length,
    "repeated_lines": _repeated_lines,
    "few_words_with_letters": _few_words_with_letters,
    "shouting": _shouting,
    "lines_cut_off": _lines_cut_off,
}


def _base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])


def order_rules(docs: DataFrame, *, sample_rows: int = 2000) -> list[str]:
    """Rules by rejections per second, measured on about ``sample_rows`` rows drawn by hash of the text."""
    arrow_rows(docs.sparkSession, 500)
    n = docs.count()
    sample = docs.select("text")
    if n > sample_rows:
        sample = sample.where(F.pmod(F.xxhash64(F.lit(11), F.coalesce("text", F.lit(""))), F.lit(1 << 20)) < int((1 << 20) * sample_rows / n))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected = dict.fromkeys(RULES, 0.0), dict.fromkeys(RULES, 0)
        for batch in batches:
            for at, to in pieces(column(batch, "text")):
                texts = column(batch, "text").slice(at, to - at)
                counts = base_counts(*buffer_of(texts))
                rows = Rows(texts, counts, np.flatnonzero(~_base_failed(counts)))
                for name, rule in RULES.items():
                    begun = time.perf_counter()
                    rejected[name] += int(rule(rows).sum())
                    spent[name] += time.perf_counter() - begun
        yield pa.RecordBatch.from_pydict({"rule": list(RULES), "spent": list(spent.values()), "rejected": list(rejected.values())})

    measured = sample.mapInArrow(measure, "rule string, spent double, rejected bigint")
    totals = {r["rule"]: r for r in measured.groupBy("rule").agg(F.sum("spent").alias("spent"), F.sum("rejected").alias("rejected")).collect()}

    def worth(name: str) -> float:
        return (totals[name]["rejected"] + 0.1) / (totals[name]["spent"] + 1e-6) if name in totals else 0.0

    return sorted(RULES, key=worth, reverse=True)


RESULT = ", ".join(f"{c}: bigint" for c in COUNTS) + ", base_failed: boolean, kept: boolean"


def judged(texts: pa.Array, order: list[str]) -> pa.StructArray:
    """Counts and verdict of each text; rules run on what is left by those before."""
    counts = base_counts(*buffer_of(texts))
    failed = _base_failed(counts)
    left = np.flatnonzero(~failed)
    for name in order:
        if not len(left):
            break
        left = left[~RULES[name](Rows(texts, counts, left))]
    kept = np.zeros(len(texts), bool)
    kept[left] = True
    return pa.StructArray.from_arrays([*(pa.array(counts[c]) for c in COUNTS), pa.array(failed), pa.array(kept)], [*COUNTS, "base_failed", "kept"])


def quality_udf(order: list[str]):
    @F.arrow_udf(f"struct<{RESULT}>")
    def quality(texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts, "")
        done = [judged(texts.slice(at, to - at), order) for at, to in pieces(texts)]
        return pa.concat_arrays(done) if done else judged(texts, order)

    return quality


def judge_quality(docs: DataFrame, *, sample_rows: int = 2000, to: str = "quality") -> DataFrame:
    """``docs`` with a struct column of the counts, ``base_failed`` and ``kept``."""
    order = order_rules(docs, sample_rows=sample_rows)
    arrow_rows(docs.sparkSession, 500)
    return docs.withColumn(to, quality_udf(order)(F.col("text")))
