"""Mixing sources to target weights by Pareto order sampling.

Each source gets a word target. Inside a source a document of size ``s`` is expected ``e`` times, in proportion to the
square root of its size class and at most ``cap`` times. ``floor(e)`` copies are certain. For the rest, ``p``, the documents
are put in the order of the Pareto key ``(u / (1 - u)) / (p / (1 - p))``, ``u`` uniform from a hash of the row, and the
first ones are taken until the source's words come nearest to its target.

Nothing is sorted or gathered by source: size classes and key ranges are summed up before the shuffle, and the place where
to stop is found by four rounds of 256 key ranges each. Rows never move.

Defined results: null text or text without words has size 0 and is never taken; null source is a source of its own, last in
order; rows that are the same in doc_id, source and text share a key and are taken or left together; an empty table gives
an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.store import packed, saved, unpacked

WORD = r"[^\x20\x09-\x0D]+"
CLASSES_PER_DOUBLING = 4
LEVELS, RANGES = 4, 256
SEED = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(*columns: Column) -> Column:
    bits = F.xxhash64(F.lit(SEED), *columns).bitwiseAND(F.lit((1 << 52) - 1))
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def _size_class(size: Column) -> Column:
    return F.when(size > 0, F.floor(F.log2(size) * CLASSES_PER_DOUBLING).cast("int"))


def _measure(size_class: Column) -> Column:
    return F.pow(F.lit(2.0), size_class / F.lit(2.0 * CLASSES_PER_DOUBLING))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources are ranked by code point, null last, over range partitions, and take the weights in turn. Targets start in
    proportion to the weights; one above ``cap`` times its source's size is set to that, and the rest is shared again.
    """
    grouped = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranged = saved(
        grouped.repartitionByRange(8, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "mix-sources"
    )
    before = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") + F.col("before")) % len(weights) + 1).cast("int"))
    ranked = saved(
        ranged.withColumn("place", place).join(before, "part").select("source", "source_size", weight.alias("weight")), "mix-weights"
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    factor, full = 0.0, F.lit(False)
    while True:
        size = F.col("source_size")
        free, held = ranked.agg(
            F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, size))
        ).first()
        if not free:
            break
        factor = (share * total - cap * (held or 0)) / free
        above = full | (F.lit(factor) * F.col("weight") > F.lit(cap) * size)
        if not ranked.where(above & ~full).limit(1).count():
            break
        full = above
    target = F.when(full, F.lit(cap) * F.col("source_size")).otherwise(F.lit(factor) * F.col("weight"))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _expected(sizes: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """(source, size_class, expected): copies of each document, from word sums by size class."""
    classes = sizes.where("size > 0").groupBy("source", _size_class(F.col("size")).alias("size_class")).agg(F.sum("size").alias("words"))
    t = targets.select(F.col("source").alias("of"), "target")
    classes = classes.join(t, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    classes = classes.withColumn("measure", _measure(F.col("size_class")))
    larger = Window.partitionBy("source").orderBy(F.desc("size_class")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("source")
    taken = F.coalesce(F.sum("words").over(larger), F.lit(0))
    rest = F.sum(F.col("measure") * F.col("words")).over(everything) - F.coalesce(
        F.sum(F.col("measure") * F.col("words")).over(larger), F.lit(0.0)
    )
    classes = classes.withColumn("scale", (F.col("target") - F.lit(cap) * taken) / rest)
    fits = F.col("scale") * F.col("measure") <= cap
    scale = F.max_by(F.when(fits, F.col("scale")), F.when(fits, F.col("size_class"))).over(everything)
    expected = F.greatest(F.lit(0.0), F.least(F.lit(cap), F.coalesce(scale * F.col("measure"), F.lit(cap))))
    return classes.select("source", "size_class", "words", expected.alias("expected"))


def _pareto_rank(expected: Column, u: Column) -> Column:
    """The Pareto key as a number of LEVELS bytes; null where no draw is needed."""
    p = expected - F.floor(expected)
    odds = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, F.floor(odds / (1 + odds) * F.lit(float(RANGES**LEVELS))).cast("bigint"))


def _keyed(sized: DataFrame, expected: DataFrame) -> DataFrame:
    e = expected.select(F.col("source").alias("of"), F.col("size_class").alias("of_class"), "expected")
    joined = sized.withColumn("size_class", _size_class(F.col("size"))).join(
        e, F.col("source").eqNullSafe(F.col("of")) & (F.col("size_class") == F.col("of_class")), "left"
    )
    return joined.drop("of", "of_class", "size_class").withColumn("rank", _pareto_rank(F.col("expected"), F.col("u")))


def _cutoffs(keyed: DataFrame, expected: DataFrame) -> DataFrame:
    """(source, cutoff): ranks below the cutoff are drawn; its words come nearest to what the certain copies leave."""
    left = expected.groupBy("source").agg(F.sum((F.col("expected") - F.floor("expected")) * F.col("words")).alias("wanted"))
    state = saved(left.withColumn("prefix", F.lit(0).cast("bigint")), "mix-cut")
    draws = keyed.where(F.col("rank").isNotNull())
    for level in range(LEVELS):
        width = RANGES ** (LEVELS - level - 1)
        s = state.select(F.col("source").alias("of"), "prefix", "wanted")
        inside = draws.join(
            s, F.col("source").eqNullSafe(F.col("of")) & (F.floor(F.col("rank") / F.lit(width * RANGES)) == F.col("prefix"))
        )
        sums = inside.groupBy("source", F.floor(F.col("rank") / F.lit(width)).alias("range"), "wanted").agg(F.sum("size").alias("words"))
        before = F.sum("words").over(Window.partitionBy("source").orderBy("range")) - F.col("words")
        sums = sums.withColumn("before", before)
        reached = sums.where(F.col("before") <= F.col("wanted")).groupBy("source").agg(
            F.max_by(F.struct("range", "words", (F.col("wanted") - F.col("before")).alias("wanted")), "range").alias("at")
        )
        state = saved(reached.select("source", F.col("at.wanted").alias("wanted"), F.col("at.range").alias("prefix"), F.col("at.words").alias("words")), "mix-cut")
    nearer = F.col("words") <= 2 * F.col("wanted")
    return state.select("source", (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("cutoff"))


def _copies(keyed: DataFrame, cutoffs: DataFrame) -> DataFrame:
    c = cutoffs.select(F.col("source").alias("of"), "cutoff")
    drawn = F.coalesce((F.col("rank") < F.col("cutoff")).cast("int"), F.lit(0))
    copies = (F.coalesce(F.floor("expected"), F.lit(0)) + drawn).cast("int")
    return keyed.join(c, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("copies", copies).drop("of", "cutoff")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` with size, source_size, target and the copies the mix takes of it."""
    key = uniform(F.col("doc_id"), F.col("source"), F.col("text"))
    sized = packed(docs, source=F.col("source"), size=word_count(F.col("text")), u=key)
    narrow = saved(sized.select("source", "size", "u"), "mix-sizes")
    targets = saved(source_targets(narrow, weights, share, cap), "mix-targets")
    expected = saved(_expected(narrow, targets, cap), "mix-expected")
    cutoffs = _cutoffs(_keyed(narrow, expected), expected)
    t = targets.withColumnRenamed("source", "its")
    marked = _copies(_keyed(sized, expected), cutoffs)
    return marked.join(t, F.col("source").eqNullSafe(F.col("its")), "left").select("row", "size", "source_size", "target", "copies")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns of ``docs``."""
    mixed = mix_sources(docs, **settings).where("copies > 0")
    return unpacked(mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")))
