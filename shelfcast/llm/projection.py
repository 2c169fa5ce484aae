"""Embedding near-duplicates by sorted projection passes.

In each pass a vector gets a row of random bits, the signs of its products with random planes, and the vectors of a label are
put in lexicographic order of these bits. Neighbours up to ``window`` places apart are compared exactly, over the borders of
partitions too; a pass passes on a spanning forest of the pairs it has verified, and the passes' forests are united.

The number of leading bits follows from the largest label. Two vectors at the threshold share them with a probability that
their angle alone gives, and passes are added until a pair is missed with ``miss`` at most. Where the bits split a label evenly,
a window holds all vectors that share them. Where they do not, as in dense groups or with vectors of a common direction, the
counts of each pass tell which groups exceed the window, and all vectors of such a group are compared block by block. A label
for which that is more work than all its pairs is compared whole, once: nothing is missed there, at the price of its square.
Vectors are not centred, as that would change the angles that the probability rests on.

Vectors of one component are then compared block by block, so that ``n_links`` counts all links inside the component and no
pair is ever written.

Equal vectors of a label become one row first. Cosines are computed in double precision.

Defined results: a vector that is null, empty, zero or holds a null or non-finite number, and one without label, is linked
with nothing; vectors of different lengths are never linked; equal rows are linked with each other; component_id is the
smallest vec_id that can be reached, null vec_ids left out; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.llm.store import arrow_rows, saved
from shelfcast.llm.text import column

BITS, AT_ONCE, BLOCK, WIDE = 48, 4, 512, 4096


def _units(raw: list[bytes] | pd.Series) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _checked(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, raw): raw holds the vector's doubles, null where it links with nothing."""
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for v, known in zip(column(batch, "embedding"), column(batch, "label").is_valid().to_pylist()):
                x = np.array(v.as_py(), float) if known and v.is_valid and len(v) and None not in v.as_py() else np.zeros(1)
                norm = math.sqrt(float(x @ x)) if np.isfinite(x).all() else 0.0
                raw.append((x + 0.0).tobytes() if 0 < norm < math.inf else None)
            yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), column(batch, "label"), pa.array(raw, pa.binary())], ["vec_id", "label", "raw"])

    kept = vectors.select("vec_id", "label", "embedding")
    return kept.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, raw binary")


def leading_bits(largest: int, window: int) -> int:
    """Bits that leave half a window of a label which they split evenly."""
    return min(BITS, math.ceil(math.log2(max(2.0, 2 * largest / window))))


def passes_needed(leading: int, cosine: float, miss: float) -> int:
    same = 1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    found = min(same**leading, 1 - 1e-9)
    return max(8, math.ceil(math.log(miss) / math.log(1 - found)))


def _ordered_bits(classes: DataFrame, passes: range) -> DataFrame:
    """One row for each class and pass, with the pass's bits as a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = column(batch, "raw").to_pylist()
            widths = np.array([len(r) // 8 for r in raw])
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                unit = _units([raw[i] for i in at])
                part = batch.take(pa.array(at))
                for p in passes:
                    planes = np.random.Generator(np.random.PCG64([p, int(width)])).standard_normal((int(width), BITS))
                    bits = (unit @ planes > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [column(part, "class"), column(part, "space"), column(part, "raw"), pa.array(np.full(len(at), p, np.int32)), pa.array(bits)],
                        ["class", "space", "raw", "pass", "bits"],
                    )

    return classes.select("class", "space", "raw").mapInArrow(run, "class bigint, space bigint, raw binary, pass int, bits bigint")


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of pairs that connect what those before leave apart."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    used = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            used.append(i)
    return used


def _near(ids: np.ndarray, groups: np.ndarray, raw: list[bytes], window: int, cosine: float, fresh: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of a sorted run, at most ``window`` places apart, of which the later is at ``fresh`` or after."""
    found_a, found_b = [], []
    cuts = np.flatnonzero(groups[1:] != groups[:-1]) + 1
    for start, end in zip(np.append(0, cuts), np.append(cuts, len(ids))):
        unit = _units(raw[start:end])
        for apart in range(1, min(window, end - start - 1) + 1):
            hit = np.flatnonzero(np.einsum("ij,ij->i", unit[:-apart], unit[apart:]) >= cosine)
            hit = hit[hit + apart + start >= fresh]
            found_a.append(ids[hit + start])
            found_b.append(ids[hit + start + apart])
    a = np.concatenate(found_a) if found_a else np.empty(0, np.int64)
    b = np.concatenate(found_b) if found_b else np.empty(0, np.int64)
    used = _forest(a, b)
    return a[used], b[used]


def _neighbours(rows: DataFrame, window: int, cosine: float) -> DataFrame:
    """(a, b): verified pairs of near places in the order of (space, pass, bits)."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism * 2
    ranged = rows.repartitionByRange(tasks, "space", "pass", "bits", "class").sortWithinPartitions("space", "pass", "bits", "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tail: pa.Table | None = None
        head_left = window

        def seam(table: pa.Table, side: int) -> list[pa.RecordBatch]:
            n = len(table)
            table = table.append_column("a", pa.array([None] * n, pa.int64())).append_column("b", pa.array([None] * n, pa.int64()))
            table = table.append_column("seam", pa.array(np.full(n, part + side, np.int64))).append_column("place", pa.array(np.arange(n) + side * window * -2))
            return table.to_batches()

        def group_of(table: pa.Table) -> np.ndarray:
            space, turn = (table.column(c).to_numpy() for c in ("space", "pass"))
            return space * 4096 + turn

        for batch in batches:
            table = pa.Table.from_batches([batch]).select(["class", "space", "raw", "pass"])
            if head_left > 0:
                yield from seam(table.slice(0, head_left), 0)
                head_left -= min(head_left, len(table))
            fresh = 0 if tail is None else len(tail)
            both = table if tail is None else pa.concat_tables([tail, table])
            a, b = _near(both.column("class").to_numpy(), group_of(both), both.column("raw").to_pylist(), window, cosine, fresh)
            empty = pa.nulls(len(a))
            yield pa.RecordBatch.from_arrays(
                [empty.cast(pa.int64()), empty.cast(pa.int64()), empty.cast(pa.binary()), empty.cast(pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), empty.cast(pa.int64()), empty.cast(pa.int64())],
                ["class", "space", "raw", "pass", "a", "b", "seam", "place"],
            )
            tail = both.slice(max(0, len(both) - window))
        if tail is not None:
            yield from seam(tail, 1)

    out = saved(ranged.mapInArrow(run, "class bigint, space bigint, raw binary, pass int, a bigint, b bigint, seam bigint, place bigint"), "projection-pass")

    def over_seam(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        ids, groups = frame["class"].to_numpy(np.int64), frame["space"].to_numpy(np.int64) * 4096 + frame["pass"].to_numpy(np.int64)
        a, b = _near(ids, groups, [bytes(r) for r in frame["raw"]], window, cosine, 0)
        return pd.DataFrame({"a": a, "b": b})

    seams = out.where("seam is not null").groupBy("seam").applyInPandas(over_seam, "a bigint, b bigint")
    return out.where("a is not null").select("a", "b").union(seams)


def _wide_groups(rows: DataFrame, leading: int, window: int) -> DataFrame:
    """(space, pass, prefix, n): groups that share the leading bits and are more than a window covers."""
    prefix = F.shiftright("bits", BITS - leading).alias("prefix")
    return rows.groupBy("space", "pass", prefix).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > window + 1)


def _inside(rows: DataFrame, groups: DataFrame, keys: list[str], cosine: float) -> DataFrame:
    """(a, b): pairs that connect what is linked inside the groups, whose sizes are ``n``; all their vectors are compared.

    Groups are cut into blocks of about WIDE classes, and each pair of blocks is worked on by itself.
    """
    blocks = F.ceil(F.col("n") / WIDE)
    own = F.pmod(F.xxhash64("class"), blocks)
    spread = rows.join(groups, keys).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    spread = spread.select(*keys, "class", "raw", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("is_low"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        unit, ids, left = _units([bytes(r) for r in frame["raw"]]), frame["class"].to_numpy(np.int64), frame["is_low"].to_numpy()
        same = frame["low"].iloc[0] == frame["high"].iloc[0]
        first, second = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(left), np.flatnonzero(~left))
        a = b = np.empty(0, np.int64)
        for at in range(0, len(first), BLOCK):
            x, y = np.nonzero(unit[first[at : at + BLOCK]] @ unit[second].T >= cosine)
            x, y = first[at + x], second[y]
            a, b = np.append(a, ids[x[x != y]]), np.append(b, ids[y[x != y]])
            used = _forest(a, b)
            a, b = a[used], b[used]
        return pd.DataFrame({"a": a, "b": b})

    return spread.groupBy(*keys, "low", "high").applyInPandas(compare, "a bigint, b bigint")


def _link_counts(members: DataFrame, cosine: float) -> DataFrame:
    """(class, others): for each class of a component the vectors of other classes linked to it.

    Components are cut into blocks of about BLOCK classes; each pair of blocks is one product of two small matrices.
    """
    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("class"), blocks)
    spread = members.join(sizes, "label").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    spread = spread.select(
        "label", "class", "raw", "copies", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("is_low"),
    )

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        unit, copies = _units([bytes(r) for r in frame["raw"]]), frame["copies"].to_numpy(np.int64)
        left = frame["is_low"].to_numpy()
        others = np.zeros(len(frame), np.int64)
        if frame["low"].iloc[0] == frame["high"].iloc[0]:
            for at in range(0, len(unit), BLOCK):
                near = unit[at : at + BLOCK] @ unit.T >= cosine
                near[np.arange(len(near)), at + np.arange(len(near))] = False
                others[at : at + BLOCK] = near @ copies
        else:
            near = unit[left] @ unit[~left].T >= cosine
            others[left], others[~left] = near @ copies[~left], copies[left] @ near
        return pd.DataFrame({"class": frame["class"], "others": others})

    counted = spread.groupBy("label", "low", "high").applyInPandas(count, "class bigint, others bigint")
    return counted.groupBy("class").agg(F.sum("others").alias("others"))


def near_vectors(vectors: DataFrame, *, cosine: float = 0.98, window: int = 32, miss: float = 1e-6) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors(vec_id, embedding, label)``."""
    spark = vectors.sparkSession
    arrow_rows(spark, 4096)
    checked = saved(_checked(vectors), "projection-vectors")
    grouped = checked.where("raw is not null").groupBy("label", "raw").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("lowest"))
    space = F.pmod(F.xxhash64("label", F.length("raw")), F.lit(1 << 48))
    classes = saved(grouped.withColumn("class", F.monotonically_increasing_id()).withColumn("space", space), "projection-classes")
    spaces = classes.groupBy("space").agg(F.count(F.lit(1)).alias("n"))
    largest = spaces.agg(F.max("n")).first()[0] or 0
    leading = leading_bits(largest, window)
    passes = passes_needed(leading, cosine, miss)
    tried = saved(_ordered_bits(classes, range(min(passes, AT_ONCE))).drop("raw", "class"), "projection-bits")
    work = _wide_groups(tried, leading, window).groupBy("space").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("work"))
    whole = spaces.join(work, "space").where(F.col("work") * (passes / AT_ONCE) >= F.col("n").cast("double") * F.col("n"))
    whole = saved(whole.select("space", "n"), "projection-whole")
    links = saved(_inside(classes.select("space", "class", "raw"), whole, ["space"], cosine).distinct(), "projection-links")
    parted = classes.join(whole, "space", "left_anti")
    for at in range(0, passes, AT_ONCE):
        rows = _ordered_bits(parted, range(at, min(passes, at + AT_ONCE)))
        wide = saved(_wide_groups(rows, leading, window), "projection-wide")
        found = _neighbours(rows, window, cosine)
        prefixed = rows.withColumn("prefix", F.shiftright("bits", BITS - leading)).drop("bits")
        found = found.union(_inside(prefixed, wide, ["space", "pass", "prefix"], cosine))
        links = saved(links.union(found).distinct(), "projection-links")
    labels = components(links).withColumnRenamed("node", "class").withColumnRenamed("label", "group")
    members = saved(classes.join(labels, "class").select(F.col("group").alias("label"), "class", "raw", "copies", "lowest"), "projection-members")
    smallest = members.groupBy("label").agg(F.min("lowest").alias("component"))
    counts = _link_counts(members.drop("lowest"), cosine)
    known = members.join(smallest, "label").join(counts, "class", "left").select("class", "component", "others")
    final = classes.join(known, "class", "left").select(
        F.col("label").alias("of"), F.col("raw").alias("is"), F.coalesce("component", "lowest").alias("component"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"),
    )
    joined = checked.join(final, (F.col("label") == F.col("of")) & (F.col("raw") == F.col("is")), "left")
    component = F.when(F.col("is").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
