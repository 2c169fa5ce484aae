from __future__ import annotations

import numpy as np

from shelfcast.llm.projection import near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def exact(rows, cosine=0.98):
    unit = []
    for _, e, label in rows:
        x = np.array([np.nan if v is None else np.float32(v) for v in e], float) if e else np.zeros(1)
        n = np.sqrt((x * x).sum())
        unit.append(x / n if label is not None and np.isfinite(x).all() and n > 0 else None)
    links = [{j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine} for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((rows[i][0], len(links[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def found(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_links(spark):
    draw = np.random.Generator(np.random.PCG64(5))
    rows, n = [], 0
    for label in range(3):
        for size in [1] * 60 + [2] * 10 + [7, 30, 700 if label == 0 else 40]:
            base = draw.standard_normal(32)
            for _ in range(size):
                rows.append((n * 7 % 10007, (base + draw.standard_normal(32) * 0.09).tolist(), label))
                n += 1
    rows += [(20000 + i, rows[i * 5][1], rows[i * 5][2]) for i in range(40)]  # exact copies
    assert found(near_vectors(spark.createDataFrame(rows, SCHEMA))) == exact(rows)


def with_common_direction(n, planted, dense):
    """Vectors with a mean cosine of about 0.9, pairs at about 0.981 with nothing near, and a dense group without links."""
    draw = np.random.Generator(np.random.PCG64(11))
    centre, width = draw.standard_normal(64), 64
    centre /= np.linalg.norm(centre)

    def around(middle, cosine, count):
        side = draw.standard_normal((count, width))
        side -= np.outer(np.einsum("ij,ij->i", side, np.broadcast_to(middle, side.shape)), 1) * middle if middle.ndim == 1 else np.einsum("ij,ij->i", side, middle)[:, None] * middle
        side /= np.linalg.norm(side, axis=1)[:, None]
        return cosine * middle + np.sqrt(1 - cosine**2) * side

    x = around(centre, np.sqrt(0.9), n)
    pairs = around(x[:planted], 0.981, planted)
    return np.concatenate([x, pairs, around(-centre, np.sqrt(0.97), dense)])


def test_common_direction_and_dense_groups(spark):
    x = with_common_direction(6000, 1500, 500).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(100_000 + i, v.tolist(), 1) for i, v in enumerate(np.random.Generator(np.random.PCG64(12)).standard_normal((300, 64)))]
    unit = x.astype(float)
    unit /= np.sqrt((unit * unit).sum(1))[:, None]
    links = (unit @ unit.T >= 0.98).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert links.sum() >= 3000 and [got[i] for i in range(len(x))] == links.tolist()


def test_dense_groups_in_an_even_label(spark):
    """The bits split this label, but for one group of 300 vectors a little below the threshold."""
    draw = np.random.Generator(np.random.PCG64(13))
    middle = draw.standard_normal(64)
    dense = middle + draw.standard_normal((300, 64)) * 0.16
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([draw.standard_normal((2500, 64)), dense, dense[:60] + draw.standard_normal((60, 64)) * 0.18]))]
    assert found(near_vectors(spark.createDataFrame(rows, SCHEMA), miss=1e-4)) == exact(rows)


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0], 0), (8, [1.0, None], 0),
        (9, [float("nan"), 1.0], 0), (10, [float("inf"), 1.0], 0), (None, [1.0, 0.01], 0), (12, [1.0, 0.0, 0.0], 0), (13, [-1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, None, None),
    ]
    assert found(near_vectors(spark.createDataFrame(rows, SCHEMA))) == exact(rows)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
