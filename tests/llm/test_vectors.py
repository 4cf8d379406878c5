"""Near duplicates among embeddings."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlytics.llm import vectors
from txnlytics.llm.vectors import Near


def all_pairs(rows, threshold):
    """(key, links, component, kept) of each row by comparing every pair in double precision."""

    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [k for k, (_, v) in enumerate(rows) if usable(v)]
    label, links = list(range(len(rows))), [0] * len(rows)

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for x in good:
        for y in good:
            a, b = np.array(rows[x][1], dtype=float), np.array(rows[y][1], dtype=float)
            if x < y and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                links[x] += 1
                links[y] += 1
                label[max(root(x), root(y))] = min(root(x), root(y))
    low = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            low[root(k)] = min(key, low.get(root(k), key))
    return sorted(((key, links[k], low.get(root(k)), key == low.get(root(k))) for k, (key, _) in enumerate(rows)), key=repr)


def made(seed, dim, centres, copies, noise):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(centres):
        centre = rng.normal(size=dim)
        for _ in range(rng.integers(1, copies)):
            out.append((centre + rng.normal(size=dim) * noise * rng.random()) * 10.0 ** rng.integers(-3, 4))
    return np.array(out, dtype=np.float32)


@pytest.mark.parametrize("rules", [Near(), Near(block_values=400, least_block=100, tile=7, chunk=5), Near(cosine=0.8, least_block=64)])
def test_links_equal_all_pairs(spark, rules):
    base = made(3, 8, 12, 14, 0.9)
    rows = [(100 + k, v.tolist()) for k, v in enumerate(base)]
    rows += [(5, rows[0][1]), (900, rows[0][1]), (100, rows[1][1]), (None, rows[2][1]), (None, [0.5] * 8)]
    rows += [(901, None), (902, []), (903, [0.0] * 8), (904, [-0.0] * 8), (905, [1.0] * 7 + [float("nan")]), (906, [float("inf")] * 8)]
    rows += [(907, [1.0, None] * 4), (908, [1.0, 2.0]), (909, [2.0, 4.0]), (910, [1e-30] * 8), (911, [3e30] * 8), (912, [1.0, -2.0])]
    rows = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n_links", F.lit("clash")).repartition(5)
    got = vectors.near_vectors(df, rules=rules)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == all_pairs(rows, rules.cosine)


def test_error_bounds_hold_for_any_vectors():
    rng = np.random.default_rng(4)
    for dim in (1, 2, 64, 300, 1500):
        x = rng.normal(size=(200, dim)) * np.where(rng.random((200, dim)) < 0.1, 50, 1)
        codes, scale, error = vectors.quantise(x)
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        assert (np.linalg.norm(unit - codes * scale[:, None], axis=1) <= error).all()
        a, b = vectors.Side(x[:100]), vectors.Side(x[100:])
        upper = (a.codes @ b.codes.T) * a.scale[:, None] * b.scale + a.error[:, None] + (1 + a.error[:, None]) * b.error
        assert (upper + vectors._SLACK >= unit[:100] @ unit[100:].T).all()


def test_tiny_tables_and_bad_thresholds(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id int, embedding array<double>")
    assert [tuple(r) for r in vectors.near_vectors(df).collect()] == [(1, 0, 1, True)]
    assert vectors.near_vectors(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        Near(cosine=0.0)
